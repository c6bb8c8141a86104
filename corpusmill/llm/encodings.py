"""Search for the way back from text decoded with a wrong encoding.

States are texts.  A step decodes runs of characters as the UTF-8 bytes they
were made of, unescapes character references, or, as the last one, reads all
characters back into the bytes of one encoding and decodes those by another.
The search expands the most plausible text first, remembers the hashes of those
seen and ends when no text is left, so the way it returns is the cheapest of
all; plausibility is a cost of characters, trained on the corpus (see
``CharacterModel``).  All steps but the last shorten the text, so the states
are few.
"""

from __future__ import annotations

import codecs
import heapq
import html
import math
import re
import unicodedata
from collections import Counter
from functools import lru_cache

# Single-byte encodings in wide use for the languages of the corpus, and multi-byte ones.
SINGLE_BYTE = (
    "cp1252", "iso8859_1", "iso8859_15", "cp1250", "iso8859_2", "cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic",
    "cp1253", "iso8859_7", "cp737", "cp1254", "iso8859_9", "cp857", "mac_roman", "cp437", "cp850", "cp852",
)
MULTI_BYTE = ("cp932", "euc_jp")
#: Characters of a probe on which a way is sought before it is applied to the whole, and those that two windows share.
PROBE_CHARS, OVERLAP = 160, 32
#: Texts that one search looks at before it goes on with the halves of its piece; pieces of so few characters are searched to the end.
MOST_STATES, LEAST_PIECE = 2000, 24
#: Cost of a character that no sound text has, and the bound of the others.
BROKEN_COST, MOST_COST = 8.0, 6.0
#: A way is taken if it lowers the cost by this much, and to this share.
LEAST_GAIN, MOST_LEFT = 1.8, 0.5
#: A word is suspicious from this cost on.
SUSPICIOUS = 1.9
#: The search ends early at a text of so little cost; an encoding adds this for each one that is in wider use.
SOUND, RARER = 0.6, 0.04
#: Pairs of letters in this share of documents or more cost nothing; each tenth of it costs one, up to a bound.
PAIR_SHARE, MOST_PAIR = 10**-1.5, 3.0


@lru_cache(maxsize=None)
def decoding(name: str) -> str:
    """The characters of the 256 bytes; a byte without one stands for the control character of its number."""
    table = []
    for byte in range(256):
        try:
            char = bytes([byte]).decode(name)
        except UnicodeDecodeError:
            char = chr(byte)
        table.append(char)
    return "".join(table)


@lru_cache(maxsize=None)
def _upper(name: str) -> frozenset[str]:
    return frozenset(decoding(name)[128:])


@lru_cache(maxsize=None)
def _to_bytes(name: str) -> dict[int, int]:
    return {ord(c): i for i, c in enumerate(decoding(name)) if i >= 128}


@lru_cache(maxsize=None)
def _translation(read: str, write: str) -> dict[int, str]:
    source, target = decoding(read), decoding(write)
    return {ord(source[i]): target[i] for i in range(128, 256)}


@lru_cache(maxsize=None)
def utf8_runs(name: str, lowered: bool = False) -> re.Pattern:
    """Runs of characters that the encoding made of whole UTF-8 sequences of several bytes.

    With ``lowered`` the characters were lower-cased afterwards, which only
    shows in the first one of a sequence.
    """
    table = decoding(name)
    if lowered:
        table = table[:0xC2] + "".join(c.lower() if len(c.lower()) == 1 else c for c in table[0xC2:])
    chars = lambda a, b: "[" + "".join(re.escape(c) for c in dict.fromkeys(table[a : b + 1])) + "]"
    rest = chars(0x80, 0xBF)
    return re.compile(f"(?:{chars(0xC2, 0xDF)}{rest}|{chars(0xE0, 0xEF)}{rest}{{2}}|{chars(0xF0, 0xF4)}{rest}{{3}})+")


@lru_cache(maxsize=1)
def any_utf8_run() -> re.Pattern:
    return re.compile("|".join(f"(?:{utf8_runs(n).pattern[3:-2]})" for n in SINGLE_BYTE))


@lru_cache(maxsize=1)
def _stretches() -> re.Pattern:
    return re.compile("[" + re.escape("".join(sorted(set().union(*map(_upper, SINGLE_BYTE))))) + "]{2,}")


#: Runs of a Latin letter and a sign that never follows it in sound text, though the sign is no symbol.
_LETTER_AND_SIGN = re.compile("[Â-ß][¡¿ºª³²¹µ°·]|Ã\xa0")


@lru_cache(maxsize=200_000)
def _misread_stretch(stretch: str) -> bool:
    if _LETTER_AND_SIGN.search(stretch):
        return True
    for run in any_utf8_run().finditer(stretch):
        kinds = {char_kind(c) for c in stretch[max(0, run.start() - 1) : run.end() + 1]}
        if "S" in {char_kind(c) for c in run[0]} and kinds & set(LETTERS):
            return True
    return False


def misread(text: str) -> bool:
    """Whether a text has a mark of misreading that does not depend on how common its characters are.

    UTF-8 read by another encoding: such a run with a symbol in it, in or
    beside a word.  Single-byte encodings confused: letters of two scripts or
    a small letter and a capital beyond ASCII next to each other, or controls.
    """
    if _ODD.search(text):
        return True
    return any(_misread_stretch(text[max(0, m.start() - 1) : m.end() + 1]) for m in _stretches().finditer(text))


_ODD = re.compile(
    "[\x80-\x9f]|[A-Za-z\u00c0-\u024f][\u0370-\u04ff]|[\u0370-\u04ff][A-Za-z\u00c0-\u024f]|[\u0370-\u03ff][\u0400-\u04ff]|[\u0400-\u04ff][\u0370-\u03ff]"
    "|[a-z\u00df-\u00f6\u00f8-\u00ff][\u00c0-\u00d6\u00d8-\u00de]|[\u0430-\u044f][\u0410-\u042f]|[\u03b1-\u03c9][\u0391-\u03a9]"
)


@lru_cache(maxsize=None)
def _raised(name: str) -> dict[int, str]:
    """The upper-case forms of first characters of UTF-8 sequences that were lower-cased."""
    return {ord(c.lower()): c for c in decoding(name)[0xC2:0xF5] if len(c.lower()) == 1 and c.lower() != c}


def read_utf8(text: str, name: str, lowered: bool = False) -> str:
    """The text with every such run decoded as UTF-8."""
    table, first = _to_bytes(name), _raised(name)

    def decode(match: re.Match) -> str:
        run = match[0]
        if lowered:
            # a sequence begins wherever a character is no continuation
            run = "".join(first.get(ord(c), c) if not 0x80 <= table.get(ord(c), 0) <= 0xBF else c for c in run)
        try:
            return bytes(table[ord(c)] for c in run).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            return match[0]

    return utf8_runs(name, lowered).sub(decode, text)


class CharacterModel:
    """Plausibility cost of texts from the shares of documents that hold a character or a pair of letters.

    ``chars`` maps a character to the share of documents that hold it, for
    letters of other scripts than Latin of the documents in that script;
    ``pairs`` maps a pair of neighbouring lower-case letters of which one at
    least is not ASCII, with ``^`` and ``$`` for the ends of a run of letters,
    to its share in the same way.
    """

    def __init__(self, chars: dict[str, float], pairs: dict[str, float]):
        self.chars, self.pairs = chars, pairs
        self._char: dict[str, float] = {}
        self._word: dict[str, float] = {}

    def char_cost(self, char: str) -> float:
        known = self._char.get(char)
        if known is None:
            if char < "\x80" and (char >= " " or char in "\t\n\r\f\v"):
                known = 0.0
            elif char == "\ufffd" or unicodedata.category(char) in ("Cc", "Co", "Cn", "Cs"):
                known = BROKEN_COST
            else:
                share = max(self.chars.get(char, 0), self.chars.get(char.lower(), 0) / 4)
                known = max(0.0, min(MOST_COST, -math.log10(max(share, 1e-6)) - 1))
                if char_kind(char) == "S":
                    known = max(known, 0.5)
            self._char[char] = known
        return known

    def pair_cost(self, first: str, second: str) -> float:
        share = self.pairs.get(first + second, 0)
        return 0.0 if share >= PAIR_SHARE else min(MOST_PAIR, math.log10(PAIR_SHARE / max(share, 1e-9)))

    def cost(self, text: str) -> float:
        """Sum over the words of a text."""
        return sum(self.word_cost(w) for w in words_of(text) if not w.isascii())

    def word_cost(self, word: str) -> float:
        known = self._word.get(word)
        if known is None:
            known = self._measure(word)
            if len(word) < 64:
                if len(self._word) > 200_000:
                    self._word.clear()
                self._word[word] = known
        return known

    def _measure(self, word: str) -> float:
        """Characters, meetings of neighbours, and pairs: of Greek and Cyrillic letters each pair counts, of a Latin
        one the rarest of its own share and its two pairs."""
        lower = word.lower()
        if len(lower) != len(word):
            lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in word)
        kinds = [char_kind(c) for c in word]
        total, last = 0.0, len(word) - 1
        for i, char in enumerate(word):
            kind = kinds[i]
            before = kinds[i - 1] if i else ""
            after = kinds[i + 1] if i < last else ""
            if i and (char > "\x7f" or word[i - 1] > "\x7f"):
                total += self._meeting(word[i - 1], before, char, kind, after)
            if kind == "L":
                if char > "\x7f":
                    left = self.pair_cost(lower[i - 1] if before == "L" else "^", lower[i])
                    right = self.pair_cost(lower[i], lower[i + 1] if after == "L" else "$")
                    total += max(self.char_cost(char), left, right)
            elif kind in ("G", "C"):
                total += self.char_cost(char) + self.pair_cost(lower[i - 1] if before in ("G", "C") else "^", lower[i])
                if after not in ("G", "C"):
                    total += self.pair_cost(lower[i], "$")
            elif char > "\x7f":
                total += self.char_cost(char)
        return total

    def _meeting(self, before: str, kind_before: str, char: str, kind: str, after: str) -> float:
        """Cost of two neighbours of which one at least is not ASCII."""
        if kind in LETTERS and kind_before in LETTERS:
            if kind != kind_before:
                return 3.0
            return 1.5 if before.islower() and char.isupper() else 0.0
        if kind in LETTERS:
            return 2.0 if kind_before == "S" or before in _NOT_BEFORE or before in "\u00b2\u00b3\u00b9" else 0.75 if before == "\xa0" else 0.0
        if kind_before in LETTERS:
            closes = char == "\u201c" and after not in LETTERS
            return 2.0 if kind == "S" or char in _NOT_AFTER and not closes else 0.75 if char == "\xa0" else 0.0
        return 0.0


LETTERS = ("L", "G", "C", "J")
#: Punctuation that does not stand right before, or right after, a letter in running text.
_NOT_BEFORE, _NOT_AFTER = "”»–—…•†‡‰›", "“„«–—•†‡‰‹‚"
_SPACES = re.compile("[ \t\n\r\f\v\x1c-\x1f\u3000]+")


def words_of(text: str) -> list[str]:
    """The parts between plain spaces and line ends; other spaces belong to the words."""
    return _SPACES.split(text)


#: Signs that stand beside letters and figures in measures.
_MEASURES = "²³¹µ°ªº"


@lru_cache(maxsize=100_000)
def char_kind(char: str) -> str:
    """L, G, C or J for letters of the Latin, Greek, Cyrillic or another script, S for symbols, D for the rest."""
    if char.isascii():
        return "L" if char.isalpha() else "D"
    if char in _MEASURES:
        return "D"
    if char.isalpha():
        name = unicodedata.name(char, "")
        return "L" if name.startswith("LATIN") else "G" if name.startswith("GREEK") else "C" if name.startswith("CYRILLIC") else "J"
    category = unicodedata.category(char)
    return "S" if category[0] in "SC" or "\xa1" <= char <= "\xbf" and char not in "¡¿«»·" or category in ("Nl", "No", "Lo") else "D"


#: Character references.
_REFERENCE = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")


def steps_from(text: str):
    """Texts one shortening step away, each with the name of the step."""
    if _REFERENCE.search(text) and (plain := html.unescape(text)) != text:
        yield ("unescape", ""), plain
    if text.isascii():
        return
    forms = (False, True) if text == text.lower() else (False,)
    for read in SINGLE_BYTE:
        for lowered in forms:
            if utf8_runs(read, lowered).search(text) and (fixed := read_utf8(text, read, lowered)) != text:
                yield (read, "utf_8_lowered" if lowered else "utf_8"), fixed
    for read in MULTI_BYTE:
        data = _bytes_of(text, read)
        if data is not None and (other := decode_mostly(data, "utf_8")) is not None:
            yield (read, "utf_8"), other


def _bytes_of(text: str, name: str) -> bytes | None:
    try:
        return text.encode(name)
    except UnicodeEncodeError:
        return None


def last_steps(text: str):
    """Texts whose characters are the bytes of this one in another encoding, each with the name of the step."""
    outside = {c for c in text if c > "\x7f"}
    if not outside:
        return
    known = set()
    for read in (*SINGLE_BYTE, *MULTI_BYTE):
        if read in MULTI_BYTE:
            data = _bytes_of(text, read)
        else:
            data = text.translate(_to_bytes(read)).encode("latin-1") if outside <= _upper(read) else None
        if data is None or data in known:
            continue
        known.add(data)
        for write in SINGLE_BYTE if read not in MULTI_BYTE else ():
            if write != read and (other := codecs.charmap_decode(data, "strict", decoding(write))[0]) != text:
                yield (read, write), other
        for write in MULTI_BYTE:
            if write != read and (other := decode_mostly(data, write)) is not None:
                yield (read, write), other


def decode_mostly(data: bytes, name: str) -> str | None:
    """The decoded bytes, if all but a few at the ends or a twentieth of them make sense."""
    text = data.decode(name, "replace")
    return text if text.count("�") <= max(2, len(text) // 20) else None


def follow(text: str, way: tuple) -> str:
    """The text after the steps of a way; characters a step cannot read stay as they are."""
    for read, write in way:
        if read == "unescape":
            text = html.unescape(text)
        elif write.startswith("utf_8") and read not in MULTI_BYTE:
            text = read_utf8(text, read, write != "utf_8")
        elif read in MULTI_BYTE or write in MULTI_BYTE:
            if read in MULTI_BYTE:
                data = _bytes_of(text, read)
            else:
                outside = {c for c in text if c > "\x7f"}
                data = text.translate(_to_bytes(read)).encode("latin-1") if outside <= _upper(read) else None
            other = None if data is None else decode_mostly(data, write)
            text = text if other is None else other
        else:
            text = text.translate(_translation(read, write))
    return text


def _rarity(step: tuple[str, str]) -> float:
    """What a step adds to the cost of its text when it is compared with others."""
    return RARER * sum(_ORDER.get(name, 0) for name in step)


_ORDER = {name: place for place, name in enumerate((*SINGLE_BYTE, *MULTI_BYTE))}


def accepted(before: float, after: float) -> bool:
    """Whether a text of cost ``before`` was garbled, if a way leads to one of cost ``after``."""
    return before - after >= LEAST_GAIN and after <= MOST_LEFT * before


def cheapest(text: str, model: CharacterModel, states: int | None = None, enough: bool = False) -> tuple[float, tuple, str, bool]:
    """Cost, way and text of the most plausible text that can be reached, and whether all were looked at.

    The search ends after ``states`` texts, if that is given; with ``enough``
    it ends at the first text that proves the start to be garbled.
    """
    start = model.cost(_plain(text))
    best, rank = (start, (), text), start
    queue = [(start, 0, text, ())]
    seen = {hash(text)}
    while queue and rank >= SOUND and not (enough and accepted(start, best[0])):
        _, _, now, way = heapq.heappop(queue)
        for steps, goes_on in ((steps_from, True), (last_steps, False)):
            for step, other in steps(now):
                if hash(other) in seen:
                    continue
                seen.add(hash(other))
                price = model.cost(other)
                if price + _rarity(step) < rank - 1e-9:
                    best, rank = (price, (*way, step), other), price + _rarity(step)
                if goes_on:
                    # whole UTF-8 sequences hardly arise by chance
                    heapq.heappush(queue, (price / 4, len(seen), other, (*way, step)))
            if rank < SOUND:
                break
        if states and len(seen) > states:
            return *best, not queue
    return *best, True


#: A short quotation, such as of garbled characters as an example.
_QUOTED = re.compile(r"[“„«‘‚\"]\s?[^\s“”„«»\"]{1,8}\s?[”“»’\"]")
_REPLACED = "�"


def _plain(word: str) -> str:
    """The word with its character references unescaped."""
    return html.unescape(word) if "&" in word and _REFERENCE.search(word) else word


class Mender:
    """Finds garbled places of texts and mends what it can."""

    def __init__(self, model: CharacterModel):
        self.model, self.enough = model, False
        self._tried: dict[tuple[str, bool], tuple] = {}

    def examine(self, text: str, restore: bool = False) -> tuple[bool, str]:
        """Whether a text is garbled, and the text as far as it could be restored.

        Without ``restore`` the examination ends with the first proof.
        """
        self.enough = not restore
        if text.isascii() and not _REFERENCE.search(text):
            return False, text
        found = False
        while True:
            sound = _QUOTED.sub(self._unquote, text)
            found = found or _REPLACED in sound
            if found and self.enough:
                return True, text
            way = self._way(self._suspicious(sound))
            if not way:
                return found, text
            found = True
            if self.enough:
                return True, text
            mended = self._mend(text, way)
            if mended == text:
                return True, text
            text = mended

    def _suspicious(self, text: str) -> list[str]:
        """The different words that are not plausible; of words without a letter only those that UTF-8 may have made.

        A letter that stands alone can be cited: it counts only if it is Latin
        and stands so more than once, as a misread dash does.
        """
        cost = self.model.word_cost
        found = []
        for word, times in Counter(words_of(text)).items():
            plain = word if word.isascii() and "&" not in word else _plain(word)
            if plain.isascii() or _REPLACED in plain:
                continue
            if cost(plain) < SUSPICIOUS * (1 + plain.isupper()):
                continue
            letters = [c for c in plain if c.isalpha()]
            if len(letters) == 1 and letters[0] > "\x7f" and sum(c > "\x7f" for c in plain) == 1 and (times < 2 or char_kind(letters[0]) != "L"):
                continue
            if letters or any("\x7f" < c < "\xa0" for c in plain) or any_utf8_run().search(plain):
                found.append(word)
        return found

    def _unquote(self, match: re.Match) -> str:
        return " " if self.model.cost(_plain(match[0][1:-1])) >= 1 else match[0]

    def _way(self, words: list[str]) -> tuple:
        """A way that makes suspicious words plausible: sought for the costliest ones together, then for each alone."""
        cost = self.model.word_cost
        ranked = sorted(words, key=lambda w: (-cost(_plain(w)) / len(w) ** 0.5, w))
        probe, held = [], 0
        for word in ranked:
            if held + len(word) <= PROBE_CHARS:
                probe.append(word)
                held += len(word)
        joined = [" ".join(probe)] if len(probe) > 1 else []
        for piece in [*joined, *(p for w in ranked for p in pieces(w))]:
            if way := self._search(piece):
                return way
        return ()

    def _search(self, piece: str) -> tuple:
        """The way of one piece; where there are too many texts to look at, that of one of its overlapping halves."""
        before = self.model.cost(_plain(piece))
        if before < LEAST_GAIN:
            return ()
        way = self._tried.get((piece, self.enough))
        if way is None:
            after, way, _, complete = cheapest(piece, self.model, MOST_STATES if len(piece) > LEAST_PIECE else None, self.enough)
            if not accepted(before, after):
                middle, shared = len(piece) // 2, min(OVERLAP, len(piece) // 4) // 2
                way = () if complete else self._search(piece[: middle + shared]) or self._search(piece[middle - shared :])
            if len(self._tried) > 50_000:
                self._tried.clear()
            self._tried[piece, self.enough] = way
        return way

    def _mend(self, text: str, way: tuple) -> str:
        """The text with the way applied to every word, or part of a word, that it makes more plausible.

        A word that is as plausible either way goes with the ones around it.
        """
        cost = self.model.cost
        parts = re.split(f"({_SPACES.pattern})", text)
        places, changed = [], []
        for i, word in enumerate(parts):
            if word and (not word.isascii() or _plain(word) != word):
                for piece in dict.fromkeys([word, *pieces(word)]):
                    other = follow(piece, way)
                    if cost(other) >= SUSPICIOUS and other != piece:
                        # another way may suit this one better
                        own = follow(piece, self._search(piece))
                        other = own if cost(own) < cost(other) else other
                    if piece in parts[i] and cost(other) < cost(_plain(piece)) - 0.5:
                        parts[i] = parts[i].replace(piece, other)
                places.append(i)
                changed.append(parts[i] != word)
        last = len(places) - 1
        for n, i in enumerate(places):
            around = [changed[k] for k in (n - 1, n + 1) if 0 <= k <= last]
            if around and all(around) and not changed[n]:
                other = follow(parts[i], way)
                if cost(other) <= cost(parts[i]) + 0.5:
                    parts[i] = other
        return "".join(parts)


@lru_cache(maxsize=1)
def _foreign() -> re.Pattern:
    """Stretches of letters of single-byte encodings and of what such encodings make of bytes."""
    chars = {c for name in SINGLE_BYTE for c in _upper(name)}
    return re.compile("[A-Za-z" + re.escape("".join(sorted(chars))) + "]+")


def _windows(word: str) -> list[str]:
    """The word in windows of ``PROBE_CHARS`` characters, which overlap so that no sequence is cut in all of them."""
    return [word[i : i + PROBE_CHARS] for i in range(0, max(1, len(word) - OVERLAP), PROBE_CHARS - OVERLAP)]


def pieces(word: str) -> list[str]:
    """The word in windows; of a long word of another script first the stretches that are not of its script."""
    if len(word) < 12 or not any(char_kind(c) == "J" for c in word):
        return _windows(word)
    found = [m[0] for m in _foreign().finditer(word) if not m[0].isascii()]
    return list(dict.fromkeys(w for piece in [*found, word] for w in _windows(piece)))
