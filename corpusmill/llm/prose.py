"""Structural profiles of lines of text and their distance from prose.

A line is described by the shares of its characters (but white space) in five
classes: letters of common words, other letters, digits, punctuation and
symbols.  Its nearest profile by Jensen-Shannon divergence tells whether it is
running prose of its language, a list, a table, figures, code or bare symbols.
What the common words of a language are, what prose of it looks like, and which
words follow each other in it, is learnt from its texts (``fit``, and in parts
``tally``, ``common_words``, ``known_pairs``, ``text_shares`` and ``profile_of``);
texts of a language with too few to learn from are compared without telling
common words from others.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from corpusmill.llm.shingles import code_points, mix, words_in

FUNCTION, LETTER, DIGIT, PUNCTUATION, SYMBOL, SPACE = range(6)

#: Shares of the five classes in the profiles of what is no prose.
PROFILES = {
    "list": (0.01, 0.88, 0.04, 0.06, 0.01),
    "table": (0.01, 0.53, 0.34, 0.08, 0.04),
    "figures": (0.00, 0.05, 0.70, 0.25, 0.00),
    "code": (0.01, 0.62, 0.17, 0.12, 0.08),
    "symbols": (0.00, 0.10, 0.05, 0.35, 0.50),
}
#: Names of all outcomes: lines of prose, of the profiles above, and of words in no order.
OUTCOMES = ("prose", *PROFILES, "salad")
#: Shares of prose in a language that could not be learnt, all letters counting as one class.
ANY_PROSE = (0.0, 0.92, 0.03, 0.05, 0.0)
#: Digits in prose full of figures, and the part of the common words that lean prose has of them.
MANY_DIGITS, LEAN_PART = 0.14, 0.5
#: A line borrows from its neighbours until it has so many characters.
CONTEXT_CHARS = 60
#: In a language that could not be learnt a line of fewer characters that no punctuation closes counts as an entry of a list.
ENTRY_CHARS = 30
#: A word is common if this share of the language's texts hold it and its share of the words of entries (short lines that no
#: punctuation closes) is at most this part of its share of those of sentences (long closed lines); at most so many are.
COMMON_SHARE, ENTRY_PART, MOST_COMMON = 0.05, 0.25, 150
#: Without so many words in entries the most frequent words are taken, if this share of the texts hold them.
ENTRY_WORDS, FREQUENT_SHARE = 200, 0.5
#: A pair of words is known if this share of the language's texts, and so many of them, hold it.
PAIR_SHARE, PAIR_TEXTS = 0.003, 3
#: Words stand in no order if their share of known pairs is below this part of the texts' median; the median that makes
#: the measure usable, and the pairs a text must have.
ORDER_PART, ORDER_MEDIAN, ORDER_PAIRS = 0.45, 0.25, 15
#: Least texts of a language to learn from.
LEAST_TEXTS = 30


@dataclass(frozen=True)
class Language:
    """What was learnt of one language."""

    code: str
    common: np.ndarray
    pairs: np.ndarray
    prose: tuple[float, ...]
    order: float


_CLOSING = ".!?…。！？;:”»\"')’"


def _closing() -> np.ndarray:
    return np.frombuffer(_CLOSING.encode("utf-32-le"), np.uint32)


def _class_of(char: str) -> int:
    if char.isspace():
        return SPACE
    if "ぁ" <= char <= "ゟ":
        return FUNCTION
    category = unicodedata.category(char)
    if category[0] in "LM" or char == "ー":
        return LETTER
    if category[0] == "N":
        return DIGIT
    if category[0] == "P" and char not in "#%&*/@\\_":
        return PUNCTUATION
    return SPACE if category in ("Cf", "Zl", "Zp") else SYMBOL


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.full(0x110000, LETTER, np.int8)
    low = np.fromiter((_class_of(chr(c)) for c in range(0x30000)), np.int8, 0x30000)
    table[:0x30000] = low
    table[0xE0000:] = SYMBOL
    return table


def divergence(rows: np.ndarray, profile: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence, in bits, of each row of shares from the profiles."""
    middle = (rows + profile) / 2

    def part(p):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(p > 0, p * np.log2(p / middle), 0).sum(-1)

    return (part(rows) + part(np.broadcast_to(profile, middle.shape))) / 2


@dataclass
class _Parsed:
    """Texts as arrays: classes of characters, words with their texts and lines, and lines with their texts."""

    codes: np.ndarray
    kinds: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    word_text: np.ndarray
    first: np.ndarray
    line: np.ndarray

    @property
    def lines(self) -> int:
        return len(self.first)


def _parse(texts: list[str | None]) -> _Parsed:
    codes, bounds = code_points([(t or "").lower() for t in texts])
    kinds = _classes()[codes]
    starts, lengths, hashes = words_in(codes)
    breaks = (codes == 10) | (codes == 13) | (codes == 0x2028) | (codes == 0x85)
    first = np.concatenate([[0], np.flatnonzero(breaks[:-1]) + 1]) if len(codes) else np.zeros(0, np.int64)
    line = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.concatenate([first, [len(codes)]])))
    return _Parsed(codes, kinds, bounds, starts, lengths, hashes, np.searchsorted(bounds, starts, "right"), first, line)


def _pairs(parsed: _Parsed) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all neighbouring words and the texts they are in; all numbers count as one word."""
    words = np.where(parsed.kinds[parsed.starts] == DIGIT, np.uint64(1), parsed.hashes)
    if len(words) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    same = parsed.word_text[1:] == parsed.word_text[:-1]
    with np.errstate(over="ignore"):
        pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    return pairs[same], parsed.word_text[1:][same]


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.searchsorted(table, values).clip(0, len(table) - 1)] == values


def _texts_with(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and in how many texts each occurs."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return np.unique(values[fresh], return_counts=True)


def _tables(parsed: _Parsed, function: np.ndarray) -> np.ndarray:
    """Characters of each class in each line, the letters of the marked words being of common words."""
    filled = parsed.kinds != SPACE
    table = np.bincount(parsed.line[filled].astype(np.int64) * 5 + parsed.kinds[filled], minlength=parsed.lines * 5).reshape(-1, 5).astype(np.float64)
    moved = np.bincount(parsed.line[parsed.starts[function]], parsed.lengths[function], parsed.lines)
    table[:, FUNCTION] += moved
    table[:, LETTER] -= moved
    return table


def tally(texts: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """What is counted over texts of one language: how many have a character, and their words and pairs.

    Words are rows ``(hash, texts that hold it, occurrences in sentences, in
    entries)``, pairs are rows ``(hash, texts that hold it)``, ascending.
    Tallies of disjoint texts add up (``summed``).
    """
    parsed = _parse(texts)
    letters = parsed.kinds[parsed.starts] == LETTER
    hashes, line = parsed.hashes[letters], parsed.line[parsed.starts[letters]]
    values, held = _texts_with(hashes, parsed.word_text[letters])
    filled = parsed.kinds != SPACE
    last = np.zeros(parsed.lines, np.uint32)
    last[parsed.line[filled]] = parsed.codes[filled]
    closed, size = np.isin(last, _closing()), np.bincount(parsed.line[filled], minlength=parsed.lines)
    sentence, entry = (closed & (size >= CONTEXT_CHARS))[line], (~closed & (size < ENTRY_CHARS))[line]
    at = np.searchsorted(values, hashes)
    counts = [np.bincount(at[k], minlength=len(values)) for k in (sentence, entry)]
    used = len(np.unique(np.searchsorted(parsed.bounds, np.flatnonzero(filled), "right")))
    as_rows = lambda *columns: np.stack([c.astype(np.uint64) for c in columns], 1)
    return used, as_rows(values, held, *counts), as_rows(*_texts_with(*_pairs(parsed)))


def summed(rows: np.ndarray) -> np.ndarray:
    """Rows of a tally with those of the same hash added up, ascending."""
    if not len(rows):
        return rows
    rows = rows[np.argsort(rows[:, 0])]
    first = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
    return np.concatenate([rows[first, :1], np.add.reduceat(rows[:, 1:], first, axis=0)], 1)


def widespread(words: np.ndarray, used: int) -> np.ndarray:
    """The words of a tally that enough texts hold to be common."""
    return words[words[:, 1] >= COMMON_SHARE * used]


def known_pairs(pairs: np.ndarray, used: int) -> np.ndarray:
    """The pairs of a tally that enough texts hold to be known."""
    return pairs[pairs[:, 1] >= max(PAIR_TEXTS, PAIR_SHARE * used)]


def common_words(words: np.ndarray, used: int, sentences: int, entries: int) -> np.ndarray:
    """The words that sentences hold and entries do not, as articles and prepositions: sorted hashes.

    Of the words of a tally the widespread ones, ascending, are enough;
    ``sentences`` and ``entries`` are the occurrences of all words in each.
    """
    words = widespread(words, used)
    values, held = words[:, 0], words[:, 1].astype(np.int64)
    if entries < ENTRY_WORDS:
        fits = held >= FREQUENT_SHARE * used
    else:
        fits = (words[:, 3] + 0.5) / (entries + 1) <= ENTRY_PART * ((words[:, 2] + 0.5) / (sentences + 1))
    order = np.argsort(-held, kind="stable")
    return np.sort(values[order[fits[order]][:MOST_COMMON]])


def text_shares(texts: list[str], common: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The class shares of each text and its share of known pairs, NaN in texts without a character or with too few pairs."""
    parsed = _parse(texts)
    table = _tables(parsed, _among(parsed.hashes, common))
    owner = np.searchsorted(parsed.bounds, parsed.first, "right")
    per_text = np.stack([np.bincount(owner, table[:, k], len(texts)) for k in range(5)], 1)
    pairs, owner = _pairs(parsed)
    total = np.bincount(owner, minlength=len(texts))
    with np.errstate(invalid="ignore", divide="ignore"):
        order = np.where(total >= ORDER_PAIRS, np.bincount(owner, _among(pairs, known), len(texts)) / total, np.nan)
        return np.concatenate([per_text / per_text.sum(1, keepdims=True), order[:, None]], 1)


def profile_of(code: str, common: np.ndarray, known: np.ndarray, medians: list[float | None]) -> Language:
    """The language whose texts have these medians of their shares, see ``text_shares``."""
    middle = np.array(medians[:5]) + 1e-4
    order = medians[5] or 0.0
    return Language(code, common, known, tuple((middle / middle.sum()).tolist()), ORDER_PART * order if order >= ORDER_MEDIAN else 0.0)


def fit(code: str, texts: list[str]) -> Language | None:
    """What the texts tell of their language, or None if they are too few.

    Prose has the median class shares of all texts with a character, so that a
    minority of tables and lists does not matter.
    """
    used, words, pairs = tally(texts)
    if used < LEAST_TEXTS:
        return None
    common, known = common_words(words, used, *words[:, 2:].sum(0).tolist()), known_pairs(pairs, used)[:, 0]
    shares = text_shares(texts, common, known).T
    return profile_of(code, common, known, [float(np.median(s[~np.isnan(s)])) if (~np.isnan(s)).any() else None for s in shares])


def measure(texts: list[str | None], editions: list[str | None], model: list[Language]) -> dict[str, np.ndarray]:
    """Statistics of each text.

    ``editions`` holds the language code of each text, or None to take the
    language of the model whose common words fill most of it.  Languages that
    the model lacks have the number -1.  Texts without a character but white
    space have zero counts and shares, and no profile (-1).
    """
    count = len(texts)
    parsed = _parse(texts)
    word_text, kinds = parsed.word_text, parsed.kinds
    names = [m.code for m in model]
    known = np.array([names.index(e) if e in names else -1 if e else -2 for e in editions], np.int64)
    # letters of common words of each language in each text, to settle the language where it is not given
    asked, hits = known[word_text], []
    held = np.zeros((count, len(model) + 1))
    hiragana = np.bincount(np.searchsorted(parsed.bounds, np.flatnonzero(kinds == FUNCTION), "right"), minlength=count)
    for number, learnt in enumerate(model):
        at = np.flatnonzero((asked == number) | (asked == -2))
        at = at[_among(parsed.hashes[at], learnt.common)]
        hits.append(at)
        held[:, number] = np.bincount(word_text[at], parsed.lengths[at], count) + (hiragana if learnt.code == "ja" else 0)
    guess = np.where(held.max(1) > 0, held.argmax(1), -1)
    language = np.where(known == -2, guess, known)
    function = np.zeros(len(word_text), bool)
    for number, at in enumerate(hits):
        function[at[language[word_text[at]] == number]] = True

    table = _tables(parsed, function)
    sizes = table.sum(1)
    line_text = np.searchsorted(parsed.bounds, parsed.first, "right")
    full = np.flatnonzero(sizes > 0)
    rows, owner, size = table[full], line_text[full], sizes[full]
    last = np.zeros(parsed.lines, np.uint32)
    filled = kinds != SPACE
    last[parsed.line[filled]] = parsed.codes[filled]
    closes = np.isin(last[full], _closing())

    nearest = _nearest(rows, owner, size, closes, language, model)
    mass = np.bincount(owner * len(OUTCOMES) + nearest, size, count * len(OUTCOMES)).reshape(count, -1)
    ordered = _order_shares(parsed, count, language, model)
    limit = np.array([m.order for m in model] + [0.0])[language]
    salad = ordered < limit
    mass[salad, -1] += mass[salad, 0]
    mass[salad, 0] = 0
    total = np.bincount(owner, size, count)

    words = np.bincount(word_text, minlength=count)
    per = lambda a, b: np.divide(a, b, out=np.zeros(count), where=np.asarray(b) > 0)
    sums = np.stack([np.bincount(owner, rows[:, k], count) for k in range(5)], 1)
    return {
        "words": words,
        "mean_word_length": per(np.bincount(word_text, parsed.lengths, count), words),
        "symbol_share": per(sums[:, SYMBOL] + sums[:, PUNCTUATION], total),
        "digit_share": per(sums[:, DIGIT], total),
        "lines": np.bincount(owner, minlength=count),
        "closed_line_share": per(np.bincount(owner, closes, count), np.bincount(owner, minlength=count)),
        "common_word_share": per(np.bincount(word_text, function, count), words),
        "common_letter_share": per(sums[:, FUNCTION], total),
        "prose_share": per(mass[:, 0], total),
        "profile": np.where(total > 0, np.where(mass[:, 0] * 2 >= total, 0, mass[:, 1:].argmax(1) + 1), -1),
        "language": language,
        "characters": total,
    }


def _order_shares(parsed: _Parsed, count: int, language: np.ndarray, model: list[Language]) -> np.ndarray:
    """The share of known pairs of words in each text; 1 for texts with too few pairs."""
    pairs, owner = _pairs(parsed)
    known = np.zeros(len(pairs), bool)
    for number, learnt in enumerate(model):
        mine = np.flatnonzero(language[owner] == number)
        known[mine] = _among(pairs[mine], learnt.pairs)
    total = np.bincount(owner, minlength=count)
    return np.where(total >= ORDER_PAIRS, np.bincount(owner, known, count) / np.maximum(total, 1), 1.0)


def _nearest(rows, owner, size, closes, language, model) -> np.ndarray:
    """The number of the outcome nearest to each line."""
    if not len(rows):
        return np.zeros(0, np.int64)
    near = _with_context(rows, owner, size)
    shares = near / near.sum(1, keepdims=True)
    plain = np.array([m.prose for m in model] + [ANY_PROSE])
    lean = plain.copy()
    lean[:, FUNCTION] *= LEAN_PART
    lean[:, LETTER] += plain[:, FUNCTION] - lean[:, FUNCTION]
    kinds = [plain, lean]
    for kind in (plain, lean):
        rich = kind * (1 - MANY_DIGITS) / (1 - kind[:, [DIGIT]])
        rich[:, DIGIT] = MANY_DIGITS
        kinds.append(rich)
    unknown = language[owner] < 0
    others = np.array(list(PROFILES.values()))
    merged = shares.copy()
    merged[:, LETTER] += merged[:, FUNCTION]
    merged[:, FUNCTION] = 0
    shares = np.where(unknown[:, None], merged, shares)
    prose = np.stack([divergence(shares, kind[language[owner]]) for kind in kinds], 1).min(1)
    apart = np.stack([divergence(shares, p) for p in others], 1)
    # without common words a list differs from prose by its line ends alone
    apart[unknown, 0] = np.where((size < ENTRY_CHARS) & ~closes, 0, 9)[unknown]
    return np.where(prose <= apart.min(1), 0, apart.argmin(1) + 1)


def _with_context(rows: np.ndarray, owner: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Class counts of each line with as much of the lines next to it, in the same text, as a short line needs."""
    near = rows.copy()
    for step in (1, -1):
        other = np.roll(rows, -step, 0)
        same = np.roll(owner, -step) == owner
        if step == 1:
            same[-1:] = False
        else:
            same[:1] = False
        lack = np.maximum(0, CONTEXT_CHARS - size) / 2
        held = np.roll(size, -step)
        part = np.where(same, np.minimum(1, lack / np.maximum(held, 1)), 0)
        near += other * part[:, None]
    return near
