"""Prose from wikitext.

A scanner walks over the markup once and keeps a stack of open constructs.  A
construct that closes is replaced by the prose it stands for; one that never
closes stays as it was written, so that the residue check rejects the page
instead of a guess deciding where it ends.
"""

from __future__ import annotations

import html
import re
import unicodedata

from corpusmill.functions.markup import BOILERPLATE_HEADINGS, DROPPED_LINK_PREFIXES, DROPPED_TAGS, TABLE_ATTRIBUTES

# Reference tags, with at most 2048 characters of attributes. ``ref`` may be glued to ``name=``. A tag
# closes itself only if its slash follows a quote, white space or the name, so that an address in an attribute may end
# in a slash.
_REF = r"ref(?:\b|(?=name\s*=))"
_REF_ALONE = re.compile(rf"<\s*{_REF}(?:\s*|[^>]{{0,2048}}?[\"'\s])/\s*>", re.I | re.S)
_REF_BLOCK = re.compile(rf"<\s*{_REF}[^>]{{0,2048}}>.*?</\s*ref\s*>", re.I | re.S)
_REF_TAG = re.compile(rf"</?\s*{_REF}[^>]{{0,2048}}/?\s*>", re.I | re.S)
_HEADING = re.compile(r"^(?P<signs>={1,6})(?P<title>[^\n]*?)(?P=signs)$", re.M)
_EMPTY_LINES = re.compile(r"\n{3,}")
_EDGES = re.compile(r"^[^\S\n]+|[^\S\n]+$", re.M)
# What the line stage rewrites, in the order of the contract. Marks go after the blanks, so that one taken
# out between two blanks leaves both.
_LINE_RULES = (
    (re.compile(r"\r\n?"), "\n"),
    (re.compile(r"[\t\f\v ]+"), " "),
    (_EDGES, ""),
    (re.compile(r"__[A-Z][A-Z_]+__"), ""),
    (re.compile(r"'{2,}"), ""),
    (re.compile(r"<!--|--!?>"), ""),
    (_EDGES, ""),
)
# Lines that are fragments of tables, by their edge, a cell attribute, or cells in a row.
_TABLE_LINE = re.compile(
    rf"""^(?: \|[-}}] | \{{\| | [|!]\s*(?:{"|".join(TABLE_ATTRIBUTES)})\s*= | (?=\|)[^\n]*\|\| | (?=!)[^\n]*!! )[^\n]*(?:\n|\Z)""", re.I | re.M | re.X
)
_WORD = re.compile(r"[^\W\d_]+")

#: Tags whose content is not parsed; of these, the ones whose content is no prose.
_RAW = ("categorytree", "ce", "chem", "graph", "hiero", "inputbox", "math", "nowiki", "pre", "score", "section", "source",
        "syntaxhighlight", "templatedata", "timeline")
_HIDDEN = ("categorytree", "graph", "inputbox", "math", "score", "section", "templatedata", "timeline")
#: Tags that have no content.
_VOID = ("br", "hr", "wbr", "meta", "link", "img")

_TOKEN = re.compile(
    r"""(?P<comment><!--.*?-->)
    |(?P<raw><\s*(?P<rawname>%s)\b[^<>]*(?<!/)>(?P<rawbody>.*?)</\s*(?P=rawname)\s*>)
    |(?P<tag><(?P<close>/?)\s*(?P<name>[A-Za-z][A-Za-z0-9]*)\b(?P<rest>[^<>]*?)(?P<alone>/?)\s*>)
    |(?P<open>\{\{\{(?!\{)|\{\{|\[\[|(?:(?<=\n)|\A)[ \t:]*\{\||\[(?=(?:https?:|ftp:|mailto:)?//|mailto:))
    |(?P<shut>\}\}\}|\}\}|\]\]|(?:(?<=\n)|\A)[ \t]*\|\}|\])
    |(?P<bar>\|)
    |(?P<entity>&(?:\#[0-9]+|\#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);)
    |(?P<list>(?:(?<=\n)|\A)[*\#:;]+)
    |(?P<rule>(?:(?<=\n)|\A)-{4,})
    """
    % "|".join(_RAW),
    re.X | re.S | re.I,
)


class _Open:
    """A construct that has begun: how it was written, and the prose of its parts so far."""

    __slots__ = ("kind", "mark", "parts", "written")

    def __init__(self, kind: str, mark: str):
        self.kind, self.mark = kind, mark
        self.parts, self.written = [[]], [mark]

    def add(self, prose: str, written: str) -> None:
        self.parts[-1].append(prose)
        self.written.append(written)


def strip_markup(text: str) -> str:
    """The prose of balanced markup; headings keep their equals signs, unbalanced markup stays."""
    root = _Open("root", "")
    stack = [root]
    place = 0
    for token in _TOKEN.finditer(text):
        if token.start() > place:
            piece = text[place : token.start()]
            stack[-1].add(piece, piece)
        place = token.end()
        _take(token, stack)
    stack[-1].add(text[place:], text[place:])
    while len(stack) > 1:
        _give_up(stack)
    prose = "".join(root.parts[0]).strip("\n")
    return _EMPTY_LINES.sub("\n\n", prose)


def _take(token: re.Match, stack: list[_Open]) -> None:
    written = token[0]
    top = stack[-1]
    if token["comment"]:
        top.add("", written)
    elif token["raw"]:
        top.add("" if token["rawname"].lower() in _HIDDEN else token["rawbody"], written)
    elif token["tag"]:
        _take_tag(token, stack)
    elif token["open"]:
        kind = {"{{{": "argument", "{{": "template", "[[": "link", "[": "address"}.get(written, "table")
        stack.append(_Open(kind, written))
    elif token["shut"]:
        kind = {"}}}": "argument", "}}": "template", "]]": "link", "]": "address"}.get(written, "table")
        if written == "}}}" and not _holds(stack, kind):
            # the end of a template and a brace of its own
            _close(stack, "template", "}}") or top.add("}}", "}}")
            stack[-1].add("}", "}")
        else:
            _close(stack, kind, written) or top.add(written, written)
    elif token["bar"]:
        if top.kind in ("template", "argument", "link"):
            top.parts.append([])
            top.written.append(written)
        else:
            top.add(written, written)
    elif token["entity"]:
        plain = html.unescape(written)
        top.add(plain, written)
    else:
        top.add("", written)


def _take_tag(token: re.Match, stack: list[_Open]) -> None:
    name, written = token["name"].lower(), token[0]
    if name in _VOID or (token["alone"] and not token["close"]):
        stack[-1].add("", written)
    elif not token["close"]:
        stack.append(_Open(f"<{name}", written))
    elif not _close(stack, f"<{name}", written):
        stack[-1].add(written, written)


def _holds(stack: list[_Open], kind: str) -> bool:
    return any(o.kind == kind for o in stack)


def _close(stack: list[_Open], kind: str, mark: str) -> bool:
    """Close the innermost open construct of a kind; what is still open inside it stays as written."""
    if not _holds(stack, kind):
        return False
    while stack[-1].kind != kind:
        _give_up(stack)
    done = stack.pop()
    parts = ["".join(p) for p in done.parts]
    stack[-1].add(_prose_of(done.kind, parts), "".join(done.written) + mark)
    return True


def _give_up(stack: list[_Open]) -> None:
    left = stack.pop()
    inside = left.mark + "|".join("".join(p) for p in left.parts)
    stack[-1].add(inside, "".join(left.written))


def _prose_of(kind: str, parts: list[str]) -> str:
    if kind == "argument":
        return "|".join(parts[1:])
    if kind == "link":
        prefix, colon, _ = parts[0].strip().partition(":")
        if colon and prefix.casefold() in DROPPED_LINK_PREFIXES:
            return ""
        return "|".join(parts[1:]) if len(parts) > 1 else parts[0]
    if kind == "address":
        words = re.split(r"\s", parts[0], maxsplit=1)
        return words[1] if len(words) > 1 else ""
    if kind in ("template", "table") or kind[1:] in DROPPED_TAGS or kind[1:] in _HIDDEN:
        return ""
    return parts[0]


def shown_sections(text: str) -> str:
    """The text without boilerplate sections; headings that stay lose their equals signs.

    Every boilerplate heading hides an interval that ends where the next
    heading of its own or a higher level begins.  The ends come from one sweep
    over the headings from the last to the first, and what lies between the
    intervals is kept.
    """
    headings = list(_HEADING.finditer(text))
    ends: list[int] = []
    later: list[tuple[int, int]] = []  # headings to come, each of a higher level than those before it
    for heading in reversed(headings):
        level = len(heading["signs"])
        while later and later[-1][0] > level:
            later.pop()
        ends.append(later[-1][1] if later else len(text))
        later.append((level, heading.start()))
    kept, place, boilerplate = [], 0, False
    for heading, end in zip(headings, reversed(ends)):
        if heading.start() < place:
            continue
        title = heading["title"].strip()
        boilerplate = title.casefold().rstrip(":") in BOILERPLATE_HEADINGS
        kept += [text[place : heading.start()], "" if boilerplate else title]
        place = end if boilerplate else heading.end()
    shown = "".join([*kept, text[place:]])
    return shown.removesuffix("\n") if boilerplate and place == len(text) else shown


def normal_lines(text: str) -> str:
    """The line stage: composed characters, blanks, leftover marks, headings and table fragments."""
    text = unicodedata.normalize("NFC", text)
    for pattern, plain in _LINE_RULES:
        text = pattern.sub(plain, text)
    text = _TABLE_LINE.sub("", shown_sections(text))
    return _EMPTY_LINES.sub("\n\n", text).strip()


def plain_text(wikitext: str) -> str:
    """The prose of a page's wikitext."""
    for pattern in (_REF_ALONE, _REF_BLOCK, _REF_TAG):
        wikitext = pattern.sub("", wikitext)
    # what the first pass lays bare is parsed once more
    text = strip_markup(strip_markup(wikitext))
    for pattern in (_REF_BLOCK, _REF_TAG):
        text = pattern.sub("", text)
    return normal_lines(text)


def count_words(text: str) -> int:
    """The number of runs of letters."""
    return len(_WORD.findall(text))
