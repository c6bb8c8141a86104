"""Markup that must not be left in prose: fixed word lists and patterns, as Python and as SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and words that the extraction contract lists.
DROPPED_LINK_PREFIXES = ("category", "draft", "file", "help", "image", "media", "module", "portal", "template", "wikipedia")
DROPPED_TAGS = ("gallery", "imagemap", "ref", "references", "table")
BOILERPLATE_HEADINGS = (
    "bibliography", "external links", "further reading", "notes", "other websites", "references", "related pages", "see also", "sources",
)
TABLE_ATTRIBUTES = ("colspan", "rowspan", "style", "class", "bgcolor", "align", "scope")

_ATTRIBUTE = rf"(?:{'|'.join(TABLE_ATTRIBUTES)})"
# What counts as residual markup, in the order of the contract. Existence patterns without lookarounds,
# so that Java, RE2 and Python read them alike.
RESIDUE = {
    "braces": r"\{\{|\}\}",
    "brackets": r"\[\[|\]\]",
    "external_link": r"(?i)\[(?:https?:)?//",
    "nonprose_tag": r"(?i)<\s*/?\s*(?:ref(?:\b|name\s*=)|references\b|gallery\b|imagemap\b|table\b)",
    "transclusion_tag": r"(?i)<\s*/?\s*(?:includeonly|noinclude|onlyinclude|nowiki)\b",
    "table_edge": r"(?m)^\s*(?:\{\||\|\})",
    "table_attribute": rf"(?im)(?:^|\s)[|!]\s*{_ATTRIBUTE}\s*=",
    "apostrophes": r"'{2,}",
    "comment": r"<!--|--!?>",
    "magic_word": r"__[A-Z][A-Z_]+__",
}
_COMPILED = tuple(re.compile(p) for p in RESIDUE.values())


def has_residue(text: str) -> bool:
    """Whether a text still holds markup."""
    return any(p.search(text) for p in _COMPILED)


def residue_kinds(text: Column) -> Column:
    """The names of the kinds of residual markup in a text, in the order of the contract; null for null."""
    found = F.array(*(F.when(text.rlike(p), F.lit(n)) for n, p in RESIDUE.items()))
    return F.when(text.isNotNull(), F.filter(found, lambda x: x.isNotNull()))
