"""The section skip as a column expression: one fold over the lines of a row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.markup import BOILERPLATE_HEADINGS


def heading_level(line: Column) -> Column:
    """The level of a literal heading ``== x ==``, 0 for other lines: the equals signs that both ends have, six at most.

    A line of equals signs alone is a heading without a title.
    """
    lead = F.length(F.regexp_extract(line, "^(=*)", 1))
    trail = F.length(F.regexp_extract(line, "(=*)$", 1))
    both = F.when(lead == F.length(line), F.floor(lead / 2).cast("int")).otherwise(F.least(lead, trail))
    return F.least(both, F.lit(6)).cast("int")


def heading_title(line: Column, level: Column) -> Column:
    """The title of a heading of that level."""
    inside = F.substring(line, level + 1, F.length(line) - 2 * level)
    return F.regexp_replace(inside, r"^\s+|\s+$", "")


def without_boilerplate(text: Column) -> Column:
    """The text without boilerplate sections; kept headings lose their equals signs; null for null.

    A boilerplate heading hides what follows up to the next heading of its own
    or a higher level.
    """

    def step(state: Column, line: Column) -> Column:
        level = heading_level(line)
        title = heading_title(line, level)
        hidden = state["hidden"]
        begins = (level > 0) & ((hidden == 0) | (level <= hidden))
        boilerplate = F.regexp_replace(F.lower(title), ":+$", "").isin(*BOILERPLATE_HEADINGS)
        now = F.when(begins, F.when(boilerplate, level).otherwise(0)).otherwise(hidden).cast("int")
        shown = F.when(level > 0, title).otherwise(line)
        kept = F.when(now > 0, state["kept"]).otherwise(F.concat(state["kept"], F.array(shown)))
        return F.struct(now.alias("hidden"), kept.alias("kept"))

    start = F.struct(F.lit(0).alias("hidden"), F.array().cast("array<string>").alias("kept"))
    return F.aggregate(F.split(text, "\n", -1), start, step, lambda s: F.array_join(s["kept"], "\n"))
