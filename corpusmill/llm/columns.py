"""Column expressions that bring differently written labels together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: White space of any script, as a character class.
SPACE = r"\s\p{Z}\x1c-\x1f\x85"


def not_blank(column: Column) -> Column:
    """Whether a text holds anything but white space; never for null."""
    return F.coalesce(column.rlike(f"[^{SPACE}]"), F.lit(False))


def tidy(column: Column) -> Column:
    """Lower-cased and without white space around it; null stays null, blank becomes null."""
    text = F.lower(F.regexp_replace(column, f"^[{SPACE}]+|[{SPACE}]+$", ""))
    return F.when(text != "", text)


def language(column: Column) -> Column:
    """The primary part of a language label, such as ``pt`` of ``pt-PT``; without one, ``und``."""
    code = F.regexp_extract(tidy(column), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(code != "", code).otherwise("und").alias("language")


def edition_language(column: Column) -> Column:
    """The language of a wiki edition: its name without the ending, the simple edition being English."""
    name = F.regexp_extract(tidy(column), r"^([a-z_]+?)wiki$", 1)
    return F.when(name == "simple", "en").when(name == "", None).otherwise(name)


def host(column: Column) -> Column:
    """The host of an address or a bare domain: lower case, no port, no ``www.`` and no ``m`` label."""
    bare = F.regexp_extract(tidy(column), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@?#]*@)?([^/:?#]+)", 1)
    bare = F.regexp_replace(F.regexp_replace(bare, r"^www\.|\.$", ""), r"^([^.]+)\.m\.", "$1.")
    return F.when(bare != "", bare)


def text_class(frame: DataFrame, text_col: str = "text") -> Column:
    """A 64-bit name of each text of a frame, the same for equal texts and, checked over all of them, for no others.

    It is a hash; where two different texts share it, a second, independent
    hash takes its place.  Those hashes, about one at four billion texts, are
    all that reaches the driver.
    """
    first, second = F.xxhash64(text_col), F.xxhash64(F.lit(17), F.col(text_col))
    seen = frame.where(F.col(text_col).isNotNull()).select(first.alias("first"), second.alias("second")).groupBy("first").agg(F.min("second").alias("a"), F.max("second").alias("b"))
    shared = [r["first"] for r in seen.where("a <> b").select("first").collect()]
    return F.when(first.isin(shared), second).otherwise(first) if shared else first
