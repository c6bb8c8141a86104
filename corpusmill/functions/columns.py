"""Column expressions of the document model, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.config import SplitConfig

#: Bounds in code points of the review strata, and their names.
SHORT_BELOW, LONG_ABOVE = 500, 5000
STRATA = ("short_lt_500_chars", "medium_500_to_5000_chars", "long_gt_5000_chars")
#: Letters as word characters, and letters, digits and the underscore: classes all engines read alike.
LETTER_RUN = r"([\p{L}\p{Nl}\p{No}]+)"
WORD_RUN = r"([\p{L}\p{N}_]+)"


def text_hash(text: Column) -> Column:
    """SHA-256 of a text in lower-case hexadecimal; null for null."""
    return F.sha2(text, 256)


def hash_prefix(text: Column) -> Column:
    """The first 8 bytes of the SHA-256 as 16 hexadecimal digits, which sort as the unsigned number does."""
    return F.substring(F.sha2(text, 256), 1, 16)


def hash_number(text: Column) -> Column:
    """The first 8 bytes of the SHA-256 as an unsigned number."""
    return F.conv(hash_prefix(text), 16, 10).cast("decimal(20,0)")


def assigned_split(page_id: Column, config: SplitConfig = SplitConfig()) -> Column:
    """The split of a page from its identifier alone; null for null."""
    bucket = F.pmod(hash_number(F.concat(F.lit(f"{config.seed}:"), page_id.cast("string"))), F.lit(10_000).cast("decimal(20,0)")).cast("int")
    return F.when(page_id.isNull(), None).when(bucket < config.train, "train").when(bucket < config.train + config.validation, "validation").otherwise("test")


def sample_score(namespace: str, page_id: Column) -> Column:
    """A score that draws pages in an order fixed by the namespace; lower is drawn first."""
    return hash_prefix(F.concat(F.lit(f"{namespace}:"), page_id.cast("string")))


def stratum(text: Column) -> Column:
    """The length stratum of a text; null for null."""
    size = F.length(text)
    return F.when(size < SHORT_BELOW, STRATA[0]).when(size <= LONG_ABOVE, STRATA[1]).when(size > LONG_ABOVE, STRATA[2])


def article_url(wiki: Column, page_id: Column, site: str) -> Column:
    """The address of a page; null where the edition does not end in ``wiki``."""
    language = F.regexp_extract(wiki, r"^(.+)wiki$", 1)
    return F.when(language != "", F.concat(F.lit("https://"), language, F.lit(f".{site}/?curid="), page_id.cast("string")))


def revision_url(url: Column, revision_id: Column) -> Column:
    """The address of one revision of a page."""
    return F.concat(url, F.lit("&oldid="), revision_id.cast("string"))


def word_count(text: Column) -> Column:
    """The number of runs of letters in a text."""
    return F.size(F.regexp_extract_all(text, F.lit(LETTER_RUN), F.lit(1)))


def collapsed_lines(text: Column) -> Column:
    """Line ends as line feeds, runs of blanks as one, lines stripped, and no more than one empty line in a row."""
    lines = F.regexp_replace(text, "\r\n|\r", "\n")
    lines = F.regexp_replace(lines, "[\t\f\x0b ]+", " ")
    lines = F.regexp_replace(lines, r"(?m)^ | $", "")
    return F.regexp_replace(F.regexp_replace(lines, "\n{3,}", "\n\n"), r"^\n+|\n+$", "")


def id_list_hash(ids: Column) -> Column:
    """SHA-256 of identifiers in ascending order, each as 8 bytes, most significant first.

    For the lists of a group, whose size is bounded by the group.
    """
    digits = F.transform(F.array_sort(ids), lambda i: F.lpad(F.hex(i), 16, "0"))
    return F.sha2(F.unhex(F.array_join(digits, "")), 256)


def tidy(text: Column) -> Column:
    """Trimmed and lower-cased; blank becomes null."""
    cleaned = F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))
    return F.when(cleaned != "", cleaned)


def parsed_integer(text: Column) -> Column:
    """An integer field of a page: digits with an optional sign and blanks around them, else null.

    Digits may be grouped by single underscores.
    """
    plain = F.regexp_extract(text, r"^\s*([+-]?[0-9]+(?:_[0-9]+)*)\s*$", 1)
    return F.when(plain != "", F.regexp_replace(plain, "_", "").try_cast("bigint"))
