"""Projections and single-table checks of the document table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.config import SplitConfig
from corpusmill.functions import columns as C
from corpusmill.schemas import ATTRIBUTION_COLUMNS


def split_assignment(pages: DataFrame, config: SplitConfig = SplitConfig()) -> DataFrame:
    """Rows ``(page_id, split)``: each page with an identifier once, with its assigned split."""
    return pages.select("page_id").where("page_id is not null").distinct().select("page_id", C.assigned_split(F.col("page_id"), config).alias("split"))


def split_summary(pages: DataFrame, config: SplitConfig = SplitConfig()) -> DataFrame:
    """Rows ``(split, pages)``: how many pages each split gets."""
    return split_assignment(pages, config).groupBy("split").agg(F.count(F.lit(1)).alias("pages"))


def text_fingerprints(documents: DataFrame) -> DataFrame:
    """One row for each row: hash, length, words and stratum of the text, and whether the stated hash is that of the text.

    Null texts have null figures; ``hash_holds`` is null where either side is null.
    """
    text = F.col("text")
    return documents.select(
        "page_id",
        "revision_id",
        C.text_hash(text).alias("computed_sha256"),
        (F.lower("text_sha256") == C.text_hash(text)).alias("hash_holds"),
        F.length(text).cast("bigint").alias("chars"),
        C.word_count(text).cast("bigint").alias("words"),
        C.stratum(text).alias("stratum"),
    )


def article_urls(documents: DataFrame, site: str) -> DataFrame:
    """Rows ``(page_id, revision_id, url, oldid_url)`` rebuilt from edition and identifiers, each once."""
    url = C.article_url(F.col("wiki"), F.col("page_id"), site)
    return documents.select("page_id", "revision_id", url.alias("url"), C.revision_url(url, F.col("revision_id")).alias("oldid_url")).distinct()


def attribution(documents: DataFrame) -> DataFrame:
    """The seven columns that name the origin of a document, each different row once."""
    return documents.select(*ATTRIBUTION_COLUMNS).distinct()


def attribution_mismatches(documents: DataFrame, attributed: DataFrame) -> DataFrame:
    """Rows ``(page_id, side)``: pages whose attribution is missing, left over or different, nulls counting as equal."""
    left = documents.select(*ATTRIBUTION_COLUMNS).distinct()
    right = attributed.select(*ATTRIBUTION_COLUMNS).distinct()
    sides = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(2)))
    seen = sides.groupBy(*ATTRIBUTION_COLUMNS).agg(F.sum("side").alias("sides"))
    return seen.where("sides <> 3").select("page_id", F.when(F.col("sides") == 1, "documents").otherwise("attribution").alias("side"))


def split_intersection(documents: DataFrame) -> DataFrame:
    """Rows ``(page_id, splits)``: pages found in more than one split, counted after trimming and lower-casing."""
    return (
        documents.select("page_id", C.tidy(F.col("split")).alias("split"))
        .where("page_id is not null and split is not null")
        .groupBy("page_id")
        .agg(F.countDistinct("split").alias("splits"))
        .where("splits > 1")
    )


def order_violations(pages: DataFrame) -> DataFrame:
    """Rows ``(page_id, copies)``: identifiers that keep the table from rising strictly when sorted.

    A sorted table rises strictly iff no identifier occurs twice, so no global
    sort is needed.
    """
    return pages.where("page_id is not null").groupBy("page_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
