"""Token budgets per source, language and domain (problem 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.columns import edition_language, host, language, tidy
from corpusmill.llm.encode import count_tokens
from corpusmill.llm.vocab import DEFAULT_TOKENIZER

SLICES = ("source", "language", "domain", "split")


def corpus_records(wiki_documents: DataFrame, documents: DataFrame) -> DataFrame:
    """Both tables in one shape: ``(corpus, record_id, revision_id, source, language, domain, split, text_key, text)``.

    ``text_key`` is the SHA-256 of the text, null for a null text.  Labels are
    trimmed and lower-cased; the language of an edition is that of its name.
    """
    key = F.unhex(F.sha2("text", 256)).alias("text_key")
    wiki = wiki_documents.select(
        F.lit("wiki_documents").alias("corpus"),
        F.col("page_id").alias("record_id"),
        F.col("revision_id"),
        tidy(F.col("wiki")).alias("source"),
        edition_language(F.col("wiki")).alias("language"),
        host(F.col("url")).alias("domain"),
        tidy(F.col("split")).alias("split"),
        key,
        "text",
    )
    other = documents.select(
        F.lit("documents").alias("corpus"),
        F.col("doc_id").alias("record_id"),
        F.lit(None).cast("bigint").alias("revision_id"),
        tidy(F.col("source")).alias("source"),
        language(F.col("lang")),
        host(F.col("site_domain")).alias("domain"),
        F.lit(None).cast("string").alias("split"),
        key,
        "text",
    )
    return wiki.unionByName(other)


def text_tokens(records: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, folder: str | None = None) -> DataFrame:
    """Rows ``(text_key, tokens)``: every distinct text, tokenized once.

    Copies are dropped before the exchange as well as after it, so a text that
    fills a third of the rows crosses the network once from each task.
    """
    distinct = records.where("text is not null").select("text_key", "text").dropDuplicates(["text_key"])
    return count_tokens(distinct, "text", tokenizer, folder)


def token_counts(records: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, folder: str | None = None) -> DataFrame:
    """The records without their text, with ``tokens``: one row for each row of the input, repeats included.

    Null and empty texts have 0 tokens.
    """
    counted = text_tokens(records, tokenizer, folder)
    return (
        records.drop("text")
        .join(counted, "text_key", "left")
        .select("corpus", "record_id", "revision_id", *SLICES, F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))
    )


def token_totals(records: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, folder: str | None = None) -> DataFrame:
    """Rows ``(corpus, source, language, domain, split, records, texts, tokens, distinct_tokens)``.

    ``tokens`` counts a text as often as it occurs in the slice, and
    ``distinct_tokens`` once.  Multiplicities are counted before the join, so
    the join sees one row for each text and slice.  Missing labels form their
    own slice under null.
    """
    times = records.groupBy("text_key", "corpus", *SLICES).agg(F.count(F.lit(1)).alias("times"))
    counted = text_tokens(records, tokenizer, folder)
    tokens = F.coalesce("tokens", F.lit(0))
    return (
        times.join(counted, "text_key", "left")
        .groupBy("corpus", *SLICES)
        .agg(
            F.sum("times").cast("bigint").alias("records"),
            F.count("text_key").alias("texts"),
            F.sum(tokens * F.col("times")).cast("bigint").alias("tokens"),
            F.sum(tokens).cast("bigint").alias("distinct_tokens"),
        )
    )


def totals_by(totals: DataFrame, *by: str) -> DataFrame:
    """The totals summed over all slices but the named ones; a text in two slices counts in both."""
    return totals.groupBy("corpus", *by).agg(
        *(F.sum(c).cast("bigint").alias(c) for c in ("records", "tokens"))
    )
