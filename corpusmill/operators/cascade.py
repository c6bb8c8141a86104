"""The drop cascade: raw pages to documents or one reason each."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.config import SplitConfig
from corpusmill.functions import columns as C
from corpusmill.functions.markup import has_residue
from corpusmill.functions.wikitext import count_words, plain_text
from corpusmill.runtime import spread
from corpusmill.schemas import DOCUMENTS

LEAST_WORDS = 3


def structural_reason(expected: Column | None = None) -> Column:
    """The reason to drop a page that its fields alone give, first match first; null to go on.

    An identifier that is missing or no number, a namespace that is, or an
    empty title make a page invalid; then come other namespaces, redirect
    elements, a missing revision or one without a numeric identifier, and
    redirects written as text.
    """
    page, space = C.parsed_integer(F.col("id")), C.parsed_integer(F.col("ns"))
    revision = C.parsed_integer(F.col("revision.id"))
    body = F.lower(F.regexp_replace(F.coalesce("revision.text", F.lit("")), r"^[\s\x1c-\x1f\x85\p{Z}]+", ""))
    return (
        F.when(page.isNull() | space.isNull() | (F.coalesce("title", F.lit("")) == ""), "invalid_page")
        .when(space != 0, "non_article_namespace")
        .when(F.col("redirect").isNotNull(), "redirect")
        .when(F.col("revision").isNull() | revision.isNull(), "invalid_page")
        .when(body.startswith("#redirect"), "redirect")
    )


def structural_decisions(pages: DataFrame) -> DataFrame:
    """Rows ``(page_id, title, reason)`` of all pages; null reasons are left to the text stages.  Repeated pages stay."""
    return pages.select(C.parsed_integer(F.col("id")).alias("page_id"), "title", structural_reason().alias("reason"))


def extracted(pages: DataFrame) -> DataFrame:
    """The pages with ``page_id``, ``revision_id``, ``reason`` and ``text``, one row each.

    Pages that no field dropped are parsed where they are read; an empty text,
    markup left in it, and fewer than three words drop the rest.  ``text`` is
    null for dropped pages.
    """
    fields = pages.columns
    rows = pages.select(
        *fields,
        C.parsed_integer(F.col("id")).alias("page_id"),
        C.parsed_integer(F.col("revision.id")).alias("revision_id"),
        structural_reason().alias("reason"),
    )
    kept = [f for f in rows.schema.fields if f.name != "revision"]
    names = [f.name for f in kept]
    slim = rows.select(*names, F.col("revision.rev_timestamp").alias("revision_timestamp"), F.when(F.col("reason").isNull(), F.coalesce("revision.text", F.lit(""))).alias("wikitext"))

    def run(batches):
        for batch in batches:
            reasons, texts = batch.column(names.index("reason")).to_pylist(), []
            for i, wikitext in enumerate(batch.column(len(names) + 1).to_pylist()):
                text = None
                if wikitext is not None:
                    text = plain_text(wikitext)
                    reason = text_reason(text)
                    if reason:
                        reasons[i], text = reason, None
                texts.append(text)
            columns = [pa.array(reasons, pa.string()) if n == "reason" else batch.column(k) for k, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(len(names)), pa.array(texts, pa.string())], names=[*names, "revision_timestamp", "text"])

    from pyspark.sql import types as T

    schema = T.StructType([*kept, T.StructField("revision_timestamp", T.StringType()), T.StructField("text", T.StringType())])
    return spread(slim).mapInArrow(run, schema)


def text_reason(text: str) -> str | None:
    """The reason to drop a page for its normalized text."""
    if not text:
        return "empty_text"
    if has_residue(text):
        return "markup_residue"
    return "insufficient_text" if count_words(text) < LEAST_WORDS else None


def documents_of(pages: DataFrame, wiki: str, site: str, license: str, split: SplitConfig = SplitConfig()) -> DataFrame:
    """The document table of extracted pages."""
    emitted = pages.where("reason is null")
    return emitted.select(
        F.lit(wiki).alias("wiki"),
        "page_id",
        "revision_id",
        F.coalesce("revision_timestamp", F.lit("")).alias("revision_timestamp"),
        "title",
        C.article_url(F.lit(wiki), F.col("page_id"), site).alias("url"),
        "text",
        C.text_hash(F.col("text")).alias("text_sha256"),
        C.assigned_split(F.col("page_id"), split).alias("split"),
        F.lit(license).alias("license"),
    ).to(DOCUMENTS)


def decisions_of(pages: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """One decision for each extracted page."""
    return pages.select(
        "page_id",
        F.col(ordinal).cast("int").alias("stream_ordinal"),
        F.when(F.col("reason").isNull(), "emitted").otherwise("dropped").alias("decision"),
        "reason",
    )
