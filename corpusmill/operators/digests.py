"""Content digests: canonical rows, the corpus, and texts."""

from __future__ import annotations

import hashlib
import json
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import spread
from corpusmill.schemas import ATTRIBUTION_COLUMNS, DOCUMENTS

#: Leading hexadecimal digits of a row digest that name its block in the corpus digest.
BLOCK_DIGITS = 4


def canonical_row(row: dict) -> bytes:
    """A row as compact JSON with sorted keys in UTF-8."""
    return json.dumps(row, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode("utf-8", "surrogatepass")


def framed(row: dict) -> bytes:
    """The canonical row after its length in 8 bytes, most significant first."""
    data = canonical_row(row)
    return len(data).to_bytes(8, "big") + data


def row_digests(documents: DataFrame, columns: tuple[str, ...] = tuple(DOCUMENTS.fieldNames())) -> DataFrame:
    """Rows ``(page_id, revision_id, row_sha256)``: SHA-256 of each canonical row over the named columns, repeats included."""
    names = list(columns)

    def run(batches):
        for batch in batches:
            rows = batch.select(names).to_pylist()
            digests = pa.array([hashlib.sha256(canonical_row(r)).hexdigest() for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("revision_id"), digests], names=["page_id", "revision_id", "row_sha256"])

    return spread(documents.select(names)).mapInArrow(run, "page_id bigint, revision_id bigint, row_sha256 string")


def corpus_digest(documents: DataFrame, columns: tuple[str, ...] = tuple(DOCUMENTS.fieldNames())) -> DataFrame:
    """One row ``(blocks, rows, corpus_sha256)``: a digest of digests that depends on the different rows alone.

    Row digests are dealt to blocks by their first digits, so blocks are even
    whatever the identifiers, and bounded in number; each is hashed in the
    order of its digests, and the block digests in the order of the blocks.
    An empty table gives the hash of nothing.
    """
    rows = row_digests(documents, columns).select("row_sha256").distinct().withColumn("block", F.substring("row_sha256", 1, BLOCK_DIGITS))
    blocks = rows.groupBy("block").agg(
        F.count(F.lit(1)).alias("rows"), F.sha2(F.array_join(F.array_sort(F.collect_list("row_sha256")), ""), 256).alias("digest")
    )
    return blocks.agg(
        F.count(F.lit(1)).alias("blocks"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "digest"))), lambda s: s["digest"]), ""), 256).alias("corpus_sha256"),
    )


def content_digest(documents: DataFrame, columns: tuple[str, ...] = tuple(DOCUMENTS.fieldNames())) -> str:
    """The corpus digest over the named columns, as manifests state it."""
    return corpus_digest(documents, columns).first()["corpus_sha256"]


def sequential_digest(documents: DataFrame, columns: tuple[str, ...] = tuple(DOCUMENTS.fieldNames())) -> str:
    """SHA-256 over the framed canonical rows in ascending order of pages, for comparison with chains stated elsewhere.

    A chain over all rows cannot be split; rows come to the driver one
    partition at a time, already sorted.
    """
    digest = hashlib.sha256()
    for row in documents.select(*columns).orderBy("page_id").toLocalIterator(prefetchPartitions=True):
        digest.update(framed(row.asDict()))
    return digest.hexdigest()


def attribution_digest(documents: DataFrame) -> str:
    """The corpus digest over the attribution columns."""
    return content_digest(documents, ATTRIBUTION_COLUMNS)


def id_digest(ids) -> str:
    """SHA-256 of non-negative identifiers in the given order, 8 bytes each, most significant first."""
    digest = hashlib.sha256()
    for page_id in ids:
        if page_id < 0:
            raise ValueError("an identifier is negative")
        digest.update(int(page_id).to_bytes(8, "big"))
    return digest.hexdigest()


def composed_text(documents: DataFrame) -> DataFrame:
    """Rows ``(page_id, composed_sha256)``: the hash of each page's text in composed form (NFC), each once."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            digests = [hashlib.sha256(unicodedata.normalize("NFC", t).encode()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string())], names=["page_id", "composed_sha256"])

    rows = documents.select("page_id", "text").where("page_id is not null and text is not null")
    return spread(rows).mapInArrow(run, "page_id bigint, composed_sha256 string").distinct()


def residue_report(texts: DataFrame, kinds: Column, examples: int = 20) -> DataFrame:
    """One row ``(texts, first_pages)``: how many different pages hold markup, and the first of them as a list."""
    hit = texts.where(F.size(kinds) > 0).distinct()
    first = hit.where("page_id is not null").select("page_id").distinct().orderBy("page_id").limit(examples)
    listed = first.agg(F.array_join(F.array_sort(F.collect_list("page_id")).cast("array<string>"), ",").alias("first_pages"))
    return hit.agg(F.count(F.lit(1)).alias("texts")).crossJoin(listed)
