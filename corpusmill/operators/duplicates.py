"""Exact-duplicate audit and the near-duplicate probe over a declared sample."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import columns as C
from corpusmill.runtime import checkpointed

EXAMPLES = 20
#: The probe: sampled documents, characters and words read of each, fewest words, shingle width, bands, and greatest distance.
SAMPLE, PROBE_CHARS, PROBE_WORDS, LEAST_WORDS, SHINGLE, BANDS, DISTANCE = 5000, 8000, 1000, 20, 3, 4, 3
_SEPARATOR = "\x1f"
_WORDS = re.compile(r"\w+")


def distinct_pages(documents: DataFrame) -> DataFrame:
    """Rows ``(page_id, split, text, text_sha256)``: each page and text once, with the hash of the text computed anew."""
    return (
        documents.select("page_id", C.tidy(F.col("split")).alias("split"), "text")
        .where("page_id is not null and text is not null")
        .withColumn("text_sha256", C.text_hash(F.col("text")))
        .dropDuplicates(["page_id", "split", "text_sha256"])
    )


def exact_duplicate_groups(documents: DataFrame) -> DataFrame:
    """Rows ``(text_sha256, first_page_id, documents, splits)`` of texts that more than one page has.

    A page delivered twice counts once.  Only hashes are shuffled, and counted
    before the exchange, so a text that very many pages share stays one row
    from each task; the set of splits is bounded by their number.
    """
    pages = (
        documents.select("page_id", C.tidy(F.col("split")).alias("split"), C.text_hash(F.col("text")).alias("text_sha256"))
        .where("page_id is not null and text_sha256 is not null")
        .distinct()
    )
    return (
        pages.groupBy("text_sha256", "page_id")
        .agg(F.collect_set("split").alias("held"))
        .groupBy("text_sha256")
        .agg(
            F.min("page_id").alias("first_page_id"),
            F.count(F.lit(1)).alias("documents"),
            F.array_sort(F.flatten(F.collect_set("held"))).alias("splits"),
        )
        .where("documents > 1")
        .select("text_sha256", "first_page_id", "documents", F.array_distinct("splits").alias("splits"))
    )


def cross_split_groups(documents: DataFrame, limit: int = EXAMPLES) -> DataFrame:
    """The first duplicate groups that reach over splits, by first page: a report of ``limit`` examples."""
    return (
        exact_duplicate_groups(documents)
        .where(F.size("splits") > 1)
        .select("first_page_id", "documents", F.array_join("splits", ",").alias("splits"), "text_sha256")
        .orderBy("first_page_id", "text_sha256")
        .limit(limit)
    )


def exact_audit(documents: DataFrame) -> DataFrame:
    """One row ``(duplicate_groups, cross_split_groups, documents_in_groups)``; zeros for an empty table."""
    groups = exact_duplicate_groups(documents)
    return groups.agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.count_if(F.size("splits") > 1).alias("cross_split_groups"),
        F.coalesce(F.sum("documents"), F.lit(0)).alias("documents_in_groups"),
    )


def near_sample(documents: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The ``size`` pages with the lowest scores, with their rank: a declared sample, kept by a top-k without a full sort."""
    pages = (
        documents.select("page_id", C.tidy(F.col("split")).alias("split"), F.substring("text", 1, PROBE_CHARS).alias("text"), C.text_hash(F.col("text")).alias("text_sha256"))
        .where("page_id is not null and text is not null")
        .withColumn("score", C.sample_score("near-v1", F.col("page_id")))
        .dropDuplicates(["page_id"])
    )
    return pages.orderBy("score", "page_id").limit(size)


def simhash(text: str) -> int | None:
    """The 64-bit fingerprint of a text's word triples, or None with too few words.

    Each triple votes on every bit with the first 8 bytes of its SHA-256; triples
    count as often as they occur, and ties set the bit.
    """
    words = _WORDS.findall(text[:PROBE_CHARS].casefold())[:PROBE_WORDS]
    if len(words) < LEAST_WORDS:
        return None
    runs = (_SEPARATOR.join(words[i : i + SHINGLE]).encode() for i in range(len(words) - SHINGLE + 1))
    digests = np.frombuffer(b"".join(hashlib.sha256(r).digest()[:8] for r in runs), np.uint8).reshape(-1, 8)
    set_bits = np.unpackbits(digests, axis=1).sum(0) * 2 >= len(digests)
    return int.from_bytes(np.packbits(set_bits).tobytes(), "big")


def simhashes(sample: DataFrame) -> DataFrame:
    """Rows ``(page_id, split, text_sha256, score, high, low)``: 64-bit fingerprints in halves, for texts with enough words.

    A sample comes out of its top-k in one partition; it is spread before the
    fingerprints are made.
    """
    names = ["page_id", "split", "text_sha256", "score"]

    def run(batches):
        for batch in batches:
            values = [simhash(t) for t in batch.column(4).to_pylist()]
            keep = pa.array([i for i, v in enumerate(values) if v is not None], pa.int64())
            held = [v for v in values if v is not None]
            columns = [batch.column(i).take(keep) for i in range(4)]
            halves = [pa.array([v >> 32 for v in held], pa.int64()), pa.array([v & 0xFFFFFFFF for v in held], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *halves], names=[*names, "high", "low"])

    cores = sample.sparkSession.sparkContext.defaultParallelism
    return sample.select(*names, "text").repartition(cores).mapInArrow(run, "page_id bigint, split string, text_sha256 string, score string, high bigint, low bigint")


def near_candidates(fingerprints: DataFrame) -> DataFrame:
    """Pairs of fingerprints that agree in one of four 16-bit bands, each once, with their distance.

    Four bands and a distance of up to three leave one band equal, so no near
    pair is missed.  The probe's declared sample bounds the pairs.
    """
    bands = F.array(*(F.struct(F.lit(b).alias("band"), F.shiftright(F.col("low" if b < 2 else "high"), 16 * (b % 2)).bitwiseAND(F.lit(0xFFFF).cast("bigint")).alias("value")) for b in range(BANDS)))
    keyed = fingerprints.withColumn("key", F.explode(bands))
    left = keyed.select(*(F.col(c).alias(f"{c}_a") for c in fingerprints.columns), "key")
    right = keyed.select(*(F.col(c).alias(f"{c}_b") for c in fingerprints.columns), "key")
    before = (F.col("score_a") < F.col("score_b")) | ((F.col("score_a") == F.col("score_b")) & (F.col("page_id_a") < F.col("page_id_b")))
    pairs = left.join(right, "key").where(before).drop("key").dropDuplicates(["page_id_a", "page_id_b"])
    distance = F.bit_count(F.col("high_a").bitwiseXOR(F.col("high_b"))) + F.bit_count(F.col("low_a").bitwiseXOR(F.col("low_b")))
    return pairs.withColumn("distance", distance.cast("int")).withColumn("same_text", F.col("text_sha256_a") == F.col("text_sha256_b"))


def near_pairs(fingerprints: DataFrame) -> DataFrame:
    """Rows ``(page_id_a, page_id_b, splits, distance)``: near pairs of different texts of the sample, the smaller page first."""
    return (
        near_candidates(fingerprints)
        .where(~F.col("same_text") & (F.col("distance") <= DISTANCE))
        .select(
            F.least("page_id_a", "page_id_b").alias("page_id_a"),
            F.greatest("page_id_a", "page_id_b").alias("page_id_b"),
            F.array_join(F.array_sort(F.array("split_a", "split_b")), ",").alias("splits"),
            "distance",
        )
    )


def near_examples(fingerprints: DataFrame, count: int = EXAMPLES) -> DataFrame:
    """Rows ``(page_id_a, page_id_b, split_a, split_b, distance)``: the first near pairs of different texts.

    In the order of the sample's later page of a pair, the first band on which
    the two agree, and the earlier page; that is ``page_id_a``.
    """
    agrees = [
        F.shiftright(F.col(f"{half}_a").bitwiseXOR(F.col(f"{half}_b")), 16 * k).bitwiseAND(F.lit(0xFFFF).cast("bigint")) == 0 for half in ("low", "high") for k in (0, 1)
    ]
    band = F.coalesce(*(F.when(a, F.lit(i)) for i, a in enumerate(agrees)))
    near = near_candidates(fingerprints).where(~F.col("same_text") & (F.col("distance") <= DISTANCE))
    first = near.orderBy("score_b", "page_id_b", band, "score_a", "page_id_a").limit(count)
    return first.select("page_id_a", "page_id_b", "split_a", "split_b", "distance")


def near_audit(documents: DataFrame, size: int = SAMPLE) -> DataFrame:
    """One row of figures of the probe: sample, eligible texts, pairs examined, near pairs and those over splits."""
    sample = checkpointed(near_sample(documents, size))
    prints = checkpointed(simhashes(sample))
    candidates = near_candidates(prints)
    near = ~F.col("same_text") & (F.col("distance") <= DISTANCE)
    pairs = candidates.agg(
        F.count(F.lit(1)).alias("candidate_pairs_examined"),
        F.count_if(near).alias("near_duplicate_pairs_observed"),
        F.count_if(near & ~F.col("split_a").eqNullSafe(F.col("split_b"))).alias("cross_split_pairs_observed"),
    )
    held = sample.agg(F.count(F.lit(1)).alias("observed_sample_size"))
    eligible = prints.agg(F.count(F.lit(1)).alias("eligible_documents"))
    return held.crossJoin(eligible).crossJoin(pairs).select(
        F.lit(size).alias("requested_sample_size"), "observed_sample_size", "eligible_documents",
        "candidate_pairs_examined", "near_duplicate_pairs_observed", "cross_split_pairs_observed",
    )
