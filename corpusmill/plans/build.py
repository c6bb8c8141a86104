"""The complete build of one dated dump: resumable, audited, published only when valid."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable
from dataclasses import asdict
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import __version__
from corpusmill.config import CONTRACT_VERSION, DROP_REASONS, BuildConfig
from corpusmill.errors import ValidationError
from corpusmill.functions import columns as C
from corpusmill.functions.markup import residue_kinds
from corpusmill.operators import cascade, digests, documents, duplicates, review
from corpusmill.plans import publish, tokens
from corpusmill.plans.source import Prepared, copy_index, prepare
from corpusmill.plans.validate import validate
from corpusmill.runtime import checkpointed, ship
from corpusmill.schemas import ATTRIBUTION_COLUMNS
from corpusmill.sources.files import artifact, compact_line, read_json, write_json
from corpusmill.sources.segments import load_catalog, read_index, read_segments

#: Segments of one commit: a job large enough for the cluster, and the most that a failure can cost.
COMMIT_SEGMENTS = 4096
SCOPE = "complete_dated_dump"


def ranges_of(spark: SparkSession, prepared: Prepared) -> DataFrame:
    """The segment catalog of a prepared source, held in the shared folder."""
    return checkpointed(load_catalog(read_index(spark, f"file://{prepared.index}"), prepared.metadata["dump"]["bytes"]))


def commits(spark: SparkSession, work: Path, identity: str) -> list[dict]:
    """The commits of a work folder in order; one of another identity, or whose data changed, is an error."""
    found = []
    for marker in sorted((work / "commits").glob("*/commit.json")):
        commit = read_json(marker, "a commit")
        if commit.get("identity") != identity:
            raise ValidationError("a commit belongs to another source")
        held = artifact(marker.parent, "pages", commit.get("artifact", {}).get("records", 0), spark).as_dict()
        if held != commit.get("artifact"):
            raise ValidationError("the data of a commit have changed")
        found.append(commit | {"folder": str(marker.parent)})
    return found


def build_segments(spark: SparkSession, config: BuildConfig, prepared: Prepared, ranges: DataFrame, progress: Callable | None = None) -> tuple[list[dict], int]:
    """Extract all segments that no commit holds yet; the commits in order and how many segments were reused.

    Segments are worked off in batches of neighbouring ordinals.  A batch is
    one Spark job; its pages are written to a hidden folder, checked against
    the catalog, and committed by a rename.  A run that ends in between loses
    at most its last batch.
    """
    work = config.work_folder
    (work / "commits").mkdir(parents=True, exist_ok=True)
    done = commits(spark, work, prepared.identity)
    for commit in done:
        held = spark.read.parquet(f"file://{commit['folder']}/pages")
        faults = _batch_faults(held, ranges.where(F.col("ordinal").between(commit["first"], commit["last"])), commit["artifact"]["records"])
        if faults:
            raise ValidationError("a commit is not sound any more: " + "; ".join(faults))
    held = {o for c in done for o in range(c["first"], c["last"] + 1)}
    reused = len(held)
    total = ranges.count()
    step = config.fail_after or COMMIT_SEGMENTS
    left = sorted(set(range(total)) - held)
    built = 0
    while left:
        first = left[0]
        last = first
        while last + 1 - first < step and last + 1 < total and last + 1 not in held:
            last += 1
        done.append(_commit_batch(config, prepared, ranges.where(F.col("ordinal").between(first, last)), first, last))
        left = [o for o in left if o > last]
        built += last - first + 1
        if progress:
            progress({"segments_done": total - len(left), "segments": total})
        if config.fail_after and built >= config.fail_after:
            raise ValidationError(f"stopped on request after {built} segments")
    return sorted(done, key=lambda c: c["first"]), reused


def _commit_batch(config: BuildConfig, prepared: Prepared, ranges: DataFrame, first: int, last: int) -> dict:
    work = config.work_folder / "commits"
    final, hidden = work / f"{first:06d}-{last:06d}", work / f".{first:06d}-{last:06d}"
    shutil.rmtree(hidden, ignore_errors=True)
    parallel = min(last - first + 1, max(config.workers, ranges.sparkSession.sparkContext.defaultParallelism))
    pages = read_segments(ranges, str(prepared.dump), config.quarantine, config.max_segment_text_bytes, parallel)
    # a page without a usable identifier of its own is known by the index's
    named = pages.withColumn("own_id", F.col("id")).withColumn("listed", F.col("expected_page_id"))
    rows = cascade.extracted(named)
    rows = rows.withColumn("page_id", F.coalesce("page_id", "expected_page_id")).select(
        "ordinal", "position", "page_id", "revision_id", "title", "reason", "revision_timestamp", "text", "problem", "segment_bytes", "segment_sha256"
    )
    rows.write.option("compression", "zstd").parquet(f"file://{hidden}/pages")
    written = rows.sparkSession.read.schema(rows.schema).parquet(f"file://{hidden}/pages")
    faults = _batch_faults(written, ranges)
    if faults:
        raise ValidationError("a batch of segments is not sound: " + "; ".join(faults))
    count = written.count()
    commit = {"identity": prepared.identity, "first": first, "last": last, "artifact": artifact(hidden, "pages", count, rows.sparkSession).as_dict()}
    write_json(hidden / "commit.json", commit)
    os.replace(hidden, final)
    return commit | {"folder": str(final)}


def _batch_faults(pages: DataFrame, ranges: DataFrame, records: int | None = None) -> list[str]:
    """What keeps a batch from being committed or used again.

    Pages lost or added, their order, lengths and hashes of the segments,
    decisions without a known reason, and texts that are no prose.
    """
    sound = pages.where("problem is null")
    seen = sound.groupBy("ordinal").agg(
        C.id_list_hash(F.collect_list("page_id")).alias("seen"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("page_id").alias("different"),
        F.min("page_id").alias("least"),
        F.min("segment_bytes").alias("bytes"),
        F.max("segment_bytes").alias("most_bytes"),
        F.min("segment_sha256").alias("hash"),
        F.max("segment_sha256").alias("last_hash"),
    )
    broken = pages.where("problem is not null").select("ordinal").distinct()
    wanted = ranges.select("ordinal", "start", "end", "pages", "page_ids_sha256").join(broken, "ordinal", "left_anti")
    joined = wanted.join(seen, "ordinal", "left")
    checks = {
        "missing segments": F.col("n").isNull(),
        "page counts": F.col("n") != F.col("pages"),
        "page lists": F.col("seen") != F.col("page_ids_sha256"),
        "repeated pages": F.col("different") != F.col("n"),
        "page identifiers": F.col("least") < 0,
        "segment lengths": ~(F.col("bytes").eqNullSafe(F.col("end") - F.col("start") + 1) & F.col("most_bytes").eqNullSafe(F.col("bytes"))) & F.col("n").isNotNull(),
        "segment hashes": ~(F.col("hash").eqNullSafe(F.col("last_hash")) & F.coalesce(F.length("hash") == 64, F.lit(False))) & F.col("n").isNotNull(),
    }
    row = joined.agg(*(F.count_if(c).alias(n) for n, c in checks.items())).first()
    dropped = F.col("reason").isNotNull()
    figures = pages.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("problem").isNull() & (dropped & ~F.col("reason").isin(*DROP_REASONS) | ~dropped & F.col("text").isNull() | dropped & F.col("text").isNotNull())).alias("reasons"),
        F.count_if(~dropped & ((C.word_count(F.col("text")) < cascade.LEAST_WORDS) | (F.size(residue_kinds(F.col("text"))) > 0))).alias("texts"),
    ).first()
    found = [n for n in checks if row[n]] + [n for n in ("reasons", "texts") if figures[n]]
    return found + (["records"] if records is not None and figures["rows"] != records else [])


def segment_ledger(pages: DataFrame, ranges: DataFrame, docs: DataFrame) -> DataFrame:
    """One row for each segment: range, listed pages, bytes and hash, outcome, and the digest of its documents."""

    def digest(table: pa.Table) -> pa.Table:
        import hashlib

        value = hashlib.sha256()
        for row in table.sort_by("page_id").to_pylist():
            ordinal = row.pop("ordinal")
            value.update(digests.framed(row))
        return pa.table({"ordinal": pa.array([ordinal], pa.int32()), "documents_content_sha256": [value.hexdigest()]})

    content = docs.groupBy("ordinal").applyInArrow(digest, "ordinal int, documents_content_sha256 string")
    counted = pages.groupBy("ordinal").agg(
        F.count(F.lit(1)).alias("pages_seen"),
        F.count_if(F.col("reason").isNull()).alias("documents_emitted"),
        F.count_if(F.col("reason").isNotNull()).alias("pages_dropped"),
        F.struct(*(F.count_if(F.col("reason") == r).alias(r) for r in DROP_REASONS)).alias("drop_counts"),
        F.first("segment_bytes").alias("bytes"),
        F.first("segment_sha256").alias("sha256"),
    )
    nothing = digests.hashlib.sha256().hexdigest()
    return (
        ranges.join(counted, "ordinal")
        .join(content, "ordinal", "left")
        .select(
            F.struct("ordinal", "start", "end", "first_page_id").alias("stream"),
            F.struct("pages", "page_ids_sha256").alias("index"),
            F.struct("bytes", "sha256").alias("segment"),
            F.struct("pages_seen", "documents_emitted", "pages_dropped", "drop_counts").alias("extraction"),
            F.coalesce("documents_content_sha256", F.lit(nothing)).alias("documents_content_sha256"),
        )
        .orderBy("stream.ordinal")
    )


def corpus_audit(docs: DataFrame, near_sample: int) -> dict:
    """The duplicate audit of a corpus; every figure is computed, and sets that reach the driver are bounded reports."""
    exact = duplicates.exact_audit(docs).first().asDict()
    examples = [
        {"first_page_id": r["first_page_id"], "documents": r["documents"], "splits": r["splits"].split(",")}
        for r in duplicates.cross_split_groups(docs).collect()
    ]
    near = duplicates.near_audit(docs, near_sample).first().asDict()
    prints = duplicates.simhashes(duplicates.near_sample(docs, near_sample))
    near["near_duplicate_examples"] = [
        {"page_ids": [r["page_id_a"], r["page_id_b"]], "splits": [r["split_a"], r["split_b"]], "distance": r["distance"]} for r in duplicates.near_examples(prints).collect()
    ]
    return {
        "page_id_split_intersection_count": documents.split_intersection(docs).count(),
        "exact_duplicates": {
            "duplicate_groups": exact["duplicate_groups"],
            "cross_split_groups": exact["cross_split_groups"],
            "cross_split_examples": examples,
        },
        "near_duplicates": near | {"hamming_distance_threshold": duplicates.DISTANCE, "inference_boundary": "the sample only"},
        "semantic_review": {"strata": list(C.STRATA), "candidates_per_stratum": review.PER_STRATUM},
    }


def review_rows(docs: DataFrame) -> list[dict]:
    """The review packet: at most ten candidates a stratum."""
    return [{k: v for k, v in r.asDict().items() if k != "place"} for r in review.review_candidates(docs).collect()]


def _write_ordered_lines(frame: DataFrame, path: Path) -> int:
    """Write the rows of an ordered frame as JSON lines, one partition at a time through the driver."""
    count = 0
    with path.open("w", encoding="utf-8", newline="\n") as file:
        for row in frame.toLocalIterator(prefetchPartitions=True):
            file.write(compact_line(row.asDict(recursive=True)))
            count += 1
    return count


def stage(spark: SparkSession, config: BuildConfig, prepared: Prepared, ranges: DataFrame, done: list[dict], staging: Path) -> dict:
    """Write all artifacts of the committed segments into the staging folder; the manifest's account of them."""
    pages = spark.read.parquet(*(f"file://{c['folder']}/pages" for c in done))
    quarantined = pages.where("problem is not null").select("ordinal", "problem").orderBy("ordinal")
    pages = pages.where("problem is null")
    docs = cascade.documents_of(pages.where("reason is null"), config.wiki, config.site, config.license, config.split)
    if docs.groupBy("page_id").count().where("count > 1").limit(1).count():
        raise ValidationError("a page stands in more than one segment")
    publish.write_table(docs, staging / publish.DOCUMENTS)
    held = spark.read.parquet(f"file://{staging / publish.DOCUMENTS}")
    publish.write_table(held.select(*ATTRIBUTION_COLUMNS), staging / publish.ATTRIBUTION)
    publish.write_table(cascade.decisions_of(pages), staging / publish.DECISIONS)
    dropped = _write_ordered_lines(
        pages.where("reason is not null").select("page_id", "reason", "title").orderBy("ordinal", F.col("page_id").asc_nulls_first()), staging / publish.DROPPED
    )
    keyed = held.join(pages.select("page_id", "ordinal"), "page_id")
    segments = _write_ordered_lines(segment_ledger(pages, ranges.drop("page_ids"), keyed), staging / publish.SEGMENTS)
    if config.quarantine:
        _write_ordered_lines(quarantined, staging / "quarantined-segments.jsonl")
    counts = pages.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("reason").isNull()).alias("e"), *(F.count_if(F.col("reason") == r).alias(r) for r in DROP_REASONS)).first()
    extraction = {
        "pages_seen": counts["n"],
        "documents_emitted": counts["e"],
        "pages_dropped": counts["n"] - counts["e"],
        "drop_counts": {r: counts[r] for r in DROP_REASONS},
    }
    if dropped != extraction["pages_dropped"]:
        raise ValidationError("the ledger of dropped pages does not account for every page")
    audit = {"documents_content_sha256": digests.content_digest(held)} | corpus_audit(held, config.near_sample)
    write_json(staging / publish.AUDIT, audit)
    packet = review_rows(held)
    with (staging / publish.REVIEW).open("w", encoding="utf-8", newline="\n") as file:
        file.writelines(map(compact_line, packet))
    copy_index(prepared, staging / publish.INDEX)
    (staging / publish.CARD).write_text(publish.data_card(prepared.metadata, extraction, audit), encoding="utf-8")
    tokenization = check = None
    if config.tokenizer:
        tokenization = tokens.write_shards(held, config.tokenizer, config.eos_token_id, staging, config.context_length, config.sequences_per_shard)
        check = tokens.training_check(tokenization, staging)
    records = {
        publish.DOCUMENTS: extraction["documents_emitted"], publish.ATTRIBUTION: extraction["documents_emitted"],
        publish.DECISIONS: extraction["pages_seen"], publish.DROPPED: dropped, publish.SEGMENTS: segments, publish.AUDIT: 1,
        publish.REVIEW: len(packet), publish.CARD: 1, publish.INDEX: extraction["pages_seen"],
    }
    return {
        "extraction": extraction,
        "artifacts": {n: artifact(staging, n, r, spark).as_dict() for n, r in records.items()},
        "documents_content_sha256": audit["documents_content_sha256"],
        "attribution_content_sha256": digests.attribution_digest(held),
        "tokenization": tokenization,
        "training_check": check,
    }


def run_build(spark: SparkSession, config: BuildConfig, progress: Callable | None = None, client=None) -> dict:
    """Build, validate and publish; the manifest."""
    ship(spark)
    target = config.output.resolve()
    if target.exists():
        raise ValidationError(f"the output exists already: {target}")
    prepared = prepare(config, client)
    ranges = ranges_of(spark, prepared)
    done, reused = build_segments(spark, config, prepared, ranges, progress)
    with publish.staging_for(target) as staging:
        staged = stage(spark, config, prepared, ranges, done, staging)
        manifest = {
            "schema_version": 2,
            "project": {"name": "corpusmill", "version": __version__, "scope": SCOPE, "contract_version": CONTRACT_VERSION},
            "source": prepared.metadata,
            "execution": {"identity": prepared.identity, "segments": sum(c["last"] - c["first"] + 1 for c in done), "segments_reused": reused},
            "split": asdict(config.split) | {"strategy": "page_id_sha256"},
            "site": config.site,
            "near_sample": config.near_sample,
            "claims": {"semantic_extraction_validated": False, "tested_scope": "mechanically validated"},
        } | staged
        write_json(staging / publish.MANIFEST, manifest)
        report = validate(spark, staging)
        if not report.ok:
            raise ValidationError("; ".join(report.errors))
        publish.publish(staging, target)
    if not config.keep_work:
        publish.clean_up(config.work_folder)
    return manifest


def manifest_text(manifest: dict) -> str:
    """A manifest as it is printed."""
    return json.dumps(manifest, indent=2, sort_keys=True, ensure_ascii=False)


