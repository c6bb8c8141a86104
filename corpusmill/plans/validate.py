"""The separate validator: every claim of a manifest is derived again from the data."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import CONTRACT_VERSION, DROP_REASONS, SPLITS, SplitConfig
from corpusmill.errors import CorpusError, ValidationError
from corpusmill.functions import columns as C
from corpusmill.functions.markup import residue_kinds
from corpusmill.operators import catalog, digests, documents, ledger
from corpusmill.operators.packing import with_neighbours
from corpusmill.plans import publish, tokens
from corpusmill.runtime import ship
from corpusmill.schemas import ATTRIBUTION, DOCUMENTS, PAGE_DECISIONS
from corpusmill.sources.files import artifact, compact_line, confined, file_digests, read_json, read_lines
from corpusmill.sources.segments import read_index
from corpusmill.sources.shards import TOKEN_TYPES, ShardView


@dataclass
class Report:
    """The checks that ran and every violation they found."""

    checks: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.errors

    def need(self, holds: bool, message: str) -> bool:
        if not holds:
            self.errors.append(message)
        return bool(holds)


def validate(spark: SparkSession, folder: Path) -> Report:
    """Validate a dataset of either manifest version; errors are collected, never raised."""
    ship(spark)
    report = Report()
    root = folder.resolve()
    try:
        manifest = read_json(root / publish.MANIFEST, "the manifest")
        version = manifest.get("schema_version")
        if version not in (1, 2):
            report.errors.append("unsupported manifest version")
            return report
        if version == 2:
            _source(report, manifest)
        if not _artifacts(spark, report, manifest, root):
            return report
        docs = _documents(spark, report, manifest, root)
        if version == 2:
            _attribution(spark, report, manifest, root, docs)
            _segments(spark, report, manifest, root)
            _decisions(spark, report, manifest, root, docs)
            _audit(report, manifest, root, docs)
            _review(report, root, docs)
        else:
            _accounting(report, manifest, root)
        if manifest.get("tokenization"):
            _tokens(report, manifest, root)
    except (CorpusError, OSError, KeyError, TypeError, ValueError, AttributeError) as error:
        report.errors.append(f"validation could not complete: {type(error).__name__}: {error}")
    return report


def _source(report: Report, manifest: dict) -> None:
    project, source = manifest["project"], manifest["source"]
    report.need(project.get("scope") == "complete_dated_dump", "source scope is wrong")
    report.need(project.get("contract_version") == CONTRACT_VERSION, "contract version is wrong")
    report.need(isinstance(source.get("snapshot"), str) and len(source["snapshot"]) == 8 and source["snapshot"].isdigit(), "source snapshot is not dated")
    report.need(source.get("status") == "done", "source status is not done")
    for name in ("dump", "index"):
        report.need(source[name].get("sha1") == source[name].get("published_sha1"), f"source {name} checksum differs from the published one")
    report.checks.append("source identity")


def _artifacts(spark: SparkSession, report: Report, manifest: dict, root: Path) -> bool:
    before = len(report.errors)
    for name, stated in manifest["artifacts"].items():
        path = confined(root, stated.get("path"))
        if not report.need(path.exists(), f"artifact {name} is missing"):
            continue
        held = artifact(root, stated["path"], stated.get("records"), spark).as_dict()
        report.need(held["bytes"] == stated.get("bytes"), f"artifact {name} has another size")
        report.need(held["sha256"] == stated.get("sha256"), f"artifact {name} has another hash")
    if "source" in manifest and publish.INDEX in manifest["artifacts"]:
        first, second, size = file_digests(root / publish.INDEX)
        stated = manifest["source"]["index"]
        report.need((first, second, size) == (stated.get("sha1"), stated.get("sha256"), stated.get("bytes")), "bundled index is not the source index")
    report.checks.append("artifact hashes")
    return len(report.errors) == before


def _split_config(manifest: dict) -> SplitConfig:
    stated = manifest["split"]
    if stated.get("strategy") != "page_id_sha256":
        raise ValidationError("unknown split strategy")
    return SplitConfig(stated["train"], stated["validation"], stated["test"], stated["seed"])


def _same_schema(frame: DataFrame, wanted) -> bool:
    return [(f.name, f.dataType) for f in frame.schema.fields] == [(f.name, f.dataType) for f in wanted.fields]


def _documents(spark: SparkSession, report: Report, manifest: dict, root: Path) -> DataFrame:
    raw = spark.read.parquet(f"file://{root / publish.DOCUMENTS}")
    if not report.need(_same_schema(raw, DOCUMENTS), "document schema differs"):
        raise ValidationError("documents cannot be checked")
    docs = raw
    text = F.col("text")
    figures = docs.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("page_id").alias("pages"),
        F.count_if(~F.col("split").eqNullSafe(C.assigned_split(F.col("page_id"), _split_config(manifest)))).alias("splits"),
        F.count_if(~F.col("text_sha256").eqNullSafe(C.text_hash(text))).alias("hashes"),
        F.count_if(F.coalesce(F.size(residue_kinds(text)), F.lit(0)) > 0).alias("residue"),
        F.count_if(C.word_count(text) < 3).alias("short"),
        F.count_if(F.col("page_id").isNull() | (F.col("page_id") < 0)).alias("ids"),
    ).first()
    stated = manifest["artifacts"][publish.DOCUMENTS]["records"]
    report.need(figures["rows"] == stated and figures["rows"] == manifest["extraction"]["documents_emitted"], "document counts differ")
    report.need(figures["rows"] == figures["pages"] and not figures["ids"], "page identifiers are repeated or missing")
    report.need(not publish.out_of_order(spark, root / publish.DOCUMENTS), "page identifiers do not rise strictly")
    report.need(not figures["splits"], f"{figures['splits']} documents are in another split than assigned")
    report.need(not figures["hashes"], f"{figures['hashes']} text hashes differ")
    if figures["residue"]:
        first = [r["page_id"] for r in docs.where(F.size(residue_kinds(text)) > 0).orderBy("page_id").limit(20).select("page_id").collect()]
        report.errors.append(f"{figures['residue']} documents hold markup, first {first}")
    report.need(not figures["short"], f"{figures['short']} documents have fewer than three words")
    report.need(digests.content_digest(docs) == manifest["documents_content_sha256"], "document content hash differs")
    report.checks.append("documents")
    return docs


def _attribution(spark: SparkSession, report: Report, manifest: dict, root: Path, docs: DataFrame) -> None:
    rows = spark.read.parquet(f"file://{root / publish.ATTRIBUTION}")
    if report.need(_same_schema(rows, ATTRIBUTION), "attribution schema differs"):
        report.need(rows.count() == manifest["extraction"]["documents_emitted"], "attribution count differs")
        report.need(documents.attribution_mismatches(docs, rows).isEmpty(), "attribution differs from the documents")
        report.need(digests.attribution_digest(rows) == manifest["attribution_content_sha256"], "attribution content hash differs")
    report.checks.append("attribution")


def _ranges(spark: SparkSession, manifest: dict, root: Path) -> tuple[DataFrame, DataFrame]:
    index = read_index(spark, f"file://{root / publish.INDEX}")
    size = manifest["source"]["dump"]["bytes"]
    return index, catalog.segment_ranges(index, size)


_LEDGER = (
    "stream struct<ordinal:int,start:bigint,end:bigint,first_page_id:bigint>, index struct<pages:bigint,page_ids_sha256:string>, "
    "segment struct<bytes:bigint,sha256:string>, extraction struct<pages_seen:bigint,documents_emitted:bigint,pages_dropped:bigint,"
    "drop_counts:map<string,bigint>>, documents_content_sha256 string"
)


def _segments(spark: SparkSession, report: Report, manifest: dict, root: Path) -> None:
    """The segment ledger against the ranges of the index, as a join; errors name the first segment of each kind."""
    stated = spark.read.schema(_LEDGER).option("mode", "FAILFAST").json(f"file://{root / publish.SEGMENTS}")
    _, ranges = _ranges(spark, manifest, root)
    count = lambda key: F.coalesce(F.col(f"extraction.drop_counts.{key}"), F.lit(0))
    rows = with_neighbours(stated.withColumn("ordinal", F.col("stream.ordinal")), "ordinal", "stream")
    wanted = ranges.select("ordinal", F.struct("start", "end", "first_page_id", "pages", "page_ids_sha256").alias("wanted"))
    joined = rows.join(wanted, "ordinal", "full")
    differs = lambda part, names: F.lit(False) if not names else ~F.struct(*(F.col(f"{part}.{n}") for n in names)).eqNullSafe(F.struct(*(F.col(f"wanted.{n}") for n in names)))
    listed, known = F.col("stream").isNotNull(), F.col("wanted").isNotNull()
    outcome, segment, stream = F.col("extraction"), F.col("segment"), F.col("stream")
    accounts = (outcome["documents_emitted"] + outcome["pages_dropped"] == outcome["pages_seen"]) & (outcome["pages_seen"] == F.col("wanted.pages"))
    dropped = F.aggregate(F.map_values(outcome["drop_counts"]), F.lit(0).cast("bigint"), lambda a, b: a + b)
    unknown = F.size(F.array_except(F.map_keys(outcome["drop_counts"]), F.array(*map(F.lit, DROP_REASONS)))) > 0
    faults = {
        "is not in the index": listed & ~known,
        "is not in the ledger": known & ~listed,
        "is listed twice or out of number": listed & (F.col("place") != F.col("ordinal")),
        "range differs": listed & known & differs("stream", ["start", "end", "first_page_id"]),
        "pages differ": listed & known & differs("index", ["pages", "page_ids_sha256"]),
        "does not follow the one before": listed & (stream["start"] != F.col("before.end") + 1),
        "length differs": listed & ~segment["bytes"].eqNullSafe(stream["end"] - stream["start"] + 1),
        "has no hash": listed & ~F.coalesce(F.length(segment["sha256"]) == 64, F.lit(False)),
        "does not account for its pages": listed & known & ~F.coalesce(accounts, F.lit(False)),
        "reasons differ": listed & ~dropped.eqNullSafe(outcome["pages_dropped"]),
        "has an unknown reason": listed & F.coalesce(unknown, F.lit(True)),
    }
    totals = ("pages_seen", "documents_emitted", "pages_dropped")
    figures = joined.agg(
        *(F.min(F.when(c, F.col("ordinal"))).alias(f"f{i}") for i, c in enumerate(faults.values())),
        *(F.coalesce(F.sum(outcome[t]), F.lit(0)).alias(t) for t in totals),
        *(F.coalesce(F.sum(count(r)), F.lit(0)).alias(r) for r in DROP_REASONS),
        F.max(stream["end"]).alias("end"),
    ).first()
    for i, message in enumerate(faults):
        if figures[f"f{i}"] is not None:
            report.errors.append(f"segment {figures[f'f{i}']} {message}")
    report.need(figures["end"] == manifest["source"]["dump"]["bytes"] - 1, "the last segment does not end the dump")
    extraction = manifest["extraction"]
    report.need(all(figures[t] == extraction[t] for t in totals), "segment totals differ from the manifest")
    report.need({r: figures[r] for r in DROP_REASONS} == extraction["drop_counts"], "segment reasons differ from the manifest")
    report.checks.append("segments")


def _decisions(spark: SparkSession, report: Report, manifest: dict, root: Path, docs: DataFrame) -> None:
    rows = spark.read.parquet(f"file://{root / publish.DECISIONS}")
    if not report.need(_same_schema(rows, PAGE_DECISIONS), "decision schema differs"):
        return
    extraction = manifest["extraction"]
    problems = {r["problem"]: r["n"] for r in ledger.decision_problems(rows).groupBy("problem").agg(F.count(F.lit(1)).alias("n")).collect()}
    for name, count in sorted(problems.items()):
        report.errors.append(f"{count} decisions: {name}")
    index, ranges = _ranges(spark, manifest, root)
    sides = {r["only_in"]: r["n"] for r in ledger.decisions_against_index(rows, index).groupBy("only_in").agg(F.count(F.lit(1)).alias("n")).collect()}
    report.need(not sides.get("decisions"), f"{sides.get('decisions')} decisions are of pages not in the index")
    report.need(not sides.get("index"), f"{sides.get('index')} pages of the index have no decision")
    placed = ranges.select("ordinal", F.explode("page_ids").alias("page_id"))
    moved = rows.join(placed, "page_id").where(F.col("ordinal") != F.col("stream_ordinal"))
    report.need(moved.isEmpty(), "decisions stand under another segment than the index")
    report.need(not publish.out_of_order(spark, root / publish.DECISIONS), "decisions are not in the order of the index")
    report.need(ledger.decisions_against_documents(rows, docs).isEmpty(), "emitted decisions and documents differ")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("decision") == "emitted").alias("e")).first()
    report.need((counts["n"], counts["e"]) == (extraction["pages_seen"], extraction["documents_emitted"]), "decision counts differ")
    held = {r["reason"]: r["pages"] for r in ledger.drop_counts(rows).collect()}
    report.need(held == extraction["drop_counts"], "decision reasons differ")
    dropped = rows.where("decision = 'dropped'").select("page_id", "reason")
    listed = spark.read.schema("page_id bigint, reason string, title string").option("mode", "FAILFAST").json(f"file://{root / publish.DROPPED}").select("page_id", "reason")
    report.need(dropped.exceptAll(listed).isEmpty() and listed.exceptAll(dropped).isEmpty(), "dropped pages and decisions differ")
    report.checks.append("decisions")


def _audit(report: Report, manifest: dict, root: Path, docs: DataFrame) -> None:
    from corpusmill.plans.build import corpus_audit

    stated = read_json(root / publish.AUDIT, "the audit")
    derived = corpus_audit(docs, manifest["near_sample"])
    report.need(stated.get("documents_content_sha256") == manifest["documents_content_sha256"], "the audit is of another corpus")
    report.need(derived["page_id_split_intersection_count"] == 0, "pages stand in more than one split")
    for name, value in derived.items():
        report.need(stated.get(name) == value, f"audit differs: {name}")
    report.checks.append("audit")


def _review(report: Report, root: Path, docs: DataFrame) -> None:
    from corpusmill.plans.build import review_rows

    held = (root / publish.REVIEW).read_text(encoding="utf-8")
    report.need(held == "".join(map(compact_line, review_rows(docs))), "review packet differs")
    report.checks.append("review packet")


def _accounting(report: Report, manifest: dict, root: Path) -> None:
    rows = read_lines(root / publish.DROPPED, "the dropped pages")
    extraction = manifest["extraction"]
    report.need(len(rows) == extraction["pages_dropped"], "dropped pages differ")
    report.need(extraction["documents_emitted"] + extraction["pages_dropped"] == extraction["pages_seen"], "pages are not accounted for")
    counted = {r: sum(row.get("reason") == r for row in rows) for r in DROP_REASONS}
    report.need(all(row.get("reason") in DROP_REASONS for row in rows), "a page is dropped for an unknown reason")
    report.need(counted == extraction["drop_counts"], "drop reasons differ")
    report.checks.append("accounting")


def _tokens(report: Report, manifest: dict, root: Path) -> None:
    stated = manifest["tokenization"]
    holder = stated["tokenizer"]
    path = confined(root, holder.get("path"))
    if report.need(path.is_file(), "the tokenizer is missing"):
        _, digest, size = file_digests(path)
        report.need((digest, size) == (holder.get("sha256"), holder.get("bytes")), "the tokenizer differs")
    if not report.need(stated.get("dtype") in TOKEN_TYPES, "unknown token type") or not report.need(isinstance(stated.get("shards"), list), "shards are no list"):
        return
    width = np.dtype(TOKEN_TYPES[stated["dtype"]]).itemsize
    for shard in stated["shards"]:
        place, name = confined(root, shard.get("path")), shard.get("path")
        if not report.need(place.is_file(), f"shard {name} is missing"):
            continue
        _, digest, size = file_digests(place)
        sound = report.need(size == shard.get("bytes") == shard.get("sequences", -1) * stated["context_length"] * width, f"shard {name} has another size")
        report.need(digest == shard.get("sha256"), f"shard {name} has another hash")
        report.need(shard.get("split") in SPLITS, f"shard {name} has no known split")
        if sound and size:
            report.need(int(ShardView(place, stated["dtype"], stated["context_length"]).rows.max()) < holder["vocab_size"], f"shard {name} holds an id outside of the vocabulary")
    if manifest.get("training_check") is not None and report.ok:
        report.need(tokens.training_check(stated, root) == manifest["training_check"], "training check differs")
    report.checks.append("tokens")
