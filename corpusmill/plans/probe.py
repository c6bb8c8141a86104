"""A build of one segment: the shortest way from a dump to a validated dataset."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusmill import __version__
from corpusmill.config import DROP_REASONS, ProbeConfig
from corpusmill.errors import ConfigError, SourceError, ValidationError
from corpusmill.operators import cascade, digests
from corpusmill.plans import publish, tokens
from corpusmill.plans.source import AGENT
from corpusmill.plans.validate import validate
from corpusmill.runtime import checkpointed, ship
from corpusmill.sources.files import artifact, write_json, write_lines
from corpusmill.sources.http import Client, source_urls
from corpusmill.sources.segments import load_catalog, read_index, read_range, read_segments


def run_probe(spark: SparkSession, config: ProbeConfig, client: Client | None = None) -> dict:
    """Extract one segment of a local dump or of a published one; the manifest."""
    ship(spark)
    target = config.output.resolve()
    with publish.staging_for(target) as staging:
        index = staging / publish.INDEX
        if config.dump and config.index:
            index.write_bytes(config.index.read_bytes())
            size, dump = config.dump.stat().st_size, config.dump.resolve()
        else:
            urls = source_urls(config.wiki, config.snapshot, config.base_url)
            web = client or Client(AGENT, config.timeout)
            size, dump = web.length(urls["dump"]), None
            index.write_bytes(web.get(urls["index"], config.max_index_bytes))
        ranges = checkpointed(load_catalog(read_index(spark, f"file://{index}"), size))
        chosen = ranges.where(F.col("ordinal") == config.ordinal)
        row = chosen.first()
        if row is None:
            raise ConfigError("there is no segment of this number")
        length = row["end"] - row["start"] + 1
        if length > config.max_segment_bytes:
            raise SourceError("the segment is larger than allowed")
        segment = staging / ".segment"
        segment.write_bytes(read_range(str(dump), row["start"], row["end"]) if dump else web.get_range(urls["dump"], row["start"], row["end"]))
        local = chosen.withColumn("start", F.lit(0).cast("bigint")).withColumn("end", F.lit(length - 1).cast("bigint"))
        pages = checkpointed(cascade.extracted(read_segments(local, str(segment))).withColumn("page_id", F.coalesce("page_id", "expected_page_id")))
        segment.unlink()
        docs = cascade.documents_of(pages, config.wiki, config.site, config.license, config.split)
        publish.write_table(docs, staging / publish.DOCUMENTS)
        held = spark.read.parquet(f"file://{staging / publish.DOCUMENTS}")
        # the pages of one segment are few
        lost = [r.asDict() for r in pages.where("reason is not null").select("page_id", "reason", "title").orderBy("page_id").collect()]
        write_lines(staging / publish.DROPPED, lost)
        extraction = {
            "pages_seen": pages.count(),
            "documents_emitted": held.count(),
            "pages_dropped": len(lost),
            "drop_counts": {r: sum(x["reason"] == r for x in lost) for r in DROP_REASONS},
        }
        tokenization = check = None
        if config.tokenizer:
            tokenization = tokens.write_shards(held, config.tokenizer, config.eos_token_id, staging, config.context_length, config.sequences_per_shard)
            check = None
        records = {publish.DOCUMENTS: extraction["documents_emitted"], publish.DROPPED: len(lost)}
        manifest = {
            "schema_version": 1,
            "project": {"name": "corpusmill", "version": __version__, "scope": "one_segment"},
            "stream": {k: row[k] for k in ("ordinal", "start", "end", "first_page_id")},
            "split": asdict(config.split) | {"strategy": "page_id_sha256"},
            "extraction": extraction,
            "artifacts": {n: artifact(staging, n, r).as_dict() for n, r in records.items()},
            "documents_content_sha256": digests.content_digest(held),
            "tokenization": tokenization,
            "training_check": check,
        }
        index.unlink()
        write_json(staging / publish.MANIFEST, manifest)
        report = validate(spark, staging)
        if not report.ok:
            raise ValidationError("; ".join(report.errors))
        publish.publish(staging, target)
    return manifest
