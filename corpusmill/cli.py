"""The command line: probe, build, validate, inspect, review-semantic."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from corpusmill import __version__
from corpusmill.config import BuildConfig, ProbeConfig, SplitConfig
from corpusmill.errors import CorpusError


def session():
    """The active Spark session, or a local one."""
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("corpusmill").config("spark.sql.session.timeZone", "UTC")
    return SparkSession.getActiveSession() or builder.getOrCreate()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusmill", description=__doc__)
    top.add_argument("--version", action="version", version=f"corpusmill {__version__}")
    verbs = top.add_subparsers(dest="verb", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--wiki", required=True)
    common.add_argument("--output", type=Path, required=True)
    common.add_argument("--dump", type=Path, help="a local dump; else it is fetched")
    common.add_argument("--index", type=Path, help="the local index of the dump")
    common.add_argument("--base-url")
    common.add_argument("--site", default="wikipedia.org")
    common.add_argument("--seed", default=SplitConfig.seed)
    common.add_argument("--train", type=int, default=SplitConfig.train)
    common.add_argument("--validation", type=int, default=SplitConfig.validation)
    common.add_argument("--test", type=int, default=SplitConfig.test)
    common.add_argument("--tokenizer", type=Path)
    common.add_argument("--eos-token-id", type=int)
    common.add_argument("--context-length", type=int, default=BuildConfig.context_length)
    common.add_argument("--sequences-per-shard", type=int, default=BuildConfig.sequences_per_shard)
    probe = verbs.add_parser("probe", parents=[common], help="extract one segment")
    probe.add_argument("--snapshot", default=ProbeConfig.snapshot)
    probe.add_argument("--ordinal", type=int, default=0)
    build = verbs.add_parser("build", parents=[common], help="build a dated dump")
    build.add_argument("--snapshot", required=True)
    build.add_argument("--work", type=Path)
    build.add_argument("--workers", type=int, default=BuildConfig.workers)
    build.add_argument("--near-sample", type=int, default=BuildConfig.near_sample)
    build.add_argument("--keep-work", action="store_true")
    build.add_argument("--quarantine", action="store_true", help="set faulty segments aside instead of failing")
    build.add_argument("--fail-after", type=int, help=argparse.SUPPRESS)
    for name, text in (("validate", "check a dataset"), ("inspect", "print a manifest")):
        verbs.add_parser(name, help=text).add_argument("dataset", type=Path)
    review = verbs.add_parser("review-semantic", help="evaluate human decisions")
    review.add_argument("dataset", type=Path)
    review.add_argument("decisions", type=Path)
    return top


def _shared(a: argparse.Namespace) -> dict:
    return {
        "wiki": a.wiki, "snapshot": a.snapshot, "output": a.output, "dump": a.dump, "index": a.index, "base_url": a.base_url, "site": a.site,
        "split": SplitConfig(a.train, a.validation, a.test, a.seed), "tokenizer": a.tokenizer, "eos_token_id": a.eos_token_id,
        "context_length": a.context_length, "sequences_per_shard": a.sequences_per_shard,
    }


def _print(value: object) -> None:
    print(json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False))


def summary(output: Path, manifest: dict) -> dict:
    """What a run reports of its manifest: where it lies, what was seen and kept, and the hash of the content."""
    execution, tokenization = manifest.get("execution", {}), manifest.get("tokenization")
    return {
        "output": str(output),
        "schema_version": manifest["schema_version"],
        "extraction": manifest["extraction"],
        "documents_content_sha256": manifest["documents_content_sha256"],
        "segments": execution.get("segments", 1),
        "segments_reused": execution.get("segments_reused", 0),
        "token_shards": len(tokenization["shards"]) if tokenization else 0,
    }


def run(a: argparse.Namespace) -> int:
    """Run one verb; 0 for success, 1 for a dataset that is not valid or a review that blocks."""
    if a.verb == "probe":
        from corpusmill.plans.probe import run_probe

        config = ProbeConfig(ordinal=a.ordinal, **_shared(a))
        _print(summary(config.output, run_probe(session(), config)))
        return 0
    if a.verb == "build":
        from corpusmill.plans.build import run_build

        config = BuildConfig(
            work=a.work, workers=a.workers, near_sample=a.near_sample, keep_work=a.keep_work, quarantine=a.quarantine, fail_after=a.fail_after, **_shared(a)
        )
        manifest = run_build(session(), config, lambda state: print(json.dumps(state, sort_keys=True), file=sys.stderr))
        _print(summary(config.output, manifest))
        return 0
    if a.verb == "validate":
        from corpusmill.plans.validate import validate

        report = validate(session(), a.dataset)
        _print({"checks": report.checks, "errors": report.errors, "ok": report.ok})
        return 0 if report.ok else 1
    if a.verb == "inspect":
        from corpusmill.sources.files import read_json

        _print(read_json(a.dataset / "manifest.json", "the manifest"))
        return 0
    from corpusmill.plans.semantic import evaluate_review

    result = evaluate_review(session(), a.dataset, a.decisions)
    _print(result)
    return 0 if result["passed"] else 1


def main(args: list[str] | None = None) -> int:
    """Parse and run; errors the engine names go to standard error with status 2."""
    try:
        return run(parser().parse_args(args))
    except (CorpusError, OSError, ValueError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 2
