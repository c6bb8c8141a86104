"""The gate of a dataset over human review."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

from corpusmill.errors import ValidationError
from corpusmill.functions.columns import STRATA
from corpusmill.operators.review import BLOCKING, LABELS, PER_STRATUM, decision_problems
from corpusmill.plans import publish
from corpusmill.plans.validate import validate
from corpusmill.schemas import REVIEW_DECISIONS
from corpusmill.sources.files import file_digests, read_lines


def evaluate_review(spark: SparkSession, folder: Path, decisions: Path) -> dict:
    """Whether complete and valid decisions let a validated dataset pass; the summary of the review.

    The packet must hold ten candidates of each stratum.  Both files are
    bounded by the packet, so they are read on the driver.
    """
    report = validate(spark, folder)
    if not report.ok:
        raise ValidationError("the dataset is not valid: " + "; ".join(report.errors))
    packet = read_lines(folder / publish.REVIEW, "the review packet")
    given = read_lines(decisions, "the decisions")
    held = {s: sum(c.get("stratum") == s for c in packet) for s in STRATA}
    if held != dict.fromkeys(STRATA, PER_STRATUM) or len(packet) != PER_STRATUM * len(STRATA):
        raise ValidationError("the review packet does not hold ten candidates of each stratum")
    for row in given:
        for name in ("page_id", "revision_id"):
            if type(row.get(name)) is not int or row[name] < 0:
                raise ValidationError(f"a decision has no usable {name}")
        for name in ("reviewer", "reviewed_at", "label", "notes"):
            if row.get(name) is not None and not isinstance(row[name], str):
                raise ValidationError(f"decision of page {row['page_id']}: {name} is no text")
    names = REVIEW_DECISIONS.fieldNames()
    frame = spark.createDataFrame([tuple(r.get(n) for n in names) for r in given], REVIEW_DECISIONS)
    candidates = spark.createDataFrame([(c["page_id"], c["revision_id"]) for c in packet], "page_id bigint, revision_id bigint")
    problems = decision_problems(frame, candidates).orderBy("page_id", "problem").collect()
    if problems:
        raise ValidationError("; ".join(f"page {p['page_id']}: {p['problem']}" for p in problems[:20]))
    stratum = {c["page_id"]: c["stratum"] for c in packet}
    blocking = sorted(r["page_id"] for r in given if r["label"] in BLOCKING)
    return {
        "passed": not blocking,
        "candidate_count": len(packet),
        "candidate_file_sha256": file_digests(folder / publish.REVIEW)[1],
        "decision_count": len(given),
        "decision_file_sha256": file_digests(decisions)[1],
        "label_counts": {n: sum(r["label"] == n for r in given) for n in sorted(LABELS)},
        "labels_by_stratum": {s: {n: sum(r["label"] == n and stratum[r["page_id"]] == s for r in given) for n in sorted(LABELS)} for s in STRATA},
        "blocking_page_ids": blocking,
        "reviewers": sorted({r["reviewer"].strip() for r in given}),
        "reviewed_at_dates": sorted({r["reviewed_at"] for r in given}),
        "inference_boundary": "the reviewed sample only",
    }
