"""The review sample of a corpus and the gate over human decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.functions import columns as C
from corpusmill.functions.columns import STRATA

PER_STRATUM = 10
#: Labels of a decision; the last two block a corpus.
LABELS = ("acceptable", "minor_issue", "major_issue", "unreviewable")
BLOCKING = LABELS[2:]


def review_strata(documents: DataFrame) -> DataFrame:
    """Rows ``(stratum, documents)`` of the pages with a text; each page counts once in a stratum."""
    pages = documents.select("page_id", C.stratum(F.col("text")).alias("stratum")).where("page_id is not null and stratum is not null")
    return pages.distinct().groupBy("stratum").agg(F.count(F.lit(1)).alias("documents"))


def review_candidates(documents: DataFrame, per_stratum: int = PER_STRATUM) -> DataFrame:
    """The pages with the lowest scores of each length stratum, ``per_stratum`` of each: the sample humans review.

    The bound per stratum is applied before the exchange as well as after it.
    A page delivered several times is drawn once, with its latest revision;
    pages without an identifier or text are not drawn.
    """
    scored = (
        documents.where("page_id is not null and text is not null")
        .withColumn("stratum", C.stratum(F.col("text")))
        .withColumn("score", C.sample_score("semantic-review-v1", F.col("page_id")))
    )
    key = ("score", "page_id")
    latest = W.partitionBy("stratum", "page_id").orderBy(F.col("revision_id").desc_nulls_last(), "text")
    # scores order the pages, so the bound of a stratum holds on (score, page_id) before pages are told apart
    ranked = scored.withColumn("place", F.dense_rank().over(W.partitionBy("stratum").orderBy(*key))).where(F.col("place") <= per_stratum)
    return (
        ranked.withColumn("copy", F.row_number().over(latest))
        .where("copy = 1")
        .select(
            "stratum",
            "page_id",
            "revision_id",
            "revision_timestamp",
            "title",
            "url",
            C.revision_url(F.col("url"), F.col("revision_id")).alias("oldid_url"),
            C.text_hash(F.col("text")).alias("text_sha256"),
            F.col("text").alias("extracted_text"),
            F.lit(None).cast("string").alias("human_label"),
            F.lit(None).cast("string").alias("human_notes"),
            F.col("place").cast("int").alias("place"),
        )
        .orderBy("stratum", "place")
    )


def decision_problems(decisions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows ``(page_id, problem, rows)``: everything that keeps the decisions from being accepted.

    Problems: ``not_a_candidate``, ``duplicated``, ``wrong_revision``,
    ``invalid_label``, ``no_reviewer``, ``invalid_date``, ``invalid_notes``
    (null, or blank for another label than acceptable), and ``missing`` for
    candidates without a decision.  Dates are ``YYYY-MM-DD``.
    """
    known = candidates.select(F.col("page_id").alias("candidate"), F.col("revision_id").alias("wanted")).distinct()
    joined = decisions.join(known, decisions["page_id"] == known["candidate"], "left")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    date = F.when(F.col("reviewed_at").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(F.try_to_timestamp("reviewed_at", F.lit("yyyy-MM-dd"))))
    checks = {
        "not_a_candidate": F.col("candidate").isNull(),
        "wrong_revision": F.col("candidate").isNotNull() & ~F.col("revision_id").eqNullSafe(F.col("wanted")),
        "invalid_label": ~F.coalesce(F.col("label").isin(*LABELS), F.lit(False)),
        "no_reviewer": blank(F.col("reviewer")),
        "invalid_date": date.isNull(),
        "invalid_notes": F.col("notes").isNull() | (F.coalesce(F.col("label") != "acceptable", F.lit(True)) & blank(F.col("notes"))),
    }
    found = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())), lambda x: x.isNotNull())
    single = joined.select("page_id", F.explode(found).alias("problem"))
    repeated = decisions.groupBy("page_id").count().where("count > 1").select("page_id", F.lit("duplicated").alias("problem"))
    missing = known.join(decisions.select("page_id").distinct(), known["candidate"] == decisions["page_id"], "left_anti").select(
        F.col("candidate").alias("page_id"), F.lit("missing").alias("problem")
    )
    return single.unionByName(repeated).unionByName(missing).groupBy("page_id", "problem").agg(F.count(F.lit(1)).alias("rows"))


def label_counts(decisions: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows ``(stratum, label, decisions)`` for every stratum and label, zero where there is none.

    Decisions count under the stratum of their page; labels out of the list and
    pages without a text are left out.
    """
    spark = decisions.sparkSession
    grid = spark.createDataFrame([(s, n) for s in STRATA for n in LABELS], "stratum string, label string")
    of_page = documents.where("page_id is not null and text is not null").groupBy("page_id").agg(F.min(C.stratum(F.col("text"))).alias("stratum"))
    counted = decisions.where(F.col("label").isin(*LABELS)).join(of_page, "page_id").groupBy("stratum", "label").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(grid).join(counted, ["stratum", "label"], "left").select("stratum", "label", F.coalesce("n", F.lit(0)).alias("decisions"))


def reviewers(decisions: DataFrame) -> DataFrame:
    """Rows ``(reviewer, decisions, pages, dates, blocking)`` of each reviewer, names trimmed; blank names are left out."""
    return (
        decisions.withColumn("reviewer", F.trim("reviewer"))
        .where("reviewer <> ''")
        .groupBy("reviewer")
        .agg(
            F.count(F.lit(1)).alias("decisions"),
            F.countDistinct("page_id").alias("pages"),
            F.countDistinct("reviewed_at").alias("dates"),
            F.count_if(F.col("label").isin(*BLOCKING)).alias("blocking"),
        )
    )
