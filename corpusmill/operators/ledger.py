"""Accounting: every page is emitted or dropped, once, with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.config import DROP_REASONS


def accounting(decisions: DataFrame) -> DataFrame:
    """Rows ``(stream_ordinal, pages_seen, emitted, dropped, unaccounted)`` of each segment, repeated decisions counted once."""
    rows = decisions.distinct()
    emitted, dropped = F.count_if(F.col("decision") == "emitted"), F.count_if(F.col("decision") == "dropped")
    return rows.groupBy("stream_ordinal").agg(
        F.count(F.lit(1)).alias("pages_seen"),
        emitted.alias("emitted"),
        dropped.alias("dropped"),
        (F.count(F.lit(1)) - emitted - dropped).alias("unaccounted"),
    )


def drop_counts(decisions: DataFrame) -> DataFrame:
    """Rows ``(reason, pages)`` of all six reasons, zero where there is none; repeated decisions count once."""
    counted = decisions.where("decision = 'dropped'").distinct().groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    reasons = decisions.sparkSession.createDataFrame([(r,) for r in DROP_REASONS], "reason string")
    return F.broadcast(reasons).join(counted, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("pages"))


def decision_problems(decisions: DataFrame) -> DataFrame:
    """Rows ``(page_id, stream_ordinal, problem, rows)`` of decisions that break the rules.

    ``unknown_decision``; ``emitted_with_reason``; ``dropped_without_reason``
    and ``unknown_reason``; ``no_page`` for a null identifier; ``repeated`` for
    a page decided more than once.
    """
    decision, reason = F.col("decision"), F.col("reason")
    checks = {
        "unknown_decision": ~F.coalesce(decision.isin("emitted", "dropped"), F.lit(False)),
        "emitted_with_reason": (decision == "emitted") & reason.isNotNull(),
        "dropped_without_reason": (decision == "dropped") & reason.isNull(),
        "unknown_reason": reason.isNotNull() & ~reason.isin(*DROP_REASONS),
        "no_page": F.col("page_id").isNull(),
    }
    found = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())), lambda x: x.isNotNull())
    single = decisions.select("page_id", "stream_ordinal", F.explode(found).alias("problem"))
    repeated = (
        decisions.where("page_id is not null")
        .groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("page_id", F.lit(None).cast("int").alias("stream_ordinal"), F.lit("repeated").alias("problem"))
    )
    return single.unionByName(repeated).groupBy("page_id", "stream_ordinal", "problem").agg(F.count(F.lit(1)).alias("rows"))


def page_difference(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Rows ``(page_id, only_in)``: identifiers of one side that the other lacks; nulls are left out.

    Both sides are reduced to distinct identifiers before they meet.
    """
    sides = left.select("page_id", F.lit(1).alias("side")).distinct().unionByName(right.select("page_id", F.lit(2).alias("side")).distinct())
    seen = sides.where("page_id is not null").groupBy("page_id").agg(F.sum("side").alias("sides"))
    return seen.where("sides <> 3").select("page_id", F.when(F.col("sides") == 1, left_name).otherwise(right_name).alias("only_in"))


def decisions_against_index(decisions: DataFrame, index: DataFrame) -> DataFrame:
    """Pages of the decisions and the index that the other side lacks: ``extra`` and ``missing`` decisions."""
    return page_difference(decisions, index, "decisions", "index")


def decisions_against_documents(decisions: DataFrame, documents: DataFrame) -> DataFrame:
    """Emitted decisions without a document and documents without an emitted decision."""
    return page_difference(decisions.where("decision = 'emitted'"), documents, "decisions", "documents")


def positions_against_index(pages: DataFrame, index_pages: DataFrame) -> DataFrame:
    """Rows ``(ordinal, position, page_id, expected_page_id)`` where a segment's pages differ from its index lines.

    ``pages`` has ``(ordinal, position, page_id)``, ``index_pages`` the same of
    the index.  A page without an identifier of its own takes the index's and
    is no difference.
    """
    expected = index_pages.select("ordinal", "position", F.col("page_id").alias("expected_page_id"), F.lit(True).alias("listed"))
    seen = pages.select("ordinal", "position", "page_id", F.lit(True).alias("found"))
    differs = F.col("listed").isNull() | F.col("found").isNull() | (F.col("page_id").isNotNull() & (F.col("page_id") != F.col("expected_page_id")))
    return seen.join(expected, ["ordinal", "position"], "full").where(differs).select("ordinal", "position", "page_id", "expected_page_id")


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows ``(page_id, left_rows, right_rows)`` of the identifiers that the sides hold in different numbers; nulls are compared too."""
    sides = left.select("page_id", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select("page_id", F.lit(0).alias("l"), F.lit(1).alias("r")))
    counted = sides.groupBy("page_id").agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    return counted.where("left_rows <> right_rows")


def ledger_against_ranges(ledger: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows ``(ordinal, pages_seen, pages)`` where the accounting of a segment and the pages the index lists for it differ.

    A segment that one side lacks has null there; accounts without a segment
    are left out.
    """
    seen = ledger.where("stream_ordinal is not null").select(F.col("stream_ordinal").alias("ordinal"), "pages_seen")
    return seen.join(ranges.select("ordinal", "pages"), "ordinal", "full").where(~F.col("pages_seen").eqNullSafe(F.col("pages")))
