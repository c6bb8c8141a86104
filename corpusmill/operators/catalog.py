"""The segment catalog: byte ranges and page lists from an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.functions import columns as C
from corpusmill.operators.packing import with_neighbours


def parse_index_lines(lines: DataFrame) -> DataFrame:
    """Rows ``(byte_offset, page_id, title, line)`` of text lines ``offset:page_id:title``; the title may hold colons.

    A line with fewer than three fields or a field that is no number has nulls
    there, for ``index_problems`` to report.
    """
    parts = F.split("value", ":", 3)
    return lines.select(
        C.parsed_integer(F.get(parts, 0)).alias("byte_offset"),
        C.parsed_integer(F.get(parts, 1)).alias("page_id"),
        F.get(parts, 2).alias("title"),
        F.col("value").alias("line"),
    )


def segment_ranges(index: DataFrame, dump_size: int | None = None) -> DataFrame:
    """Rows ``(ordinal, start, end, first_page_id, pages, page_ids_sha256)`` of the segments that an index names.

    Lines with the same offset form a segment; it ends before the next one and
    the last at the end of the dump (null where its size is not given).
    Repeated lines and lines with nulls are left out.  Starts alone are
    ordered, in two phases; the page lists, each of a bounded number of pages,
    stay in their groups.
    """
    lines = index.select("byte_offset", "page_id").where("byte_offset is not null and page_id is not null").distinct()
    segments = lines.groupBy(F.col("byte_offset").alias("start")).agg(
        F.min("page_id").alias("first_page_id"),
        F.count(F.lit(1)).alias("pages"),
        F.array_sort(F.collect_list("page_id")).alias("page_ids"),
    )
    starts = with_neighbours(lines.select(F.col("byte_offset").alias("start")).distinct(), "start", "start")
    end = F.coalesce(F.col("after") - 1, F.lit(None if dump_size is None else dump_size - 1).cast("bigint"))
    return segments.join(starts.select("start", F.col("place").cast("int").alias("ordinal"), end.alias("end")), "start").select(
        "ordinal", "start", "end", "first_page_id", "pages", C.id_list_hash(F.col("page_ids")).alias("page_ids_sha256"), "page_ids"
    )


def index_problems(index: DataFrame, dump_size: int | None = None) -> DataFrame:
    """Rows ``(problem, page_id, byte_offset, lines)``: what is wrong with an index, read in the order of its pages.

    ``malformed`` and ``negative`` fields, ``repeated`` pages, offsets that go
    ``backwards`` (below the greatest offset of a smaller page), and offsets
    ``outside`` the dump.  The greatest offset before a page is found per range
    of pages first, so no task orders the whole index.
    """
    lines = index.select("byte_offset", "page_id")
    malformed = F.col("byte_offset").isNull() | F.col("page_id").isNull()
    negative = (F.col("byte_offset") < 0) | (F.col("page_id") < 0)
    outside = F.col("byte_offset") >= F.lit(dump_size).cast("bigint") if dump_size is not None else F.lit(False)
    found = F.filter(
        F.array(F.when(malformed, F.lit("malformed")), F.when(negative, F.lit("negative")), F.when(outside, F.lit("outside"))), lambda x: x.isNotNull()
    )
    single = lines.select(F.explode(found).alias("problem"), "page_id", "byte_offset")
    good = lines.where("byte_offset is not null and page_id is not null").groupBy("page_id", "byte_offset").agg(F.count(F.lit(1)).alias("n"))
    repeated = lines.where("page_id is not null").groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = repeated.select(F.lit("repeated").alias("problem"), "page_id", F.lit(None).cast("bigint").alias("byte_offset"))
    step = F.floor(F.col("page_id") / F.lit(RANGE_PAGES))
    ranges = good.groupBy(step.alias("range")).agg(F.max("byte_offset").alias("most"))
    before = ranges.select("range", F.max("most").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)).alias("before"))
    inside = W.partitionBy("range").orderBy("page_id").rangeBetween(W.unboundedPreceding, -1)
    held = good.withColumn("range", step).withColumn("within", F.max("byte_offset").over(inside)).join(before, "range")
    backwards = held.where(F.col("byte_offset") < F.greatest("before", "within")).select(F.lit("backwards").alias("problem"), "page_id", "byte_offset")
    return single.unionByName(repeated).unionByName(backwards).groupBy("problem", "page_id", "byte_offset").agg(F.count(F.lit(1)).alias("lines"))


#: Pages of one range of the order check.
RANGE_PAGES = 65536


def range_problems(ranges: DataFrame, dump_size: int | None = None) -> DataFrame:
    """Rows ``(ordinal, problem)``: ``empty`` ranges, ``gap`` to the one before, numbers that are not ``dense``, and a wrong last end.

    The order of the segments is taken in two phases.
    """
    placed = with_neighbours(ranges.select("ordinal", F.struct("ordinal", "start", "end").alias("range")), "ordinal", "range")
    rows = placed.select(
        "ordinal",
        (F.col("range.end") < F.col("range.start")).alias("empty"),
        (F.col("range.start") != F.col("before.end") + 1).alias("gap"),
        (F.col("ordinal") != F.col("place")).alias("dense"),
        (F.col("after").isNull() & (F.col("range.end") != F.lit(dump_size).cast("bigint") - 1)).alias("last"),
    )
    found = F.filter(
        F.array(*(F.when(F.col(n), F.lit(m)) for n, m in (("empty", "empty"), ("gap", "gap"), ("dense", "not_dense"), ("last", "wrong_end")))),
        lambda x: x.isNotNull(),
    )
    return rows.select("ordinal", F.explode(found).alias("problem"))


def remaining_segments(ranges: DataFrame, committed: DataFrame) -> DataFrame:
    """The segments without a committed checkpoint."""
    return ranges.join(committed.select("ordinal").distinct(), "ordinal", "left_anti")
