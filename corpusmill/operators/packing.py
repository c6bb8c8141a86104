"""Packing of token streams into sequences of fixed length and shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.runtime import checkpointed, small_side


def with_offsets(frame: DataFrame, group: str, order: list[str], size: str) -> DataFrame:
    """The rows with ``offset``, the sum of ``size`` of all rows before them in their group.

    In two phases: rows are cut into sorted ranges, ranges are summed into a
    table with one row each, and offsets are taken within ranges plus that of
    the range.  No task orders a whole group.  ``frame`` must be held, since it
    is ranged once and read twice.
    """
    ranged = checkpointed(frame.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy(group, "_range").agg(F.sum(size).alias("_total"))
    before = F.sum("_total").over(W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    starts = totals.select(group, "_range", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.sum(size).over(W.partitionBy(group, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return (
        ranged.join(starts, [group, "_range"])
        .withColumn("offset", F.col("_start") + F.coalesce(inside, F.lit(0)))
        .drop("_range", "_start")
    )


def with_neighbours(frame: DataFrame, key: str, value: str) -> DataFrame:
    """The rows with ``place``, their number in the order of ``key`` from 0, and ``before`` and ``after``, the value of the rows next to them.

    In two phases as ``with_offsets``: what the last step orders is one row a
    range, whatever the number of rows.  Rows with equal keys stand in any order.
    """
    ranged = checkpointed(frame.repartitionByRange(key).withColumn("_range", F.spark_partition_id()))
    ends = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), F.min_by(value, key).alias("_first"), F.max_by(value, key).alias("_last"))
    ranges, inside = W.orderBy("_range"), W.partitionBy("_range").orderBy(key)  # one row a range
    around = ends.select(
        "_range",
        F.coalesce(F.sum("_rows").over(ranges.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.lag("_last").over(ranges).alias("_before"),
        F.lead("_first").over(ranges).alias("_after"),
    )
    return (
        ranged.join(F.broadcast(around), "_range")
        .withColumn("place", F.col("_start") + F.row_number().over(inside) - 1)
        .withColumn("before", F.coalesce(F.lag(value).over(inside), "_before"))
        .withColumn("after", F.coalesce(F.lead(value).over(inside), "_after"))
        .drop("_range", "_start", "_before", "_after")
    )


def packed_sequences(documents: DataFrame, length: int, per_shard: int) -> DataFrame:
    """Rows ``(split, sequence, shard, tokens)`` of full sequences of ``length`` tokens.

    ``documents`` has ``(split, page_id, tokens)``, the tokens of each document
    with its end token, a page once in its split.  Documents follow each other
    by page in their split; what does not fill the last sequence is left out
    (see ``dropped_tails``).  Only sizes are ordered; their offsets go back to
    the documents, which send one slice of their tokens to each sequence they
    touch.
    """
    # ranging samples its input, which would make the tokens once more
    sized = checkpointed(documents.select("split", "page_id", F.size("tokens").cast("bigint").alias("size")))
    offsets = with_offsets(sized, "split", ["page_id"], "size").where("size > 0")
    placed = documents.select("split", "page_id", "tokens").join(small_side(offsets, offsets.count()), ["split", "page_id"])
    first, last = F.floor(F.col("offset") / length), F.floor((F.col("offset") + F.col("size") - 1) / length)
    cut = placed.withColumn("sequence", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("sequence") * length, F.col("offset"))
    end = F.least((F.col("sequence") + 1) * length, F.col("offset") + F.col("size"))
    part = F.struct(start.alias("at"), F.slice("tokens", (start - F.col("offset") + 1).cast("int"), (end - start).cast("int")).alias("piece"))
    joined = cut.select("split", "sequence", part.alias("part")).groupBy("split", "sequence").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return (
        joined.select("split", "sequence", F.flatten(F.transform("parts", lambda p: p["piece"])).alias("tokens"))
        .where(F.size("tokens") == length)
        .select("split", "sequence", F.floor(F.col("sequence") / per_shard).alias("shard"), "tokens")
    )


def dropped_tails(documents: DataFrame, length: int) -> DataFrame:
    """Rows ``(split, tokens, sequences, dropped_tail_tokens)`` of each split."""
    total = documents.groupBy("split").agg(F.sum(F.size("tokens")).cast("bigint").alias("tokens"))
    return total.select("split", "tokens", F.floor(F.col("tokens") / length).alias("sequences"), (F.col("tokens") % length).alias("dropped_tail_tokens"))


def shard_sizes(documents: DataFrame, length: int, per_shard: int) -> DataFrame:
    """Rows ``(split, shard, sequences)`` from the totals alone."""
    tails = dropped_tails(documents, length).where("sequences > 0")
    shards = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("sequences") - 1) / per_shard)))
    return tails.select("split", shards.alias("shard"), "sequences").select(
        "split", "shard", F.least(F.lit(per_shard).cast("bigint"), F.col("sequences") - F.col("shard") * per_shard).alias("sequences")
    )


def bigram_loss(sequence: DataFrame) -> DataFrame:
    """One row ``(token_pairs, observed_vocabulary, loss_before, loss_after)``: a step of a bigram model on one sequence.

    ``sequence`` has ``(position, token)``.  The model starts from zero weights
    and takes one step of rate 1; both losses have a closed form in the counts
    of pairs.  A sequence of fewer than two tokens gives nulls.
    """
    pairs = sequence.select(F.col("token").alias("i"), F.lead("token").over(W.orderBy("position")).alias("j")).where("j is not null")  # one sequence
    vocabulary = sequence.select("token").distinct().agg(F.count(F.lit(1)).alias("v"))
    counted = pairs.groupBy("i", "j").agg(F.count(F.lit(1)).alias("c"))
    sums = counted.groupBy("i").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("k"))
    size = counted.agg(F.sum("c").alias("pairs"))
    rows = counted.join(sums, "i").crossJoin(F.broadcast(vocabulary)).crossJoin(F.broadcast(size))
    rows = rows.withColumn("logit", (F.col("c") - F.col("n") / F.col("v")) / F.col("pairs"))
    unseen = (F.col("v") - F.col("k")) * F.exp(-F.col("n") / (F.col("v") * F.col("pairs")))
    lse = rows.groupBy("i").agg(F.log(F.sum(F.exp("logit")) + F.max(unseen)).alias("lse"))
    return rows.join(lse, "i").agg(
        F.sum("c").alias("token_pairs"),
        F.max("v").alias("observed_vocabulary"),
        F.round(F.log(F.max("v").cast("double")), 9).alias("loss_before"),
        F.round(-F.sum(F.col("c") * (F.col("logit") - F.col("lse"))) / F.max("pairs"), 9).alias("loss_after"),
    )
