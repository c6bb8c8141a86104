"""Filling containers of fixed capacity (problem 4).

Texts are dealt to shards by a hash of their page, as many shards as the total
length needs, each of a bounded number of containers; shards are packed
independently.  Within a shard items are taken from long to short and each goes
into the open container, fitting under every constraint, whose residual vector
suits it best.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.columns import tidy
from corpusmill.runtime import checkpointed

#: Containers of a shard: enough that the last, emptier ones hardly count, few enough to pack in memory.
SHARD_CONTAINERS = 512
#: Most texts or pieces of one container.
MAX_ITEMS = 32
#: Attention cost of one container, the sum of its items' squared lengths, as a share of the squared capacity.
ATTENTION_SHARE = 0.85
#: Weights of the three constraints in the choice of a container.
WEIGHTS = (1.0, 0.05, 0.25)


def best_fit(sizes: np.ndarray, capacity: int, max_items: int = MAX_ITEMS, attention: float | None = None, score: str = "norm") -> np.ndarray:
    """The container number of each item, none larger than the capacity.

    Every item asks for a share of three capacities: its length, one place of
    ``max_items``, and its squared length of ``attention``, by default
    ``ATTENTION_SHARE`` of the squared capacity.  An item that costs more
    attention than that by itself is alone in its container.  Among the open containers that can take it under
    all three it goes to the one with the smallest weighted norm of what would
    be left (``norm``) or the largest weighted product with what is left
    (``dot``); ties go to the older container, and where none fits a new one is
    opened.
    """
    attention = ATTENTION_SHARE * float(capacity) ** 2 if attention is None else float(attention)
    sizes = np.asarray(sizes, float)
    need = np.stack([sizes / capacity, np.full(len(sizes), 1 / max_items), np.minimum(1.0, sizes**2 / attention)], 1)
    if len(sizes) and need.max() > 1 + 1e-12:
        raise ValueError("an item exceeds a capacity by itself")
    weights = np.array(WEIGHTS)
    left = np.ones((64, 3))
    opened, alive = 0, np.zeros(0, np.int64)
    places = np.zeros(len(sizes), np.int64)
    order = np.lexsort((np.arange(len(sizes)), -sizes))
    smallest = need[order[-1]] if len(order) else None
    for item in order:
        ask = need[item]
        rest = left[alive] - ask
        fits = np.flatnonzero((rest >= -1e-12).all(1))
        if len(fits):
            worth = -(rest[fits] ** 2 @ weights) if score == "norm" else left[alive[fits]] @ (weights * ask)
            at = fits[int(np.argmax(worth))]
            bin_ = alive[at]
        else:
            if opened == len(left):
                left = np.concatenate([left, np.ones_like(left)])
            bin_, at, opened = opened, len(alive), opened + 1
            alive = np.append(alive, bin_)
        left[bin_] -= ask
        places[item] = bin_
        if (left[bin_] < smallest - 1e-12).any():
            alive = np.delete(alive, at)
    return places


def _capacities(capacities: DataFrame) -> DataFrame:
    """Rows ``(split, capacity)``: the smaller one of a split that occurs twice; null splits and capacities below 1 are left out."""
    return (
        capacities.select(tidy(F.col("split")).alias("split"), F.col("capacity_chars").cast("bigint").alias("capacity"))
        .where("capacity > 0 and split is not null")
        .groupBy("split")
        .agg(F.min("capacity").alias("capacity"))
    )


def pack_texts(
    pages: DataFrame,
    capacities: DataFrame,
    max_items: int = MAX_ITEMS,
    shard_containers: int = SHARD_CONTAINERS,
    score: str = "norm",
    attention_share: float = ATTENTION_SHARE,
) -> DataFrame:
    """Rows ``(page_id, split, piece, piece_start, n_chars, container)``: the container of each text or piece.

    Lengths are code points.  A text longer than the capacity is cut into
    pieces of exactly the capacity and one rest; no other text is cut.  A page
    delivered several times with the same text and split is packed once.  Null
    and empty texts need no container and give no row; nor do rows whose split,
    trimmed and lower-cased, has no capacity.  Full pieces fill a container and
    are numbered without being packed.  Splits that occur twice in
    ``capacities`` take the smaller one.  A container holds at most
    ``max_items`` items and ``attention_share`` of the squared capacity in
    squared lengths, unless a single item exceeds that.
    """
    caps = _capacities(capacities)
    items = (
        pages.select("page_id", tidy(F.col("split")).alias("split"), F.length("text").cast("bigint").alias("size"), F.xxhash64("text").alias("text_key"))
        .where("size > 0")
        .distinct()
        .join(F.broadcast(caps), "split")
    )
    items = checkpointed(items)
    shares = items.groupBy("split").agg(
        F.greatest(
            F.ceil(F.sum(F.col("size") % F.col("capacity")) / (F.max("capacity") * F.lit(shard_containers))),
            F.ceil(F.count(F.lit(1)) / F.lit(max_items * shard_containers)),
            F.lit(1),
        ).alias("shards")
    )
    pieces = (
        items.join(F.broadcast(shares), "split")
        .withColumn("shard", F.pmod(F.xxhash64("page_id", "text_key"), F.col("shards")))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / F.col("capacity")))))
        .withColumn("piece_start", F.col("piece") * F.col("capacity"))
        .withColumn("n_chars", F.least("capacity", F.col("size") - F.col("piece_start")))
    )
    columns = ["page_id", "split", "piece", "piece_start", "n_chars"]
    full = pieces.where("n_chars = capacity").select(
        *columns, F.concat_ws("-", "split", F.lit("full"), "page_id", F.lower(F.hex("text_key")), "piece").alias("container")
    )

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["page_id", "text_key", "piece"], kind="stable")
        capacity = int(frame["capacity"].iloc[0])
        places = best_fit(frame["n_chars"].to_numpy(), capacity, max_items, attention_share * float(capacity) ** 2, score)
        frame["container"] = [f"{s}-{h:06d}-{p:05d}" for s, h, p in zip(frame["split"], frame["shard"], places)]
        return frame[[*columns, "container"]]

    schema = "page_id bigint, split string, piece bigint, piece_start bigint, n_chars bigint, container string"
    rest = pieces.where("n_chars < capacity").select(*columns, "capacity", "shard", "text_key").groupBy("split", "shard").applyInPandas(pack, schema)
    return full.unionByName(rest)


def container_fill(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Rows ``(split, containers, items, chars, least_containers, fill)`` of each split that has containers."""
    caps = _capacities(capacities)
    return (
        packed.groupBy("split")
        .agg(F.countDistinct("container").alias("containers"), F.count(F.lit(1)).alias("items"), F.sum("n_chars").alias("chars"))
        .join(F.broadcast(caps), "split")
        .select(
            "split",
            "containers",
            "items",
            "chars",
            F.ceil(F.col("chars") / F.col("capacity")).alias("least_containers"),
            F.round(F.col("chars") / (F.col("containers") * F.col("capacity")), 6).alias("fill"),
        )
    )
