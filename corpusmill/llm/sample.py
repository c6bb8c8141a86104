"""A sample that stays the same as the data grow (problem 1).

A Feistel network permutes the 64-bit identifiers: four rounds exchange the two
32-bit halves, each mixed with the other.  An identifier is chosen iff its
permuted value, read as an unsigned number, is below ``rate * 2**64``.  The
choice needs the identifier alone, so neither order, partitioning nor other
rows can change it, and no two identifiers share a permuted value.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Round keys of the permutation; other keys give an independent sample.
ROUND_KEYS = (0x3C6EF372, 0x1B873593, 0x27D4EB2F, 0x165667B1)
_MASK = 0xFFFFFFFF
#: Factors and prime moduli that a half passes one after the other. Each product stays below 2**63, and each value is
#: used once, so nested rounds do not multiply the expression.
_STEPS = ((0x45D9F3B5, 2147483629), (0x719DE1F3, 2147483587), (0x2C1B3C6D, 4294967291))
#: Share of the identifiers that the registered queries choose.
DEFAULT_RATE = 0.1


def permuted_halves(column: Column, keys: tuple[int, ...] = ROUND_KEYS) -> tuple[Column, Column]:
    """Upper and lower 32 bits of the permuted identifier, as non-negative longs."""
    identifier = column.cast("bigint")
    left = F.shiftrightunsigned(identifier, 32)
    right = identifier.bitwiseAND(F.lit(_MASK).cast("bigint"))
    for key in keys:
        mixed = _mixed(right, key)
        left, right = right, left.bitwiseXOR(mixed)
    return left, right


def _mixed(half: Column, key: int) -> Column:
    """A 32-bit hash of a half."""
    value = half.bitwiseXOR(F.lit(key).cast("bigint"))
    for factor, prime in _STEPS:
        value = (value * F.lit(factor).cast("bigint")) % F.lit(prime).cast("bigint")
    return value


def permute(identifier: int, keys: tuple[int, ...] = ROUND_KEYS) -> int:
    """The permuted value of one identifier, as the column expression computes it."""
    bits = identifier & 0xFFFFFFFFFFFFFFFF
    left, right = bits >> 32, bits & _MASK
    for key in keys:
        value = right ^ key
        for factor, prime in _STEPS:
            value = value * factor % prime
        left, right = right, left ^ value
    return left << 32 | right


def threshold(rate: float) -> int:
    """The number of permuted values that a rate chooses."""
    if not 0 <= rate <= 1:
        raise ValueError("rate must lie between 0 and 1")
    return int(Fraction(rate) * 2**64)


def chosen(column: Column, rate: float, keys: tuple[int, ...] = ROUND_KEYS) -> Column:
    """Whether an identifier belongs to the sample; never for null."""
    bound = threshold(rate)
    upper, lower = bound >> 32, bound & _MASK
    left, right = permuted_halves(column, keys)
    below = (left < F.lit(upper).cast("bigint")) | (
        (left == F.lit(upper).cast("bigint")) & (right < F.lit(lower).cast("bigint"))
    )
    return F.coalesce(below, F.lit(False))


def sample_pages(pages: DataFrame, arrivals: DataFrame, rate: float = DEFAULT_RATE) -> DataFrame:
    """Rows ``(page_id, first_snapshot, deliveries)``: each page of ``pages`` that is chosen, once.

    ``first_snapshot`` is the earliest snapshot that delivered the page and
    ``deliveries`` the number of its different deliveries, null and 0 if none
    did.  The choice is made in both scans, before any exchange, so only the
    chosen share of either table moves; a page that holds very many deliveries
    is counted before the exchange.  Pages with a null identifier are never
    chosen; an empty table gives no rows.
    """
    ids = pages.select("page_id").where(chosen(F.col("page_id"), rate)).distinct()
    seen = (
        arrivals.select("page_id", "revision_id", "snapshot_id", "arrived_at")
        .where(chosen(F.col("page_id"), rate))
        .distinct()
        .groupBy("page_id")
        .agg(F.min("snapshot_id").alias("first_snapshot"), F.count(F.lit(1)).alias("deliveries"))
    )
    return ids.join(seen, "page_id", "left").select("page_id", "first_snapshot", F.coalesce("deliveries", F.lit(0)).alias("deliveries"))


def growth_by_snapshot(pages: DataFrame, arrivals: DataFrame, rate: float = DEFAULT_RATE) -> DataFrame:
    """Rows ``(snapshot_id, known, sampled, new_known, new_sampled)``: how the sample grows with the snapshots.

    A page counts from the earliest snapshot that has it, so ``known`` and
    ``sampled`` only rise.  Pages that no snapshot delivered are left out.
    """
    from pyspark.sql import Window as W

    first = arrivals.where("page_id is not null and snapshot_id is not null").groupBy("page_id").agg(F.min("snapshot_id").alias("snapshot_id"))
    known = pages.select("page_id").where("page_id is not null").distinct().join(first, "page_id")
    per = known.groupBy("snapshot_id").agg(
        F.count(F.lit(1)).alias("new_known"), F.count_if(chosen(F.col("page_id"), rate)).alias("new_sampled")
    )
    upto = W.orderBy("snapshot_id").rowsBetween(W.unboundedPreceding, 0)  # one row a snapshot
    return per.select(
        "snapshot_id",
        F.sum("new_known").over(upto).alias("known"),
        F.sum("new_sampled").over(upto).alias("sampled"),
        "new_known",
        "new_sampled",
    )


def chosen_sql(column: str, rate: float) -> str:
    """The chosen identifiers of a table ``ids`` as SQL text, for comparison in another engine."""
    left, right = f"(({column} >> 32) & {_MASK})", f"({column} & {_MASK})"
    text = f"SELECT {column} AS id, {left} AS l0, {right} AS r0 FROM ids"
    for i, key in enumerate(ROUND_KEYS):
        value = f"xor(r{i}, {key})"
        for factor, prime in _STEPS:
            value = f"({value} * {factor} % {prime})"
        text = f"SELECT id, r{i} AS l{i + 1}, xor(l{i}, {value}) AS r{i + 1} FROM ({text})"
    n, bound = len(ROUND_KEYS), threshold(rate)
    return f"SELECT id FROM ({text}) WHERE l{n} < {bound >> 32} OR (l{n} = {bound >> 32} AND r{n} < {bound & _MASK})"
