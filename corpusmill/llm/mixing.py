"""Mixing sources to target shares of all tokens (problem 8).

Documents fall into cells of source, language and size class.  The token
totals of the cells, a table bounded by the number of targets, languages and
classes, are raked on the driver by iterative proportional fitting until the
sums over each of the three margins meet their targets, no cell being used
more often than its source may be; the quotient of raked and present tokens is
how often a document of the cell is expected in the mix.  Its whole part is
used outright, the fraction by a draw that depends on the document alone.  The
draws of each cell are calibrated by a histogram, so that the margins are met
to within a document or a four-thousandth of a cell.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.columns import language, tidy
from corpusmill.llm.encode import count_tokens
from corpusmill.llm.sample import permuted_halves
from corpusmill.llm.vocab import DEFAULT_TOKENIZER
from corpusmill.runtime import checkpointed

#: Bounds in tokens of the size classes that serve as topic margin, as the data have no topic column.
SIZE_CLASSES = (150, 600)
#: Steps of the histogram in which the draws of a cell are calibrated.
DRAW_STEPS = 4096
#: Without targets of their own, languages and topics are to have the tokens they hold to this power, so that small ones gain.
SMOOTHING = 0.7
#: Relative error of a language's or topic's share up to which its target counts as met.
TOLERANCE = 0.002
_DRAW_KEYS = (0x2545F491, 0x1F83D9AB, 0x5BE0CD19, 0x137E2179)


def sized_documents(documents: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, folder: str | None = None) -> DataFrame:
    """Rows ``(doc_id, source, language, topic, draw, tokens)`` of each document.

    ``draw`` is uniform in [0, 1) and depends on ``doc_id`` alone.
    """
    rows = documents.select("doc_id", tidy(F.col("source")).alias("source"), language(F.col("lang")), "text")
    upper, _ = permuted_halves(F.col("doc_id"), _DRAW_KEYS)
    topic = F.lit("long")
    for name, bound in (("medium", SIZE_CLASSES[1]), ("short", SIZE_CLASSES[0])):
        topic = F.when(F.col("tokens") < bound, name).otherwise(topic)
    return count_tokens(rows, "text", tokenizer, folder).select(
        "doc_id", "source", "language", topic.alias("topic"), (upper / F.lit(float(2**32))).alias("draw"), "tokens"
    )


def rake(present: np.ndarray, margins: list[tuple[np.ndarray, np.ndarray]], caps: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Expected uses of each cell such that its tokens meet the margins, the first one last and so exactly.

    ``margins`` holds for each dimension the label number of every cell and the
    target of each label.  No cell exceeds its cap; what a capped cell cannot
    take goes to the other cells of the label.
    """
    uses = np.where(present > 0, np.minimum(1.0, caps), 0.0)
    for _ in range(rounds):
        before = uses
        for labels, targets in [*margins[1:], margins[0]]:
            uses = _meet(present, uses, labels, targets, caps)
        if np.allclose(before, uses, rtol=1e-7, atol=1e-12):
            break
    return uses


def _meet(present: np.ndarray, uses: np.ndarray, labels: np.ndarray, targets: np.ndarray, caps: np.ndarray) -> np.ndarray:
    """The uses scaled label by label to the targets, as far as the caps allow."""
    count = len(targets)
    for _ in range(len(uses) + 1):
        free = uses < caps * (1 - 1e-12)
        sums, loose = (np.bincount(labels, present * uses * f, count) for f in (1, free))
        if np.allclose(sums, targets, rtol=1e-10):
            break
        fixed = sums - loose
        # a label that is too large even by its capped cells alone is scaled as a whole
        whole = targets <= fixed
        base = np.where(whole, sums, loose)
        factor = np.divide(np.where(whole, targets, targets - fixed), base, out=np.ones(count), where=base > 0)
        scaled = np.where(free | whole[labels], np.minimum(uses * factor[labels], caps), uses)
        if np.array_equal(scaled, uses):
            break
        uses = scaled
    return uses


def _goals(labels: list[str], held: np.ndarray, wanted: dict[str, float] | None) -> np.ndarray:
    """The share of each label: as wanted, or by the smoothed tokens it holds."""
    share = held**SMOOTHING if wanted is None else np.array([max(0.0, float(wanted.get(n) or 0)) for n in labels])
    if not share.sum() > 0:
        raise ValueError("no label of a margin has a target")
    return share / share.sum()


def mix_plan(
    cells: list, targets: list, total: float | None = None, languages: dict[str, float] | None = None, topics: dict[str, float] | None = None
) -> list[tuple]:
    """Expected uses of each cell: rows ``(source, language, topic, uses)``.

    ``cells`` are rows ``(source, language, topic, tokens)``, ``targets`` rows
    ``(source, target_share, max_repeats)``.  Sources without a target are not
    used; targets without tokens cannot be met, and the others share the whole
    in their proportions.  ``languages`` and ``topics`` are target shares; a
    label they do not name is not used, and without them a label is to have its
    tokens to the power ``SMOOTHING``.  Unless given, the size of the mix is
    the largest at which no source needs more repeats than it may have and
    all margins are met to ``TOLERANCE``; where no size meets them all (such as
    a source in one language only), the sources are met, at the largest size,
    and the others as nearly as raking gets.
    """
    wanted = {t[0]: (float(t[1]), int(t[2])) for t in targets if t[0] and t[1] and t[1] > 0 and t[2] and t[2] > 0}
    cells = [c for c in cells if c[0] in wanted and c[3] > 0]
    if not cells:
        return []
    names = [sorted({c[i] for c in cells}) for i in range(3)]
    present = np.array([c[3] for c in cells], float)
    at = [np.array([labels.index(c[i]) for c in cells]) for i, labels in enumerate(names)]
    held = [np.bincount(a, present, len(labels)) for a, labels in zip(at, names)]
    shares = [_goals(names[0], held[0], {n: wanted[n][0] for n in names[0]}), _goals(names[1], held[1], languages), _goals(names[2], held[2], topics)]
    repeats = np.array([wanted[s][1] for s in names[0]], float)
    most = float((held[0] * repeats / shares[0]).min())

    def plan(size: float) -> tuple[np.ndarray, bool]:
        margins = [(a, share * size) for a, share in zip(at, shares)]
        uses = rake(present, margins, repeats[at[0]])
        met = all(np.allclose(np.bincount(a, present * uses, len(goal)), goal, rtol=TOLERANCE, atol=1e-9 * size) for a, goal in margins)
        return uses, met

    uses, met = plan(most if total is None else min(float(total), most))
    if total is None and not met:
        low, high, best = 0.0, most, None
        for _ in range(12):
            middle = (low + high) / 2
            tried, met = plan(middle)
            low, high, best = (middle, high, tried) if met else (low, middle, best)
        uses = uses if best is None else best
    return [(*c[:3], float(u)) for c, u in zip(cells, uses)]


def _shares_of(table: DataFrame | None, column: str) -> dict[str, float] | None:
    """Target shares of a margin from a table ``(column, target_share)``, which must name each label once."""
    if table is None:
        return None
    rows = [r for r in table.select(tidy(F.col(column)), "target_share").collect() if r[0] is not None]
    if len({r[0] for r in rows}) != len(rows):
        raise ValueError(f"a {column} has more than one target")
    return {r[0]: r[1] for r in rows}


def mix_sources(
    documents: DataFrame,
    targets: DataFrame,
    total_tokens: int | None = None,
    tokenizer: str = DEFAULT_TOKENIZER,
    folder: str | None = None,
    languages: DataFrame | None = None,
    topics: DataFrame | None = None,
) -> DataFrame:
    """Rows ``(doc_id, source, language, topic, tokens, copies)``: the documents of the mix and how often each is used.

    ``copies`` is at least 1 and at most the ``max_repeats`` of the source.
    Documents without tokens, a source or a target are not used.  Sources match
    after trimming and lower-casing; a source named twice in the targets is an
    error.  ``languages`` and ``topics`` are optional tables
    ``(language, target_share)`` and ``(topic, target_share)``, see
    ``mix_plan``.  Only cell totals reach the driver: they are bounded by the
    targets and languages, whatever the number of documents.
    """
    spark = documents.sparkSession
    goals = [tuple(r) for r in targets.select(tidy(F.col("source")), "target_share", "max_repeats").collect()]
    names = [g[0] for g in goals if g[0]]
    if len(set(names)) != len(names):
        raise ValueError("a source has more than one target")
    sized = checkpointed(sized_documents(documents, tokenizer, folder).where(F.col("source").isin(names) & (F.col("tokens") > 0)))
    cell = ["source", "language", "topic"]
    cells = sized.groupBy(*cell).agg(F.sum("tokens").alias("tokens")).collect()
    plan = mix_plan([tuple(c) for c in cells], goals, total_tokens, _shares_of(languages, "language"), _shares_of(topics, "topic"))
    fields = [T.StructField(n, T.StringType()) for n in cell]
    uses = F.broadcast(spark.createDataFrame(plan, T.StructType([*fields, T.StructField("uses", T.DoubleType())])))
    drawn = sized.join(uses, cell).select(
        *sized.columns, F.floor(F.col("uses") + 1e-9).cast("int").alias("base"), "uses", F.floor(F.col("draw") * DRAW_STEPS).cast("int").alias("step")
    )
    # a cell has at most one row a step, so its window is bounded
    steps = drawn.groupBy(*cell, "step").agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * (F.col("uses") - F.col("base"))).alias("wanted"))
    inside = W.partitionBy(*cell)
    summed = steps.select(*cell, "step", F.sum("tokens").over(inside.orderBy("step")).alias("held"), F.sum("wanted").over(inside).alias("wanted"))
    nearest = summed.groupBy(*cell).agg(F.min_by(F.struct("step", "held"), F.struct(F.abs(F.col("held") - F.col("wanted")), "step")).alias("at"), F.max("wanted").alias("wanted"))
    # none at all may be nearer than the first step
    reach = F.when(F.abs(F.col("at.held") - F.col("wanted")) < F.col("wanted"), F.col("at.step")).otherwise(-1)
    limits = F.broadcast(nearest.select(*cell, reach.alias("reach")))
    copies = F.col("base") + F.when(F.col("step") <= F.col("reach"), 1).otherwise(0)
    return drawn.join(limits, cell).select("doc_id", *cell, "tokens", copies.alias("copies")).where("copies > 0")


def mix_margins(mix: DataFrame) -> DataFrame:
    """Rows ``(margin, label, tokens, share)``: what each source, language and topic has of the mix."""
    labels = F.explode(F.array(*(F.struct(F.lit(n).alias("margin"), F.col(n).alias("label")) for n in ("source", "language", "topic")))).alias("at")
    sums = mix.select(labels, (F.col("tokens") * F.col("copies")).alias("used")).groupBy("at.margin", "at.label").agg(F.sum("used").alias("tokens"))
    whole = sums.where("margin = 'source'").agg(F.sum("tokens").alias("whole"))
    return sums.crossJoin(F.broadcast(whole)).select("margin", "label", "tokens", F.round(F.col("tokens") / F.col("whole"), 6).alias("share"))


def mix_shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows ``(source, target_share, max_repeats, reached_share, tokens, documents, most_copies)`` for each target.

    A target without documents reaches 0.  With an empty mix all shares are 0.
    """
    used = mix.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_copies")
    )
    whole = used.agg(F.sum("tokens").alias("whole"))
    rows = targets.select(tidy(F.col("source")).alias("source"), "target_share", "max_repeats").join(F.broadcast(used), "source", "left")
    return rows.crossJoin(F.broadcast(whole)).select(
        "source",
        "target_share",
        "max_repeats",
        F.round(F.coalesce(F.col("tokens") / F.col("whole"), F.lit(0.0)), 6).alias("reached_share"),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("tokens", "documents", "most_copies")),
    )
