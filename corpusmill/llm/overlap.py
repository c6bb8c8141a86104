"""Texts of evaluation splits that are also in the training split (problem 6).

Evaluation texts are the queries: each is cut into segments and joined with the
windows of the training texts.  Candidates share enough segments at any place,
since whole paragraphs may have moved.  They are verified by dynamic
programming in a band: few enough edits prove the likeness.  Only where there
are more, as in rearranged texts, the likeness of the shingle sets decides.
Equal texts of any length meet by their key.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import blocks, segments
from corpusmill.llm.columns import not_blank, text_class, tidy
from corpusmill.llm.near import MIN_WORDS, THRESHOLD, WIDTH
from corpusmill.llm.partenum import FREQUENT_SHARE, SLOTS, slot
from corpusmill.llm.shingles import shingle_hashes, word_hashes
from corpusmill.runtime import checkpointed, small_side, spread

TRAINING, EVALUATION = "train", ("validation", "test")
#: Bits under the window hash: the number of keys needed, and whether the record is of an evaluation text.
_META = 17
#: Candidate pairs of an evaluation and a training text handled at once.
_PAIR_BLOCK = 1 << 20


def split_texts(pages: DataFrame) -> DataFrame:
    """Rows ``(page_id, split, wiki, text_class, text)`` of the rows in one of the splits with a text that is not blank.

    Splits count after trimming and lower-casing; a null split is in none.
    """
    return pages.select(
        "page_id", tidy(F.col("split")).alias("split"), tidy(F.col("wiki")).alias("wiki"), text_class(pages).alias("text_class"), "text"
    ).where(F.col("page_id").isNotNull() & F.col("split").isin(TRAINING, *EVALUATION) & not_blank(F.col("text")))


def segment_candidates(texts: DataFrame, threshold: float, min_words: int, hot_members: int = blocks.HOT_MEMBERS) -> DataFrame:
    """Rows ``(a, b)``: classes of an evaluation and of a training text that share enough segments; held in the shared folder.

    Windows with very many members are rare, since segments prefer rare
    windows.  Where there are any, their members meet in a salted join and all
    hits are counted again with theirs.
    """

    def slots_of(part):
        values, ends, words = segments.windows(part)
        return slot(values), np.repeat(np.arange(len(part)), np.diff(ends)), words >= min_words, int((words[words >= min_words] // 2).sum())

    load, count, expected = blocks.slot_loads(texts, "text_class", "text", slots_of, SLOTS)
    loads, frequent = load.astype(np.int64), max(2, int(FREQUENT_SHARE * count))
    buckets = max(1, -(-expected // blocks.BUCKET_RECORDS))

    def records(batches):
        seen: set[tuple[int, bool]] = set()
        for batch in batches:
            roles = [s != TRAINING for s in batch.column(1).to_pylist()]
            keys = list(zip(batch.column(0).to_pylist(), roles))
            fresh = blocks.first_of(keys, seen)
            column = batch.column(2).take(pa.array(fresh, pa.int64())).to_pylist()
            for a, b in blocks.text_chunks(column):
                values, ends, words = segments.windows(column[a:b])
                ranks = segments.window_ranks(values, loads, frequent)
                found, sizes = [], []
                for i in range(b - a):
                    mine, order = values[ends[i] : ends[i + 1]], ranks[ends[i] : ends[i + 1]]
                    if words[i] < min_words:
                        got, meta = mine[:0], 0
                    elif keys[fresh[a + i]][1]:
                        got, need = segments.evaluation_request(mine, order, int(words[i]))
                        meta = min(need, 0xFFFF) << 1 | 1
                    else:
                        got, meta = segments.training_keys(mine, order, int(words[i]), threshold), 0
                    found.append((got >> np.uint64(_META) << np.uint64(_META)) | np.uint64(meta))
                    sizes.append(len(got))
                names = np.array([keys[fresh[i]][0] for i in range(a, b)], np.int64).view(np.uint64)
                yield np.stack([np.concatenate(found), np.repeat(names, sizes)], 1)

    sent = spread(texts.select("text_class", "split", "text")).mapInArrow(
        lambda batches: blocks.pack_blocks(records(batches), buckets, _META), "bucket bigint, block binary"
    )
    rows = blocks.by_bucket(sent, buckets, partial(_meet, hot_members=hot_members), ["a", "b", "need", "hot"], 2)

    def counted(hits: DataFrame) -> DataFrame:
        return hits.groupBy("a", "b", "hot").agg(F.count(F.lit(1)).alias("held"), F.max("need").alias("need")).where("hot > 0 or held >= need")

    found = checkpointed(counted(rows))
    hot = found.where("hot > 0")
    if not hot.isEmpty():
        asking = hot.where("hot = 1").select(F.col("a").alias("key"), F.col("b").alias("a"), "need")
        holding = hot.where("hot = 2").select(F.col("a").alias("key"), "b")
        more = blocks.salted_pairs(asking, holding).where("a <> b").select("a", "b", "need", F.lit(0).cast("bigint").alias("hot"))
        found = checkpointed(counted(rows.where("hot = 0").union(more)))
    return found.where("hot = 0").select("a", "b")


def _meet(records: np.ndarray, hot_members: int = blocks.HOT_MEMBERS):
    """Rows ``(a, b, need, 0)``: evaluation and training classes with the same window, and the windows that ``a`` needs.

    A window with more than ``hot_members`` training texts gives rows of its
    members instead: ``(window, a, need, 1)`` and ``(window, b, 0, 2)``.
    """
    records = np.unique(records, axis=0)
    window = records[:, 0] >> np.uint64(_META)
    asks = (records[:, 0] & np.uint64(1)).astype(bool)
    need = ((records[:, 0] >> np.uint64(1)) & np.uint64(0xFFFF)).astype(np.int64)
    names = records[:, 1].view(np.int64)
    held, held_names = window[~asks], names[~asks]
    asked, asking, need = window[asks], names[asks], need[asks]
    first, last = np.searchsorted(held, asked, "left"), np.searchsorted(held, asked, "right")
    counts = last - first
    hot = counts > hot_members
    if hot.any():
        members = np.isin(held, asked[hot])
        zero = np.zeros(int(members.sum()), np.int64)
        yield np.stack([asked[hot].astype(np.int64), asking[hot], need[hot], np.ones(int(hot.sum()), np.int64)], 1)
        yield np.stack([held[members].astype(np.int64), held_names[members], zero, zero + 2], 1)
    use = (counts > 0) & ~hot
    first, asking, need, counts = first[use], asking[use], need[use], counts[use]
    sums = np.concatenate([[0], np.cumsum(counts)])
    start = 0
    while start < len(counts):
        end = max(start + 1, int(np.searchsorted(sums, sums[start] + _PAIR_BLOCK, "right")) - 1)
        n = counts[start:end]
        at = np.repeat(first[start:end], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows = np.stack([np.repeat(asking[start:end], n), held_names[at], np.repeat(need[start:end], n), np.zeros(int(n.sum()), np.int64)], 1)
        yield rows[rows[:, 0] != rows[:, 1]]
        start = end


def edit_bound(shingles: int, threshold: float, width: int) -> int:
    """The most word edits after which a set of so many shingles is still alike to the threshold.

    An edit takes at most ``width`` shingles out of the set and brings as many
    in, so ``d`` edits leave a likeness of at least
    ``(shingles - width * d) / (shingles + width * d)``.
    """
    return int(shingles * (1 - threshold) / (1 + threshold) / width + 1e-9)


def worded(texts: DataFrame) -> DataFrame:
    """Rows ``(text_class, words)``: the word hashes of each text in order."""

    def run(batches):
        for batch in batches:
            column = batch.column(1).to_pylist()
            for a, b in blocks.text_chunks(column):
                words, ends = word_hashes(column[a:b])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(words.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["text_class", "words"])

    return texts.select("text_class", "text").mapInArrow(run, "text_class bigint, words array<bigint>")


def judge_pair(left: np.ndarray, right: np.ndarray, threshold: float, width: int) -> tuple[float, int | None] | None:
    """Likeness and word edits of two word strings if they are alike to the threshold; no edits if they are too many to count."""
    sets = [np.unique(shingle_hashes(words, np.array([0, len(words)]), width)[0]) for words in (left, right)]
    distance = segments.word_distance(left, right, edit_bound(min(map(len, sets)), threshold, width))
    common = len(np.intersect1d(*sets, assume_unique=True))
    likeness = common / max(1, len(sets[0]) + len(sets[1]) - common)
    return (likeness, distance) if distance is not None or likeness >= threshold else None


def overlap_classes(
    texts: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, min_words: int = MIN_WORDS, hot_members: int = blocks.HOT_MEMBERS
) -> DataFrame:
    """Rows ``(a, b, likeness, distance)``: evaluation class ``a`` and training class ``b`` of different but similar texts.

    ``distance`` counts the word edits between them where these alone prove the
    likeness, and is null where the shingle sets do.
    """
    pairs = segment_candidates(texts, threshold, min_words, hot_members)
    involved = pairs.select(F.explode(F.array("a", "b")).alias("text_class")).distinct()
    involved = small_side(involved, involved.count())
    held = worded(texts.join(involved, "text_class", "left_semi").dropDuplicates(["text_class"])).where(F.size("words") >= min_words)
    joined = pairs.join(held.select(F.col("text_class").alias("a"), F.col("words").alias("left")), "a").join(
        held.select(F.col("text_class").alias("b"), F.col("words").alias("right")), "b"
    )

    def run(batches):
        for batch in batches:
            sides = []
            for side in (2, 3):
                lists = batch.column(side)
                values, ends = lists.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                sides.append([values[a:b] for a, b in zip(ends[:-1], ends[1:])])
            found = [judge_pair(left, right, threshold, width) for left, right in zip(*sides)]
            kept = pa.array([i for i, f in enumerate(found) if f], pa.int64())
            likeness, distance = zip(*filter(None, found)) if len(kept) else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(likeness, pa.float64()), pa.array(distance, pa.int64())],
                names=["a", "b", "likeness", "distance"],
            )

    return joined.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint, likeness double, distance bigint")


def class_overlaps(texts: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows ``(a, b, likeness, distance, kind)``: all pairs of an evaluation and a training class that overlap.

    ``kind`` is ``same`` for equal texts, ``edited`` where few word edits lead
    from one to the other, and ``moved`` where parts stand elsewhere.  Copies
    are not expanded; ``split_texts`` tells the pages of a class.
    """
    similar = overlap_classes(texts, threshold, width, min_words)
    near = similar.withColumn("kind", F.when(F.col("distance").isNotNull(), "edited").otherwise("moved"))
    roles = texts.groupBy("text_class").agg(F.max(F.col("split") == TRAINING).alias("trains"), F.max(F.col("split") != TRAINING).alias("asks"))
    same = roles.where("trains and asks").select(
        F.col("text_class").alias("a"),
        F.col("text_class").alias("b"),
        F.lit(1.0).alias("likeness"),
        F.lit(0).cast("bigint").alias("distance"),
        F.lit("same").alias("kind"),
    )
    return near.unionByName(same)


def overlapping_pages(pages: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows ``(page_id_a, page_id_b)``, ``page_id_a < page_id_b``: pages of which one is in training and the other in evaluation.

    Their texts are equal, or both have ``min_words`` words and are alike to
    the threshold.  Null, empty and blank texts, null identifiers and other
    splits are in no pair; repeated deliveries change nothing; an empty table
    gives no rows.
    """
    texts = split_texts(pages)
    pairs = checkpointed(class_overlaps(texts, threshold, width, min_words))
    asking, holding = _members(texts, pairs)
    return (
        pairs.join(asking, "a")
        .join(holding, "b")
        .where("page_a <> page_b")
        .select(F.least("page_a", "page_b").alias("page_id_a"), F.greatest("page_a", "page_b").alias("page_id_b"))
        .distinct()
    )


def _members(texts: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Evaluation pages by class ``a`` and training pages by class ``b``, of the classes in a pair."""
    involved = pairs.select(F.explode(F.array("a", "b")).alias("text_class")).distinct()
    involved = small_side(involved, involved.count())
    members = texts.select("page_id", "split", "text_class").join(involved, "text_class", "left_semi").distinct()
    asking = members.where(F.col("split") != TRAINING).select(F.col("text_class").alias("a"), F.col("page_id").alias("page_a"))
    holding = members.where(F.col("split") == TRAINING).select(F.col("text_class").alias("b"), F.col("page_id").alias("page_b"))
    return asking, holding


def overlap_report(pages: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows ``(split, wiki, pages, same_pages, edited_pages, moved_pages, overlapping_pages)`` of each evaluation split and edition.

    Pages are counted once for each edition and split they are in; a page can
    overlap in several ways, see ``class_overlaps``.
    """
    texts = split_texts(pages)
    pairs = checkpointed(class_overlaps(texts, threshold, width, min_words))
    kinds = ("same", "edited", "moved")
    hit = pairs.groupBy(F.col("a").alias("text_class")).agg(*(F.max(F.col("kind") == k).alias(k) for k in kinds))
    asked = texts.where(F.col("split") != TRAINING).select("page_id", "split", "wiki", "text_class").distinct()
    per_page = asked.join(hit, "text_class", "left").groupBy("split", "wiki", "page_id").agg(*(F.coalesce(F.max(k), F.lit(False)).alias(k) for k in kinds))
    return per_page.groupBy("split", "wiki").agg(
        F.count(F.lit(1)).alias("pages"),
        *(F.count_if(k).alias(f"{k}_pages") for k in kinds),
        F.count_if(F.col("same") | F.col("edited") | F.col("moved")).alias("overlapping_pages"),
    )
