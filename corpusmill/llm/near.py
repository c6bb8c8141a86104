"""Near-duplicate texts (problem 5).

Texts are told apart by a checked 64-bit key, so exact copies are one class from the
start and never paired.  Signatures are made where the rows are read; what
moves are the signature records, then candidate pairs of classes, then the
shingle sets of the few texts that are in a pair.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import blocks, partenum
from corpusmill.llm.columns import not_blank, text_class
from corpusmill.llm.shingles import shingle_hashes, shingle_sets, word_hashes
from corpusmill.runtime import checkpointed, small_side, spread

#: As TESTDATA.md sets them for this corpus: words of a shingle, least likeness, least words of a text.
WIDTH, THRESHOLD, MIN_WORDS = 3, 0.6, 20
#: Pairs of classes made at once.
PAIR_BLOCK = 1 << 20
#: Classes of a signature from which they are compared by the shingles of their prefixes and not all with all.
HOT_CLASSES = 64


def keyed_texts(pages: DataFrame, id_col: str = "page_id", text_col: str = "text") -> DataFrame:
    """Rows ``(page_id, text_class, text)`` of all rows with an identifier and a text that is not blank."""
    return pages.select(F.col(id_col).alias("page_id"), text_class(pages, text_col).alias("text_class"), F.col(text_col).alias("text")).where(
        F.col("page_id").isNotNull() & not_blank(F.col("text"))
    )


def shingle_loads(texts: DataFrame, width: int, min_words: int) -> tuple[np.ndarray, np.ndarray, int]:
    """In how many texts the shingles of each counter occur, which of these are very frequent, and a number of buckets for the signatures."""

    def slots_of(part):
        words, offsets = word_hashes(part)
        hashes, owner = shingle_hashes(words, offsets, width)
        long = np.diff(offsets) >= min_words
        sets = np.bincount(owner, minlength=len(part))[long]
        per_group = partenum.PARTS if partenum.MISSING else 1
        groups = np.minimum(partenum.GROUPS, sets / (partenum.PARTS * partenum.FILL_SMALL) + 1)
        return partenum.slot(hashes[long[owner]]), owner[long[owner]], long, int(2 * per_group * groups.sum())

    load, count, expected = blocks.slot_loads(texts, "text_class", "text", slots_of, partenum.SLOTS)
    return load, load >= max(2.0, partenum.FREQUENT_SHARE * count), max(1, -(-expected // blocks.BUCKET_RECORDS))


def candidate_pairs(texts: DataFrame, threshold: float, width: int, min_words: int, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """Rows ``(a, b)``, ``a < b``: classes that share a PartEnum signature; held in the shared folder.

    The classes of a signature that very many share are not paired all with
    all, but only where they can be alike, see ``prefix_pairs``.
    """
    loads, frequent, buckets = shingle_loads(texts, width, min_words)
    packed = np.packbits(frequent)

    def records(batches):
        marks = np.unpackbits(packed)[: partenum.SLOTS].astype(bool)
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            fresh = blocks.first_of(keys, seen)
            column = batch.column(1).take(pa.array(fresh, pa.int64())).to_pylist()
            names = np.array([keys[i] for i in fresh], np.int64).view(np.uint64)
            for a, b in blocks.text_chunks(column):
                hashes, ends, words = shingle_sets(column[a:b], width)
                hashes, ends, kept = long_sets(hashes, ends, words >= min_words)
                found, owner = partenum.signatures(hashes, ends, marks, threshold)
                yield np.stack([found, names[a:b][kept][owner]], 1)

    sent = spread(texts.select("text_class", "text")).mapInArrow(lambda batches: blocks.pack_blocks(records(batches), buckets), "bucket bigint, block binary")
    rows = checkpointed(blocks.by_bucket(sent, buckets, partial(group_pairs, hot_members=hot_classes), ["a", "b", "hot"], 2).distinct())
    pairs, hot = rows.where("hot = 0").select("a", "b"), rows.where("hot = 1")
    if hot.isEmpty():
        return pairs
    involved = hot.select(F.col("b").alias("text_class")).distinct()
    involved = small_side(involved, involved.count())
    members = texts.select("text_class", "text").join(involved, "text_class", "left_semi").dropDuplicates(["text_class"])
    return checkpointed(pairs.union(prefix_pairs(members, loads, threshold, width, min_words)).distinct())


def prefix_pairs(texts: DataFrame, loads: np.ndarray, threshold: float, width: int, min_words: int) -> DataFrame:
    """Rows ``(a, b)``, ``a < b``: the pairs of the classes that share a shingle of their prefixes.

    With all shingles in one order, rare ones first, two sets alike to the
    threshold share one among the first ``size - ceil(threshold * size) + 1``
    of each, so none is lost; sets that have only common passages in common
    share none.
    """
    held = loads.astype(np.int64).tobytes()

    def run(batches):
        rank = np.frombuffer(held, np.int64)
        for batch in batches:
            column = batch.column(1).to_pylist()
            for a, b in blocks.text_chunks(column):
                hashes, ends, words = shingle_sets(column[a:b], width)
                hashes, ends, kept = long_sets(hashes, ends, words >= min_words)
                sizes = np.diff(ends)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((hashes, rank[partenum.slot(hashes)], owner))
                place = np.arange(len(owner)) - np.repeat(ends[:-1], sizes)
                use = order[place <= np.repeat(sizes - np.ceil(threshold * sizes - 1e-9), sizes)]
                names = batch.column(0).slice(a, b - a).take(pa.array(kept[owner[use]], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(hashes[use].view(np.int64)), names], names=["shingle", "text_class"])

    sent = checkpointed(texts.select("text_class", "text").mapInArrow(run, "shingle bigint, text_class bigint"))
    left, right = (sent.select("shingle", F.col("text_class").alias(side)) for side in "ab")
    return left.join(right, "shingle").where("a < b").select("a", "b").distinct()


def long_sets(hashes: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The kept sets, their ends, and their numbers."""
    sizes = np.diff(ends)
    inside = np.repeat(keep, sizes)
    return hashes[inside], np.concatenate([[0], np.cumsum(sizes[keep])]), np.flatnonzero(keep)


def group_pairs(records: np.ndarray, hot_members: int = HOT_CLASSES):
    """Rows ``(a, b, 0)`` of the pairs of different classes with equal keys, in bounded blocks.

    A key with more than ``hot_members`` classes gives rows ``(key, class, 1)``
    instead, to be compared by their shingles.
    """
    records = np.unique(records, axis=0)
    keys, names = records[:, 0], records[:, 1].view(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(cuts)
    held = []
    for size in np.unique(sizes[(sizes > 1) & (sizes <= hot_members)]):
        starts = cuts[:-1][sizes == size]
        i, j = np.triu_indices(size, 1)
        step = max(1, PAIR_BLOCK // len(i))
        for block in range(0, len(starts), step):
            some = starts[block : block + step]
            held.append(_ordered(np.stack([names[(some[:, None] + i).ravel()], names[(some[:, None] + j).ravel()]], 1)))
            if sum(map(len, held)) >= PAIR_BLOCK:
                yield _marked(_ordered(np.concatenate(held)), 0)
                held = []
    if held:
        yield _marked(_ordered(np.concatenate(held)), 0)
    hot = np.repeat(sizes > hot_members, sizes)
    if hot.any():
        yield _marked(np.stack([keys[hot].view(np.int64), names[hot]], 1), 1)


def _marked(rows: np.ndarray, mark: int) -> np.ndarray:
    return np.concatenate([rows, np.full((len(rows), 1), mark, np.int64)], 1)


def _ordered(pairs: np.ndarray) -> np.ndarray:
    return np.unique(np.sort(pairs, 1), axis=0)


def shingled(texts: DataFrame, width: int) -> DataFrame:
    """Rows ``(text_class, words, shingles)``: number of words and distinct shingle hashes of each text."""

    def run(batches):
        for batch in batches:
            column = batch.column(1).to_pylist()
            for a, b in blocks.text_chunks(column):
                hashes, ends, words = shingle_sets(column[a:b], width)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(words, pa.int64()), lists], names=["text_class", "words", "shingles"]
                )

    return texts.select("text_class", "text").mapInArrow(run, "text_class bigint, words bigint, shingles array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float, width: int, min_words: int) -> DataFrame:
    """Rows ``(a, b, likeness)``: the candidate pairs of classes whose shingle sets are alike to the threshold.

    ``pairs`` must be held (checkpointed).  Only texts in a pair are shingled;
    their classes are broadcast to the scan if few, else the scan is shuffled
    to them.
    """
    involved = pairs.select(F.explode(F.array("a", "b")).alias("text_class")).distinct()
    involved = small_side(involved, involved.count())
    sets = shingled(texts.join(involved, "text_class", "left_semi").dropDuplicates(["text_class"]), width).where(F.col("words") >= min_words)
    left = sets.select(F.col("text_class").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("text_class").alias("b"), F.col("shingles").alias("right"))
    common = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", (common / (F.size("left") + F.size("right") - common)).alias("likeness"))
        .where(F.col("likeness") >= threshold)
    )


def similar_classes(
    texts: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, min_words: int = MIN_WORDS, hot_classes: int = HOT_CLASSES
) -> DataFrame:
    """Rows ``(a, b, likeness)``, ``a < b``: all pairs of different texts alike to the threshold, by text class.

    Likeness is the Jaccard similarity of the sets of ``width`` consecutive
    words.  Texts of fewer than ``min_words`` words are in no pair.
    """
    pairs = candidate_pairs(texts, threshold, width, min_words, hot_classes)
    return verified(pairs, texts, threshold, width, min_words)


def near_pages(
    pages: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, min_words: int = MIN_WORDS, hot_classes: int = HOT_CLASSES
) -> DataFrame:
    """Rows ``(page_id_a, page_id_b)``, ``page_id_a < page_id_b``: different pages with similar but different texts.

    Each pair once, however often its pages are delivered.  Null, empty and
    blank texts and null identifiers are in no pair; an empty table gives none.
    Pages with the same text are not paired with each other, but each of them
    is with every page of a similar text.
    """
    texts = keyed_texts(pages)
    pairs = checkpointed(similar_classes(texts, threshold, width, min_words, hot_classes))
    members = class_members(texts, pairs)
    left, right = (members.select(F.col("text_class").alias(c), F.col("page_id").alias(f"page_{c}")) for c in "ab")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where("page_a <> page_b")
        .select(F.least("page_a", "page_b").alias("page_id_a"), F.greatest("page_a", "page_b").alias("page_id_b"))
        .distinct()
    )


def class_members(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows ``(page_id, text_class)`` of the pages whose text is in a pair, each once."""
    involved = pairs.select(F.explode(F.array("a", "b")).alias("text_class")).distinct()
    involved = small_side(involved, involved.count())
    return texts.select("page_id", "text_class").join(involved, "text_class", "left_semi").distinct()


def duplicate_groups(pages: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows ``(page_id, text_class, group_id, links)``: every page with a usable text and the group it belongs to.

    Pages belong together if their texts are equal or linked by a chain of
    similar texts; ``group_id`` is the least text class of the chain and
    ``links`` the number of different texts similar to the page's own.
    Components are found on classes by repeated minimum over links and
    pointer jumping, so their number of rounds grows with the logarithm of the
    longest chain; nothing but counts reaches the driver.
    """
    texts = keyed_texts(pages)
    links = checkpointed(similar_classes(texts, threshold, width, min_words).select("a", "b"))
    groups = components(links)
    both = links.union(links.select("b", "a"))
    degrees = both.groupBy(F.col("a").alias("text_class")).agg(F.count(F.lit(1)).alias("links"))
    return (
        texts.select("page_id", "text_class")
        .distinct()
        .join(groups, "text_class", "left")
        .join(degrees, "text_class", "left")
        .select("page_id", "text_class", F.coalesce("group_id", "text_class").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
    )


def components(links: DataFrame) -> DataFrame:
    """Rows ``(text_class, group_id)``: the least class reachable from each class over the links ``(a, b)``."""
    both = checkpointed(links.union(links.select("b", "a")).distinct())
    label = checkpointed(both.groupBy(F.col("a").alias("text_class")).agg(F.least(F.col("a"), F.min("b")).alias("group_id")))
    while True:
        seen = label.select(F.col("text_class").alias("b"), F.col("group_id").alias("near"))
        best = both.join(seen, "b").groupBy(F.col("a").alias("text_class")).agg(F.min("near").alias("near"))
        step = label.join(best, "text_class").select("text_class", "group_id", F.least("group_id", "near").alias("least"))
        jump = label.select(F.col("text_class").alias("least"), F.col("group_id").alias("far"))
        after = checkpointed(step.join(jump, "least").select("text_class", F.least("least", "far").alias("new"), F.col("group_id").alias("old")))
        changed = after.where("new <> old").limit(1).count()
        label = after.select("text_class", F.col("new").alias("group_id"))
        if not changed:
            return label
