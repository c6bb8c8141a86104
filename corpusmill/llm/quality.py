"""Text quality statistics of documents (problem 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import blocks, prose
from corpusmill.llm.columns import edition_language, not_blank
from corpusmill.runtime import checkpointed, spread

#: A text is running prose if at least this share of its characters stands in lines nearest to prose.
PROSE_SHARE = 0.5
#: Characters of text for each record of a bucket of word counts that the number of buckets reckons with.
CHARACTERS_A_RECORD = 8
#: Cells of the histograms that medians are searched in; a power of two, so that values fall into them without rounding.
MEDIAN_CELLS = 4096
_COUNTS = ("words", "lines", "characters")
_SHARES = (
    "mean_word_length",
    "symbol_share",
    "digit_share",
    "closed_line_share",
    "common_word_share",
    "common_letter_share",
    "prose_share",
)


def learnt_languages(pages: DataFrame) -> list[prose.Language]:
    """Profiles of each language, learnt from all texts of its editions as ``prose.fit`` does from a list.

    Each text counts once, however often it is delivered.  Words and pairs are
    counted in tasks and added up by buckets of their hashes; the medians of
    the texts' shares are exact.  What reaches the driver are the words and
    pairs that are frequent enough to be learnt: as they are held by fixed
    shares of the texts, their number follows the length of a text and not the
    number of texts.
    """
    rows = pages.select(edition_language(F.col("wiki")).alias("language"), "text").where(F.col("language").isNotNull() & not_blank(F.col("text")))
    sizes = rows.groupBy("language").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("characters")).where(F.col("rows") >= prose.LEAST_TEXTS)
    words = _frequent_words(rows, {r["language"]: r["characters"] for r in sizes.orderBy("language").collect()})
    found = {k: v for k, v in medians(_shares(rows, words)).items() if k in words} if words else {}
    return [prose.profile_of(code, *words[code], found[code]) for code in sorted(found)]


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    """The languages of a batch, with the places of their texts and the texts, in ranges of bounded size."""
    column = batch.column("language").dictionary_encode()
    for number, code in enumerate(column.dictionary.to_pylist()):
        places = np.flatnonzero(column.indices.to_numpy() == number)
        texts = batch.column("text").take(pa.array(places)).to_pylist()
        for a, b in blocks.text_chunks(texts):
            yield code, places[a:b], texts[a:b]


def _frequent_words(rows: DataFrame, characters: dict[str, int]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Common words and known pairs, as sorted hashes, of those of the languages that have enough texts.

    ``characters`` tells about how much text there is of each language; every
    language has its own buckets, as many as that needs.
    """
    codes = sorted(characters)
    buckets = [1 + characters[c] // (CHARACTERS_A_RECORD * blocks.BUCKET_RECORDS) for c in codes]
    first = np.concatenate([[0], np.cumsum(buckets)])
    limit = blocks.FLUSH_RECORDS

    def count(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for code, parts in held.items():
                number = codes.index(code)
                used, *both = _added(parts)
                cut = [_by_bucket(rows, buckets[number]) for rows in both]
                some = sorted({0, *cut[0], *cut[1]})
                columns = pa.array([int(first[number]) + k for k in some]), pa.array([0 if k else used for k in some])
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array([c.get(k, b"") for k in some], pa.binary()) for c in cut)], names=["bucket", "used", "words", "pairs"])

        for batch in batches:
            for code, _, texts in _by_language(batch):
                part = prose.tally(texts)
                held.setdefault(code, []).append(part)
                size += len(part[1]) + len(part[2])
                if size >= limit:
                    held = {c: [_added(parts)] for c, parts in held.items()}
                    size = sum(len(p[1]) + len(p[2]) for parts in held.values() for p in parts)
                    # what adding up has not made much smaller is sent on
                    if 2 * size >= limit:
                        yield from flush()
                        held, size = {}, 0
        yield from flush()

    def add(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        used, words, pairs = _added([(u.as_py(), _read(w, 4), _read(p, 2)) for u, w, p in zip(*(table.column(c) for c in ("used", "words", "pairs")))])
        sentences, entries = words[:, 2:].sum(0).tolist()
        # a language has at least so many texts if it is learnt
        kept = prose.widespread(words, prose.LEAST_TEXTS), prose.known_pairs(pairs, prose.LEAST_TEXTS)
        code = codes[int(np.searchsorted(first, bucket, "right")) - 1]
        columns = [code], [used], [sentences], [entries], [kept[0].tobytes()], [kept[1].tobytes()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    names = ["language", "used", "sentences", "entries", "words", "pairs"]
    kinds = [pa.string(), *[pa.int64()] * 3, pa.binary(), pa.binary()]
    if not codes:
        return {}
    sent = rows.where(F.col("language").isin(codes)).distinct().mapInArrow(count, "bucket bigint, used bigint, words binary, pairs binary")
    grouped = sent.repartition(int(first[-1]), "bucket").groupBy("bucket")
    sums = checkpointed(grouped.applyInArrow(add, "language string, used bigint, sentences bigint, entries bigint, words binary, pairs binary"))
    totals = {r["language"]: r for r in sums.groupBy("language").agg(*(F.sum(n).alias(n) for n in names[1:4])).collect() if r["used"] >= prose.LEAST_TEXTS}
    used = {c: r["used"] for c, r in totals.items()}

    def choose(batches):
        for batch in batches:
            for code, w, p in zip(*(batch.column(n) for n in ("language", "words", "pairs"))):
                if (code := code.as_py()) in used:
                    kept = prose.widespread(_read(w, 4), used[code]), prose.known_pairs(_read(p, 2), used[code])[:, 0]
                    yield pa.RecordBatch.from_arrays([pa.array([code]), *(pa.array([k.tobytes()], pa.binary()) for k in kept)], names=["language", "words", "pairs"])

    held: dict[str, list] = {}
    for r in sums.mapInArrow(choose, "language string, words binary, pairs binary").collect():
        held.setdefault(r["language"], []).append((np.frombuffer(r["words"], np.uint64).reshape(-1, 4), np.frombuffer(r["pairs"], np.uint64)))
    found = {}
    for code, parts in held.items():
        words = prose.summed(np.concatenate([w for w, _ in parts]))
        found[code] = prose.common_words(words, used[code], totals[code]["sentences"], totals[code]["entries"]), np.sort(np.concatenate([p for _, p in parts]))
    return found


def _by_bucket(rows: np.ndarray, buckets: int) -> dict[int, bytes]:
    """The rows of each bucket of their hashes that has some."""
    to = (rows[:, 0] % np.uint64(buckets)).astype(np.int64)
    rows, ends = rows[np.argsort(to, kind="stable")], np.cumsum(np.bincount(to, minlength=buckets))
    return {int(k): rows[ends[k - 1] if k else 0 : ends[k]].tobytes() for k in np.unique(to)}


def _read(block: pa.Scalar, fields: int) -> np.ndarray:
    return np.frombuffer(block.as_py(), np.uint64).reshape(-1, fields)


def _added(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """One tally of several."""
    return sum(p[0] for p in parts), *(prose.summed(np.concatenate([p[k] for p in parts])) for k in (1, 2))


def _shares(rows: DataFrame, words: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Rows ``(language, statistic, value)``: the shares of each different text of the languages, see ``prose.text_shares``."""
    shared = rows.sparkSession.sparkContext.broadcast(words)
    names = [f"s{k}" for k in range(6)]

    def run(batches):
        for batch in batches:
            for code, places, texts in _by_language(batch):
                got = prose.text_shares(texts, *shared.value[code])
                keys = batch.column("key").take(pa.array(places))
                yield pa.RecordBatch.from_arrays([pa.array([code] * len(texts)), keys, *(pa.array(c, pa.float64(), from_pandas=True) for c in got.T)], names=["language", "key", *names])

    keyed = rows.where(F.col("language").isin(list(words))).select("language", F.unhex(F.sha2("text", 256)).alias("key"), "text")
    schema = "language string, key binary, " + ", ".join(f"{n} double" for n in names)
    # copies of a text have equal rows
    held = checkpointed(spread(keyed).mapInArrow(run, schema).distinct().drop("key"))
    return held.select("language", F.posexplode(F.array(*names)).alias("statistic", "value")).where("value is not null")


def medians(values: DataFrame) -> dict[str, list[float | None]]:
    """The exact medians of the six statistics of each language, from rows ``(language, statistic, value)`` with values of 0 to 1.

    In two phases, so that no task sorts all values: the cells of a histogram
    that hold the middle ranks, then the different values within these.
    """
    keys = ["language", "statistic"]
    celled = values.withColumn("cell", F.floor(F.col("value") * MEDIAN_CELLS))
    upto = lambda by, column: F.sum("n").over(Window.partitionBy(*by).orderBy(column))
    middle = "upto > (total - 1) div 2 and upto - n <= total div 2"
    cells = celled.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumns({"upto": upto(keys, "cell"), "total": F.sum("n").over(Window.partitionBy(*keys))}).where(middle)
    inside = celled.join(F.broadcast(cells.select(*keys, "cell", (F.col("upto") - F.col("n")).alias("before"), "total")), [*keys, "cell"])
    inside = inside.groupBy(*keys, "cell", "before", "total", "value").agg(F.count(F.lit(1)).alias("n"))
    inside = inside.withColumn("upto", F.col("before") + upto([*keys, "cell"], "value")).where(middle)
    found: dict[str, list[float | None]] = {}
    for r in inside.groupBy(*keys).agg(((F.min("value") + F.max("value")) / 2).alias("median")).collect():
        found.setdefault(r["language"], [None] * 6)[r["statistic"]] = r["median"]
    return found


def text_statistics(pages: DataFrame, model: list[prose.Language] | None = None) -> DataFrame:
    """One row for each row of the input with its statistics.

    Columns: ``page_id``, ``words``, ``lines`` (not blank), ``characters`` (no
    white space), ``mean_word_length``, ``symbol_share`` and ``digit_share`` of
    the characters, ``closed_line_share`` of lines that end with closing
    punctuation, ``common_word_share`` (common words among the words),
    ``common_letter_share`` (their letters among the characters),
    ``prose_share`` (characters in lines nearest to prose), ``language`` whose
    prose it was compared with, and ``profile``.  The language is that of the
    edition; where that is missing, the one whose common words fill most of
    the text; ``und`` where it could not be learnt.  Null, empty and blank
    texts have zeros and a null profile and language.  The profiles are learnt
    from the pages unless given; the statistics are one narrow pass.
    """
    shared = pages.sparkSession.sparkContext.broadcast(learnt_languages(pages) if model is None else model)

    def run(batches):
        model = shared.value
        codes = [m.code for m in model] + ["und"]
        for batch in batches:
            texts, languages = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a, b in blocks.text_chunks(texts):
                got = prose.measure(texts[a:b], languages[a:b], model)
                some = got["profile"] >= 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        *(pa.array(got[c].astype(np.int64)) for c in _COUNTS),
                        *(pa.array(got[c].astype(np.float64)) for c in _SHARES),
                        pa.array([codes[k] if s else None for k, s in zip(got["language"], some)], pa.string()),
                        pa.array([prose.OUTCOMES[k] if s else None for k, s in zip(got["profile"], some)], pa.string()),
                    ],
                    names=["page_id", *_COUNTS, *_SHARES, "language", "profile"],
                )

    schema = "page_id bigint, " + ", ".join([f"{c} bigint" for c in _COUNTS] + [f"{c} double" for c in _SHARES]) + ", language string, profile string"
    return spread(pages.select("page_id", "text", edition_language(F.col("wiki")).alias("edition"))).mapInArrow(run, schema)


def not_prose(pages: DataFrame, model: list[prose.Language] | None = None) -> DataFrame:
    """Rows ``(page_id)``: the pages of whose characters more than half stand in no running prose, each once.

    Null, empty and blank texts are no case.
    """
    rows = text_statistics(pages, model).where(F.col("profile").isNotNull() & (F.col("prose_share") < PROSE_SHARE))
    return rows.select("page_id").distinct()
