"""Records whose text was decoded with a wrong encoding (problem 9)."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.encodings import CharacterModel, Mender, char_kind, misread
from corpusmill.runtime import spread

_OTHER_WORDS = re.compile("[Ͱ-ϿЀ-ӿ]+")
#: Runs of Latin letters.
_LATIN_WORDS = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def count_characters(batches):
    """The sums of one task's texts, as one batch of ``(kind, mark, documents)``."""
    sums: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if not text:
                continue
            if text.isascii():
                sums["n", "all"] += 1
                continue
            # all that counts lies in words with a character beyond ASCII
            words = " ".join(w for w in set(text.replace("\n", " ").split(" ")) if not w.isascii())
            if misread(words):
                continue
            sums["n", "all"] += 1
            chars = {c for c in set(words) if c > "\x7f"}
            sums.update(("c", c) for c in chars)
            if any(c >= "\u2e80" for c in chars) and sum(c >= "\u2e80" for c in words) > 20:
                sums["n", "J"] += 1
            lower = words.lower()
            runs = {r for r in set(_LATIN_WORDS.findall(lower)) if not r.isascii()}
            pairs = {p for w in runs for p in map("".join, zip("^" + w, w + "$")) if not p.isascii()}
            sums.update(("p", p) for p in pairs)
            if any("Ͱ" <= c <= "ӿ" for c in chars):
                others = set(_OTHER_WORDS.findall(lower))
                pairs = {p for w in others for p in map("".join, zip("^" + w, w + "$"))}
                sums.update(("p", p) for p in pairs)
                for name, low, high in (("G", "Ͱ", "Ѐ"), ("C", "Ѐ", "Ԁ")):
                    if sum(low <= w[0] < high for w in others) > 5:
                        sums["n", name] += 1
    kinds, marks = [k for k, _ in sums], [m for _, m in sums]
    yield pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(marks, pa.string()), pa.array(list(sums.values()), pa.int64())], names=["kind", "mark", "documents"]
    )


def character_counts(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows ``(kind, mark, documents)``: in how many documents each character and pair of letters occurs.

    ``kind`` is ``c`` for characters, ``p`` for pairs of neighbouring letters of
    Greek and Cyrillic words and of Latin letters of which one is beyond ASCII,
    with the ends of words, and ``n`` for the numbers of all documents
    (``all``) and of those with more than a few Greek (``G``), Cyrillic (``C``)
    or East Asian (``J``) words or letters.  Counted over all documents but
    those with a mark of misreading (``encodings.misread``), so that a whole
    source that is garbled in one way does not make its garbling look common;
    each task sends its sums once, so what moves is bounded by the pairs of
    characters there are.
    """

    parts = spread(documents.select(text_col)).mapInArrow(count_characters, "kind string, mark string, documents bigint")
    return parts.groupBy("kind", "mark").agg(F.sum("documents").alias("documents"))


def character_model(counts: list) -> tuple[dict[str, float], dict[str, float]]:
    """Shares of documents by character and by pair, from rows ``(kind, mark, documents)``."""
    total = {m: n for k, m, n in counts if k == "n"}
    every = max(1, total.get("all", 0))

    def base(letter: str) -> int:
        """The number of documents in the letter's script."""
        kind = char_kind(letter)
        return max(1, total.get(kind, 0)) if kind in ("G", "C", "J") else every

    chars = {m: min(1.0, n / base(m)) for k, m, n in counts if k == "c"}
    pairs = {m: min(1.0, n / base(m[1] if m[0] == "^" else m[0])) for k, m, n in counts if k == "p"}
    return chars, pairs


def mend_texts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", restore: bool = True) -> DataFrame:
    """Rows ``(id_col, restored)`` of the records with garbled characters.

    ``restored`` is the text as far as it could be mended, equal to the input
    where the original cannot be had, and null without ``restore``.  Two scans:
    one counts characters over all documents, whose table is bounded by the
    characters there are, the other examines each record where it is read; no
    text is shuffled.  Null, empty and blank texts and texts that only quote
    garbled characters are no case.  A record delivered twice is reported twice.
    """
    counts = [tuple(r) for r in character_counts(documents, text_col).collect()]
    shared = documents.sparkSession.sparkContext.broadcast(character_model(counts))
    kind = documents.schema[id_col].dataType

    def run(batches):
        mender = _mender(shared)
        for batch in batches:
            places, texts = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text:
                    found, mended = mender.examine(text, restore)
                    if found:
                        places.append(i)
                        texts.append(mended if restore else None)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places, pa.int64())), pa.array(texts, pa.string())], names=[id_col, "restored"])

    schema = T.StructType([T.StructField(id_col, kind), T.StructField("restored", T.StringType())])
    return spread(documents.select(id_col, text_col)).mapInArrow(run, schema)


_menders: dict[int, Mender] = {}


def _mender(shared) -> Mender:
    """The worker's mender for a broadcast model, with what it has learnt of words so far."""
    key = id(shared.value)
    if key not in _menders:
        _menders.clear()
        _menders[key] = Mender(CharacterModel(*shared.value))
    return _menders[key]


def garbled_documents(documents: DataFrame) -> DataFrame:
    """Rows ``(doc_id)`` of the documents with garbled characters."""
    return mend_texts(documents, restore=False).select("doc_id")
