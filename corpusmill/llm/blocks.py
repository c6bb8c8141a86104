"""Exchange of many small fixed-width records as packed blocks.

Signature records are 16 bytes.  Sent as rows they would cost several times
that in the JVM, so each task packs its records by bucket and sends one block a
bucket; buckets are read back as arrays.  The number of buckets follows the
number of records, so a bucket stays within memory at any size of the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.shingles import mix
from corpusmill.runtime import spread

#: Characters of text turned into arrays at once.
CHUNK_CHARS = 1 << 19
#: Records a task gathers before it sends them on.
FLUSH_RECORDS = 1 << 20
#: Records of a bucket that the number of buckets aims at.
BUCKET_RECORDS = 1 << 19
#: Members of a key from which its pairs are made by a salted join and not in the task of its bucket, and salts of that join.
HOT_MEMBERS, HOT_SALTS = 4096, 64


def text_chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of the texts of about ``limit`` characters each; a longer text is a range by itself."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def pack_blocks(records: Iterator[np.ndarray], buckets: int, shift: int = 0) -> Iterator[pa.RecordBatch]:
    """Blocks ``(bucket, block)`` of record arrays whose first field, but for its lowest ``shift`` bits, is the key; equal records of a flush are sent once."""
    held, count = [], 0

    def flush():
        rows = np.unique(np.concatenate(held), axis=0)
        to = ((rows[:, 0] >> np.uint64(shift)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        rows, to = rows[order], to[order]
        cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        ends = np.concatenate([cuts[1:], [len(to)]])
        return pa.RecordBatch.from_arrays(
            [pa.array(to[cuts], pa.int64()), pa.array([rows[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())], names=["bucket", "block"]
        )

    for part in records:
        if len(part):
            held.append(part)
            count += len(part)
            if count >= FLUSH_RECORDS:
                yield flush()
                held, count = [], 0
    if held:
        yield flush()


def by_bucket(blocks: DataFrame, buckets: int, handle: Callable[[np.ndarray], Iterator[np.ndarray]], names: list[str], fields: int) -> DataFrame:
    """Rows of longs that ``handle`` makes of the records of each bucket.

    There are as many partitions as buckets, whatever the session's default, so
    the data of a task do not grow with the input.
    """
    schema = ", ".join(f"{n} bigint" for n in names)

    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(b.as_py(), np.uint64).reshape(-1, fields) for batch in group for b in batch.column("block")]
        for rows in handle(np.concatenate(parts)):
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, i].view(np.int64)) for i in range(len(names))], names=names)

    return blocks.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, schema)


def salted_pairs(left: DataFrame, right: DataFrame, salts: int = HOT_SALTS) -> DataFrame:
    """The pairs ``(a, b)`` of members of the same hot key, from ``(key, a, ...)`` and ``(key, b)``.

    The right members of a key are dealt to salts and the left ones repeated
    for each, so that no task holds a whole key.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return left.withColumn("salt", every).join(right.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int")), ["key", "salt"]).drop("key", "salt")


#: Registers of the counter of one slot, and of that of all texts.
REGISTERS, TEXT_REGISTERS = 32, 1 << 14


def observe(registers: np.ndarray, counter: np.ndarray, names: np.ndarray, per_counter: int) -> None:
    """Enter names into counters that tell how many different names each has seen, however often and wherever it has seen them."""
    hashes = mix(names ^ mix(counter.astype(np.uint64) + np.uint64(0x51ED27)))
    place = counter * per_counter + (hashes & np.uint64(per_counter - 1)).astype(np.int64)
    # the place of the first set bit of what is left of the hash
    rest = (hashes >> np.uint64(per_counter.bit_length() - 1)).astype(np.float64)
    rank = 65 - per_counter.bit_length() + 1 - np.frexp(rest)[1]
    np.maximum.at(registers, place, rank.astype(np.uint8))


def estimates(registers: np.ndarray, per_counter: int) -> np.ndarray:
    """The number of different names of each counter."""
    rows = registers.reshape(-1, per_counter).astype(np.float64)
    raw = 0.7213 / (1 + 1.079 / per_counter) * per_counter**2 / (2.0**-rows).sum(1)
    empty = (rows == 0).sum(1)
    return np.where((raw <= 2.5 * per_counter) & (empty > 0), per_counter * np.log(per_counter / np.maximum(empty, 1)), raw)


def slot_loads(rows: DataFrame, key_col: str, text_col: str, slots_of: Callable[[list[str | None]], tuple], slots: int) -> tuple[np.ndarray, int, int]:
    """In how many different texts each slot occurs, about how many texts there are, and how many records are expected.

    ``slots_of`` gives the slots of some texts, the text each belongs to, which
    texts count, and the expected records.  All texts are counted, by counters
    that a copy cannot change: the result depends on the set of texts alone and
    not on their layout.  Each task sends its counters once; they are of fixed
    size, whatever the number of texts.
    """
    pieces = 64
    sizes = slots // pieces * REGISTERS

    def count(batches):
        held, texts, expected = np.zeros(slots * REGISTERS, np.uint8), np.zeros(TEXT_REGISTERS, np.uint8), 0
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            fresh = first_of(keys, seen)
            column = batch.column(1).take(pa.array(fresh, pa.int64())).to_pylist()
            names = np.array([keys[i] for i in fresh], np.int64).view(np.uint64)
            for a, b in text_chunks(column):
                got, owner, counted, records = slots_of(column[a:b])
                observe(held, got, names[a:b][owner], REGISTERS)
                observe(texts, np.zeros(int(counted.sum()), np.int64), names[a:b][counted], TEXT_REGISTERS)
                expected += records
        parts = [held[i * sizes : (i + 1) * sizes].tobytes() for i in range(pieces)] + [texts.tobytes()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(pieces + 1), pa.int32()), pa.array(parts, pa.binary()), pa.array([expected] + [0] * pieces, pa.int64())], names=["piece", "held", "expected"]
        )

    def merge(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, expected, piece = None, 0, None
        for batch in group:
            for i in range(batch.num_rows):
                piece = batch.column("piece")[i].as_py()
                part = np.frombuffer(batch.column("held")[i].as_py(), np.uint8)
                total = part.copy() if total is None else np.maximum(total, part)
            expected += sum(batch.column("expected").to_pylist())
        per = TEXT_REGISTERS if piece == pieces else REGISTERS
        loads = np.round(estimates(total, per)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int32()), pa.array([loads.tobytes()], pa.binary()), pa.array([expected], pa.int64())], names=["piece", "held", "expected"]
        )

    schema = "piece int, held binary, expected bigint"
    sums = spread(rows.select(key_col, text_col)).mapInArrow(count, schema).groupBy("piece").applyInArrow(merge, schema).collect()
    loads = {r["piece"]: np.frombuffer(bytes(r["held"]), np.int64) for r in sums}
    if not loads:
        return np.zeros(slots, np.int64), 0, 0
    return np.concatenate([loads[i] for i in range(pieces)]), int(loads[pieces][0]), sum(r["expected"] for r in sums)


def first_of(keys: list[int], seen: set[int]) -> list[int]:
    """Places of the keys not seen before; the keys are added to the seen ones."""
    places = []
    for i, key in enumerate(keys):
        if key not in seen:
            seen.add(key)
            places.append(i)
    return places
