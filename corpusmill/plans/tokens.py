"""Token shards of a corpus with a tokenizer file."""

from __future__ import annotations

import math
import shutil
from collections import Counter
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.config import SPLITS
from corpusmill.errors import ConfigError, ValidationError
from corpusmill.operators.packing import dropped_tails, packed_sequences
from corpusmill.plans.publish import TOKENIZER, TOKENS
from corpusmill.runtime import checkpointed
from corpusmill.sources.files import file_digests
from corpusmill.sources.shards import TOKEN_TYPES, ShardView, token_type


@lru_cache(maxsize=2)
def _tokenizer(content: bytes):
    from tokenizers import Tokenizer

    return Tokenizer.from_buffer(content)


def tokenized(documents: DataFrame, content: bytes, end: int) -> DataFrame:
    """Rows ``(split, page_id, tokens)`` with the end token after each document; an unknown split is an error."""
    shared = documents.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        tokenizer = _tokenizer(shared.value)
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        for batch in batches:
            splits = batch.column(0).to_pylist()
            if set(splits) - set(SPLITS):
                raise ValidationError(f"a document has no known split: {sorted(map(str, set(splits) - set(SPLITS)))[0]}")
            lists = [e.ids + [end] for e in tokenizer.encode_batch(batch.column(2).to_pylist(), add_special_tokens=False)]
            if any(max(ids) >= size for ids in lists):
                raise ValidationError("the tokenizer gives an id outside of its vocabulary")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))], names=["split", "page_id", "tokens"])

    return documents.select("split", "page_id", "text").mapInArrow(run, "split string, page_id bigint, tokens array<bigint>")


def write_sequences(packed: DataFrame, folder: Path, kind: str) -> DataFrame:
    """Rows ``(split, shard, sequences, largest)`` of the shards that are written as they are computed.

    A shard is written by the task that holds its sequences, through a
    temporary name, so a repeated task leaves the same file.
    """
    place, width = str(folder), TOKEN_TYPES[kind]

    def write(table: pa.Table) -> pa.Table:
        import os

        table = table.sort_by("sequence")
        split, shard = table.column("split")[0].as_py(), table.column("shard")[0].as_py()
        values = table.column("tokens").combine_chunks().flatten().to_numpy().astype(width)
        name = f"{split}-{shard:05d}.bin"
        with open(f"{place}/.{name}.{os.getpid()}", "wb") as file:
            file.write(values.tobytes())
        os.replace(f"{place}/.{name}.{os.getpid()}", f"{place}/{name}")
        return pa.table({"split": [split], "shard": [shard], "sequences": [table.num_rows], "largest": [int(values.max())]})

    return packed.groupBy("split", "shard").applyInArrow(write, "split string, shard bigint, sequences bigint, largest bigint")


def write_shards(documents: DataFrame, tokenizer: Path, end: int, folder: Path, length: int, per_shard: int) -> dict:
    """Write the shards of all splits under ``folder`` and return their summary."""
    content = tokenizer.read_bytes()
    size = _tokenizer(content).get_vocab_size(with_added_tokens=True)
    if not 0 <= end < size:
        raise ConfigError("the end token is not in the vocabulary")
    kind = token_type(max(size - 1, end))
    if tokenizer.resolve() != (folder / TOKENIZER).resolve():
        shutil.copyfile(tokenizer, folder / TOKENIZER)
    target = folder / TOKENS
    target.mkdir()
    rows = checkpointed(tokenized(documents, content, end))
    tails = {r["split"]: r["dropped_tail_tokens"] for r in dropped_tails(rows, length).collect()}
    written = write_sequences(packed_sequences(rows, length, per_shard), target, kind)
    shards = []
    for row in sorted(written.collect(), key=lambda r: (SPLITS.index(r["split"]), r["shard"])):
        name = f"{TOKENS}/{row['split']}-{row['shard']:05d}.bin"
        _, digest, held = file_digests(folder / name)
        shards.append({"path": name, "split": row["split"], "sequences": row["sequences"], "sha256": digest, "bytes": held})
    _, digest, held = file_digests(folder / TOKENIZER)
    return {
        "tokenizer": {"path": TOKENIZER, "sha256": digest, "bytes": held, "vocab_size": size, "eos_token_id": end},
        "dtype": kind,
        "context_length": length,
        "sequences_per_shard": per_shard,
        "dropped_tail_tokens": {s: tails.get(s, 0) for s in SPLITS},
        "shards": shards,
    }


def bigram_step(tokens: np.ndarray) -> tuple[float, float]:
    """Loss of a bigram model with zero weights on a sequence, and after one step of rate 1, in closed form."""
    pairs = Counter(zip(tokens[:-1].tolist(), tokens[1:].tolist()))
    if not pairs:
        raise ValidationError("a training check needs two tokens")
    total, size = sum(pairs.values()), len(set(tokens.tolist()))
    row, followers = Counter(), Counter()
    for (i, _), c in pairs.items():
        row[i] += c
        followers[i] += 1
    seen = Counter()
    logit = {k: (c - row[k[0]] / size) / total for k, c in pairs.items()}
    for (i, _), value in logit.items():
        seen[i] += math.exp(value)
    scale = {i: math.log(seen[i] + (size - followers[i]) * math.exp(-row[i] / (size * total))) for i in row}
    after = -sum(c * (logit[k] - scale[k[0]]) for k, c in pairs.items()) / total
    return math.log(size), after


def training_check(summary: dict, folder: Path) -> dict:
    """The bigram step on the first sequence of the first shard; its loss must fall."""
    if not summary["shards"]:
        raise ValidationError("a training check needs a shard")
    first = summary["shards"][0]
    tokens = np.asarray(ShardView(folder / first["path"], summary["dtype"], summary["context_length"])[0], np.int64)
    before, after = bigram_step(tokens)
    if not after < before:
        raise ValidationError("the training check did not lower the loss")
    return {
        "model": "bigram-one-step",
        "shard": first["path"],
        "token_pairs": len(tokens) - 1,
        "observed_vocabulary": len(set(tokens.tolist())),
        "loss_before": round(before, 12),
        "loss_after": round(after, 12),
    }
