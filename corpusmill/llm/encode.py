"""Encoding of a corpus with a public tokenizer (problem 7)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusmill.llm.vocab import DEFAULT_TOKENIZER, encoder, vocabulary_file
from corpusmill.runtime import spread


def encode_texts(
    frame: DataFrame, id_col: str, text_col: str, tokenizer: str = DEFAULT_TOKENIZER, folder: str | None = None
) -> DataFrame:
    """Rows ``(id_col, ids)``: the token ids of each text, without special tokens.

    One narrow pass without a shuffle: each row is encoded where it is read, so
    the plan is the same at any size, and rows repeat as often as they occur.
    Null and empty texts give an empty list; strings that look like control
    tokens are ordinary text; other columns of the input are not read.
    """
    shared = frame.sparkSession.sparkContext.broadcast(vocabulary_file(tokenizer, folder))

    def run(batches):
        worker = encoder(shared.value)
        for batch in batches:
            parts, counts = worker.encode_column(batch.column(1))
            values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    kind = frame.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return spread(frame.select(id_col, text_col)).mapInArrow(run, schema)


def count_tokens(frame: DataFrame, text_col: str, tokenizer: str = DEFAULT_TOKENIZER, folder: str | None = None) -> DataFrame:
    """The rows of the frame without their text, with a column ``tokens``; null and empty texts have 0.

    A narrow pass; the text column itself does not leave the scan.
    """
    shared = frame.sparkSession.sparkContext.broadcast(vocabulary_file(tokenizer, folder))
    kept = [f for f in frame.schema.fields if f.name != text_col]
    names = [f.name for f in kept]

    def run(batches):
        worker = encoder(shared.value)
        for batch in batches:
            counts = worker.count_column(batch.column(len(names)))
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*names, "tokens"])

    schema = T.StructType([*kept, T.StructField("tokens", T.LongType())])
    return spread(frame.select(*names, text_col)).mapInArrow(run, schema)
