"""Artifacts of a dataset, and its publication."""

from __future__ import annotations

import os
import shutil
import tempfile
import warnings
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.errors import ValidationError

DOCUMENTS, ATTRIBUTION, DECISIONS = "documents", "attribution", "page-decisions"
DROPPED, SEGMENTS, AUDIT = "dropped-pages.jsonl", "segments.jsonl", "corpus-audit.json"
REVIEW, CARD, INDEX, MANIFEST = "review-candidates.jsonl", "DATA_CARD.md", "source-index.txt.bz2", "manifest.json"
TOKENS, TOKENIZER = "tokens", "tokenizer.json"


def write_table(frame: DataFrame, path: Path, key: str = "page_id") -> None:
    """Write a table in ascending order of its key over all part files, compressed, without dictionaries."""
    ordered = frame.repartitionByRange(F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first())
    ordered.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(f"file://{path}")


def out_of_order(spark: SparkSession, path: Path, key: str = "page_id") -> int:
    """How many rows of a written table do not rise strictly above the row before them, over all its part files.

    Rows are compared within their file, and files, of which each gives one
    row, with the file before.
    """
    rows = spark.read.parquet(f"file://{path}").select(F.col(key).alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    placed = rows.withColumn("before", F.lag("key").over(W.partitionBy("file").orderBy("row")))
    files = placed.groupBy("file").agg(
        F.count_if(F.col("key").isNull() | (F.col("key") <= F.col("before"))).alias("inside"), F.min("key").alias("least"), F.max("key").alias("most")
    )
    joints = files.withColumn("reached", F.max("most").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)))  # one row a file
    return joints.agg(F.coalesce(F.sum(F.col("inside") + F.when(F.col("least") <= F.col("reached"), 1).otherwise(0)), F.lit(0)).alias("n")).first()["n"]


@contextmanager
def staging_for(target: Path):
    """A hidden folder beside the target, removed if what fills it fails."""
    if target.exists():
        raise ValidationError(f"the output exists already: {target}")
    target.parent.mkdir(parents=True, exist_ok=True)
    staging = Path(tempfile.mkdtemp(prefix=f".{target.name}.staging-", dir=target.parent))
    try:
        yield staging
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def publish(staging: Path, target: Path) -> None:
    """Make the staged dataset readable and give it its name, in one step."""
    staging.chmod(0o755)
    os.replace(staging, target)


def clean_up(work: Path) -> None:
    """Remove the work folder; that it cannot be is only worth a warning."""
    try:
        shutil.rmtree(work)
    except OSError as error:
        warnings.warn(f"the dataset is published, but its work folder stays: {error}", RuntimeWarning, stacklevel=2)


def data_card(source: dict, extraction: dict, audit: dict) -> str:
    """A description of the dataset for its readers, in Markdown."""
    exact, near = audit["exact_duplicates"], audit["near_duplicates"]
    drops = "\n".join(f"| {reason} | {count} |" for reason, count in sorted(extraction["drop_counts"].items()))
    return f"""# Data card: {source['wiki']} {source['snapshot']}

Prose of the articles of one dated dump, extracted mechanically. Licence of the texts: {source['license']}.

| figure | value |
|---|---|
| pages seen | {extraction['pages_seen']} |
| documents | {extraction['documents_emitted']} |
| pages dropped | {extraction['pages_dropped']} |
| groups of equal texts | {exact['duplicate_groups']} |
| of these over splits | {exact['cross_split_groups']} |
| near pairs in the probed sample | {near['near_duplicate_pairs_observed']} |

| reason of a drop | pages |
|---|---|
{drops}

The near-duplicate figures hold for a declared sample only. The extraction has not been reviewed by people unless a
review says so; templates are not expanded, and tables, references and lists of links are left out.
"""
