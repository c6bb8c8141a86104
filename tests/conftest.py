from __future__ import annotations

import bz2
import json
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = Path(os.environ.get("CORPUSMILL_TESTDATA", "/root/testdata")) / "sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def page(number, text, title="Title", ns="0", extra="", revision=None):
    revision = number + 100 if revision is None else revision
    return (
        f"<page><title>{title}</title><ns>{ns}</ns><id>{number}</id>{extra}<revision><id>{revision}</id>"
        f"<timestamp>2026-08-01T00:00:00Z</timestamp><text>{text}</text></revision></page>"
    )


def pages_of_two_segments():
    """Six pages: the first segment holds one document, the second three in all length strata."""
    return [
        [(1, page(1, "A short sentence with words.", "One")), (2, page(2, "word", "Two")), (3, page(3, "Talk text with words.", "Talk:Three", "1"))],
        [
            (4, page(4, ("word " * 200).strip(), "Four")),
            (5, page(5, ("words " * 1200).strip(), "Five")),
            (6, page(6, "Une phrase accentuée, déjà écrite.", "Six: a title")),
        ],
    ]


def write_dump(folder: Path, segments=None) -> tuple[Path, Path]:
    """A dump with a header stream and one stream a segment, and its index."""
    segments = segments or pages_of_two_segments()
    # the index of the tests starts with the first segment, so the dump has no separate header
    data, lines = b"", []
    for number, pages in enumerate(segments):
        body = "".join(text for _, text in pages) + ("\n</mediawiki>" if number == len(segments) - 1 else "")
        lines += [f"{len(data)}:{page_id}:Title: {page_id}" for page_id, _ in pages]
        data += bz2.compress(body.encode())
    dump, index = folder / "dump.xml.bz2", folder / "index.txt.bz2"
    dump.write_bytes(data)
    index.write_bytes(bz2.compress(("\n".join(lines) + "\n").encode()))
    return dump, index


@pytest.fixture
def dump(tmp_path):
    return write_dump(tmp_path)


@pytest.fixture(scope="session")
def tokenizer(tmp_path_factory):
    """A word-level tokenizer file with an unknown and an end token."""
    path = tmp_path_factory.mktemp("tokenizer") / "tokenizer.json"
    words = ["[UNK]", "[EOS]", "word", "words", "a", "short", "sentence", "with", "une", "phrase", "A"]
    path.write_text(
        json.dumps(
            {
                "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
                "pre_tokenizer": {"type": "Whitespace"}, "post_processor": None, "decoder": None,
                "model": {"type": "WordLevel", "vocab": {w: i for i, w in enumerate(words)}, "unk_token": "[UNK]"},
            }
        )
    )
    return path
