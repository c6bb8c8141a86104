"""Queries over small written cases: page texts, a compressed dump, token shards, checksum lists."""

from __future__ import annotations

import bz2
import json
import uuid
from pathlib import Path

from pyspark.sql import functions as F

from corpusmill.operators import cascade
from corpusmill.plans import tokens
from corpusmill.runtime import shared_folder, ship
from corpusmill.sources.files import published_sha1
from corpusmill.sources.segments import load_catalog, read_index, read_segments

#: Page texts with the reason they are dropped for, or the prose they hold.
TEXTS = (
    ("[[File:A.jpg|right|200px]] '''Clean''' prose links to [[Useful|useful text]].\n[[Category:X]]\n==References==\nCited.", None, "Clean prose links to useful text."),
    ("An introduction of useful prose.\n{{table header}}\n|-bgcolor=#fefefe\n| One || Two || align=right | 2 km", None, "An introduction of useful prose."),
    ("Opening.<ref>\nCited.</ref> More.<ref\nname=\"m\"/> Final.<ref name=http://example.com/>Cited.</ref> Last.<refname=A /> End.", None, "Opening. More. Final. Last. End."),
    ("Useful words here.<references>\nlist\n</references> Adjacent.<references />", None, "Useful words here. Adjacent."),
    ("Opening stays.\n{| class=\"a\"\n| {| class=\"b\"\n| nested || cells\n|}\n|}\n==References==\nnoise\n==History==\nStays too.", None, "Opening stays.\n\nHistory\nStays too."),
    ("==Life==\nOpening words.\n===References===\nnoise\n====Notes====\nnoise\n===Career===\nIt resumes.", None, "Life\nOpening words.\nCareer\nIt resumes."),
    ("Caf&eacute; {{x|{{y}}}}[http://a.example title here] [http://b.example] {{{p|default}}} <b>bold</b> [[A|b [[c]] d]]", None, "Café title here default bold b c d"),
    ("One __NOTOC__ ''two''.\n! colspan=\"2\" | head\n* item\n----\nline--> ends", None, "One  two.\nitem\n\nline ends"),
    ("&lt;ref&gt;cited&lt;/ref&gt;Kept words here", None, "Kept words here"),
    ("A <nowiki>[single] bracket</nowiki> stays", None, "A [single] bracket stays"),
    ("{{outer|[[File:x.png|thumb|caption]]}}Three words stay", None, "Three words stay"),
    ("Tabs\tand   blanks\r\n\r\n\r\n\r\nand lines collapse ", None, "Tabs and blanks\n\nand lines collapse"),
    ("A decomposed café is composed", None, "A decomposed café is composed"),
    ("! a !! b\n| c || d\n|- x\nOnly this line stays", None, "Only this line stays"),
    ("{{Only|a template}}", "empty_text", None),
    ("", "empty_text", None),
    ("==Notes==\nnothing else than notes", "empty_text", None),
    ("{{Infobox country\n| name = Broken\nProse that cannot be told apart.", "markup_residue", None),
    ("[[File:A.jpg|thumb|An unclosed caption.\nProse stays ambiguous.", "markup_residue", None),
    ("Prose with a dangling close.\n</references>", "markup_residue", None),
    ("Opening.\nSpecifications: | style=\"x\" | 42 kg.\nMore prose follows.", "markup_residue", None),
    ("Text with a [//example.org link", "markup_residue", None),
    ("tiny", "insufficient_text", None),
    ("two 22 words 33", "insufficient_text", None),
    ("  #redirect [[Elsewhere]]", "redirect", None),
)
#: Pages of two segments: identifier, title, text.
SEGMENTS = (((1, "One", "A short sentence."), (2, "Two: a title", "word")), ((3, "Three", "Une phrase accentuée."), (4, "Four", "last &amp; least"), (7, "Seven", None)))
#: A checksum list and the files asked of it.
CHECKSUMS = ("a" * 40 + "  dump.xml.bz2\n" + "B" * 40 + "  index.txt.bz2\n" + "c" * 40 + "  index.txt.bz2.old\n", ("dump.xml.bz2", "index.txt.bz2"))
#: Words of a word-level vocabulary by their identifiers, and texts with the tokens they give.
VOCABULARY = ("[UNK]", "[EOS]", "word", "words", "a", "short", "sentence", "with", "une", "phrase", "A")
ENCODED = ((1, "train", "a short word", [4, 5, 2, 1]), (2, "test", "A  longer phrase", [10, 0, 9, 1]), (3, "train", "", [1]), (4, "validation", "une\nphrase with words", [8, 9, 7, 3, 1]))


def _scratch(spark, name: str) -> Path:
    """A new folder below the one that all executors share."""
    path = Path(shared_folder(spark).removeprefix("file://").removeprefix("file:")) / f"{name}-{uuid.uuid4().hex}"
    path.mkdir(parents=True)
    return path


def extraction_cases(spark, d):
    """Outcome and prose of written page texts."""
    ship(spark)
    rows = [(f"Title {i}", "0", str(i), None, {"id": str(i + 100), "rev_timestamp": "t", "text": text}) for i, (text, _, _) in enumerate(TEXTS, 1)]
    kind = "title string, ns string, id string, redirect struct<title string>, revision struct<id string, rev_timestamp string, text string>"
    return cascade.extracted(spark.createDataFrame(rows, kind)).select("page_id", "reason", "text")


def segment_cases(spark, d):
    """Pages read by byte range from a dump of two compressed segments that is written first."""
    ship(spark)
    folder, data, lines = _scratch(spark, "dump"), b"", []
    for number, pages in enumerate(SEGMENTS):
        body = ""
        for page, title, text in pages:
            lines.append(f"{len(data)}:{page}:{title}")
            body += f"<page><title>{title}</title><ns>0</ns><id>{page}</id><revision><id>{page + 100}</id><text>{text or ''}</text></revision></page>\n"
        data += bz2.compress((body + ("</mediawiki>" if number == len(SEGMENTS) - 1 else "")).encode())
    (folder / "dump.xml.bz2").write_bytes(data)
    (folder / "index.txt.bz2").write_bytes(bz2.compress(("\n".join(lines) + "\n").encode()))
    ranges = load_catalog(read_index(spark, f"file://{folder / 'index.txt.bz2'}"), len(data))
    pages = read_segments(ranges, str(folder / "dump.xml.bz2"))
    return pages.select("ordinal", "position", F.col("expected_page_id").alias("page_id"), "title", F.col("revision.id").alias("revision"), F.col("revision.text").alias("text"))


def encoded_cases(spark, d):
    """Token ids of written texts by a word-level tokenizer, with the end token."""
    ship(spark)
    content = json.dumps(
        {
            "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "Whitespace"},
            "post_processor": None, "decoder": None, "model": {"type": "WordLevel", "vocab": {w: i for i, w in enumerate(VOCABULARY)}, "unk_token": "[UNK]"},
        }
    ).encode()
    rows = spark.createDataFrame([r[:3] for r in ENCODED], "page_id bigint, split string, text string")
    return tokens.tokenized(rows, content, 1).select("page_id", "split", F.array_join("tokens", " ").alias("ids"))


def checksum_cases(spark, d):
    """Checksums that a published list states for files."""
    return spark.createDataFrame([(name, published_sha1(CHECKSUMS[0], name)) for name in CHECKSUMS[1]], "file string, sha1 string")


def queries():
    return {f.__name__: f for f in (extraction_cases, segment_cases, encoded_cases, checksum_cases)}


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(columns: str, rows) -> str:
    """SQL of a written table; columns are ``name:type``."""
    names = [c.split(":") for c in columns.split()]
    listed = ", ".join(f"CAST(c{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(names))
    inside = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    return f"SELECT {listed} FROM (VALUES {inside}) t({', '.join(f'c{i}' for i in range(len(names)))})"


def oracle_sql():
    segments = [(s, n, page, title, str(page + 100), None if text is None else text.replace("&amp;", "&")) for s, pages in enumerate(SEGMENTS) for n, (page, title, text) in enumerate(pages)]
    return {
        "extraction_cases": _values("page_id:BIGINT reason:VARCHAR text:VARCHAR", [(i, reason, text) for i, (_, reason, text) in enumerate(TEXTS, 1)]),
        "segment_cases": _values("ordinal:INT position:INT page_id:BIGINT title:VARCHAR revision:VARCHAR text:VARCHAR", segments),
        "encoded_cases": _values("page_id:BIGINT split:VARCHAR ids:VARCHAR", [(page, split, " ".join(map(str, ids))) for page, split, _, ids in ENCODED]),
        "checksum_cases": _values("file:VARCHAR sha1:VARCHAR", [(CHECKSUMS[1][0], "a" * 40), (CHECKSUMS[1][1], "b" * 40)]),
    }
