from __future__ import annotations

import bz2
import io
import json

import pytest
from conftest import page, write_dump

from corpusmill.errors import CorpusError, FormatError, SourceError, ValidationError
from corpusmill.plans.source import prepare
from corpusmill.config import BuildConfig
from corpusmill.sources.files import artifact, confined, file_digests, published_sha1, read_json, read_lines, write_json, write_lines
from corpusmill.sources.http import Client, job_done, source_urls
from corpusmill.sources.segments import SegmentSource, load_catalog, parse_pages, read_index, read_segments, segment_rows, unpack
from corpusmill.sources.shards import ShardView, token_type


def index_of(spark, tmp_path, text):
    path = tmp_path / "index.txt.bz2"
    path.write_bytes(bz2.compress(text.encode()))
    return read_index(spark, str(path))


def test_index_gives_ranges(spark, tmp_path):
    rows = load_catalog(index_of(spark, tmp_path, "10:1:A\n10:2:B: c\n100:3:C\n"), 150).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["start"], r["end"], r["first_page_id"], r["page_ids"]) for r in rows] == [(0, 10, 99, 1, [1, 2]), (1, 100, 149, 3, [3])]


def test_title_keeps_colons_and_unusual_line_ends(spark, tmp_path):
    rows = index_of(spark, tmp_path, "10:1:A: b c\n").collect()
    assert rows[0]["title"] == "A: b c"


@pytest.mark.parametrize(
    "text, size, problem",
    [
        ("10:1\n", 50, "malformed"), ("x:1:A\n", 50, "malformed"), ("10:1:A\n5:2:B\n", 50, "backwards"), ("10:1:A\n20:1:B\n", 50, "repeated"),
        ("-1:1:A\n", 50, "negative"), ("60:1:A\n", 50, "outside"), ("", 50, "empty"), ("10:1:A\n", 0, "no size"),
    ],
)
def test_unusable_index_is_rejected(spark, tmp_path, text, size, problem):
    with pytest.raises(FormatError, match=problem):
        load_catalog(index_of(spark, tmp_path, text), size)


def plan_file(tmp_path, ranges):
    rows = [r.asDict() for r in ranges.select("ordinal", "start", "end", "page_ids").collect()]
    path = tmp_path / "plan.jsonl"
    write_lines(path, rows)
    return path


def test_segments_are_read_by_range(spark, tmp_path, dump):
    ranges = load_catalog(read_index(spark, str(dump[1])), dump[0].stat().st_size)
    rows = read_segments(ranges, str(dump[0]), parallel=2).orderBy("ordinal", "position").collect()
    assert [(r["ordinal"], r["position"], r["id"]) for r in rows] == [(0, 0, "1"), (0, 1, "2"), (0, 2, "3"), (1, 0, "4"), (1, 1, "5"), (1, 2, "6")]
    spark.dataSource.register(SegmentSource)
    again = spark.read.format("corpus_segments").option("dump", str(dump[0])).option("plan", str(plan_file(tmp_path, ranges))).load()
    assert again.rdd.getNumPartitions() == 2
    assert again.orderBy("ordinal", "position").collect() == rows


def test_faulty_segment_can_be_set_aside(spark, tmp_path):
    dump = write_dump(tmp_path, [[(1, page(1, "Words of one.")), (2, page(3, "Words of another."))], [(4, page(4, "More words here."))]])
    ranges = load_catalog(read_index(spark, str(dump[1])), dump[0].stat().st_size)
    rows = read_segments(ranges, str(dump[0]), quarantine=True).orderBy("ordinal").collect()
    assert len(rows) == 2 and "is listed" in rows[0]["problem"] and rows[1]["id"] == "4"


def test_page_without_id_takes_the_listed_one():
    data = bz2.compress(b"<page><title>T</title><ns>0</ns><revision><contributor><id>5</id></contributor><text>x</text></revision></page>")
    row = segment_rows(data, 0, [7])[0]
    assert row["expected_page_id"] == 7 and row["id"] is None and row["revision"]["id"] is None


@pytest.mark.parametrize("ids, message", [([1, 2], "fewer"), ([], "more"), ([9], "is listed")])
def test_pages_must_match_the_index(ids, message):
    with pytest.raises(FormatError, match=message):
        segment_rows(bz2.compress(page(1, "x").encode()), 0, ids)


@pytest.mark.parametrize("data", [b"no bzip2", bz2.compress(b"<broken>"), bz2.compress(b"  "), bz2.compress(b"x" * 100)[:-8]])
def test_broken_segments_are_errors(data):
    with pytest.raises(FormatError):
        segment_rows(data, 0, None)


def test_unpacking_is_bounded_and_joins_streams():
    assert unpack(bz2.compress(b"a") + bz2.compress(b"b")) == b"ab"
    with pytest.raises(FormatError, match="more than allowed"):
        unpack(bz2.compress(b"a" * 100), 99)


def test_closing_tag_and_namespaces_are_no_matter():
    pages = list(parse_pages(b'<p:page xmlns:p="x"><p:title>T</p:title><p:redirect title="Z"/></p:page>\n</mediawiki>\n'))
    assert pages[0]["title"] == "T" and pages[0]["redirect"] == {"title": "Z"}


class Answer(io.BytesIO):
    def __init__(self, body=b"", status=200, **headers):
        super().__init__(body)
        self.status, self.headers = status, {k.replace("_", "-"): v for k, v in headers.items()}


class Web:
    def __init__(self, answers):
        self.answers, self.asked = answers, []

    def open(self, request, timeout):
        self.asked.append((request.get_method(), request.full_url, request.get_header("Range")))
        answer = self.answers[request.full_url] if isinstance(self.answers, dict) else self.answers
        return Answer(answer) if isinstance(answer, bytes) else answer


def client(answer):
    return Client("tests/1", opener=Web(answer))


@pytest.mark.parametrize("headers", [{}, {"Content_Length": "x"}, {"Content_Length": "0"}, {"Content_Length": "-3"}])
def test_length_must_be_usable(headers):
    with pytest.raises(SourceError):
        client(Answer(**headers)).length("http://h/x")
    assert client(Answer(Content_Length="12")).length("http://h/x") == 12


def test_get_is_bounded():
    assert client(Answer(b"abc")).get("http://h/x", 3) == b"abc"
    with pytest.raises(SourceError, match="sends more"):
        client(Answer(b"abcd")).get("http://h/x", 3)
    with pytest.raises(SourceError, match="declares more"):
        client(Answer(b"abc", Content_Length="9")).get("http://h/x", 3)


def test_range_must_be_exact():
    good = Answer(b"bcd", 206, Content_Range="bytes 1-3/9")
    assert client(good).get_range("http://h/x", 1, 3) == b"bcd"
    for answer in (Answer(b"bcd", 200), Answer(b"bcd", 206, Content_Range="bytes 0-3/9"), Answer(b"bc", 206, Content_Range="bytes 1-3/9"), Answer(b"bcde", 206, Content_Range="bytes 1-3/9")):
        with pytest.raises(SourceError):
            client(answer).get_range("http://h/x", 1, 3)
    with pytest.raises(SourceError):
        client(good).get_range("http://h/x", 3, 1)


def test_download_leaves_nothing_on_failure(tmp_path):
    target = tmp_path / "f"
    assert client(Answer(b"abc", Content_Length="3")).download("http://h/x", target, 9)[2] == 3
    for answer in (Answer(b"abc", Content_Length="5"), Answer(b"abcdefghijk")):
        with pytest.raises(SourceError):
            client(answer).download("http://h/x", tmp_path / "g", 9)
        assert not (tmp_path / "g").exists()
    with pytest.raises(FileExistsError):
        client(Answer(b"x")).download("http://h/x", target, 9)
    assert target.read_bytes() == b"abc"
    with pytest.raises(SourceError):
        Client(" ")


def published(dump, status="done", sha=None):
    urls = source_urls("simplewiki", "20260801", "http://h")
    names = {n: urls[n].rpartition("/")[2] for n in ("dump", "index")}
    sums = "".join(f"{sha or file_digests(p)[0]}  {names[n]}\n" for n, p in (("dump", dump[0]), ("index", dump[1])))
    return {
        urls["status"]: json.dumps({"jobs": {"articlesmultistreamdump": {"status": status}}}).encode(),
        urls["checksums"]: sums.encode(),
        urls["index"]: dump[1].read_bytes(),
        urls["dump"]: dump[0].read_bytes(),
    }


def settings(tmp_path):
    return BuildConfig(wiki="simplewiki", snapshot="20260801", output=tmp_path / "o", base_url="http://h")


def test_published_source_is_verified_and_reused(dump, tmp_path):
    config = settings(tmp_path)
    first = prepare(config, client(published(dump)))
    web = Web(published(dump))
    again = prepare(config, Client("t", opener=web))
    assert again.identity == first.identity and len(web.asked) == 2


@pytest.mark.parametrize("change, message", [({"status": "waiting"}, "not done"), ({"sha": "0" * 40}, "checksum")])
def test_unfinished_or_changed_source_is_rejected(dump, tmp_path, change, message):
    with pytest.raises(CorpusError, match=message):
        prepare(settings(tmp_path), client(published(dump, **change)))


def test_checksum_list_must_name_a_file_once():
    line = "a" * 40 + "  f.bz2\n"
    assert published_sha1(line, "f.bz2") == "a" * 40
    for text in ("", line * 2, line.replace("f.bz2", "xf.bz2")):
        with pytest.raises(FormatError):
            published_sha1(text, "f.bz2")


def test_status_of_a_job():
    assert not job_done({"jobs": []}) and not job_done({}) and not job_done({"jobs": {"articlesmultistreamdump": "done"}})


def test_files(tmp_path):
    write_json(tmp_path / "a.json", {"b": "ä"})
    assert read_json(tmp_path / "a.json", "x") == {"b": "ä"}
    (tmp_path / "b.json").write_text("[1]")
    with pytest.raises(ValidationError, match="no object|not an object"):
        read_json(tmp_path / "b.json", "x")
    (tmp_path / "c.jsonl").write_text('{"a":1}\n\n{"b":2}\n')
    assert read_lines(tmp_path / "c.jsonl", "x") == [{"a": 1}, {"b": 2}]
    (tmp_path / "d.jsonl").write_text("[]\n")
    with pytest.raises(ValidationError):
        read_lines(tmp_path / "d.jsonl", "x")
    assert artifact(tmp_path, "a.json", 1).sha256 == file_digests(tmp_path / "a.json")[1]
    for name in ("../x", "/x", "", 3):
        with pytest.raises(ValidationError):
            confined(tmp_path, name)


def test_shard_files(tmp_path):
    path = tmp_path / "s.bin"
    path.write_bytes(bytes(range(16)))
    assert len(ShardView(path, "uint16-le", 4)) == 2 and ShardView(path, "uint16-le", 4)[1].tolist() == [0x908, 0xB0A, 0xD0C, 0xF0E]
    for kind, length in (("uint16-le", 3), ("float", 4), ("uint16-le", 0)):
        with pytest.raises(ValueError):
            ShardView(path, kind, length)
    assert token_type(65535) == "uint16-le" and token_type(65536) == "uint32-le"
    with pytest.raises(FormatError):
        token_type(1 << 32)
