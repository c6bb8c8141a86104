"""Every registered core query against its SQL in DuckDB, and operators on small fixtures."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import DATA

from corpusmill.config import SplitConfig
from corpusmill.functions import columns as C
from corpusmill.operators import cascade, catalog, digests, documents, duplicates, ledger, packing, review
from corpusmill.plans import registry
from corpusmill.plans.tokens import bigram_step
from corpusmill.schemas import DOCUMENTS
from corpusmill.streaming import arrivals


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not DATA.exists():
        pytest.skip("no test data")
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    frame = registry.queries()[name](spark, str(DATA))
    rows = frame.collect()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    answer = duck.execute(sql)
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(frame.columns)
    wanted = sorted(repr([plain(r[names.index(c)]) for c in frame.columns]) for r in answer.fetchall())
    assert sorted(repr([plain(v) for v in r]) for r in rows) == wanted


def docs(spark, rows):
    """Documents from partial rows ``(page_id, split, text, ...)``."""
    full = [("simplewiki", r[0], (r[0] or 0) + 100, "t", f"T{r[0]}", f"u{r[0]}", r[2], None, r[1], "L") for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def test_split_follows_identifier_alone(spark):
    config = SplitConfig(6000, 2000, 2000, "test")
    rows = documents.split_assignment(docs(spark, [(9, None, "a"), (1, None, "a"), (5, None, "a"), (5, None, "b"), (None, None, "c")]), config).collect()
    assert sorted(r["page_id"] for r in rows) == [1, 5, 9]
    reached = documents.split_summary(spark.range(50_000).withColumnRenamed("id", "page_id"), SplitConfig(1, 1, 9998)).collect()
    assert {r["split"] for r in reached} == {"train", "validation", "test"}


def test_exact_groups_count_pages_not_deliveries(spark):
    frame = docs(spark, [(1, "train", "x"), (1, "train", "x"), (2, "Test ", "x"), (3, "train", "y"), (3, "train", "y"), (4, None, None), (5, None, "")])
    groups = duplicates.exact_duplicate_groups(frame).collect()
    assert [(g["first_page_id"], g["documents"], g["splits"]) for g in groups] == [(1, 2, ["test", "train"])]
    assert duplicates.exact_audit(frame.limit(0)).first().asDict() == {"duplicate_groups": 0, "cross_split_groups": 0, "documents_in_groups": 0}


def test_simhash_of_brute_force(spark):
    import hashlib
    import re

    text = " ".join(random.Random(3).choices(["Alpha", "beta", "Straße", "σας"], k=60))
    words = re.findall(r"\w+", text.casefold())
    votes = [0] * 64
    for i in range(len(words) - 2):
        value = int.from_bytes(hashlib.sha256("\x1f".join(words[i : i + 3]).encode()).digest()[:8], "big")
        for bit in range(64):
            votes[bit] += 1 if value >> bit & 1 else -1
    assert duplicates.simhash(text) == sum(1 << b for b, v in enumerate(votes) if v >= 0)
    assert duplicates.simhash("too few words") is None


def test_near_probe_finds_small_changes(spark):
    base = [f"word{i % 37} item{i % 11} thing{i}" for i in range(300)]
    other = [*base[:-1], "another ending"]
    frame = docs(spark, [(1, "train", " ".join(base)), (2, "test", " ".join(other)), (3, "train", " ".join(base)), (4, None, None), (5, "train", "short")])
    row = duplicates.near_audit(frame, 10).first()
    assert row["observed_sample_size"] == 4 and row["eligible_documents"] == 3
    assert row["candidate_pairs_examined"] == 3 and row["near_duplicate_pairs_observed"] == 2 and row["cross_split_pairs_observed"] == 2


def test_review_draws_ten_a_stratum_in_any_layout(spark):
    frame = docs(spark, [(i, "train", "x" * n) for i in range(1, 61) for n in ([10, 600, 6000][i % 3],)] + [(None, "train", "x"), (99, "train", None)])
    first = review.review_candidates(frame.repartition(1)).collect()
    assert len(first) == 30
    assert [tuple(r) for r in review.review_candidates(frame.union(frame).repartition(7)).collect()] == [tuple(r) for r in first]


def test_attribution_compares_nulls_as_equal(spark):
    frame = docs(spark, [(1, None, "a"), (2, None, "b"), (None, None, "c")])
    assert documents.attribution_mismatches(frame, documents.attribution(frame)).count() == 0
    changed = documents.attribution(frame).where("page_id = 1")
    assert documents.attribution_mismatches(frame, changed).count() == 2


def pack_by_hand(rows, length):
    out, tails = {}, {}
    for split in {r[0] for r in rows}:
        stream = [t for _, _, tokens in sorted((r for r in rows if r[0] == split), key=lambda r: r[1]) for t in tokens]
        out.update({(split, i // length): stream[i : i + length] for i in range(0, len(stream) - length + 1, length)})
        tails[split] = len(stream) % length
    return out, tails


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_packing_of_brute_force(spark, parts):
    r = random.Random(5)
    rows = [(r.choice(["train", "test"]), i, [r.randrange(99) for _ in range(r.choice([0, 1, 3, 40]))]) for i in range(120)]
    frame = spark.createDataFrame(rows, "split string, page_id bigint, tokens array<bigint>").repartition(parts)
    wanted, tails = pack_by_hand(rows, 16)
    got = {(x["split"], x["sequence"]): x["tokens"] for x in packing.packed_sequences(frame, 16, 3).collect()}
    assert got == wanted
    assert {x["split"]: x["dropped_tail_tokens"] for x in packing.dropped_tails(frame, 16).collect()} == tails
    sizes = {(x["split"], x["shard"]): x["sequences"] for x in packing.shard_sizes(frame, 16, 3).collect()}
    assert sum(sizes.values()) == len(wanted) and max(sizes.values()) == 3
    assert packing.packed_sequences(frame.limit(0), 16, 3).count() == 0


def test_bigram_step_equals_gradient_descent(spark):
    tokens = np.array([1, 2, 1, 2, 3, 1, 1, 2, 4])
    ids = np.searchsorted(np.unique(tokens), tokens)
    weights = np.zeros((4, 4))

    def loss():
        shifted = np.exp(weights[ids[:-1]])
        p = shifted / shifted.sum(1, keepdims=True)
        return p, -np.log(p[np.arange(8), ids[1:]]).mean()

    p, before = loss()
    p[np.arange(8), ids[1:]] -= 1
    np.add.at(weights, ids[:-1], -p / 8)
    after = loss()[1]
    assert bigram_step(tokens) == pytest.approx((before, after))
    frame = spark.createDataFrame(list(enumerate(tokens.tolist())), "position int, token bigint")
    row = packing.bigram_loss(frame).first()
    assert (row["loss_before"], row["loss_after"]) == pytest.approx((before, after), abs=1e-8)


def test_ledgers(spark):
    rows = [(1, 0, "emitted", None), (1, 0, "emitted", None), (2, 0, "dropped", "redirect"), (3, 1, "dropped", None), (4, 1, "emitted", "x"), (None, 1, "gone", None)]
    frame = spark.createDataFrame(rows, "page_id bigint, stream_ordinal int, decision string, reason string")
    problems = {(r["page_id"], r["problem"]) for r in ledger.decision_problems(frame).collect()}
    assert problems == {(1, "repeated"), (3, "dropped_without_reason"), (4, "emitted_with_reason"), (4, "unknown_reason"), (None, "unknown_decision"), (None, "no_page")}
    counts = {r["reason"]: r["pages"] for r in ledger.drop_counts(frame).collect()}
    assert counts == {"empty_text": 0, "insufficient_text": 0, "invalid_page": 0, "markup_residue": 0, "non_article_namespace": 0, "redirect": 1}
    index = spark.createDataFrame([(1,), (2,), (9,), (None,)], "page_id bigint")
    sides = {(r["page_id"], r["only_in"]) for r in ledger.decisions_against_index(frame, index).collect()}
    assert sides == {(3, "decisions"), (4, "decisions"), (9, "index")}
    assert ledger.accounting(frame.limit(0)).count() == 0


def test_positions_against_index(spark):
    pages = spark.createDataFrame([(0, 0, 1), (0, 1, None), (0, 2, 5), (1, 0, 7)], "ordinal int, position int, page_id bigint")
    index = spark.createDataFrame([(0, 0, 1), (0, 1, 2), (0, 2, 3), (2, 0, 9)], "ordinal int, position int, page_id bigint")
    rows = {(r["ordinal"], r["position"]) for r in ledger.positions_against_index(pages, index).collect()}
    assert rows == {(0, 2), (1, 0), (2, 0)}


def test_index_order_is_checked_over_ranges(spark):
    rows = [(p * 10, p, "t") for p in range(0, 200_000, 1000)]
    rows[100] = (5, rows[100][1], "t")
    frame = spark.createDataFrame(rows, "byte_offset bigint, page_id bigint, title string")
    found = catalog.index_problems(frame).collect()
    assert [(r["problem"], r["page_id"]) for r in found] == [("backwards", 100_000)]


def test_range_faults(spark):
    ranges = spark.createDataFrame([(0, 10, 19), (1, 20, 15), (3, 30, 40)], "ordinal int, start bigint, end bigint")
    assert {(r["ordinal"], r["problem"]) for r in catalog.range_problems(ranges, 50).collect()} == {(1, "empty"), (3, "gap"), (3, "not_dense"), (3, "wrong_end")}


def test_parsed_integers(spark):
    texts = ["5", " 5 ", "+5", "-5", "1_0", "", None, "x", "5.0", "__", "1__0", "99999999999999999999"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(C.parsed_integer(frame["t"])).collect()] == [5, 5, 5, -5, 10, None, None, None, None, None, None, None]


def raw_pages(spark, rows):
    kind = "title string, ns string, id string, redirect struct<title string>, revision struct<id string, rev_timestamp string, text string>, extra int"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], kind)


def test_cascade_gives_each_page_one_reason(spark):
    words = "Three useful words"
    cases = [
        (("T", "0", "1", None, ("1", None, words)), None),
        (("T", "0", None, None, ("1", None, words)), "invalid_page"),
        (("T", "x", "1", None, ("1", None, words)), "invalid_page"),
        (("", "0", "1", None, ("1", None, words)), "invalid_page"),
        ((None, "0", "1", None, ("1", None, words)), "invalid_page"),
        (("T", "1", "1", ("Z",), None), "non_article_namespace"),
        (("T", "0", "1", ("Z",), None), "redirect"),
        (("T", "0", "1", None, None), "invalid_page"),
        (("T", "0", "1", None, ("x", None, "#REDIRECT [[Z]]")), "invalid_page"),
        (("T", "0", "1", None, ("1", None, " \n#Redirect [[Z]]")), "redirect"),
        (("T", "0", "1", None, ("1", None, None)), "empty_text"),
        (("T", "0", "1", None, ("1", None, "{{only}}")), "empty_text"),
        (("T", "0", "1", None, ("1", None, "{{open words stay here")), "markup_residue"),
        (("T", "0", "1", None, ("1", None, "two words")), "insufficient_text"),
    ]
    rows = sorted(cascade.extracted(raw_pages(spark, [c[0] for c in cases])).collect(), key=lambda r: r["extra"])
    assert [r["reason"] for r in rows] == [c[1] for c in cases]
    assert rows[0]["text"] == words
    assert cascade.extracted(raw_pages(spark, [])).count() == 0


def test_digests_do_not_depend_on_layout(spark):
    frame = docs(spark, [(i, "train", f"text {i}\x0b\x1f\"\\ä") for i in range(1, 60)])
    values = {digests.corpus_digest(frame.repartition(n)).first()["corpus_sha256"] for n in (1, 4, 17)}
    assert len(values) == 1
    assert digests.corpus_digest(frame.union(frame)).first()["rows"] == 59
    assert len({digests.sequential_digest(frame.repartition(n)) for n in (1, 4)}) == 1
    import hashlib

    row = frame.where("page_id = 1").first().asDict()
    data = digests.canonical_row(row)
    assert digests.sequential_digest(frame.where("page_id = 1")) == hashlib.sha256(len(data).to_bytes(8, "big") + data).hexdigest()
    assert digests.corpus_digest(frame.limit(0)).first()["rows"] == 0
    with pytest.raises(ValueError):
        digests.id_digest([-1])
    frame = spark.createDataFrame([([3, 1, 2],)], "ids array<bigint>")
    assert frame.select(C.id_list_hash(frame["ids"])).first()[0] == digests.id_digest([1, 2, 3])


def test_arrivals_stream_once(spark, tmp_path):
    kind = "page_id bigint, revision_id bigint, revision_timestamp string, stream_ordinal int, snapshot_id string, arrived_at timestamp"
    day = dt.datetime(2026, 8, 1, 12)
    rows = [(1, 10, "t", 0, "20260801", day), (1, 10, "t", 0, "20260801", day), (2, 11, "t", 0, "20260801", None), (1, 9, "t", 0, "20260701", day)]
    frame = spark.createDataFrame(rows, kind)
    assert {tuple(r) for r in arrivals.latest_revisions(frame).collect()} == {(1, 10, "20260801", 2), (2, 11, "20260801", 1)}
    frame.write.parquet(str(tmp_path / "in"))
    seen = []

    def handle(batch, number):
        seen.extend((r["page_id"], r["revision_id"]) for r in batch.collect())

    for _ in range(2):
        stream = arrivals.first_deliveries(arrivals.arrival_stream(spark, str(tmp_path / "in"), frame.schema))
        arrivals.take_in(stream, str(tmp_path / "state"), handle)
    assert sorted(seen) == [(1, 9), (1, 10)]
    windows = arrivals.windowed_arrivals(arrivals.arrival_stream(spark, str(tmp_path / "in"), frame.schema))
    query = windows.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r["snapshot_id"], r["deliveries"]) for r in spark.table("windows").collect()} == {("20260801", 2), ("20260701", 1)}
