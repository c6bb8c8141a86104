"""Operators on small tables: defined results for nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from conftest import DATA

from corpusmill.llm import budget, encode, garbled, mixing, near, overlap, packing, quality, registry, sample
from corpusmill.llm.vocab import TOKENIZER_FOLDER, encoder, vocabulary_file

WIKI = "wiki string, page_id bigint, revision_id bigint, revision_timestamp string, title string, url string, text string, text_sha256 string, split string, license string"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, title string, site_domain string, fetched_at timestamp"
#: Names that operators use inside; the input may have them too.
CLASHING = ("tokens", "text_class", "size", "container", "a", "b", "copies", "draw", "shard", "language", "profile", "ids", "shingles")


def wiki(spark, rows, parts=3):
    """Pages from ``(page_id, text, split, wiki)``, with extra columns of clashing names."""
    full = [(r[3], r[0], (r[0] or 0) + 5, None, None, f"https://{(r[3] or 'x').strip()[:2]}.m.Site.example:80/?curid={r[0]}", r[1], None, r[2], None) for r in rows]
    frame = spark.createDataFrame(full, WIKI).repartition(parts)
    from pyspark.sql import functions as F

    return frame.select("*", *(F.lit(1).alias(c) for c in CLASHING))


def documents(spark, rows, parts=3):
    full = [(r[0], r[1], r[2], r[3], None, None, r[4] if len(r) > 4 else None, None) for r in rows]
    from pyspark.sql import functions as F

    return spark.createDataFrame(full, DOCS).repartition(parts).select("*", *(F.lit(1).alias(c) for c in CLASHING if c != "language"))


def words(r, n):
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


@pytest.fixture(scope="module")
def near_rows():
    """Texts with edited, moved and equal copies, short texts and none."""
    r = random.Random(11)
    rows, number = [], 0
    splits = ["train", "Train ", "validation", "test", None]
    for size in (20, 24, 40, 90, 200, 700):
        for _ in range(6):
            base = words(r, size)
            texts = [" ".join(base)]
            edited = list(base)
            edited[size // 2] = "changed"
            half = size // 2
            texts += [" ".join(edited), " ".join(base[half:] + base[:half]), texts[0].upper(), texts[0], " ".join(words(r, size))]
            for text in texts:
                number += 1
                rows.append((number, text, r.choice(splits), "enwiki"))
    rows += [(number + 1, None, "train", "enwiki"), (number + 2, "", "test", None), (number + 3, " \n", "test", "x"), (None, rows[0][1], "train", "enwiki")]
    rows += [(number + 4, "tiny text", "train", "enwiki"), (number + 5, "tiny text", "test", "enwiki"), (number + 6, "tiny  text", "test", "enwiki")]
    return rows + rows[:15]


def likeness(a, b):
    sets = []
    for text in (a, b):
        ws = re.findall(r"[^\W_]+", text.lower())
        if len(ws) < 20:
            return 0
        sets.append({tuple(ws[i : i + 3]) for i in range(len(ws) - 2)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def near_pairs_by_hand(rows):
    texts = {(i, t) for i, t, *_ in rows if i is not None and t and t.strip()}
    return {(min(i, j), max(i, j)) for (i, s), (j, t) in itertools.combinations(sorted(texts), 2) if i != j and s != t and likeness(s, t) >= 0.6}


@pytest.mark.parametrize("parts", [1, 7])
def test_near_pages_of_brute_force(spark, near_rows, parts):
    found = [tuple(r) for r in near.near_pages(wiki(spark, near_rows, parts)).collect()]
    assert len(found) == len(set(found)) and set(found) == near_pairs_by_hand(near_rows)


def test_groups_of_brute_force(spark, near_rows):
    rows = near.duplicate_groups(wiki(spark, near_rows)).collect()
    pages = {i for i, t, *_ in near_rows if i is not None and t and t.strip()}
    assert {r["page_id"] for r in rows} == pages and len(rows) == len(pages)
    group = {p: p for p in pages}

    def top(p):
        while group[p] != p:
            p = group[p]
        return p

    text = {i: t for i, t, *_ in near_rows if i is not None}
    equal = {(i, j) for i, j in itertools.combinations(sorted(pages), 2) if text[i] == text[j]}
    for i, j in near_pairs_by_hand(near_rows) | equal:
        group[top(i)] = top(j)
    for a, b in itertools.combinations(rows, 2):
        assert (a["group_id"] == b["group_id"]) == (top(a["page_id"]) == top(b["page_id"]))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    rows = {r["text_class"]: r["group_id"] for r in near.components(links).collect()}
    assert all(rows[i] == 0 for i in range(41)) and rows[100] == rows[101] == 100


def test_overlaps_of_brute_force(spark, near_rows):
    split = {}
    for i, t, s, _ in near_rows:
        if i is not None and t and t.strip() and s:
            split.setdefault(i, (t, s.strip().lower()))
    wanted = set()
    for (i, (s, x)), (j, (t, y)) in itertools.combinations(sorted(split.items()), 2):
        if (x == "train") != (y == "train") and (s == t or likeness(s, t) >= 0.6):
            wanted.add((i, j))
    found = [tuple(r) for r in overlap.overlapping_pages(wiki(spark, near_rows)).collect()]
    assert len(found) == len(set(found)) and set(found) == wanted
    report = overlap.overlap_report(wiki(spark, near_rows)).collect()
    asked = {p for pair in wanted for p in pair if split[p][1] != "train"}
    assert sum(r["overlapping_pages"] for r in report) == len(asked)
    kinds = {r["kind"] for r in overlap.class_overlaps(overlap.split_texts(wiki(spark, near_rows))).collect()}
    assert kinds == {"same", "edited", "moved"}


def test_hot_keys_are_joined_with_salts(spark, near_rows):
    pages = wiki(spark, near_rows)
    found = {tuple(r) for r in near.near_pages(pages, hot_classes=2).collect()}
    assert found == near_pairs_by_hand(near_rows)
    texts = overlap.split_texts(pages)
    plain, salted = ({(r["a"], r["b"]) for r in overlap.overlap_classes(texts, hot_members=n).collect()} for n in (10_000, 1))
    assert plain and plain == salted


def test_pair_operators_take_empty_tables(spark, near_rows):
    none = wiki(spark, near_rows).limit(0)
    assert near.near_pages(none).count() == overlap.overlapping_pages(none).count() == near.duplicate_groups(none).count() == overlap.overlap_report(none).count() == 0


def test_hot_copies_are_one_class(spark):
    # later batches of a task hold nothing but texts seen before
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        _hot_copies(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _hot_copies(spark):
    r = random.Random(1)
    base = words(r, 60)
    rows = [(i, " ".join(base), "train", "enwiki") for i in range(300)] + [(1000, " ".join([*base[:-1], "end"]), "test", "enwiki")]
    assert near.near_pages(wiki(spark, rows)).count() == 300
    assert overlap.overlapping_pages(wiki(spark, rows)).count() == 300


def test_sample_is_stable_under_growth(spark):
    pages = wiki(spark, [(i, "x", "train", "enwiki") for i in [*range(3000), None, 5, 5]])
    kind = "page_id bigint, revision_id bigint, revision_timestamp string, stream_ordinal int, snapshot_id string, arrived_at timestamp"
    arrivals = spark.createDataFrame([(i, 1, None, 0, f"2026010{1 + i % 3}", None) for i in range(0, 3000, 2)] + [(7, 1, None, 0, None, None)] * 3, kind)
    rows = {r["page_id"]: r for r in sample.sample_pages(pages, arrivals, 0.2).collect()}
    assert all((sample.permute(i) < sample.threshold(0.2)) == (i in rows) for i in range(3000))
    fewer = {r["page_id"] for r in sample.sample_pages(pages.where("page_id < 1500").repartition(9), arrivals, 0.2).collect()}
    assert fewer == {i for i in rows if i < 1500}
    assert {r["page_id"] for r in sample.sample_pages(pages, arrivals, 0.1).collect()} < set(rows)
    growth = sample.growth_by_snapshot(pages, arrivals, 0.2).orderBy("snapshot_id").collect()
    assert [g["known"] for g in growth] == [500, 1000, 1500] and growth[-1]["sampled"] == sum(i in rows for i in range(0, 3000, 2))
    assert sample.sample_pages(pages, arrivals, 0.0).count() == 0 and sample.sample_pages(pages.limit(0), arrivals.limit(0), 1.0).count() == 0


TEXTS = ["", None, " ", "Hello world", "Straße  été\r\n\r\n\tx", "日本語のテキスト。", "<|endoftext|> [END]", "a" * 5000, "x   y　z \x1c q\x85", "don't 12ab ½", "🙂👩‍🔬‍", " lead", "trail \n\n ", "Hello world"]


@pytest.mark.parametrize("name", ["byte_bpe_50k", "byte_bpe_multi_50k"])
def test_ids_equal_plain_encoding(spark, name):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(99, " ".join(words(random.Random(2), 30_000)), None, None)]
    got = {r["doc_id"]: r["ids"] for r in encode.encode_texts(documents(spark, rows), "doc_id", "text", name).collect()}
    plain = encoder(vocabulary_file(name)).encoding
    assert got == {i: plain.encode_ordinary(t or "") for i, t, *_ in rows}
    counts = encode.count_tokens(documents(spark, rows).select("doc_id", "text"), "text", name).collect()
    assert {r["doc_id"]: r["tokens"] for r in counts} == {i: len(v) for i, v in got.items()}


def test_ids_equal_the_other_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(f"{TOKENIZER_FOLDER}/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    texts = [t or "" for t in TEXTS]
    wanted = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    rows = encode.encode_texts(documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]), "doc_id", "text").collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == dict(enumerate(wanted))
    assert encode.encode_texts(documents(spark, [(1, "a", None, None)]).limit(0), "doc_id", "text").count() == 0


def test_token_budget(spark):
    pages = wiki(spark, [(1, "one two", "Train ", "SIMPLEwiki"), (1, "one two", "Train ", "SIMPLEwiki"), (2, "one two", None, None), (3, None, "train", "dewiki"), (4, "", "test", "dewiki")])
    docs = documents(spark, [(7, "one two", "PT-br", " Atlas", "www.A.example"), (8, None, None, None), (9, "one two three", "12", "atlas", "a.example")])
    records = budget.corpus_records(pages, docs)
    rows = budget.token_counts(records).collect()
    assert len(rows) == 8 and {(r["record_id"], r["tokens"]) for r in rows} == {(1, 2), (2, 2), (3, 0), (4, 0), (7, 2), (8, 0), (9, 3)}
    one = next(r for r in rows if r["record_id"] == 1)
    assert (one["source"], one["language"], one["domain"], one["split"]) == ("simplewiki", "en", "si.site.example", "train")
    assert {r["record_id"]: r["language"] for r in rows if r["corpus"] == "documents"} == {7: "pt", 8: "und", 9: "und"}
    totals = budget.token_totals(records).collect()
    first = next(r for r in totals if r["source"] == "simplewiki")
    assert (first["records"], first["tokens"], first["distinct_tokens"]) == (2, 4, 2)
    assert sum(r["tokens"] for r in totals) == sum(r["tokens"] for r in rows)
    by = {(r["corpus"], r["source"]): r["tokens"] for r in budget.totals_by(budget.token_totals(records), "source").collect()}
    assert by[("documents", "atlas")] == 5
    assert budget.token_totals(budget.corpus_records(pages.limit(0), docs.limit(0))).count() == 0


def test_containers(spark):
    r = random.Random(3)
    rows = [(i, "é" * r.choice([1, 20, 333, 999, 1000, 1001, 2500]), r.choice(["train", "TEST "]), "enwiki") for i in range(400)]
    rows += rows[:20] + [(1000, None, "train", "enwiki"), (1001, "", "train", "enwiki"), (1002, "x", None, "enwiki"), (1003, "x", "other", "enwiki")]
    sizes = spark.createDataFrame([("train", 1000), ("Test", 700), ("test", 900), (None, 5)], "split string, capacity_chars bigint")
    found = packing.pack_texts(wiki(spark, rows), sizes, shard_containers=20).collect()
    caps, filled, held = {"train": 1000, "test": 700}, {}, {}
    for f in found:
        filled[f["split"], f["container"]] = filled.get((f["split"], f["container"]), 0) + f["n_chars"]
        held.setdefault(f["page_id"], []).append(f)
    assert all(n <= caps[s] for (s, _), n in filled.items())
    wanted = {i: (len(t), caps[s.strip().lower()]) for i, t, s, _ in rows if t and s and s.strip().lower() in caps}
    assert set(held) == set(wanted)
    for i, (size, cap) in wanted.items():
        parts = sorted(held[i], key=lambda f: f["piece"])
        assert sum(p["n_chars"] for p in parts) == size and len(parts) == -(-size // cap)
        assert [p["piece_start"] for p in parts] == [k * cap for k in range(len(parts))]
    again = packing.pack_texts(wiki(spark, rows, 11), sizes, shard_containers=20).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    fill = {x["split"]: x["fill"] for x in packing.container_fill(packing.pack_texts(wiki(spark, rows), sizes), sizes).collect()}
    assert min(fill.values()) > 0.9
    assert packing.pack_texts(wiki(spark, rows).limit(0), sizes).count() == 0


def test_each_constraint_of_containers_binds(spark):
    r = random.Random(4)
    rows = [(i, "x" * r.choice([3, 5, 8, 400, 700, 930, 960]), "train", "enwiki") for i in range(600)]
    sizes = spark.createDataFrame([("train", 1000)], "split string, capacity_chars bigint")

    def packed(**settings):
        held = {}
        for f in packing.pack_texts(wiki(spark, rows), sizes, **settings).collect():
            held.setdefault(f["container"], []).append(f["n_chars"])
        return held

    both, no_items, no_attention = packed(), packed(max_items=10_000), packed(attention_share=1.0)
    assert max(map(len, both.values())) <= packing.MAX_ITEMS < max(map(len, no_items.values()))
    cost = lambda sizes: sum(s * s for s in sizes) / 1000**2
    assert all(cost(s) <= packing.ATTENTION_SHARE + 1e-9 or len(s) == 1 for s in both.values())
    assert any(cost(s) > packing.ATTENTION_SHARE and len(s) > 1 for s in no_attention.values())
    assert len({tuple(sorted(map(tuple, map(sorted, h.values())))) for h in (both, no_items, no_attention)}) == 3
    # the number of shards follows the number of items, too
    tiny = [(i, "x", "train", "enwiki") for i in range(500)]
    shards = {f["container"].split("-")[1] for f in packing.pack_texts(wiki(spark, tiny), sizes, shard_containers=2).collect()}
    assert len(shards) == 8


def test_mix_reaches_its_shares(spark):
    r = random.Random(5)
    sources = ["big"] * 60 + ["mid"] * 25 + ["small"] * 10 + ["stray"] * 5
    rows = [(i, " ".join(words(r, r.randrange(5, 60))), r.choice(["en", "de-DE", None]), r.choice([s, s.upper() + " "])) for i, s in enumerate(r.choice(sources) for _ in range(1500))]
    rows += [(9000, None, "en", "big"), (9001, "", "en", "big"), (9002, "x", "en", None)]
    targets = spark.createDataFrame([("big", 0.5, 1), ("Mid", 0.3, 2), ("small", 0.15, 3), ("none", 0.05, 2)], "source string, target_share double, max_repeats int")
    mix = mixing.mix_sources(documents(spark, rows), targets)
    used = mix.collect()
    assert len({u["doc_id"] for u in used}) == len(used)
    assert all(1 <= u["copies"] <= {"big": 1, "mid": 2, "small": 3}[u["source"]] for u in used)
    shares = {s["source"]: s["reached_share"] for s in mixing.mix_shares(mix, targets).collect()}
    for name, share in (("big", 0.5), ("mid", 0.3), ("small", 0.15)):
        assert shares[name] == pytest.approx(share / 0.95, abs=0.01)
    assert shares["none"] == 0
    assert sorted(map(tuple, mixing.mix_sources(documents(spark, rows, 9), targets).collect())) == sorted(map(tuple, used))
    assert mixing.mix_sources(documents(spark, rows).limit(0), targets).count() == 0
    assert mixing.mix_shares(mixing.mix_sources(documents(spark, rows).limit(0), targets), targets).count() == 4
    twice = targets.union(targets.limit(1))
    with pytest.raises(ValueError):
        mixing.mix_sources(documents(spark, rows), twice)


def test_margins_of_languages_and_topics_are_met(spark):
    r = random.Random(6)
    rows = [
        (i, " ".join(words(r, r.choice([12, 60, 220]))), r.choices(["en", "de", "fr"], [6, 3, 1])[0], r.choices(["big", "mid", "small"], [6, 3, 1])[0]) for i in range(9000)
    ]
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4)], "source string, target_share double, max_repeats int")
    docs = documents(spark, rows)

    def shares(languages=None, topics=None):
        tables = [spark.createDataFrame(list(t.items()), f"{n} string, target_share double") if t else None for n, t in (("language", languages), ("topic", topics))]
        mix = mixing.mix_sources(docs, targets, languages=tables[0], topics=tables[1])
        assert all(x["copies"] <= {"big": 1, "mid": 2, "small": 4}[x["source"]] for x in mix.collect())
        return {(x["margin"], x["label"]): x["share"] for x in mixing.mix_margins(mix).collect()}

    wanted = {"en": 0.4, "de": 0.35, "fr": 0.25}
    topics = {"short": 0.25, "medium": 0.6, "long": 0.15}
    held = shares(wanted, topics)
    for name, share in [(("source", "big"), 0.5), (("source", "mid"), 0.3), (("source", "small"), 0.2)] + [(("language", k), v) for k, v in wanted.items()] + [(("topic", k), v) for k, v in topics.items()]:
        assert held[name] == pytest.approx(share, rel=0.01), name
    other = shares({"en": 0.7, "de": 0.2, "fr": 0.1}, topics)
    assert other["language", "en"] == pytest.approx(0.7, rel=0.01) and other["topic", "long"] == pytest.approx(0.15, rel=0.01)
    plain = shares()
    assert plain["source", "big"] == pytest.approx(0.5, rel=0.01) and plain["language", "fr"] > 0.11
    only = shares({"de": 1.0})
    assert only["language", "de"] == 1 and ("language", "en") not in only


def test_quality(spark):
    english = "The river was moved to the north because the old mill had failed, and about forty people visit it each year."
    table = "\n".join(f"Name{i} | place | {i} | {i * 7}" for i in range(9))
    rows = [(1, english, None, "enwiki"), (2, table, None, "ENWIKI "), (2, table, None, "ENWIKI "), (3, None, None, None), (4, "", None, None), (5, f"{english}\n{table}", None, None), (6, english * 3000, None, "simplewiki")]
    got = {r["page_id"]: r for r in quality.text_statistics(wiki(spark, rows)).collect()}
    assert got[1]["profile"] == got[6]["profile"] == "prose" and got[3]["profile"] is None and got[3]["words"] == 0
    assert [r["page_id"] for r in quality.not_prose(wiki(spark, rows)).orderBy("page_id").collect()] in ([2], [2, 5])
    assert quality.not_prose(wiki(spark, rows).limit(0)).count() == 0


def test_garbled_documents(spark):
    r = random.Random(2)
    sound = ["Le café situé près de la forêt protège une dorée bibliothèque", "La célèbre école élevée où naît l’été déjà"]
    rows = [(i, " ".join(r.sample(r.choice(sound).split(), 6)), "fr", "s") for i in range(200)]
    broken = sound[0].encode().decode("cp1252")
    rows += [(500, f"{sound[1]} {broken}", "fr", "s"), (501, None, None, None), (502, "", None, None), (503, "Elle est situ� ici", "fr", "s"), (504, "Le signe “Ã©” est cité", "fr", "s")]
    found = {x["doc_id"]: x["restored"] for x in garbled.mend_texts(documents(spark, rows)).collect()}
    assert found == {500: f"{sound[1]} {sound[0]}", 503: "Elle est situ� ici"}
    assert {x["doc_id"] for x in garbled.garbled_documents(documents(spark, rows)).collect()} == {500, 503}
    assert garbled.garbled_documents(documents(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_runs_and_agrees_with_sql(spark, name):
    if not DATA.exists():
        pytest.skip("no test data")
    frame = registry.queries()[name](spark, str(DATA))
    rows = frame.collect()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows or name == "p9_found"
        return
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    wanted = sorted(repr([r[names.index(c)] for c in frame.columns]) for r in answer.fetchall())
    assert sorted(repr(list(r)) for r in rows) == wanted
