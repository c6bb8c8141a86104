from __future__ import annotations

import json
import shutil

import numpy as np
import pytest
from conftest import page, pages_of_two_segments, write_dump

from corpusmill.config import BuildConfig, ProbeConfig, SplitConfig
from corpusmill.errors import CorpusError, FormatError, ValidationError
from corpusmill.plans.build import run_build
from corpusmill.plans.probe import run_probe
from corpusmill.plans.semantic import evaluate_review
from corpusmill.plans.validate import validate
from corpusmill.sources.shards import ShardView, read_shards


def config(tmp_path, dump, name="out", **more):
    return BuildConfig(
        wiki="simplewiki", snapshot="20260801", output=tmp_path / name, dump=dump[0], index=dump[1], split=SplitConfig(10_000, 0, 0),
        context_length=4, sequences_per_shard=2, near_sample=5, **more,
    )


@pytest.fixture(scope="module")
def built(spark, tokenizer, tmp_path_factory):
    folder = tmp_path_factory.mktemp("built")
    dump = write_dump(folder)
    manifest = run_build(spark, config(folder, dump, tokenizer=tokenizer, eos_token_id=1))
    return folder / "out", manifest, dump


def test_build_accounts_for_every_page(spark, built):
    folder, manifest, _ = built
    assert manifest["extraction"] == {
        "pages_seen": 6,
        "documents_emitted": 4,
        "pages_dropped": 2,
        "drop_counts": {"empty_text": 0, "insufficient_text": 1, "invalid_page": 0, "markup_residue": 0, "non_article_namespace": 1, "redirect": 0},
    }
    docs = spark.read.parquet(str(folder / "documents")).orderBy("page_id").collect()
    assert [d["page_id"] for d in docs] == [1, 4, 5, 6]
    assert docs[0]["url"] == "https://simple.wikipedia.org/?curid=1"
    assert {d["split"] for d in docs} == {"train"}
    decisions = spark.read.parquet(str(folder / "page-decisions")).orderBy("page_id").collect()
    assert [(d["page_id"], d["stream_ordinal"], d["reason"]) for d in decisions][:3] == [(1, 0, None), (2, 0, "insufficient_text"), (3, 0, "non_article_namespace")]
    assert (folder / "dropped-pages.jsonl").read_text().splitlines()[0] == '{"page_id":2,"reason":"insufficient_text","title":"Two"}'
    assert validate(spark, folder).ok
    assert not (folder.parent / ".out.work").exists()


def test_shards_hold_the_packed_tokens(spark, built):
    folder, manifest, _ = built
    stated = manifest["tokenization"]
    view = ShardView(folder / stated["shards"][0]["path"], stated["dtype"], 4)
    assert view.rows.shape == (2, 4)
    rows = read_shards(spark, str(folder / "tokens"), stated["dtype"], 4).orderBy("path", "sequence").collect()
    assert sum(s["sequences"] for s in stated["shards"]) == len(rows)
    assert rows[0]["tokens"] == np.asarray(view[0]).tolist()
    total = sum(len(r["tokens"]) for r in rows) + stated["dropped_tail_tokens"]["train"]
    # words and punctuation marks of the four documents, and their end tokens
    assert total == 6 + 200 + 1200 + 7 + 4


def test_interrupted_build_resumes_to_the_same_content(spark, built, tmp_path):
    _, clean, dump = built
    with pytest.raises(ValidationError, match="stopped on request"):
        run_build(spark, config(tmp_path, dump, workers=1, fail_after=1))
    assert not (tmp_path / "out").exists()
    again = run_build(spark, config(tmp_path, dump, workers=1))
    assert again["execution"]["segments_reused"] == 1
    assert again["documents_content_sha256"] == clean["documents_content_sha256"]
    assert again["attribution_content_sha256"] == clean["attribution_content_sha256"]


def test_changed_commit_is_rejected(spark, built, tmp_path):
    _, _, dump = built
    with pytest.raises(ValidationError):
        run_build(spark, config(tmp_path, dump, workers=1, fail_after=1))
    part = next((tmp_path / ".out.work" / "commits" / "000000-000000" / "pages").glob("*.parquet"))
    part.write_bytes(part.read_bytes() + b"x")
    with pytest.raises(ValidationError, match="have changed"):
        run_build(spark, config(tmp_path, dump))


def test_work_folder_of_another_source_is_rejected(spark, built, tmp_path):
    _, _, dump = built
    with pytest.raises(ValidationError):
        run_build(spark, config(tmp_path, dump, workers=1, fail_after=1))
    (tmp_path / "other").mkdir()
    other = write_dump(tmp_path / "other", [[(1, page(1, "Other words stand here."))]])
    with pytest.raises(CorpusError, match="another source"):
        run_build(spark, config(tmp_path, other))


def test_existing_output_is_kept(spark, built):
    folder, _, dump = built
    with pytest.raises(ValidationError, match="exists already"):
        run_build(spark, config(folder.parent, dump))


def test_faulty_segment_fails_or_is_set_aside(spark, tmp_path):
    segments = pages_of_two_segments()
    segments[0][1] = (2, page(9, "text of another page"))
    dump = write_dump(tmp_path, segments)
    with pytest.raises(Exception, match="holds page 9 where 2 is listed"):
        run_build(spark, config(tmp_path, dump))


def edit_manifest(folder, *path, value):
    file = folder / "manifest.json"
    manifest = json.loads(file.read_text())
    place = manifest
    for key in path[:-1]:
        place = place[key]
    place[path[-1]] = value
    file.write_text(json.dumps(manifest))


MUTATIONS = [
    (("schema_version",), 3, "unsupported manifest version"),
    (("project", "scope"), "one", "source scope"),
    (("project", "contract_version"), 1, "contract version"),
    (("source", "snapshot"), "latest", "snapshot is not dated"),
    (("source", "status"), "waiting", "status is not done"),
    (("source", "dump", "published_sha1"), "0" * 40, "dump checksum"),
    (("source", "index", "sha256"), "0" * 64, "bundled index"),
    (("artifacts", "documents", "sha256"), "0" * 64, "artifact documents has another hash"),
    (("artifacts", "documents", "bytes"), 1, "artifact documents has another size"),
    (("artifacts", "documents", "path"), "../x", "leaves the dataset"),
    (("artifacts", "documents", "path"), "/x", "not relative"),
    (("artifacts", "segments.jsonl", "path"), "nothing", "is missing"),
    (("artifacts", "documents", "records"), 9, "document counts differ"),
    (("extraction", "documents_emitted"), 9, "document counts differ"),
    (("extraction", "drop_counts", "redirect"), 9, "segment reasons differ"),
    (("split", "seed"), "other", "text hashes|documents are in another split|^$"),
    (("split", "strategy"), "none", "unknown split strategy"),
    (("documents_content_sha256",), "0" * 64, "document content hash differs"),
    (("attribution_content_sha256",), "0" * 64, "attribution content hash differs"),
    (("source", "dump", "bytes"), 5, "could not complete|range differs|end the dump"),
    (("near_sample",), 2, "audit differs: near_duplicates"),
    (("tokenization", "dtype"), "float", "unknown token type"),
    (("tokenization", "shards"), {}, "shards are no list"),
    (("tokenization", "tokenizer", "sha256"), "0" * 64, "the tokenizer differs"),
    (("training_check", "loss_after"), 0.0, "training check differs"),
]


@pytest.mark.parametrize("path, value, message", [m for m in MUTATIONS if m[0] != ("split", "seed")])
def test_changed_manifest_is_noticed(spark, built, tmp_path, path, value, message):
    import re

    shutil.copytree(built[0], tmp_path / "copy")
    edit_manifest(tmp_path / "copy", *path, value=value)
    report = validate(spark, tmp_path / "copy")
    assert not report.ok and any(re.search(message, e) for e in report.errors), report.errors


def test_changed_shard_is_noticed(spark, built, tmp_path):
    shutil.copytree(built[0], tmp_path / "copy")
    shard = next((tmp_path / "copy" / "tokens").glob("*.bin"))
    shard.write_bytes(shard.read_bytes()[:-2])
    errors = validate(spark, tmp_path / "copy").errors
    assert any("another size" in e for e in errors) and any("another hash" in e for e in errors)


def test_unreadable_dataset_is_reported(spark, tmp_path):
    assert validate(spark, tmp_path).errors[0].startswith("validation could not complete")


def test_probe_builds_one_segment(spark, dump, tmp_path, tokenizer):
    probe = ProbeConfig(wiki="simplewiki", output=tmp_path / "probe", ordinal=1, dump=dump[0], index=dump[1], tokenizer=tokenizer, eos_token_id=1, context_length=4)
    manifest = run_probe(spark, probe)
    assert manifest["schema_version"] == 1 and manifest["extraction"]["documents_emitted"] == 3
    assert validate(spark, tmp_path / "probe").ok
    edit_manifest(tmp_path / "probe", "extraction", "pages_seen", value=7)
    assert "pages are not accounted for" in validate(spark, tmp_path / "probe").errors
    with pytest.raises(CorpusError, match="no segment"):
        run_probe(spark, ProbeConfig(wiki="simplewiki", output=tmp_path / "none", ordinal=5, dump=dump[0], index=dump[1]))


@pytest.mark.parametrize(
    "more",
    [
        {"wiki": "english"}, {"snapshot": "latest"}, {"workers": 0}, {"workers": 65}, {"timeout": 0}, {"context_length": 1}, {"near_sample": 0},
        {"sequences_per_shard": 0}, {"eos_token_id": 1}, {"fail_after": 1, "workers": 2}, {"fail_after": 0, "workers": 1}, {"max_dump_bytes": 0},
    ],
)
def test_settings_out_of_range_are_rejected(tmp_path, more):
    with pytest.raises(CorpusError):
        BuildConfig(**({"wiki": "simplewiki", "snapshot": "20260801", "output": tmp_path / "o"} | more))


@pytest.mark.parametrize("work", ["o", "o/inside", "."])
def test_work_and_output_must_be_apart(tmp_path, work):
    with pytest.raises(CorpusError, match="apart"):
        BuildConfig(wiki="simplewiki", snapshot="20260801", output=tmp_path / "o", work=tmp_path / work)


@pytest.mark.parametrize("shares", [(9900, 100, 100), (-1, 1, 10_000)])
def test_split_shares_must_add_up(shares):
    with pytest.raises(CorpusError):
        SplitConfig(*shares)


@pytest.fixture(scope="module")
def reviewed(spark, tmp_path_factory):
    """A dataset with ten documents of each stratum."""
    folder = tmp_path_factory.mktemp("reviewed")
    sizes = [5] * 10 + [200] * 10 + [1200] * 10
    segment = [(i + 1, page(i + 1, " ".join(f"word{i}" if k % 7 else "another" for k in range(n)).replace(f"word{i}", f"item{chr(97 + i % 26)}"))) for i, n in enumerate(sizes)]
    dump = write_dump(folder, [segment])
    run_build(spark, config(folder, dump))
    packet = [json.loads(x) for x in (folder / "out" / "review-candidates.jsonl").read_text().splitlines()]
    assert len(packet) == 30
    return folder / "out", [
        {"page_id": c["page_id"], "revision_id": c["revision_id"], "reviewer": "A", "reviewed_at": "2026-08-20", "label": "acceptable", "notes": ""} for c in packet
    ]


def gate(spark, reviewed, tmp_path, rows):
    file = tmp_path / "decisions.jsonl"
    file.write_text("\n".join(map(json.dumps, rows)) + "\n\n")
    return evaluate_review(spark, reviewed[0], file)


def test_review_passes_and_blocks(spark, reviewed, tmp_path):
    result = gate(spark, reviewed, tmp_path, reviewed[1])
    assert result["passed"] and result["label_counts"]["acceptable"] == 30
    blocked = [dict(reviewed[1][0], label="major_issue", notes="cut"), *reviewed[1][1:]]
    result = gate(spark, reviewed, tmp_path, blocked)
    assert not result["passed"] and result["blocking_page_ids"] == [blocked[0]["page_id"]]


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda r: r[1:], "missing"),
        (lambda r: [*r, r[0]], "duplicated"),
        (lambda r: [dict(r[0], revision_id=1), *r[1:]], "wrong_revision"),
        (lambda r: [dict(r[0], label="good"), *r[1:]], "invalid_label"),
        (lambda r: [dict(r[0], reviewer=" "), *r[1:]], "no_reviewer"),
        (lambda r: [dict(r[0], reviewed_at="2026-02-30"), *r[1:]], "invalid_date"),
        (lambda r: [dict(r[0], notes=None), *r[1:]], "invalid_notes"),
        (lambda r: [dict(r[0], label="minor_issue"), *r[1:]], "invalid_notes"),
        (lambda r: [dict(r[0], page_id=True), *r[1:]], "no usable page_id"),
        (lambda r: [dict(r[0], page_id=999), *r[1:]], "not_a_candidate"),
    ],
)
def test_review_rejects_invalid_decisions(spark, reviewed, tmp_path, change, message):
    with pytest.raises(ValidationError, match=message):
        gate(spark, reviewed, tmp_path, change(reviewed[1]))


def test_format_errors_are_named():
    assert issubclass(FormatError, CorpusError)
