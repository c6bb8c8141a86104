from __future__ import annotations

import json

import pytest

from corpusmill.cli import main, parser


def test_build_validate_inspect(spark, dump, tmp_path, capsys):
    out = tmp_path / "out"
    args = ["--wiki", "simplewiki", "--output", str(out), "--dump", str(dump[0]), "--index", str(dump[1])]
    assert main(["build", "--snapshot", "20260801", "--near-sample", "5", *args]) == 0
    said = capsys.readouterr()
    assert json.loads(said.out)["extraction"]["documents_emitted"] == 4
    assert '"segments_done": 2' in said.err
    assert main(["validate", str(out)]) == 0
    assert json.loads(capsys.readouterr().out)["ok"]
    assert main(["inspect", str(out)]) == 0
    (out / "dropped-pages.jsonl").write_text("")
    assert main(["validate", str(out)]) == 1
    assert main(["review-semantic", str(out), str(tmp_path / "none")]) == 2
    assert "error:" in capsys.readouterr().err


def test_probe(spark, dump, tmp_path, capsys):
    assert main(["probe", "--wiki", "simplewiki", "--output", str(tmp_path / "p"), "--dump", str(dump[0]), "--index", str(dump[1])]) == 0
    assert json.loads(capsys.readouterr().out)["schema_version"] == 1


@pytest.mark.parametrize("args", [["build", "--wiki", "x", "--output", "o", "--snapshot", "20260801"], ["inspect", "/nowhere"], ["build", "--wiki", "simplewiki", "--output", "o", "--snapshot", "new"]])
def test_errors_have_status_two(args, capsys):
    assert main(args) == 2
    assert capsys.readouterr().err.startswith("error: ")


def test_build_needs_a_snapshot():
    with pytest.raises(SystemExit):
        parser().parse_args(["build", "--wiki", "simplewiki", "--output", "o"])
