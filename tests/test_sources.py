import json
import random

import pytest

from siltstone.sources import repositories as R
from siltstone.sources import sinks
from siltstone.sources.jsonl import read_evaluation, read_jsonl

NESTED = "repo_id string, repo_path string, commit_id string, files array<struct<content_id string, content string, language string, file_path string, license_type string, detected_licenses array<string>, is_vendor boolean>>"


def repos(spark, lists):
    rows = [(f"r{i:02}", f"o/r{i}", "c", [(cid, text, lang, f"f{j}", None, None, None) for j, (cid, text, lang) in enumerate(files)] if files is not None else None) for i, files in enumerate(lists)]
    return spark.createDataFrame(rows, NESTED)


def test_jsonl_round_trip_and_guards(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text(json.dumps({"document_id": "a", "content": "x y\x85z"}, ensure_ascii=False) + "\n\n" + json.dumps({"document_id": "b", "content": None}) + "\n", encoding="utf-8")
    df = read_jsonl(spark, str(path))
    assert {r["document_id"]: r["content"] for r in df.collect()} == {"a": "x y\x85z", "b": None}
    assert read_evaluation(spark).count() == 0
    out = str(tmp_path / "out")
    sinks.write_dataset(df, df.limit(0), out)
    assert read_jsonl(spark, f"{out}/train", "document_id string, token_count int").where("document_id = 'a'").first()["token_count"] == 3
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.write_dataset(df, df.limit(0), out)
    (tmp_path / "bad.jsonl").write_text("{broken\n")
    with pytest.raises(Exception):
        read_jsonl(spark, str(tmp_path / "bad.jsonl")).collect()


def test_audit_never_holds_text(spark, tmp_path):
    df = spark.createDataFrame([("a", "secret text", "malformed")], "document_id string, content string, rejection_reason string")
    sinks.write_audit(df, str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).columns == ["document_id", "rejection_reason"]


def test_flatten(spark):
    df = repos(spark, [[("1", "a", "Go"), ("", "b", "Go"), ("2", "", "Go"), (None, "c", "Go"), ("3", "d", "C")], [], None])
    out = R.flatten(df, ["Go"], dataset="d", shard="s").collect()
    assert [(r["document_id"], r["is_vendor"], r["detected_licenses"], r["source_dataset"]) for r in out] == [("r00:f0:1", False, [], "d")]
    assert R.flatten(df).count() == 2 and R.flatten(df.limit(0)).count() == 0


def sequential(order, lists, cap):
    """File after file: accept unless the repository is full or the content was accepted before."""
    seen, out = set(), []
    for i in order:
        taken = 0
        for j, (cid, text, _) in enumerate(lists[i] or []):
            if cap and taken >= cap:
                break
            if text and cid and cid not in seen:
                seen.add(cid)
                taken += 1
                out.append((i, j))
    return sorted(out)


@pytest.mark.parametrize("cap", [0, 1, 2, 3])
def test_cap_against_stepping(spark, cap):
    rng = random.Random(cap)
    lists = [[(str(rng.randrange(9)), "t", "Go") for _ in range(rng.randrange(7))] for _ in range(9)]
    files = R.flatten(repos(spark, lists), shard="s")
    keys = {r["order_repo"]: int(r["repo_id"][1:]) for r in files.select("order_repo", "repo_id").distinct().collect()}
    order = [keys[k] for k in sorted(keys)]
    got = sorted((int(r["repo_id"][1:]), r["order_file"]) for r in R.ingest(files, cap).collect())
    assert got == sequential(order, lists, cap)
    with pytest.raises(ValueError):
        R.ingest(files, -1)


def test_shards_and_manifest(spark, tmp_path):
    assert R.select_shards(["b.parquet", "a.parquet", "x.txt", "c.parquet"], 1, 1) == ["b.parquet"]
    for names, bounds in ((["x.txt"], ()), (["a.parquet"], (-1,)), (["a.parquet"], (0, 0))):
        with pytest.raises(ValueError):
            R.select_shards(names, *bounds)
    assert R.shard_prefix([{"Go": 1}, {"C": 2, "Go": 1}, {"C": 9}], ["Go", "C"], 2) == 2
    df = spark.createDataFrame([("Go",), ("Go",), ("Ada",)], "language string")
    assert [tuple(r) for r in R.sample_manifest(df, ["Go", "C"], 2).orderBy("language").collect()] == [("C", 0, 2), ("Go", 2, 0)]


def test_run_status(spark, tmp_path):
    out = str(tmp_path / "run")
    with sinks.RunStatus(spark, out):
        assert json.loads((tmp_path / "run.status.json").read_text())["state"] == "running"
    assert json.loads((tmp_path / "run.status.json").read_text())["state"] == "finished"
    with pytest.raises(ZeroDivisionError), sinks.RunStatus(spark, out):
        _ = 1 / 0
    assert json.loads((tmp_path / "run.status.json").read_text())["state"] == "failed"
    (tmp_path / "run").mkdir()
    with pytest.raises(FileExistsError):
        sinks.RunStatus(spark, out)
