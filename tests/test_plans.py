import argparse
import json

import pytest

from siltstone.plans import experiment, pipeline, sample
from siltstone.plans.pipeline import Options
from siltstone.sources.jsonl import read_jsonl
from tests.test_pipeline import source
from tests.test_sources import NESTED


def test_paired_experiment(spark, tmp_path):
    documents = read_jsonl(spark, str(source(spark, tmp_path)))
    out = tmp_path / "out"
    summary = experiment.run(documents, ["document_id"], str(out), limit=6)
    assert summary["attempted_shared_parents"] == 6 and summary["paired_outcomes"]["both_succeeded"] == 6 and summary["mode"] == "mock"
    assert summary["quality_rejected_before_sampling"] == 1 and not summary["sampling_requirement_met"] and summary["paired_outcomes"]["mcnemar_exact_p_value"] == 1.0

    def client(row, model, method):
        if model == "codegemma" and row["parent_document_id"] in ("d01", "d03"):
            raise RuntimeError("no answer")
        text = f"User:\nx\n\nAssistant:\nTRACE:IN:a\nTRACE:OUT:{row['parent_document_id']}"
        return {"content": text, "execution_checked": True, "trace_deterministic": True}

    summary = experiment.run(documents, ["document_id"], str(out), limit=6, options=Options(mode="real", client=client, retries=1))
    assert summary["models"]["qwen_coder"]["median_trace_events"] == 2 and summary["models"]["codegemma"]["accepted"] == 4
    assert summary["paired_outcomes"]["qwen_coder_only"] == 2 and json.loads((out / "summary.json").read_text()) == summary
    assert spark.read.json(str(out / "failures")).count() == 2 and spark.read.json(str(out / "codegemma")).count() == 4


def test_sample_from_shards(spark, tmp_path):
    folder = tmp_path / "shards"
    folder.mkdir()
    for k, lists in enumerate(([("1", "a", "Go"), ("2", "b", "C")], [("1", "a", "Go"), ("3", "c", "Go")], [("4", "d", "C")])):
        rows = [(f"r{k}", "p", "c", [(cid, text, lang, f"f{cid}", None, None, None) for cid, text, lang in lists])]
        path = str(tmp_path / f"w{k}")
        spark.createDataFrame(rows, NESTED).coalesce(1).write.parquet(path)
        next((tmp_path / f"w{k}").glob("*.parquet")).rename(folder / f"s{k}.parquet")
    arguments = ["--shard-dir", str(folder), "--output", str(tmp_path / "out"), "--manifest", str(tmp_path / "m.json"), "--languages", "Go", "C", "Ada"]
    assert sample.main([*arguments, "--min-per-language", "1"], spark) == 0
    manifest = json.loads((tmp_path / "m.json").read_text())
    assert manifest["n_documents"] == 4 and manifest["documents_by_language"] == {"Ada": 0, "C": 2, "Go": 2} and manifest["shortfalls"] == {"Ada": 1} and len(manifest["shards"]) == 3
    assert manifest["repositories_scanned"] == 3 and manifest["unique_content_ids"] == 4 and manifest["requested_languages"] == ["Go", "C", "Ada"]
    documents, used = sample.draw(spark, [str(folder / f"s{k}.parquet") for k in range(3)], ["Go", "C"], 1)
    assert len(used) == 1 and documents.count() == 2


def test_experiment_command(spark, tmp_path):
    path = str(source(spark, tmp_path))
    assert experiment.main(["--input", path, "--output", str(tmp_path / "out"), "--documents", "4"], spark) == 0
    assert json.loads((tmp_path / "out" / "summary.json").read_text())["attempted_shared_parents"] == 4


SPEC = {"model_id": "id/7b", "source": "s", "access": "a", "server_path": "p", "local_path_env": "ONE_PATH", "endpoint_env": "ONE_URL"}


def test_real_mode_of_the_pipeline(spark, tmp_path):
    """Every model answers through a fake sender; one method of one model always fails."""
    models = tmp_path / "models.json"
    models.write_text(json.dumps({"models": {"qwen_coder": SPEC, "codegemma": SPEC | {"model_id": "g/7b"}}}))

    def send(url, body, seconds):
        asked = json.loads(body)
        bad = asked["model"] == "g/7b" and "software-development task" in asked["messages"][0]["content"]
        said = "Question: what\nCode: x\nAnswer: that"
        return json.dumps({"choices": [{"finish_reason": "length" if bad else "stop", "message": {"content": said}}]}).encode()

    parser = argparse.ArgumentParser()
    pipeline.add_model_arguments(parser)
    given = parser.parse_args(["--mode", "real", "--models", str(models)])
    with pytest.raises(RuntimeError):
        pipeline.client_of(given, {})
    with pytest.raises(RuntimeError):
        pipeline.client_of(given, {"ONE_PATH": str(tmp_path)})
    client = pipeline.client_of(given, {"ONE_URL": "http://host/v1"}, send)
    options = Options(mode="real", client=client, retries=0, cohort_per_model=2)
    out = str(tmp_path / "out")
    manifest = pipeline.run(read_jsonl(spark, str(source(spark, tmp_path))), spark.createDataFrame([], "content string"), ["document_id"], out, options)
    assert manifest["mode"] == "real" and manifest["synthetic_documents"] < manifest["base_synthetic_target_documents"]
    failed = spark.read.json(f"{out}/generation-rejections")
    assert {r[0] for r in failed.where("method = 'codedev'").select("model").distinct().collect()} == {"codegemma"} and "content" not in failed.columns
    made = spark.read.json(f"{out}/train").where("synthetic")
    assert made.where("mock or model_version not in ('id/7b', 'g/7b')").count() == 0 and made.count() == manifest["synthetic_documents"]


def test_one_branch_with_audit(spark, tmp_path):
    documents = read_jsonl(spark, str(source(spark, tmp_path))).where("content is not null").dropDuplicates(["content"])
    out = str(tmp_path / "out")

    def client(row, model, method):
        if row["parent_document_id"] == "d01":
            raise RuntimeError("no answer")
        return {"content": "Question: q\nAnswer: a", "mock": False}

    accepted = pipeline.synthesize_branch(documents, ["document_id"], "codegemma", "codeqa", out, Options(mode="real", client=client, retries=0))
    written = spark.read.json(f"{out}/branches/codegemma-codeqa")
    assert written.count() == accepted.count() and "d01" not in {r["parent_document_id"] for r in written.collect()}
    assert spark.read.json(f"{out}/generation-rejections/codegemma-codeqa").count() <= 1
    for bad in (Options(mode="real"), Options(mode="odd"), Options(retries=-1), Options(concurrency=0), Options(cohort_per_model=-1), Options(client=client)):
        with pytest.raises(ValueError):
            bad.check()
    with pytest.raises(ValueError):
        pipeline.synthesize_branch(documents, ["document_id"], "codegemma", "poetry", out)
