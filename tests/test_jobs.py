import os

import pytest
from test_harvest import SCHEMA, snapshot

from gramloom import jobs
from gramloom.operators import choose
from gramloom.plans import scratch
from gramloom.sources import files


def test_from_snapshots_to_a_model(spark, frame, tmp_path):
    (tmp_path / "repositories.csv").write_text("name,defaultBranch,mainLanguage\no/r,main,Java\no/s,main,C\n")
    bodies = ["int f%d(int a) { /* c */ int b = a + %d; return b; }" % (i, i) for i in range(120)]
    sources = ["class A {\n" + "\n".join(bodies[i : i + 10]) + "\n}" for i in range(0, 120, 10)]
    snapshots = frame([snapshot(s, seq) for seq, s in enumerate(sources)] + [snapshot(sources[0], 50, "o/s")], SCHEMA)
    harvested, processed, results = (str(tmp_path / name) for name in ("harvested", "processed", "results"))
    jobs.harvest_methods(spark, str(tmp_path / "repositories.csv"), snapshots, harvested, limit=105)
    assert files.read_csv(spark, harvested).count() == 105
    jobs.clean_methods(spark, harvested, processed)
    cleaned = files.read_csv(spark, processed)
    assert cleaned.columns == ["Method Code No Comments"] and 80 < cleaned.count() <= 105
    parquet, funnel = str(tmp_path / "parquet"), str(tmp_path / "funnel")
    jobs.clean_methods(spark, harvested, parquet, funnel, file_format="parquet")
    assert spark.read.parquet(parquet).exceptAll(cleaned).isEmpty()
    stages = spark.read.json(funnel).orderBy("step").collect()
    assert (stages[0].rows_in, stages[-1].rows_out) == (105, cleaned.count())
    result = jobs.model_methods(spark, parquet, output_dir=results, min_n=2, max_n=4, exact=True, file_format="parquet")
    assert result.metrics.head().perplexity < 10
    with pytest.raises(ValueError):
        jobs.clean_methods(spark, harvested, parquet, file_format="orc")


def test_text_file(spark, tmp_path):
    (tmp_path / "t.txt").write_text("\n".join(f"int f() {{ return {i % 3}; }}" for i in range(200)))
    result = jobs.model_methods(spark, training_txt=str(tmp_path / "t.txt"), output_dir=str(tmp_path / "out"), max_n=4, quick=True)
    assert result.metrics.head().accuracy > 0.8
    with pytest.raises(ValueError):
        jobs.model_methods(spark)


def test_a_run_leaves_its_outputs_only_and_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    (tmp_path / "t.txt").write_text("\n".join(f"int f() {{ return {i % 3}; }}" for i in range(200)))
    source, folder = str(tmp_path / "t.txt"), str(tmp_path / "run")
    before = set(os.listdir(scratch.scratch_root(spark))) if os.path.exists(scratch.scratch_root(spark)) else set()
    whole = jobs.model_methods(spark, training_txt=source, output_dir=str(tmp_path / "whole"), max_n=4)
    assert set(os.listdir(scratch.scratch_root(spark))) <= before

    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(choose, "final_model", fails)
        with pytest.raises(RuntimeError):
            jobs.model_methods(spark, training_txt=source, output_dir=str(tmp_path / "again"), max_n=4, run_folder=folder)
    written = {name: os.path.getmtime(f"{folder}/{name}/_SUCCESS") for name in os.listdir(folder)}
    assert {"ingested-1", "comparison-1", "order-ngrams-1"} <= set(written)
    seen = {}

    def watching(model, output_dir):
        seen.update({name: os.path.getmtime(f"{folder}/{name}/_SUCCESS") for name in written})
        return save(model, output_dir)

    save = choose.save_model
    monkeypatch.setattr(choose, "save_model", watching)
    again = jobs.model_methods(spark, training_txt=source, output_dir=str(tmp_path / "again"), max_n=4, run_folder=folder)
    assert seen == written and not os.path.exists(folder)
    assert again.best_n == whole.best_n and again.metrics.collect() == whole.metrics.collect()
    assert again.model.positions == whole.model.positions
    assert sorted(again.comparison.collect()) == sorted(whole.comparison.collect())
