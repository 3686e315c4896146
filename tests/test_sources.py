import json
import math
import os
import re
import tempfile
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gramloom.operators import fit, score
from gramloom.plans import scratch
from gramloom.sources import files, models, reports, tables

TRICKY = ['a "quoted" one', "two\nlines, and a comma", "  edges  ", 'ends with "', "back\\slash", "tab\there", "é", "'"]


def test_csv_roundtrip(frame, tmp_path, spark):
    methods = frame(list(enumerate(TRICKY)), "method_id bigint, code string")
    files.write_processed(methods.coalesce(1), str(tmp_path / "m"))
    back = files.read_methods_csv(spark, str(tmp_path / "m"))
    assert [r.code for r in back.orderBy("method_id").collect()] == TRICKY
    assert files.read_processed(spark, str(tmp_path / "m")).count() == len(TRICKY)


def test_code_column():
    assert files.resolve_code_column(["code", "method_code", "Method Code"]) == "Method Code"
    assert files.resolve_code_column(["code", "method_code"]) == "method_code"
    assert files.resolve_code_column(["id", "Source CODE x", "code"]) == "Source CODE x"
    with pytest.raises(ValueError):
        files.resolve_code_column(["id", "text"])


def test_processed_file_needs_its_column_and_drops_nulls(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Method Code No Comments\n"a b"\n\n"// c"\n"d"\n')
    assert [r.tokens for r in files.read_processed(spark, str(tmp_path / "a.csv")).orderBy("method_id").collect()] == [["a", "b"], ["d"]]
    (tmp_path / "b.csv").write_text("other\nx\n")
    with pytest.raises(ValueError):
        files.read_processed(spark, str(tmp_path / "b.csv"))


def test_text_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("int a;\n\n   \n  b() 　\r\n// c\nlast", encoding="utf-8")
    path = str(tmp_path / "t.txt")
    assert [r.code for r in files.read_text_lines(spark, path).orderBy("method_id").collect()] == ["int a;", "b()", "// c", "last"]
    assert [r.tokens for r in files.read_text_methods(spark, path).orderBy("method_id").collect()] == [["int", "a", ";"], ["b", "(", ")"], ["last"]]


def test_extracted_columns(frame, spark, tmp_path):
    row = ("main", "h", "F.java", "f", "void f() {\n}", "link")
    methods = frame([row], "branch string, commit_hash string, file_name string, method_name string, method_code string, commit_link string")
    files.write_extracted(methods, str(tmp_path / "e"))
    back = files.read_csv(spark, str(tmp_path / "e"))
    assert back.columns == ["Branch Name", "Commit Hash", "File Name", "Method Name", "Method Code", "Commit Link"]
    assert tuple(back.head()) == row


def test_repositories(spark, tmp_path):
    (tmp_path / "r.csv").write_text("id,name,defaultBranch,mainLanguage\n1,o/r,main,Java\n")
    assert tuple(files.read_repositories(spark, str(tmp_path / "r.csv")).head()) == ("o/r", "main", "Java")
    assert tuple(files.read_repository_list(spark, str(tmp_path / "r.csv")).head()) == (0, "o/r", "main", "Java")


METRICS = "n int, accuracy double, perplexity double, perplexity_no_punctuation double, vocabulary_size bigint"


def test_metrics_files(frame, spark, tmp_path):
    metrics = frame([(3, 0.5, 24.1, math.inf, 5), (2, 0.25, 3.5, 4.5, 5)], METRICS)
    reports.write_metrics(metrics.filter("n = 2"), str(tmp_path / "metrics.json"))
    assert tuple(reports.read_metrics(spark, str(tmp_path / "metrics.json")).head()) == (0.25, 3.5, 4.5, 5)
    reports.write_comparison(metrics, str(tmp_path / "compare.json"))
    written = json.loads(spark.read.text(str(tmp_path / "compare.json")).head()[0])
    assert list(written) == ["n=2", "n=3"] and written["n=2"]["vocabulary_size"] == 5
    back = reports.read_comparison(spark, str(tmp_path / "compare.json")).orderBy("n").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in metrics.orderBy("n").collect()]


def test_model_roundtrip(methods, spark, tmp_path):
    train, test = methods([["a", "b", "a"], ["a", "c"]]), methods([["a", "b", "c"]])
    model = fit.fit(train, [2, 3], smoothing_k=0.5)
    path = models.save_model(model, str(tmp_path))
    loaded = models.load_model(spark, path)
    assert (loaded.n_values, loaded.smoothing_k, loaded.lambda_factor) == ((2, 3), 0.5, 0.4)
    first, second = (sorted(map(tuple, score.evaluate(m, test).collect())) for m in (model, loaded))
    assert first == second
    assert models.load_model(spark, str(tmp_path / "nowhere")) is None


def test_loaded_model_answers_like_the_fitted_one(methods, frame, spark, tmp_path):
    words = ["a", "b", "c", "x\x1fy", "long" * 1500]
    texts = [[words[(i * i + j * (i % 3 + 1)) % len(words)] for j in range(i % 7 + 1)] for i in range(60)]
    model = fit.fit(methods(texts), [1, 2, 3])
    test = methods([["a", "b", "c"], ["new", "a"], ["x\x1fy", "b", "a", "long" * 1500, "a"]])
    asked = frame([(["a"], "b"), ([], "a"), (["new", "b"], "c"), (["a", "b", "c", "a"], "b")], "context array<string>, token string")
    for buckets in (3, 8):
        loaded = models.load_model(spark, models.save_model(model, str(tmp_path / "it's"), buckets=buckets))
        assert loaded.contexts.count() == model.contexts.count()
        for operator, question in (
            (score.evaluate, test), (score.score_positions, test), (score.probabilities, asked), (score.predict_next, asked.drop("token")),
        ):
            first, second = (operator(m, question) for m in (model, loaded))
            assert first.columns == second.columns
            assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("gramloom")]


def test_model_is_read_without_an_exchange(methods, spark, tmp_path):
    model = fit.fit(methods([["a", "b", "a"], ["a", "c"]]), 3)
    loaded = models.load_model(spark, models.save_model(model, str(tmp_path), buckets=3))
    pairs = score.evaluation_pairs(methods([["a", "b", "c"]]), loaded)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = score.pair_probabilities(loaded, pairs)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    read_by = []

    def walk(node, above):
        name = node.nodeName()
        above = above + [name] if "Exchange" in name or "Join" in name else above
        if name.startswith("Scan parquet") and "Bucketed: true" in node.toString():
            read_by.append(above[-1])
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), above)

    walk(plan, [])
    # Hot keys go by broadcast, all others meet the questions in the model's own buckets.
    assert read_by.count("SortMergeJoin") == 2 and set(read_by) <= {"SortMergeJoin", "BroadcastExchange"}, plan.toString()
    assert plan.toString().count("hashpartitioning(_hash") == 2


def test_saved_counts_are_packed_as_other_tables_are(methods, tmp_path):
    path = models.save_model(fit.fit(methods([["a", "b", "a"], ["b"]]), 2), str(tmp_path), buckets=2)
    for table in ("ngrams", "contexts"):
        files_of = list((tmp_path / os.path.basename(path) / table).glob("*.parquet"))
        assert files_of and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files_of)


def test_model_is_not_saved_over_itself(methods, spark, tmp_path):
    model = fit.fit(methods([["a", "b"]]), 2)
    loaded = models.load_model(spark, models.save_model(model, str(tmp_path)))
    with pytest.raises(ValueError, match="over itself"):
        models.save_model(loaded, str(tmp_path))
    again = models.load_model(spark, models.save_model(loaded, str(tmp_path / "copy")))
    assert sorted(map(str, again.contexts.collect())) == sorted(map(str, loaded.contexts.collect()))


def test_relative_folders(methods, spark, tmp_path):
    folder = os.path.relpath(tmp_path / "models")
    models.save_model(fit.fit(methods([["a", "b"]]), 2), folder)
    assert (tmp_path / "models" / models.DEFAULT_NAME / "ngrams" / "_SUCCESS").exists()
    assert models.load_model(spark, f"{folder}/{models.DEFAULT_NAME}").positions == 3


def test_scratch_root_on_a_cluster(spark, monkeypatch):
    class Context:
        applicationId = "app-1"
        checkpoint = None

        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return self.checkpoint

    class Session:
        def __init__(self, master, settings):
            self.sparkContext = Context(master)
            self.settings = settings
            self.conf = self

        def get(self, key, default):
            return self.settings.get(key, default)

    assert scratch.scratch_root(Session("yarn", {"spark.checkpoint.dir": "s3://b/c/"})) == "s3://b/c/app-1"
    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session("yarn", {}))
    assert scratch.scratch_root(Session("local[2]", {})).startswith(tempfile.gettempdir())


@pytest.mark.parametrize("size", ["40b", "1kb", "128mb"])
def test_numbers_do_not_depend_on_splits(spark, tmp_path, size):
    expected = []
    for name in "bca":
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i} ;\n\n" for i in range(60)))
    for name in "abc":
        expected += [f"{name}{i} ;" for i in range(60)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        found = files.read_text_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, found)) == list(enumerate(expected))


def test_turns_beyond_a_thousand_keep_their_own_ids(spark, tmp_path):
    rows = [(c, t, f"t{c} {t}") for c in (0, 1, 2) for t in range(1500)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    found = tables.conversation_texts(spark, str(tmp_path)).orderBy("method_id").collect()
    assert [(r.method_id, r.code) for r in found] == [(i, text) for i, (_, _, text) in enumerate(rows)]


def test_shuffle_files_go_when_a_table_is_written(spark):
    def on_disk():
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    before = on_disk()
    table = scratch.write_table(spark.range(10_000).repartition(7, "id"), "dealt")
    until = time.time() + 10
    while on_disk() - before and time.time() < until:
        time.sleep(0.1)
    assert not on_disk() - before
    assert table.count() == 10_000


@pytest.mark.parametrize("n_values", [3, [2, 3]])
def test_grams_lie_in_the_buckets_that_their_tables_name(spark, methods, tmp_path, n_values):
    model = fit.fit(methods([["a", "b", "a"], ["a", "c", "x\x1fy", "b"]]), n_values)
    path = models.save_model(model, str(tmp_path))
    copied = models.save_model(models.load_model(spark, path), str(tmp_path / "copy"))
    saved = [(f"{folder}/{name}", key) for folder in (path, copied) for name, key in (("ngrams", "gram"), ("contexts", "ctx"))]
    trained = [(table.inputFiles()[0].rsplit("/", 1)[0], "gram") for table in model.tables]
    for folder, key in saved + trained:
        for file in spark.read.parquet(folder).inputFiles():
            bucket = int(re.search(r"_(\d{5})\.c\d+", file).group(1))
            assert spark.read.parquet(file).filter(F.pmod(F.hash(key), F.lit(model.buckets)) != bucket).isEmpty()
    # A copy in as many buckets is made where they lie: no more files than tables that it is made of.
    for folder in (path, copied):
        files = spark.read.parquet(f"{folder}/ngrams").inputFiles()
        assert len(files) <= model.buckets * model.max_n
