"""Every operator as a query over the given tables: `(spark, sf_dir) -> DataFrame`."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramloom.functions.grams import gram_key, pad_tokens
from gramloom.functions.lexer import strip_comments
from gramloom.operators import choose, clean, corpus, fit, harvest, score
from gramloom.plans.lookup import kept
from gramloom.plans.scratch import scratch_path
from gramloom.sources import files, models, reports, tables

Query = Callable[[SparkSession, str], DataFrame]

ORDER = 3
_P_DECIMALS = 10
_PERPLEXITY_DECIMALS = 4
_ACCURACY_DECIMALS = 6


# -- corpora ---------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenised, placed and split documents on shared storage, as every stage after reads them."""
    return corpus.split_methods(corpus.tokenize_placed(tables.document_texts(spark, sf_dir)))


def _java(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.split_methods(corpus.tokenize_placed(tables.java_methods(spark, sf_dir)))


def _part_of(methods: DataFrame, split: str) -> DataFrame:
    return methods.filter(F.col("split") == split)


def _trigram(spark: SparkSession, sf_dir: str) -> tuple[fit.NGramModel, DataFrame]:
    """A model of the training documents, and the test documents."""
    methods = _documents(spark, sf_dir)
    return fit.fit(_part_of(methods, corpus.TRAIN), ORDER), _part_of(methods, corpus.TEST)


def _show_tokens(frame: DataFrame) -> DataFrame:
    return frame.select("method_id", gram_key(F.col("tokens")).alias("tokens"), F.size("tokens").alias("n_tokens"))


def _show_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "n",
        F.round("accuracy", _ACCURACY_DECIMALS).alias("accuracy"),
        F.round("perplexity", _PERPLEXITY_DECIMALS).alias("perplexity"),
        F.round("perplexity_no_punctuation", _PERPLEXITY_DECIMALS).alias("perplexity_no_punctuation"),
        "vocabulary_size",
    )


# -- tokenising, splitting, sampling ---------------------------------------


def tokenize_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_tokens(corpus.tokenize_methods(tables.document_texts(spark, sf_dir)))


def tokenize_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_tokens(corpus.tokenize_methods(tables.conversation_texts(spark, sf_dir)))


def tokenize_java(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_tokens(corpus.tokenize_methods(tables.java_methods(spark, sf_dir)))


def tokenize_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_tokens(corpus.tokenize_methods(tables.page_texts(spark, sf_dir)))


def pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = corpus.tokenize_methods(tables.java_methods(spark, sf_dir))
    padded = tokens.select("method_id", pad_tokens(F.col("tokens"), ORDER).alias("tokens"))
    return _show_tokens(padded)


def split_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.split_methods(tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("method_id")))


def split_docs_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty per cent held out."""
    documents = tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("method_id"))
    return corpus.split_methods(documents, test_size=0.3)


def exact_split_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.exact_split_methods(
        tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("method_id"))
    )


def quick_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.quick_sample(tables.java_methods(spark, sf_dir).select("method_id"))


def train_and_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.training_and_validation(split_docs(spark, sf_dir))


# -- cleaning --------------------------------------------------------------


def strip_comments_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.java_methods(spark, sf_dir).select("method_id", strip_comments(F.col("code")).alias("code"))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_empty(clean.with_clean_code(tables.java_methods(spark, sf_dir)))


def normalise_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir)


def dedup_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.remove_duplicates(_cleaned(spark, sf_dir))


def ascii_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.keep_ascii(_cleaned(spark, sf_dir))


def length_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.length_bounds(tables.document_texts(spark, sf_dir))


def length_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.trim_lengths(tables.document_texts(spark, sf_dir)).select("method_id")


def boilerplate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_boilerplate(_cleaned(spark, sf_dir))


def clean_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_methods(tables.java_methods(spark, sf_dir))


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_methods(tables.document_texts(spark, sf_dir))


def clean_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.cleaning_funnel(tables.java_methods(spark, sf_dir))


# -- training --------------------------------------------------------------


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit.vocabulary(_documents(spark, sf_dir))


def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    methods = _documents(spark, sf_dir)
    counts = fit.ngram_counts(methods.withColumn(corpus.FIRST_METHOD, F.col("method_id")), [ORDER], fit.write_counts)
    return corpus.first_positions(counts, "first_seen", methods).drop("first_seen")


def context_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit.context_counts(fit.gram_levels(_documents(spark, sf_dir), [ORDER])).select("n", "m", "ctx", "cc")


def best_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = fit.gram_levels(_documents(spark, sf_dir), [ORDER], fit.write_counts)
    return fit.best_targets(counts.ngrams(), fit.context_counts(counts)).select("n", "m", "ctx", "pred")


# -- probabilities, predictions, metrics -----------------------------------


def _pair_probabilities(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    model, test = _trigram(spark, sf_dir)
    pairs = score.pair_probabilities(model, score.evaluation_pairs(test, model), kept)
    return pairs.select("n", "ctx", "target", F.round(kind, _P_DECIMALS).alias("p"))


def raw_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pair_probabilities(spark, sf_dir, "raw")


def interpolated_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pair_probabilities(spark, sf_dir, "p")


def _predictions(model: fit.NGramModel, test: DataFrame) -> DataFrame:
    prefixes = test.select("method_id", pad_tokens(F.col("tokens"), ORDER + 1).alias("padded")).select(
        "method_id", "padded", F.explode(F.sequence(F.lit(0), F.size("padded") - ORDER - 1)).alias("pos")
    )
    contexts = prefixes.select(
        "method_id",
        "pos",
        F.slice("padded", F.col("pos") + 1, ORDER).alias("context"),
    )
    return score.predict_next(model, contexts).select(
        "method_id", "pos", "n", "matched", "pred", F.round("p", _P_DECIMALS).alias("p")
    )


def predict_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction after every prefix of every test document, from its last three tokens."""
    return _predictions(*_trigram(spark, sf_dir))


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[fit.NGramModel, DataFrame]:
    model, test = _trigram(spark, sf_dir)
    loaded = models.load_model(spark, models.save_model(model, scratch_path(spark, "saved")))
    model.drop()
    return loaded, test


def predict_next_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same predictions from a saved model, whose buckets the questions are dealt to."""
    return _predictions(*_loaded(spark, sf_dir))


def score_positions_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of all positions from a saved model, whose buckets the questions are dealt to."""
    return score.score_positions(*_loaded(spark, sf_dir)).withColumn("p", F.round("p", _P_DECIMALS))


def free_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and interpolated probability of every test token after none to three tokens; three are too many for the model."""
    model, test = _trigram(spark, sf_dir)
    padded = test.select("method_id", pad_tokens(F.col("tokens"), ORDER + 1).alias("padded"))
    positions = padded.select("*", F.explode(F.sequence(F.lit(0), F.size("padded") - ORDER - 1)).alias("pos"))
    length = F.col("pos") % (ORDER + 1)
    asked = positions.select(
        "method_id",
        "pos",
        F.slice("padded", F.col("pos") + 1 + ORDER - length, length).alias("context"),
        F.get("padded", F.col("pos") + ORDER).alias("token"),
    )
    shown = [F.round(c, _P_DECIMALS).alias(c) for c in ("raw", "p")]
    return score.probabilities(model, asked).select("method_id", "pos", "token", *shown)


def predict_without_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that has a vocabulary but no counts falls back to one of its words, at the uniform probability."""
    model, test = _trigram(spark, sf_dir)
    none = replace(
        model, ngrams=model.ngrams.filter("false"), contexts=model.contexts.filter("false"), vocabulary=model.vocabulary, positions=0
    )
    contexts = test.select("method_id", F.slice("tokens", 1, ORDER - 1).alias("context"))
    return score.predict_next(none, contexts).select("method_id", "n", "pred", F.round("p", _P_DECIMALS).alias("p"))


def score_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _trigram(spark, sf_dir)
    return score.score_positions(model, test).withColumn("p", F.round("p", _P_DECIMALS))


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _trigram(spark, sf_dir)
    return _show_metrics(score.evaluate(model, test))


def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _trigram(spark, sf_dir)
    return score.metrics_report(score.evaluate(model, test))


# -- model selection -------------------------------------------------------


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    methods = _java(spark, sf_dir)
    return choose.compare_orders(_part_of(methods, corpus.TRAIN), _part_of(methods, corpus.VALIDATION))


def compare_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_metrics(_comparison(spark, sf_dir))


def compare_n_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    methods = corpus.split_methods(corpus.tokenize_placed(tables.conversation_texts(spark, sf_dir)))
    return _show_metrics(
        choose.compare_orders(_part_of(methods, corpus.TRAIN), _part_of(methods, corpus.VALIDATION))
    )


def select_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return choose.best_order(_comparison(spark, sf_dir)).select("n")


def final_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run: select n on validation, retrain on train and validation, test."""
    tokens = corpus.tokenize_placed(tables.java_methods(spark, sf_dir))
    return _show_metrics(choose.train_and_test(tokens).metrics)


def quick_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run with n selected on the quick sample."""
    tokens = corpus.tokenize_placed(tables.java_methods(spark, sf_dir))
    return _show_metrics(choose.train_and_test(tokens, quick=True).metrics)


# -- sources and sinks -----------------------------------------------------


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Methods written as CSV in the order of their ids, read back and numbered by the reader."""
    path = scratch_path(spark, "csv")
    files.write_processed(tables.java_methods(spark, sf_dir).orderBy("method_id"), path)
    return files.read_methods_csv(spark, path)


def column_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harvested methods written as CSV; the reader picks the code column."""
    path = scratch_path(spark, "extracted")
    files.write_extracted(harvest.with_provenance(harvest.extract_methods(_java_files(spark, sf_dir))), path)
    return files.read_methods_csv(spark, path).select("code")


def processed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned methods written as CSV in the order of their ids, read back, numbered and tokenised."""
    path = scratch_path(spark, "processed")
    files.write_processed(clean.clean_methods(tables.java_methods(spark, sf_dir)).orderBy("method_id"), path)
    return _show_tokens(files.read_processed(spark, path))


def processed_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned methods written as Parquet in the order of their ids, read back, numbered and tokenised."""
    path = scratch_path(spark, "processed")
    files.write_processed(clean.clean_methods(tables.java_methods(spark, sf_dir)).orderBy("method_id"), path, "parquet")
    return _show_tokens(files.read_processed(spark, path, file_format="parquet"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text in the order of their ids, read back with one method per line and numbered."""
    path = scratch_path(spark, "text")
    tables.document_texts(spark, sf_dir).orderBy("method_id").select("code").write.text(path)
    return _show_tokens(files.read_text_methods(spark, path))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a model that was saved and loaded."""
    return _show_metrics(score.evaluate(*_loaded(spark, sf_dir)))


def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final metrics written as JSON and read back."""
    model, test = _trigram(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    reports.write_metrics(score.evaluate(model, test), path)
    return _show_metrics(reports.read_metrics(spark, path).withColumn("n", F.lit(ORDER)))


def comparison_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison written as JSON and read back."""
    path = scratch_path(spark, "comparison")
    reports.write_comparison(_comparison(spark, sf_dir), path)
    return _show_metrics(reports.read_comparison(spark, path))


# -- harvesting ------------------------------------------------------------


def java_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repository list written as CSV, read back and filtered by language."""
    path = scratch_path(spark, "repositories")
    tables.repositories(spark, sf_dir).write.option("header", True).csv(path)
    return harvest.java_repositories(files.read_repositories(spark, path))


def _repo_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = harvest.java_repositories(tables.repositories(spark, sf_dir))
    return harvest.repository_files(listed, tables.file_snapshots(spark, sf_dir))


def _java_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.java_files(_repo_files(spark, sf_dir))


def method_cap_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 500 methods of a list that was written as CSV against the order of names."""
    path = scratch_path(spark, "repositories")
    tables.repositories(spark, sf_dir).orderBy(F.desc("name")).write.option("header", True).csv(path)
    listed = harvest.java_repositories(files.read_repository_list(spark, path))
    sources = harvest.java_files(harvest.repository_files(listed, tables.file_snapshots(spark, sf_dir)))
    return harvest.cap_methods(harvest.extract_methods(sources), 500).drop("listed")


def repo_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repo_files(spark, sf_dir)


def java_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _java_files(spark, sf_dir)


def extract_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.extract_methods(_java_files(spark, sf_dir))


def method_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harvest.with_provenance(harvest.extract_methods(_java_files(spark, sf_dir)))


def method_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 500 methods, a cap that bites at every scale factor above the smallest."""
    return harvest.cap_methods(harvest.extract_methods(_java_files(spark, sf_dir)), 500)


QUERIES: dict[str, Query] = {
    "tokenize_docs": tokenize_docs,
    "tokenize_conversations": tokenize_conversations,
    "tokenize_java": tokenize_java,
    "tokenize_pages": tokenize_pages,
    "pad_tokens": pad,
    "split_docs": split_docs,
    "split_docs_30": split_docs_30,
    "exact_split_docs": exact_split_docs,
    "quick_sample": quick_sample,
    "train_and_validation": train_and_validation,
    "strip_comments": strip_comments_query,
    "normalise_whitespace": normalise_whitespace,
    "dedup_code": dedup_code,
    "ascii_filter": ascii_filter,
    "length_bounds": length_bounds,
    "length_trim": length_trim,
    "boilerplate_filter": boilerplate_filter,
    "clean_chain": clean_chain,
    "clean_documents": clean_documents,
    "clean_funnel": clean_funnel,
    "vocabulary": vocabulary,
    "ngram_counts": ngram_counts,
    "context_counts": context_counts,
    "best_target": best_target,
    "raw_probability": raw_probability,
    "interpolated_probability": interpolated_probability,
    "predict_next": predict_next,
    "predict_next_loaded": predict_next_loaded,
    "free_contexts": free_contexts,
    "predict_without_counts": predict_without_counts,
    "score_positions": score_positions,
    "score_positions_loaded": score_positions_loaded,
    "eval_metrics": eval_metrics,
    "metrics_report": metrics_report,
    "compare_n": compare_n,
    "compare_n_conversations": compare_n_conversations,
    "select_n": select_n,
    "final_model": final_model,
    "quick_model": quick_model,
    "csv_roundtrip": csv_roundtrip,
    "column_resolution": column_resolution,
    "processed_roundtrip": processed_roundtrip,
    "processed_parquet_roundtrip": processed_parquet_roundtrip,
    "text_lines": text_lines,
    "model_roundtrip": model_roundtrip,
    "metrics_json": metrics_json,
    "comparison_json": comparison_json,
    "java_repos": java_repos,
    "repo_files": repo_files,
    "java_files": java_files,
    "extract_methods": extract_methods,
    "method_provenance": method_provenance,
    "method_cap": method_cap,
    "method_cap_listed": method_cap_listed,
}
