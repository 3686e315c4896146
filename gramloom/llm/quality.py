"""Quality rules of documents and of their hosts.

Rules are judged per document.  Per host (`source`) the failures of each rule
are counted, the rates are shrunk towards the rate of all hosts by a beta prior
fitted to the hosts' own rates, and a host most of whose documents fail a rule
after that loses all its documents.  Built-in expressions only; no text is
shuffled, and hosts are pre-aggregated before they meet.

Null text: no words, so it fails the rule on few words.  Null source: a host of
its own.  Repeated rows count as often as they stand.  Empty table: no rows.
Very long texts are handled inside their row.  Other columns pass through
`kept_documents` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.llm.common import WORD, stage

LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
MOST_SYMBOLS_PER_WORD = 0.5
WINDOW = 8
#: A host goes if the shrunk rate of one rule is above this.
MOST_HOST_RATE = 0.5
#: Strength of the prior in documents, where the hosts do not tell.
WEAKEST_PRIOR, STRONGEST_PRIOR = 2.0, 10_000.0

RULES = ("few_words", "repeated", "symbols")


def _with(value: Column, then) -> Column:
    """Evaluate `value` once and use it many times."""
    return F.transform(F.array(value), then)[0]


def _repeated_words(words: Column) -> Column:
    """Words in windows of WINDOW words that stand twice or more in the text.

    Equal windows have equal hashes, so texts whose hashes all differ are done;
    in the others the windows' words themselves are compared.
    """
    last = F.size(words) - WINDOW

    def hashes() -> Column:
        """One per word; the last few are of fewer words, and equal no other."""
        return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)]))

    def places(windows: Column) -> Column:
        """Starts of repeated windows, in order; windows are sorted (words, start)."""
        return F.sort_array(
            F.transform(
                F.filter(
                    F.transform(
                        windows,
                        lambda x, i: F.struct(
                            x["at"].alias("at"),
                            (
                                ((i > 0) & (F.get(windows, i - 1)["words"] == x["words"]))
                                | F.coalesce(F.get(windows, i + 1)["words"] == x["words"], F.lit(False))
                            ).alias("again"),
                        ),
                    ),
                    lambda x: x["again"],
                ),
                lambda x: x["at"],
            )
        )

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("bigint"),
            lambda total, n: total + n,
        )

    def exact() -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), last + 1),
            lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("words"), i.alias("at")),
        )
        return _with(F.sort_array(windows), lambda sorted_: _with(places(sorted_), covered))

    found = _with(
        hashes(),
        lambda of: F.when(F.size(F.array_distinct(of)) == F.size(of), F.lit(0).cast("bigint")).otherwise(exact()),
    )
    return F.when(last < 1, F.lit(0).cast("bigint")).otherwise(found)


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return _with(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, rules' failures)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select("doc_id", F.col("source").cast("string").alias("host"), text.alias("text")).select(
        "doc_id",
        "host",
        _with(
            F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)),
            lambda words: F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
                _repeated_words(words).alias("n_repeat_words"),
            ),
        ).alias("words"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        _repeated_lines(F.col("text")).alias("n_dup_lines"),
    )
    return counted.select(
        "doc_id", "host", "words.n_words", "words.word_chars", "n_symbols", "n_dup_lines", "words.n_repeat_words"
    )


def _failures() -> dict[str, Column]:
    return {
        "few_words": F.col("n_words") < LEAST_WORDS,
        "repeated": 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"),
        "symbols": F.col("n_symbols") > MOST_SYMBOLS_PER_WORD * F.col("n_words"),
    }


def host_verdicts(judged: DataFrame, most_rate: float = MOST_HOST_RATE) -> DataFrame:
    """(host, n_docs, host_rejected, and the shrunk rate of each rule).

    The prior's mean is the hosts' mean rate; its strength comes from the
    spread of their rates by the method of moments, held between
    WEAKEST_PRIOR and STRONGEST_PRIOR documents.
    """
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(F.col(r).cast("bigint")).alias(r) for r in RULES]
    )
    hosts = stage(hosts, "hosts")
    rate = {r: F.col(r) / F.col("n_docs") for r in RULES}
    prior = hosts.agg(
        *[F.avg(rate[r]).alias(f"{r}_mean") for r in RULES], *[F.var_pop(rate[r]).alias(f"{r}_var") for r in RULES]
    ).head()
    shrunk = {}
    for r in RULES:
        mean, var = prior[f"{r}_mean"] or 0.0, prior[f"{r}_var"] or 0.0
        strength = mean * (1 - mean) / var - 1 if var > 0 else STRONGEST_PRIOR
        strength = min(max(strength, WEAKEST_PRIOR), STRONGEST_PRIOR)
        shrunk[r] = (F.col(r) + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    worst = F.greatest(*[shrunk[r] for r in RULES])
    return hosts.select(
        "host", "n_docs", *[shrunk[r].alias(f"{r}_rate") for r in RULES], (worst > most_rate).alias("host_rejected")
    )


def _judged(docs: DataFrame, most_rate: float) -> DataFrame:
    """`statistics` with the rules' failures and the verdict on the host, a row per row of `docs`."""
    judged = stage(statistics(docs).withColumns(_failures()), "judged")
    verdicts = stage(host_verdicts(judged, most_rate), "verdicts").select(F.col("host").alias("of"), "host_rejected")
    joined = judged.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "inner")
    failed = F.col("few_words") | F.col("repeated")
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~F.col("host_rejected")})


def judge(docs: DataFrame, most_rate: float = MOST_HOST_RATE) -> DataFrame:
    """Statistics of each document, `base_failed` and `kept`."""
    return _judged(docs, most_rate).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def kept_documents(docs: DataFrame, most_rate: float = MOST_HOST_RATE) -> DataFrame:
    """The rows of `docs` that are kept; rows of one id are judged each by its own text and host."""
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    # The digest goes through the statistics as a part of the id.
    named = docs.withColumn("doc_id", F.struct(F.col("doc_id").alias("id"), digest.alias("digest")))
    rejected = _judged(named, most_rate).filter(~F.col("kept"))
    rejected = rejected.select(F.col("doc_id.id").alias("gone"), F.col("doc_id.digest").alias("gone_text"), F.col("host").alias("gone_host"))
    rejected = rejected.distinct()
    same = (
        docs["doc_id"].eqNullSafe(rejected["gone"])
        & (digest == rejected["gone_text"])
        & docs["source"].cast("string").eqNullSafe(rejected["gone_host"])
    )
    return docs.join(rejected, same, "left_anti")
