"""Hard negatives against plain loops over all rows, and against their SQL."""

import math
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gramloom.llm import negatives as n
from gramloom.llm import queries
from gramloom.llm.oracle import NEGATIVES

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, is_anchor, positives=5, negatives=5, least=80, most=100):
    """The rows of `mine` by scoring all pairs."""
    used = [
        (vec_id, [math.floor(256 * x) for x in v], label)
        for vec_id, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    found = []
    for i, (anchor_id, a, label) in enumerate(used):
        if not is_anchor(anchor_id):
            continue
        scored = [
            (sum(x * y for x, y in zip(a, b, strict=True)), vec_id, other == label)
            for j, (vec_id, b, other) in enumerate(used) if j != i and len(a) == len(b)
        ]
        for p, positive_id, _ in sorted((s for s in scored if s[2]), key=order)[:positives]:
            fit = sorted((s for s in scored if not s[2] and least * p <= 100 * s[0] <= most * p), key=order)[:negatives]
            found += [(anchor_id, positive_id, k, s[1], p, s[0]) for k, s in enumerate(fit, 1)]
    return Counter(found)


def made_rows(dims=5, n_rows=500):
    rng = np.random.default_rng(dims)
    centres = rng.standard_normal((6, dims))
    rows = []
    for i in range(n_rows):
        label = 0 if i % 3 == 0 else int(rng.integers(6))  # a third of all rows has one label
        vector = centres[int(rng.integers(6))] + rng.standard_normal(dims) * 0.4
        rows.append((i, np.round(vector * 2).tolist() if i % 2 else vector.tolist(), label))  # many equal scores
    rows += [(n_rows + i, rows[1][1], rows[i][2]) for i in range(40)]  # equal vectors, several labels
    rows += [rows[20], rows[20], (None, rows[3][1], 1), (None, rows[3][1], 2), (700, [0.0] * dims, 1), (720, [0.0] * dims, 2)]
    odd = [None, [], [None] * dims, [math.nan] * dims, [math.inf] * dims]
    rows += [(10 * i + 1000, v, 1) for i, v in enumerate(odd)] + [(1100, [], 2), (1110, rows[5][1], None)]
    return rows + [(1200 + i, [1.0 * i, 2.0], i % 2) for i in range(30)]


@pytest.mark.parametrize(("block", "pack", "k"), [(n.BLOCK, n.PACK, 5), (16, 7, 3), (1, 1, 1)])
def test_against_all_pairs(spark, block, pack, k):
    rows = made_rows(n_rows=500 if block > 1 else 60)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"length": F.lit("x"), "score": F.lit(1), "pack": F.lit(2)})
    found = n.mine(frame.repartition(3), F.col("vec_id") % 10 == 0, k, k, block=block, pack=pack).collect()
    expected = plain(rows, lambda i: i is not None and i % 10 == 0, k, k)
    # Null ids that tie with each other are in no stated order; here their scores are the same, so rows agree.
    assert Counter(map(tuple, found)) == expected and expected


def test_other_windows(spark):
    rows = made_rows(3, 200)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = n.mine(frame, F.col("vec_id") % 25 == 0, 2, 4, least=-50, most=150).collect()
    assert Counter(map(tuple, found)) == plain(rows, lambda i: i is not None and i % 25 == 0, 2, 4, -50, 150)


def test_large_components_and_bounds(spark):
    big = [(i, [float(10**6 + i), -1e5, 3.0 * i], i % 2) for i in range(40)]
    found = n.mine(spark.createDataFrame(big, SCHEMA), F.col("vec_id") < 5).collect()
    assert Counter(map(tuple, found)) == plain(big, lambda i: i < 5)
    bound = [(i, [1e300, -1e300, 1.0], i % 2) for i in range(6)]
    found = n.mine(spark.createDataFrame(bound, SCHEMA), F.col("vec_id") == 0).collect()
    assert len(found) == 2 * 3 and len({r.positive_score for r in found}) == 1 and found[0].positive_score > 2**60


def test_no_anchors_and_empty_table(spark):
    frame = spark.createDataFrame(made_rows(2, 60), SCHEMA)
    assert n.mine(frame, F.col("vec_id") < 0).collect() == []
    assert n.mine(frame.limit(0), F.col("vec_id") >= 0).collect() == []
    with pytest.raises(ValueError):
        n.mine(frame, F.col("vec_id") >= 0, block=0)


def test_threshold_stops_early():
    numbers = np.arange(4000).reshape(1000, 4)
    met = []
    best = n._Best(5)
    block = n._Block(
        {"size": 1000, "block": 0, "length": 4, "all_labels": bytes(8000), "ids": np.arange(1000).tobytes(),
         "null_ids": bytes(1000), "numbers": numbers.astype("<i8").tobytes()}
    )

    def offer(at, scores):
        met.extend(at.tolist())
        best.offer(block, at, scores)

    n._Lists(numbers).walk(np.array([1, 2, 0, 1]), best.floor, offer)
    assert [r[2] for r in best.rows] == [999, 998, 997, 996, 995] and len(met) == n._FIRST_DEPTH


def test_query_equals_sql(spark, tmp_path):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(6).tolist(), int(rng.integers(10)) if i % 17 else None) for i in range(1500)]
    rows += [(1500 + i, rows[i + 1][1], 3) for i in range(200)] + [(1700, None, 1), (1800, [math.nan] * 6, 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    embeddings = pd.DataFrame(rows, columns=["vec_id", "embedding", "label"]).astype({"label": "Int64"})  # noqa: F841
    found = queries.op11_hard_negatives(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(duckdb.sql(NEGATIVES).fetchall())
