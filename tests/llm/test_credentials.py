"""The secret scan against a plain loop and its SQL, on odd rows."""

import hashlib
import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gramloom.llm import credentials as c
from gramloom.llm.oracle import CREDENTIALS

KEY = "Ab0" + "x" * 36 + "9"
PARTS = [
    "password=abcdef1", "Token = 'short'", "secret: token: abcdefgh", "AKIA" + "Z9" * 8, "AKIAZ", "0123456789abcdef01234567",
    "0123456789abcdef", "user = alice.b", "client_id: \"srv-77\"", KEY, KEY + "Q", KEY.lower(), "https://api.example.org/v1",
    "host = db.internal", "É mot", "api_key=" + KEY, "ſecret=abcdefgh", "toKen=abcdefgh", "key=" + "z" * 900, "\n\n", "\n \t\n", "\n", "x" * 390,
]


def texts():
    rng = random.Random(11)
    made = [" ".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(300)]
    far = [f"user = bob {'x' * n} {KEY}" for n in (380, 398, 399, 400, 401, 420)]
    long = "user = bob " + " ".join([KEY, "https://a.b/c", "y" * 300] * 300)
    return [*made, *far, long, None, "", "token=", "=" * 50]


def spans(text, reach):
    """All spans by their definition: (start, kind, end), strong ones first."""
    text = text or ""
    strong = [(m.start(), 0, m.end()) for m in re.finditer(c.ASSIGN, text) if len(m[2]) >= 6]
    strong += [(m.start(), 1, m.end()) for m in re.finditer(c.ACCESS, text) if len(m[0]) >= 20]
    strong += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    weak = [(m.start(), 3, m.end()) for m in re.finditer(c.IDENTIFIER, text)]
    weak += [
        (m.start(), 4, m.end())
        for m in re.finditer("[A-Za-z0-9+/]+", text)
        if len(m[0]) == 40 and all(re.search(x, m[0]) for x in ("[a-z]", "[A-Z]", "[0-9]"))
    ]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(c.ENDPOINT, text)]
    weak = [w for w in weak if not any(s < w[2] and e > w[0] for s, _, e in strong)]
    breaks = [m.start() for m in re.finditer(c.SCOPE_END, text)]

    def scope(part):
        return sum(b < part[0] for b in breaks)

    def near(part, kinds):
        return any(
            p[1] in kinds and scope(p) == scope(part) and part[0] - reach <= at <= part[2] + reach
            for p in strong + weak for at in (p[0], p[2])
        )

    needs = {3: [(0, 2, 4)], 4: [(1, 3)], 5: [(0, 2, 4), (1, 3)]}
    return sorted(strong), [w for w in weak if all(near(w, kinds) for kinds in needs[w[1]])]


def written(found):
    return ",".join(f"{c.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


@pytest.mark.parametrize("reach", [c.REACH, 7, 1])
def test_spans(spark, reach):
    rows = [(i if i % 9 else None, t, i) for i, t in enumerate(texts())] + [(1, texts()[1], 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int").withColumn("scope", F.lit("x"))
    found = c.scan(docs.repartition(5), reach).collect()
    expected = []
    for doc_id, text, _ in rows:
        strong, weak = spans(text, reach)
        digest = hashlib.sha256(written(strong).encode()).hexdigest()
        expected.append((doc_id, *[sum(k == kind for _, k, _ in strong) for kind in range(3)], digest, written(strong + weak)))
    assert sorted([tuple(r)[:6] for r in found], key=lambda r: (r[0] is None, r[0] or 0, r[1:])) == sorted(
        expected, key=lambda r: (r[0] is None, r[0] or 0, r[1:])
    )
    assert any(kind in r.spans for r in found for kind in ("identifier", "key", "endpoint"))
    by_id = {d: t for d, t, _ in rows if d is not None}
    assert all(by_id[r.doc_id][f.start : f.end] == f["value"] for r in found if r.doc_id is not None for f in r.found)


def test_spans_equal_sql(spark):
    documents = pd.DataFrame({"doc_id": range(len(texts())), "text": texts()})  # noqa: F841
    expected = duckdb.sql(CREDENTIALS).fetchall()
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id bigint, text string")
    assert sorted(map(tuple, c.scan(docs).drop("found").collect())) == sorted(expected)


def test_empty_table_and_reach(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert c.scan(docs).collect() == []
    with pytest.raises(ValueError):
        c.scan(docs, 0)
