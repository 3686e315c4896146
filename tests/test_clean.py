import random
import re

import pytest
from pyspark.sql import functions as F

from gramloom.operators import clean


def texts(frame, codes):
    return frame(list(enumerate(codes)), "method_id bigint, code string")


def test_first_copy_survives(frame):
    data = texts(frame, ["b", "a", "b", "a", "c"]).repartition(3)
    assert sorted(map(tuple, clean.remove_duplicates(data).collect())) == [(0, "b"), (1, "a"), (4, "c")]
    wide = data.withColumn("extra", F.col("method_id") * 10).select("extra", "method_id", "code")
    assert sorted(map(tuple, clean.remove_duplicates(wide).collect())) == [(0, 0, "b"), (10, 1, "a"), (40, 4, "c")]


def test_ascii(frame):
    data = texts(frame, ["plain\x7f", "é", "a b", ""])
    assert [r.method_id for r in clean.keep_ascii(data).orderBy("method_id").collect()] == [0, 3]


def quantile(values, share):
    values = sorted(values)
    place = share * (len(values) - 1)
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


def test_length_bounds_are_interpolated(frame):
    random.seed(1)
    lengths = [random.randint(1, 300) for _ in range(237)]
    data = texts(frame, ["x" * n for n in lengths])
    low, high = clean.length_bounds(data).head()
    assert (low, high) == pytest.approx((quantile(lengths, 0.05), quantile(lengths, 0.95)), abs=1e-6)
    kept = [len(r.code) for r in clean.trim_lengths(data).collect()]
    assert sorted(kept) == sorted(n for n in lengths if low <= n <= high)


def test_length_bounds_with_one_dominant_length(frame):
    data = texts(frame, ["x" * 10] * 500 + ["y" * 3] * 5 + ["z" * 99] * 5)
    assert tuple(clean.length_bounds(data).head()) == (10.0, 10.0)
    assert clean.trim_lengths(data).count() == 500


BOILERPLATE = [
    "void setName(String n) {", "if (o.getName().equals(x)) {", "String toString() {", "int[] toArray() {",
    "int hashCode() {", "int hash() {", "boolean equals(Object other) {", "Object clone() {", "@Override\nvoid f() {",
    "void setX(int a)\n{",
]
KEPT = [
    "void settle(int a) {", "int getter;", "void toStrings() {", "boolean equals(Foo o) {", "a\n@Override\nvoid f() {",
    "void setX(int a) throws E {", "void f(int a,\n getB) {", "void reset(int X) {",
]


def test_boilerplate(frame):
    data = texts(frame, BOILERPLATE + KEPT)
    assert sorted(r.code for r in clean.drop_boilerplate(data).collect()) == sorted(KEPT)
    python = re.compile("|".join(clean.BOILERPLATE_PATTERNS))
    assert all(python.search(t) for t in BOILERPLATE) and not any(python.search(t) for t in KEPT)


def test_chain_and_funnel_agree(frame):
    random.seed(2)
    pool = ["int f%d() { return %d; }" % (i, i * 1000) for i in range(60)]
    codes = random.choices(pool, k=150) + ["// c", None, "", 'String s() { return "é"; }', "int getA() { return a; }",
                                            "void g() {" + "x();" * 200 + "}", "int f1()  {  return 1000; } // again"]
    data = texts(frame, codes)
    rows = {r.stage: r for r in clean.cleaning_funnel(data).collect()}
    cleaned = clean.clean_methods(data)
    assert rows["comment_only"].rows_in == len(codes) and rows["comment_only"].removed == 3
    assert rows["boilerplate"].rows_out == cleaned.count()
    ordered = sorted(rows.values(), key=lambda r: r.step)
    assert all(a.rows_out == b.rows_in for a, b in zip(ordered, ordered[1:]))
    assert all(r.removed == r.rows_in - r.rows_out >= 0 for r in ordered)
    assert clean.remove_duplicates(cleaned).count() == cleaned.count()
    assert not any("get" in r.code or "é" in r.code for r in cleaned.collect())


def test_no_rows(frame):
    data = texts(frame, []).limit(0)
    assert clean.clean_methods(data).count() == 0
    assert {r.rows_in for r in clean.cleaning_funnel(data).collect()} == {0}
