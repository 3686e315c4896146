import random

import pytest
from pyspark.sql import functions as F

from gramloom.operators import harvest

SCHEMA = "repo string, branch string, commit_hash string, commit_seq bigint, file_name string, source_code string"

SOURCE = '''package p; // } not a brace
import java.util.*;
/* class { */
@SuppressWarnings({"all", "x{"})
public class Foo<T> extends Bar {
    private static final char OPEN = '{', QUOTE = '"';
    private int[] xs = {1, 2, 3};
    public Foo(int a) { this.a = a; }
    Foo() { this(1); }
    @Inject Foo(String s) { super(s); }
    abstract int nothing(int a);
    static { init(); }

    /** Doc {@code }. */
    @Override
    @Deprecated
    public String toString() { return "}" + '}' + "\\"}"; }
    <A extends B> Map<A, List<A>> generic(A[] as, Map<String, int[]> m) throws IOException,
            OtherException
    {
        if (m.isEmpty()) { return null; } else if (x) { call(); }
        for (int i = 0; i < 3; i++) { while (true) { break; } }
        Runnable r = new Runnable() {
            public void run() { go(); }
        };
        synchronized (this) { try { f(); } catch (E e) { throw new E() { }; } finally { } }
        switch (a) { case 1: foo(); default: return bar(); }
    }
    int[] array() { return xs; } int twin(int a) { return a; }
    /* c */ void /* d */ spaced /* e */ (int a) /* f */ { }
    String block() { return """
        } not code { "
        """; }
    enum Kind { A(1) { int f() { return 1; } }, B(2); Kind(int i) { } }
}
// trailing }'''

FOUND = ["toString", "generic", "run", "array", "twin", "spaced", "block", "f"]


def snapshot(source, seq=1, repo="o/r", branch="main", name="Foo.java"):
    return (repo, branch, f"h{seq}", seq, name, source)


def extract(frame, *rows):
    return harvest.extract_methods(frame(list(rows), SCHEMA)).orderBy("repo", "commit_seq", "ordinal").collect()


def test_methods_of_a_class(frame):
    rows = extract(frame, snapshot(SOURCE))
    assert [r.method_name for r in rows] == FOUND
    code = {r.method_name: r.method_code for r in rows}
    lines = SOURCE.split("\n")
    assert code["toString"] == "\n".join(lines[14:17])
    assert code["generic"].startswith("    <A extends B>") and code["generic"].endswith("\n    }")
    assert code["run"] == "            public void run() { go(); }"
    assert code["array"] == code["twin"] == "    int[] array() { return xs; } int twin(int a) { return a; }"
    assert code["block"].endswith('""; }') and code["block"].count("\n") == 2


def test_line_ends_do_not_matter(frame):
    unix = [(r.method_name, r.method_code) for r in extract(frame, snapshot(SOURCE))]
    windows = [(r.method_name, r.method_code) for r in extract(frame, snapshot(SOURCE.replace("\n", "\r\n")))]
    assert unix == windows


@pytest.mark.parametrize("source", ["class A { void f() { }", "class A { void f() { } } }", "} void f() { } {", "void f();", "x", "\n"])
def test_unbalanced_or_bodyless_files_yield_nothing(frame, source):
    assert extract(frame, snapshot(source)) == []


def test_one_bad_file_does_not_spoil_the_others(frame):
    rows = extract(frame, snapshot("class A { void f() {", 1), snapshot("class A { void g() { } }", 2))
    assert [r.method_name for r in rows] == ["g"]


def test_equal_snapshots_each_count(frame):
    row = snapshot("class A { void f() { } void g() { } }")
    assert [r.method_name for r in extract(frame, row, row, row)] == ["f"] * 3 + ["g"] * 3


SCOPES = """class A<K> {
    <T extends List<List<T>>> A(T t) { }
    public <T> A(Map<T, K> t) { }
    @Inject <T> A(T t, int b) { }
    int f()[] { return null; }
    Map<K, List<K>>[] g(int a)[ ] [] throws E { return null; }
    static <T> T h() { Runnable r = () -> { int no(int a) { } }; if (a < b) { int never() { } } return null; }
    Outer<K>.Inner i() { return new Outer<K>.Inner() { List<K>j() { return null; } }; }
    enum E { ONE(1) { int k() { } }, @Old TWO { int l() { } }; E() { } }
    record R<X>(X x) implements Q<X> { X m() { return x; } R { f(); } }
    @interface N { String value() default "x"; }
    int[] xs = { 1, 2 }; static { int no() { } } { int no() { } }
    void n() { switch (a) { case 1: { int no() { } } default -> { int no() { } } } class L { void o() { } } }
}
void top() { }"""


@pytest.mark.parametrize("block", [harvest.BLOCK, 7, 1])
def test_methods_stand_among_members_of_types(frame, block):
    rows = harvest.extract_methods(frame([snapshot(SCOPES)], SCHEMA), block).orderBy("ordinal").collect()
    assert [r.method_name for r in rows] == ["f", "g", "h", "i", "j", "k", "l", "m", "n", "o", "top"]
    lines = SCOPES.split("\n")
    assert all(r.method_code == next(x for x in lines if f" {r.method_name}(" in x or f">{r.method_name}(" in x) for r in rows)


def generated(rng, size):
    """A class with methods in nested classes, over lines of any length and stretches without a structural character."""
    parts, open_types, open_method = ["class C", "{"], 1, False
    for _ in range(size):
        turn = rng.random()
        if open_method:
            parts += ["}"] if turn < 0.4 else [f"x = f ( {rng.randint(0, 9)} ) ;"]
            open_method = turn >= 0.4
        elif turn < 0.5:
            parts += ["int", f"m{rng.randint(0, 99)}()", "{"]
            open_method = True
        elif turn < 0.7:
            parts += [f"class T{rng.randint(0, 9)}", "{"]
            open_types += 1
        elif turn < 0.85 and open_types > 1:
            parts.append("}")
            open_types -= 1
        else:
            parts.append("int a = 1 ;")
        parts.append(rng.choice(["\n", "\n", " ", "\n\n", "/* } */", "// {\n"]))
    return " ".join(parts + ["}"] * (open_types + open_method))


@pytest.mark.parametrize("block", [1, 2, 5, 64])
def test_any_size_of_blocks_gives_the_same_methods(frame, block):
    rng = random.Random(block)
    sources = [generated(rng, rng.choice([3, 40, 300])) for _ in range(12)] + ["class A { int m1() {", "x"]
    rows = frame([snapshot(s, i) for i, s in enumerate(sources)], SCHEMA)
    found = harvest.extract_methods(rows, block).orderBy("commit_seq", "ordinal").collect()
    whole = harvest.extract_methods(rows, 10_000).orderBy("commit_seq", "ordinal").collect()
    assert found == whole and len(found) > 100
    assert {r.commit_seq for r in found} <= set(range(12))


def test_a_large_file_is_the_work_of_many_tasks(spark, frame):
    method = "  int m%d(int a) throws E {\n    if (a > 0) { return f(a); }\n    return 0; /* } */\n  }\n"
    source = "class A {\n" + "".join(method % i for i in range(60_000)) + "}\n"
    assert len(source) > 5_000_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = frame([snapshot(source)], SCHEMA)
        rows = harvest.extract_methods(files).select("ordinal", "method_name", F.hash("method_code").alias("h")).collect()
        blocks = harvest.cut_files(files)
        dealt = harvest._segments(blocks).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.ordinal, r.method_name) for r in rows) == [(i, f"m{i}") for i in range(60_000)]
    assert len(dealt) == 4 and max(r["count"] for r in dealt) < 0.5 * sum(r["count"] for r in dealt)
    assert blocks.count() > 500


def test_no_text_is_sorted_or_gathered_per_file(spark, frame):
    blocks = harvest.cut_files(frame([snapshot(SOURCE)], SCHEMA))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        segments = harvest._measured(harvest._segments(blocks))
        cut = segments._jdf.queryExecution().executedPlan().toString()
        plan = harvest.extract_methods(frame([snapshot(SOURCE)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert cut.count("Exchange") == 1 and "Aggregate" not in cut and "Python" not in cut + plan
    # A method's text is gathered from its blocks; files and blocks are joined without a sort.
    assert plan.count("ObjectHashAggregate") == 2 and "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan


def test_repository_join_and_file_filter(frame):
    repositories = frame([("a", "main", "Java"), ("b", "dev", "Java"), ("c", "main", "Go")], "name string, defaultBranch string, mainLanguage string")
    listed = harvest.java_repositories(repositories)
    assert {r.name for r in listed.collect()} == {"a", "b"}
    snapshots = frame(
        [snapshot("x", i, repo, branch, name) for i, (repo, branch, name) in enumerate(
            [("a", "main", f"F{j}.java") for j in range(50)] + [("a", "dev", "G.java"), ("b", "dev", "H.txt"), ("b", "dev", "I.java"), ("c", "main", "J.java")]
        )] + [snapshot("", 99, "a", "main", "Empty.java"), snapshot(None, 98, "a", "main", "Null.java")],
        SCHEMA,
    )
    files = harvest.repository_files(listed, snapshots)
    assert files.count() == 54 and files.columns == snapshots.columns
    assert sorted(r.file_name for r in harvest.java_files(files).collect()) == sorted([f"F{j}.java" for j in range(50)] + ["I.java"])


def test_provenance(frame):
    row = harvest.with_provenance(harvest.extract_methods(frame([snapshot("class A { void f() { } }", 7)], SCHEMA))).head()
    assert row.asDict() == {
        "branch": "main", "commit_hash": "h7", "file_name": "Foo.java", "method_name": "f",
        "method_code": "class A { void f() { } }", "commit_link": "https://github.com/o/r/commit/h7",
    }


@pytest.mark.parametrize("limit", [0, 1, 7, 50, 299, 300, 301, 10_000])
def test_cap_equals_sorting(spark, limit):
    random.seed(5)
    rows = [(random.choice("abc"), random.randint(0, 4), random.choice("xyz"), random.randint(0, 5)) for _ in range(300)]
    methods = spark.createDataFrame(rows, "repo string, commit_seq bigint, file_name string, ordinal int")
    capped = sorted(map(tuple, harvest.cap_methods(methods, limit).collect()))
    assert capped == sorted(rows)[:limit]


@pytest.mark.parametrize("limit", [0, 1, 4, 7, 50])
def test_cap_with_nulls_and_ties(spark, limit):
    rows = [(random.choice(["a", None]), random.choice([1, 2, None]), random.choice(["x", None]), random.choice([0, None]),
             random.choice(["main", "dev", None]), f"h{i}") for i in range(30)]
    schema = "repo string, commit_seq bigint, file_name string, ordinal int, branch string, commit_hash string"
    ordered = sorted(rows, key=lambda row: [(value is not None, value if value is not None else 0) for value in row])
    capped = harvest.cap_methods(spark.createDataFrame(rows, schema), limit).collect()
    assert sorted(map(str, map(tuple, capped))) == sorted(map(str, ordered[:limit]))


@pytest.mark.parametrize("limit", [3, 10, 25])
def test_cap_in_list_order_and_by_text(spark, limit):
    """Snapshots that are equal in all but their text are told apart by it, in every layout alike."""
    rows = [(9 - i // 10, f"r{i // 10}", 1, "A.java", 0, f"int f{i}()") for i in range(30)]
    schema = "listed bigint, repo string, commit_seq bigint, file_name string, ordinal int, method_code string"
    first, second = (
        harvest.cap_methods(spark.createDataFrame(r, schema).repartition(k), limit) for r, k in ((rows, 2), (rows[::-1], 5))
    )
    assert first.columns == [part.split()[0] for part in schema.split(", ")]
    kept = sorted(map(tuple, first.collect()))
    assert kept == sorted(map(tuple, second.collect())) and len(kept) == limit
    whole = [r for r in rows if r[0] < kept[-1][0]]
    assert kept[0][0] == 7 and set(whole) <= set(kept)


def test_unbalanced_parentheses(spark):
    broken = "class A {\n void broken( { }\n int f() { return 1; }\n}\n"
    files = spark.createDataFrame([("r", "main", "h", 1, "A.java", broken)],
        "repo string, branch string, commit_hash string, commit_seq bigint, file_name string, source_code string")
    assert harvest.extract_methods(files).collect() == []


def test_segments_of_a_task_are_bounded(spark):
    """Adaptive execution would merge these blocks into a task or two, as their texts take few bytes."""
    code = "class A {" + "int f() { return 1; }" * 1000 + "}"
    files = spark.createDataFrame([(i, code) for i in range(40)], "id int, source_code string")
    blocks = harvest.cut_files(files)
    dealt = harvest._dealt(blocks, per_task=2000)
    held = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(F.size("segments")).alias("n")).collect()
    total = sum(r.n for r in held)
    assert total == blocks.agg(F.sum(F.size("segments"))).head()[0] > 40 * 3000
    assert dealt.rdd.getNumPartitions() >= total // 2000 and max(r.n for r in held) < 10_000
    assert harvest._dealt(blocks).rdd.getNumPartitions() <= 4


def test_tables_as_long_as_the_input_are_not_broadcast(frame, monkeypatch):
    plans, write = {}, harvest.write_table

    def recorded(table, name):
        plans[name] = table._jdf.queryExecution().executedPlan().toString()
        return write(table, name)

    monkeypatch.setattr(harvest, "write_table", recorded)
    found = harvest.extract_methods(frame([("a", "b", "c", 1, "F.java", SOURCE)], SCHEMA), 16)
    assert found.count() > 0
    assert "SortMergeJoin" in plans["found"] and "Broadcast" not in plans["found"]
