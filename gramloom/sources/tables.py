"""Corpora built from the given tables by one SQL projection each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramloom.plans.numbers import numbered

JAVA_METHODS = """
SELECT p_partkey AS method_id, CASE
 WHEN p_partkey % 10 = 0 THEN concat('public int get', p_brand_id, '() { return this.f', p_brand_id, '; }')
 WHEN p_partkey % 10 = 1 THEN concat('@Override', chr(10), 'public void run', p_size, '(int a) {', chr(10), '  go(a); }')
 WHEN p_partkey % 10 = 2 THEN concat('// only a comment ', p_name)
 WHEN p_partkey % 10 = 3 THEN concat('int sum', p_size % 5, '(int[] xs) { /* ', p_name, ' */', chr(10), '  int t = 0;', chr(10), '  for (int i=0;i<xs.length;i++) { t+=xs[i]; }  // add', chr(10), '  return t; }')
 WHEN p_partkey % 10 = 4 THEN concat('String s', p_size, '() { return "', p_type, ' // x"; }')
 WHEN p_partkey % 10 = 5 THEN concat('String s() { return "', chr(233), p_name, '"; }')
 WHEN p_partkey % 10 = 6 THEN concat('boolean ok(T o) { if (o.getName().equals("', p_type, '")) { return true; } return false; }')
 WHEN p_partkey % 10 = 7 THEN concat('void w', p_size, '() {', repeat(concat(chr(10), '  call', p_size, '(a, b);'), p_size), ' }')
 WHEN p_partkey % 10 = 8 THEN concat('int max(int a, int b) { return a >= b ? a : b; }')
 ELSE concat('long h', p_size, '(long x) { x ^= (x << ', p_size, '); return x & 0xFFL; }') END AS code
FROM (SELECT *, replace(p_brand, 'Brand#', 'B') AS p_brand_id FROM part) q
"""

REPOSITORIES = """
SELECT concat('org', s_suppkey % 7, '/repo', s_suppkey) AS name,
 CASE WHEN s_suppkey % 3 = 0 THEN 'main' ELSE 'master' END AS defaultBranch,
 CASE WHEN s_suppkey % 10 = 4 THEN 'Python' ELSE 'Java' END AS mainLanguage
FROM supplier
"""

# Eight consecutive methods make one class; `{body}` is their ordered
# concatenation in the dialect at hand.  Some files lie on another branch, some
# have another suffix, some lack their last brace.
FILE_SNAPSHOTS = """
SELECT concat('org', g % 10 % 7, '/repo', g % 10) AS repo,
 CASE WHEN g % 48 = 0 THEN 'dev' WHEN g % 10 % 3 = 0 THEN 'main' ELSE 'master' END AS branch,
 md5(concat('commit', g)) AS commit_hash,
 g AS commit_seq,
 concat('F', g, CASE WHEN g % 40 = 8 THEN '.txt' ELSE '.java' END) AS file_name,
 concat('package p', g % 5, ';', chr(10), 'import java.util.*;', chr(10),
  '/** Holds { some } methods. */', chr(10), '@SuppressWarnings(', chr(34), 'all', chr(34), ')', chr(10),
  'public class F', g, '<T> {', chr(10), '  private int x = 1;', chr(10),
  '  public F', g, '(int a) { this.x = a; }', chr(10), '  F', g, '() { this(1); }', chr(10),
  '  abstract int size(List<String> l);', chr(10),
  body, chr(10),
  '  @Deprecated', chr(10), '  static <A, B> Map<A, List<B>> make(A a, B[] b) throws E, G {', chr(10),
  '    Runnable r = new Runnable() {', chr(10), '      @Override', chr(10),
  '      public void run() { char c = ', chr(39), '{', chr(39), '; }', chr(10), '    };', chr(10),
  '    if (a == null) { return null; } else if (b == null) { r.run(); }', chr(10), '    return null;', chr(10), '  }', chr(10),
  '  <Q extends Comparable<Q>> F', g, '(Q q) { this.x = 2; }', chr(10),
  '  int sizes(int a)[] [ ] { return null; }', chr(10),
  '  Runnable task = () -> { call(new Object() { public String show() { return x; } }); int lost(int a) { return a; } };', chr(10),
  '  enum Kind { ONE(1) { int of() { return 1; } }, TWO { int of() { return 2; } }; Kind() { } Kind(int i) { } }', chr(10),
  '  record Pair<L, R>(L left, R right) implements Q<L> { Map<L, Q<R>>[] both() { return null; } }', chr(10),
  '  void outer() { int inner(int b) { return b; } class Own { void mine() { } } }', chr(10),
  CASE WHEN g % 56 = 16 THEN ' ' ELSE '}' END, chr(10)) AS source_code
FROM (SELECT g, {body} AS body
      FROM (SELECT method_id, code, method_id - method_id % 8 AS g FROM ({methods}) m) n GROUP BY g) f
"""

_SPARK_BODY = "listagg(code, chr(10)) WITHIN GROUP (ORDER BY method_id)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(texts: DataFrame) -> DataFrame:
    """The given tables are files of one row group, which one task would lex; here the rows are dealt out first."""
    return texts.repartition("method_id")


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`method_id, code` from the documents."""
    return _dealt(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("method_id"), F.col("text").alias("code")))


def conversation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`method_id, code` from the conversation turns, numbered in the order of conversation and turn."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("code"))
    return numbered(turns, ["conv_id", "turn"], "method_id").select("method_id", "code")


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`method_id, code` from the pages."""
    return _dealt(table(spark, sf_dir, "pages").select(F.col("page_id").alias("method_id"), F.col("html").alias("code")))


def _over_files(query: str, sf_dir: str, name: str) -> str:
    """The query with one table read from its parquet file."""
    return query.replace(f"FROM {name}", f"FROM parquet.`{sf_dir}/{name}.parquet`")


def java_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`method_id, code`: deterministic Java-like methods from the parts."""
    return _dealt(spark.sql(_over_files(JAVA_METHODS, sf_dir, "part")))


def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_over_files(REPOSITORIES, sf_dir, "supplier"))


def file_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    methods = _over_files(JAVA_METHODS, sf_dir, "part")
    return spark.sql(FILE_SNAPSHOTS.replace("{body}", _SPARK_BODY).replace("{methods}", methods))
