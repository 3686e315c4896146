import random

import pytest
from pyspark.sql import functions as F

from gramloom.functions.grams import gram_key, joinable, readable
from gramloom.functions.lexer import clean_code, normalise_whitespace, strip_comments, tokenize_code

CASES = [
    (None, []),
    ("", []),
    (" \n\t ", []),
    ("// only", []),
    ("/* a\n b */", []),
    ("int a=1;", ["int", "a", "=", "1", ";"]),
    ("a+=b++", ["a", "+", "=", "b", "+", "+"]),
    ("x //c\ny /*d*/z", ["x", "y", "z"]),
    ('"a // b"', ['"', "a // b", '"']),
    (r'"a\"b\\"', ['"', "a", r"\"", "b", r"\\", '"']),
    (r'"\n"', ['"', "\\", "n", '"']),
    ('"open', ['"', "open\n"]),
    ("'{' '\\n' '\\u00e9'", ["'{'", "'\\n'", "'\\u00e9'"]),
    ("@Override @a.B x", ["@Override", "@a.B", "x"]),
    ("1.5e-3f .5 10L 0xFF_FFL 0b01 017 3d 1e5", ["1.5e-3f", ".5", "10L", "0xFF_FFL", "0b01", "017", "3d", "1e5"]),
    ("a.b(c)->d::e", ["a", ".", "b", "(", "c", ")", "-", ">", "d", ":", ":", "e"]),
    ("é_$1 ü z", ["é_$1", "ü", "z"]),
    ("a\r\nb\rc//d\re", ["a", "b", "c", "e"]),
    ('"<END>"', ['"', "<END>", '"']),
]


def test_tokens(spark):
    rows = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "id int, code string")
    got = {r.id: r.t for r in rows.select("id", tokenize_code(F.col("code")).alias("t")).collect()}
    for i, (code, tokens) in enumerate(CASES):
        assert got[i] == tokens, code


def test_tokens_equal_an_independent_lexer(spark):
    lexers = pytest.importorskip("pygments.lexers")
    token = pytest.importorskip("pygments.token").Token
    lexer = lexers.get_lexer_by_name("java")
    random.seed(7)
    parts = ["int", " ", "\n", "x", "=", '"', "\\", "'", "a", "{", "}", "(", ")", ";", "//", "/*", "*/", "1.5f", "0x1F",
             "@A", ".", "9", "é", "\t", "+", " ", " $b ", "_"]
    codes = ["".join(random.choices(parts, k=random.randint(1, 40))) for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(codes)), "id int, code string")
    for row in frame.select("code", tokenize_code(F.col("code")).alias("t")).collect():
        expected = [v for t, v in lexer.get_tokens(row.code) if t not in token.Comment and t not in token.Text.Whitespace]
        assert row.t == expected, row.code


def test_long_literals_and_comments_do_not_overflow(spark):
    text = F.concat(F.lit('x "'), F.repeat(F.lit('ab \\" '), 200_000), F.lit('" /*'), F.repeat(F.lit("* "), 500_000), F.lit("*/ y"))
    row = spark.range(1).select(tokenize_code(text).alias("t")).head()
    assert len(row.t) == 2 + 1 + 400_000 + 1 + 1 and row.t[-1] == "y"


def test_strip_and_normalise(spark):
    code = "int sum(int[] xs) { /* c */\n  int t = 0;\n\n  for (int i=0;i<2;i++) { t+=xs[i]; } // add\n  return t; }"
    row = spark.createDataFrame([(code,)], "code string").select(
        clean_code(F.col("code")).alias("clean"), strip_comments(F.col("code")).alias("stripped")
    ).head()
    assert row.clean == (
        "int sum(int [ ] xs) {\nint t = 0;\nfor (int i = 0;\ni < 2;\ni + + ) {\nt + = xs [ i ] ;\n}\nreturn t;\n}"
    )
    assert "/*" not in row.stripped and "//" not in row.stripped


def test_normalise_matches_line_by_line(spark):
    random.seed(3)
    parts = ["a", "b", " ", "\t", "\n", "\r", "\f", "\v", " ", " ", "\x1c", "\x1f", "　", "\x85"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(2000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", normalise_whitespace(F.col("t")).alias("n")).collect():
        assert row.n == "\n".join(" ".join(line.split()) for line in row.t.splitlines() if line.strip())


def test_keys_are_one_to_one(spark):
    lists = [["a\x1fb", "c"], ["a", "b\x1fc"], ["a", "b", "c"], ["\x1e", "s"], ["\x1es"], ["\x1f"]]
    frame = spark.createDataFrame([(t,) for t in lists], "t array<string>")
    rows = frame.select(gram_key(joinable(F.col("t"))).alias("k"), F.transform(joinable(F.col("t")), readable).alias("back"), "t").collect()
    assert len({r.k for r in rows}) == len(lists)
    assert all(r.back == r.t for r in rows)
