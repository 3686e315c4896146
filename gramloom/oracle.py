"""The registered queries in DuckDB SQL, written independently of the Spark plans.

Counting goes position by position instead of by roll-up, scoring uses wide
joins instead of exploded lookups, and harvesting works on single lexemes
instead of segments, so agreement is evidence.
"""

from __future__ import annotations

# Fixed values, stated apart from the engine's so that a slip in either shows.
BOILERPLATE_PATTERNS = (
    r"\bset[A-Z][a-zA-Z0-9_]*\([^\n]*\)\s*\{",
    r"\bget[A-Z][a-zA-Z0-9_]*\([^\n]*\)\s*\{",
    r"\bto(String|Array)\(\)\s*\{",
    r"\bhash(Code|)\(\)\s*\{",
    r"\bequals\(Object\s+\w+\)\s*\{",
    r"\bclone\(\)\s*\{",
    r"^\s*@Override\s*\n",
)
CONTROL_WORDS = (
    "assert", "case", "catch", "do", "else", "for", "if", "instanceof", "new", "return", "super", "switch",
    "synchronized", "this", "throw", "try", "while", "yield",
)
NOT_A_TYPE = (
    "assert", "case", "do", "else", "instanceof", "new", "private", "protected", "public", "record", "return", "throw",
)
PUNCTUATION = (
    "!", "%", "&", "(", ")", "*", "+", ",", "-", ".", "/", ":", ";", "<", "=", ">", "?", "@", "[", "]", "^",
    "{", "|", "}", "~",
)
OPERATORS = ("!", "%", "&", "*", "+", "-", "/", "<", "=", ">", "?", "[", "]", "^", "|", "~")

# The fixtures, stated apart from the engine's.
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

# Eight consecutive methods make one class.
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


K = 0.01
LAMBDA = 0.4


# The lexemes.  RE2 never recurses and has no possessive quantifiers.
_JAVA_SPACE = r"\t-\r\x1C-\x20\x85\p{Z}"
_JAVA_BREAKS = r"\n-\r\x1C-\x1E\x85\x{2028}\x{2029}"
_JAVA_WORD = r"[\p{L}\p{Nl}\p{No}_$][\p{L}\p{N}_$]*"
_JAVA_LEXEMES = (
    _JAVA_WORD,
    r"//[^\n]*",
    r"/\*[\s\S]*?\*/",
    r'"""\n(?:[^"\\]|\\[\s\S]|""?[^"\\]|""?\\[\s\S])*(?:""")?',
    r'"(?:[^"\\]|\\[\s\S])*"?',
    r"'\\[\s\S]'|'[^\\]'|'\\u[0-9a-fA-F]{4}'",
    r"@[\p{L}\p{Nl}\p{No}_][\p{L}\p{N}_.]*",
    r"(?:[0-9][0-9_]*\.(?:[0-9][0-9_]*)?|\.[0-9][0-9_]*)(?:[eE][+-]?[0-9][0-9_]*)?[fFdD]?",
    r"[0-9][eE][+-]?[0-9][0-9_]*[fFdD]?",
    r"[0-9][fFdD]",
    r"0[xX][0-9a-fA-F][0-9a-fA-F_]*[lL]?",
    r"0[bB][01][01_]*[lL]?",
    r"0[0-7_]+[lL]?",
    r"0|[1-9][0-9_]*[lL]?",
    f"[^{_JAVA_SPACE}]",
)
_JAVA_STRING_PIECE = r'"""\n|"""|[^\\"]+|\\\\|\\"|\\|"'


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _texts(values: tuple[str, ...]) -> str:
    return ", ".join(_text(value) for value in values)


_LEXEME = _text("|".join(_JAVA_LEXEMES))
_LEXEME_OR_SPACE = _text("|".join([f"[{_JAVA_SPACE}]+", *_JAVA_LEXEMES]))
_UNIFIED = "replace(replace({code}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
_INPUT = f"(trim({_UNIFIED}, chr(10)) || chr(10))"
_IS_COMMENT = "(starts_with(x, '//') OR starts_with(x, '/*'))"


def _tokens(code: str) -> str:
    found = f"regexp_extract_all({_INPUT.format(code=code)}, {_LEXEME})"
    pieces = f"regexp_extract_all(x, {_text(_JAVA_STRING_PIECE)})"
    return (
        f"flatten(list_transform(list_filter({found}, lambda x: NOT {_IS_COMMENT}), "
        f"lambda x: CASE WHEN starts_with(x, '\"') THEN {pieces} ELSE [x] END))"
    )


def _stripped(code: str) -> str:
    found = f"regexp_extract_all({_INPUT.format(code=code)}, {_LEXEME_OR_SPACE})"
    return f"""coalesce(array_to_string(list_transform(list_filter({found}, lambda x: NOT {_IS_COMMENT}),
      lambda x: CASE WHEN x = '{{' THEN ' {{' || chr(10) WHEN x = '}}' THEN chr(10) || '}}' || chr(10)
        WHEN x = ';' THEN ';' || chr(10) WHEN x IN ({_texts(OPERATORS)}) THEN ' ' || x || ' ' ELSE x END), ''), '')"""


def _normalised(code: str) -> str:
    """Line by line: split, trim, drop blank lines, collapse runs."""
    lines = f"regexp_split_to_array({code}, {_text(f'[{_JAVA_BREAKS}]')})"
    return f"""array_to_string(list_filter(list_transform({lines},
      lambda x: trim(regexp_replace(x, {_text(f"[{_JAVA_SPACE}]+")}, ' ', 'g'))), lambda x: x <> ''), chr(10))"""


_DOCUMENTS = "SELECT doc_id AS method_id, text AS code FROM documents"
_CONVERSATIONS = "SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS method_id, text AS code FROM conversations"
_PAGES = "SELECT page_id AS method_id, html AS code FROM pages"
_BUCKET = "(('0x' || substr(md5('42:' || method_id), 1, 8))::BIGINT % 10)"
_BUCKET_20 = "(('0x' || substr(md5('42:' || method_id), 1, 8))::BIGINT % 20)"
_SPLIT = f"CASE WHEN {_BUCKET} < 8 THEN 'train' WHEN {_BUCKET} = 8 THEN 'val' ELSE 'test' END"


def _tokenised(methods: str) -> str:
    return f"""SELECT method_id, tokens, {_SPLIT} AS split
      FROM (SELECT method_id, {_tokens('code')} AS tokens FROM ({methods}) q) q WHERE len(tokens) > 0"""


def _shown(methods: str) -> str:
    return f"""SELECT method_id, array_to_string(tokens, chr(31)) AS tokens, len(tokens)::INTEGER AS n_tokens
      FROM ({_tokenised(methods)}) t"""


# -- cleaning ----------------------------------------------------------------

_IS_ASCII = r"NOT regexp_matches(code, '[^\x00-\x7F]')"
_IS_BOILERPLATE = f"regexp_matches(code, {_text('|'.join(BOILERPLATE_PATTERNS))})"


def _cleaned(methods: str) -> str:
    return f"""SELECT method_id, code FROM (SELECT method_id, {_normalised('code')} AS code
      FROM (SELECT method_id, {_stripped('code')} AS code FROM ({methods}) m) s) n"""


def _non_empty(methods: str) -> str:
    return f"SELECT * FROM ({_cleaned(methods)}) c WHERE code <> ''"


def _distinct(methods: str) -> str:
    return f"SELECT min(method_id) AS method_id, code FROM ({_non_empty(methods)}) c GROUP BY code"


def _bounds(methods: str) -> str:
    return f"""SELECT round(quantile_cont(length(code), 0.05), 6) AS lower_bound,
      round(quantile_cont(length(code), 0.95), 6) AS upper_bound FROM ({methods}) b"""


def _trimmed(methods: str) -> str:
    return f"""SELECT m.* FROM ({methods}) m, ({_bounds(methods)}) b
      WHERE length(code) BETWEEN lower_bound AND upper_bound"""


def _ascii_distinct(methods: str) -> str:
    return f"SELECT * FROM ({_distinct(methods)}) d WHERE {_IS_ASCII}"


def _chain(methods: str) -> str:
    return f"SELECT method_id, code FROM ({_trimmed(_ascii_distinct(methods))}) t WHERE NOT {_IS_BOILERPLATE}"


_NON_EMPTY = _non_empty(JAVA_METHODS)
_DISTINCT = _distinct(JAVA_METHODS)
_ASCII_DISTINCT = _ascii_distinct(JAVA_METHODS)
_CHAIN = _chain(JAVA_METHODS)
_NUMBERED_CHAIN = f"SELECT row_number() OVER (ORDER BY method_id) - 1 AS method_id, code FROM ({_CHAIN}) c"

_FUNNEL = f"""
WITH counts AS (SELECT
  (SELECT count(*) FROM ({_cleaned(JAVA_METHODS)}) c) AS raw,
  (SELECT count(*) FROM ({_NON_EMPTY}) c) AS non_empty,
  (SELECT count(*) FROM ({_DISTINCT}) c) AS distinct_texts,
  (SELECT count(*) FROM ({_ASCII_DISTINCT}) c) AS plain,
  (SELECT count(*) FROM ({_trimmed(_ASCII_DISTINCT)}) c) AS trimmed,
  (SELECT count(*) FROM ({_CHAIN}) c) AS kept)
SELECT 1::INTEGER AS step, 'comment_only' AS stage, raw AS rows_in, non_empty AS rows_out, raw - non_empty AS removed,
  NULL::DOUBLE AS lower_bound, NULL::DOUBLE AS upper_bound FROM counts
UNION ALL SELECT 2, 'duplicates', non_empty, distinct_texts, non_empty - distinct_texts, NULL, NULL FROM counts
UNION ALL SELECT 3, 'non_ascii', distinct_texts, plain, distinct_texts - plain, NULL, NULL FROM counts
UNION ALL SELECT 4, 'length', plain, trimmed, plain - trimmed, lower_bound, upper_bound
  FROM counts, ({_bounds(_ASCII_DISTINCT)}) b
UNION ALL SELECT 5, 'boilerplate', trimmed, kept, trimmed - kept, NULL, NULL FROM counts
"""

# -- counting and scoring ----------------------------------------------------


def _positions(n: int, source: str, where: str) -> str:
    """One row per window of the padded methods: `method_id, pos, t_0 .. t_<n-1>`."""
    padded = f"list_concat(list_concat(list_transform(range({n - 1}), lambda i: '<START>'), tokens), ['<END>'])"
    following = ", ".join(f"lead(t_0, {i}) OVER w AS t_{i}" for i in range(1, n))
    windows = f"""SELECT *{", " + following if following else ""} FROM (
        SELECT method_id, unnest(padded) AS t_0, generate_subscripts(padded, 1) - 1 AS pos
        FROM (SELECT method_id, {padded} AS padded FROM {source} WHERE {where}) l) u
      WINDOW w AS (PARTITION BY method_id ORDER BY pos)"""
    return f"SELECT * FROM ({windows}) x WHERE t_{n - 1} IS NOT NULL"


def _key(first: int, last: int) -> str:
    """Key of the tokens first .. last of a window; the empty string when there are none."""
    tokens = [f"t_{i}" for i in range(first, last + 1)]
    return f"concat_ws(chr(31), {', '.join(tokens)})" if tokens else "''"


def _model_tables(n: int, source: str, where: str, tag: str = "") -> str:
    """CTEs `ngrams`, `contexts`, `size` for one n, with a suffix to tell several models apart."""
    grams = " UNION ALL ".join(
        f"SELECT {m} AS m, {_key(0, m - 1)} AS ctx, t_{m} AS target, method_id, pos FROM windows{tag}" for m in range(n)
    )
    return f"""
windows{tag} AS MATERIALIZED ({_positions(n, source, where)}),
ngrams{tag} AS MATERIALIZED (
  SELECT m, ctx, target, count(*) AS c, min(method_id * 2147483648 + pos) AS first_seen FROM ({grams}) g GROUP BY ALL),
contexts{tag} AS MATERIALIZED (
  SELECT m, ctx, sum(c)::BIGINT AS cc, first(target ORDER BY c DESC, first_seen) AS pred FROM ngrams{tag} GROUP BY m, ctx),
size{tag} AS MATERIALIZED (
  SELECT count(*) AS v FROM (SELECT unnest(tokens) AS t FROM {source} WHERE {where}
    UNION SELECT '<START>' UNION SELECT '<END>') w)"""


def _with_probability(n: int, asked: str, tag: str = "") -> str:
    """`asked(ctx_0 .. ctx_<n-1>, target, ...)` plus `p` and `pred`, by one join per context length."""
    sql = f"""SELECT a.*, k{n - 1}.pred AS pred, v, {", ".join(f"k{m}.cc AS cc_{m}, g{m}.c AS c_{m}" for m in range(n))}
      FROM ({asked}) a, size{tag}"""
    for m in range(n):
        sql += f"""
      LEFT JOIN contexts{tag} k{m} ON k{m}.m = {m} AND k{m}.ctx = a.ctx_{m}
      LEFT JOIN ngrams{tag} g{m} ON g{m}.m = {m} AND g{m}.ctx = a.ctx_{m} AND g{m}.target = a.target"""
    for m in range(n):
        own = f"(coalesce(c_{m}, 0) + {K}) / (cc_{m} + {K}::DOUBLE * v)"
        if m == 0:
            p = own
        else:
            weight = f"({LAMBDA} + (1 - {LAMBDA}::DOUBLE) * least(1.0, cc_{m} / 10.0))"
            p = f"CASE WHEN cc_{m} IS NULL THEN p_{m - 1} ELSE {weight} * {own} + (1 - {weight}) * p_{m - 1} END"
        sql = f"SELECT *, {p} AS p_{m} FROM ({sql}) s{m}"
    return f"SELECT *, p_{n - 1} AS p FROM ({sql}) s"


def _asked(n: int, source: str, where: str) -> str:
    contexts = ", ".join(f"{_key(n - 1 - m, n - 2)} AS ctx_{m}" for m in range(n))
    return f"SELECT method_id, pos, t_{n - 1} AS target, {contexts} FROM ({_positions(n, source, where)}) e"


def _metrics(n: int, scored: str, tag: str = "") -> str:
    plain = f"target NOT IN ({_texts(PUNCTUATION)})"
    return f"""SELECT {n}::INTEGER AS n,
      avg(CASE WHEN pred IS NOT DISTINCT FROM target THEN 1.0 ELSE 0.0 END) AS accuracy,
      pow(2, -avg(log2(p))) AS perplexity,
      pow(2, -avg(log2(p)) FILTER (WHERE {plain})) AS perplexity_no_punctuation,
      (SELECT v FROM size{tag}) AS vocabulary_size FROM ({scored}) e"""


def _shown_metrics(decimals: tuple[int, int] = (6, 4)) -> str:
    """The metric columns rounded: accuracy, perplexities."""
    accuracy, perplexity = decimals
    return f"""n, round(accuracy, {accuracy}) AS accuracy, round(perplexity, {perplexity}) AS perplexity,
      round(perplexity_no_punctuation, {perplexity}) AS perplexity_no_punctuation, vocabulary_size"""


def _evaluated(n: int, source: str, train: str, test: str) -> str:
    tag = f"_{n}"
    return f"""{_model_tables(n, source, train, tag)},
metrics{tag} AS MATERIALIZED ({_metrics(n, _with_probability(n, _asked(n, source, test), tag), tag)})"""


_TRAIN, _VAL, _TEST = "split = 'train'", "split = 'val'", "split = 'test'"
_DOCS = f"WITH docs AS MATERIALIZED ({_tokenised(_DOCUMENTS)})"
_TRIGRAM = f"{_DOCS}, {_model_tables(3, 'docs', _TRAIN)}"
_ALL_COUNTS = f"{_DOCS}, {_model_tables(3, 'docs', 'true')}"
_SCORED = _with_probability(3, _asked(3, "docs", _TEST))
_POSITIONS = f"""{_TRIGRAM} SELECT 3::INTEGER AS n, method_id, pos::INTEGER AS pos, ctx_2 AS ctx, target, pred,
      round(p, 10) AS p, pred IS NOT DISTINCT FROM target AS correct, target IN ({_texts(PUNCTUATION)}) AS is_punct
      FROM ({_SCORED}) s"""

_TRIGRAM_METRICS = f"{_TRIGRAM} SELECT {_shown_metrics()} FROM ({_metrics(3, _SCORED)}) m"

_ORDERS = range(2, 8)


def _comparison_of(source: str) -> str:
    """CTEs up to `comparison`, one row of validation metrics per order."""
    models = ", ".join(_evaluated(n, source, _TRAIN, _VAL) for n in _ORDERS)
    union = " UNION ALL ".join(f"SELECT * FROM metrics_{n}" for n in _ORDERS)
    return f"{models}, comparison AS MATERIALIZED ({union})"


def _compared(methods: str) -> str:
    return f"""WITH corpus AS MATERIALIZED ({_tokenised(methods)}),
{_comparison_of("corpus")}"""


_COMPARISON = _compared(JAVA_METHODS)


def _final(comparison: str) -> str:
    """The test metrics of every order, of which the chosen one is kept."""
    train_and_val = "split IN ('train', 'val')"
    models = []
    for n in _ORDERS:
        tag = f"_f{n}"
        scored = _with_probability(n, _asked(n, "corpus", _TEST), tag)
        models.append(f"{_model_tables(n, 'corpus', train_and_val, tag)}, metrics{tag} AS ({_metrics(n, scored, tag)})")
    union = " UNION ALL ".join(f"SELECT * FROM metrics_f{n}" for n in _ORDERS)
    return f"""{comparison}, {", ".join(models)}
      SELECT {_shown_metrics()} FROM ({union}) f WHERE n = (SELECT n FROM comparison ORDER BY perplexity, n LIMIT 1)"""


_PREDICT = f"""{_TRIGRAM},
asked AS (SELECT method_id, pos::INTEGER AS pos, {_key(1, 2)} AS ctx_2,
    {_key(2, 2)} AS ctx_1, '' AS ctx_0 FROM ({_positions(4, 'docs', _TEST)}) p),
found AS (SELECT a.*, k2.pred IS NOT NULL AS has_2, k1.pred IS NOT NULL AS has_1,
    coalesce(k2.pred, k1.pred, k0.pred) AS target
  FROM asked a LEFT JOIN contexts k2 ON k2.m = 2 AND k2.ctx = ctx_2
    LEFT JOIN contexts k1 ON k1.m = 1 AND k1.ctx = ctx_1 LEFT JOIN contexts k0 ON k0.m = 0)
SELECT method_id, pos, 3::INTEGER AS n, (CASE WHEN has_2 THEN 2 WHEN has_1 THEN 1 ELSE 0 END)::INTEGER AS matched,
  target AS pred, round(p, 10) AS p FROM ({_with_probability(3, 'SELECT * FROM found')}) s"""

# -- harvesting --------------------------------------------------------------

_SNAPSHOTS = FILE_SNAPSHOTS.replace("{body}", "string_agg(code, chr(10) ORDER BY method_id)").replace(
    "{methods}", JAVA_METHODS
)
_JAVA_REPOS = f"SELECT * FROM ({REPOSITORIES}) r WHERE mainLanguage = 'Java'"
_REPO_FILES = f"""SELECT s.* FROM ({_SNAPSHOTS}) s JOIN ({_JAVA_REPOS}) r
  ON s.repo = r.name AND s.branch = r.defaultBranch"""
_JAVA_FILES = f"SELECT * FROM ({_REPO_FILES}) f WHERE file_name LIKE '%.java' AND length(source_code) > 0"
# Snapshots of the fixture have distinct commits, so commit_seq names the file.
_WORD = f"(?:{_JAVA_WORD})"
_PEELED = "said"
for _ in range(6):  # type arguments of the fixture nest less deeply
    _PEELED = f"regexp_replace({_PEELED}, '< [^<>]*>', '', 'g')"
_PEELED = f"trim(regexp_replace({_PEELED}, ' +', ' ', 'g'))"
_HEADER = _text(f"(?:^| )({_WORD}|\\]) ({_WORD})$")
_TYPE = _text(f"(?:^| )(class|@?interface|enum|record) {_WORD}")
_NEW = _text(f"(?:^| )(new|record) {_WORD}( [.] {_WORD})*$")
_CALLED = _text(f"^(, )?(@[^ ]+ )*{_WORD}$")
_CODE = _text(r"(^|[\]=,:]|(^| )(static|else|try|do|finally))$")
_BODY = _text(r"^(\[ \] ?)*(throws .*)?$")
_EXTRACTED = f"""
WITH files AS MATERIALIZED (
  SELECT * REPLACE ({_UNIFIED.format(code='source_code')} AS source_code) FROM ({_JAVA_FILES}) j),
cut AS (SELECT commit_seq AS f, unnest(found) AS x, generate_subscripts(found, 1) AS raw_pos
  FROM (SELECT commit_seq, regexp_extract_all(source_code, {_LEXEME_OR_SPACE}) AS found FROM files) r),
lined AS (SELECT f, x, raw_pos, coalesce(sum(len(x) - len(replace(x, chr(10), ''))) OVER (
    PARTITION BY f ORDER BY raw_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS line FROM cut),
lexemes AS MATERIALIZED (SELECT f, x, line, row_number() OVER (PARTITION BY f ORDER BY raw_pos) AS pos,
    x IN ('(', ')', '{{', '}}', ';') AS stops
  FROM lined WHERE NOT {_IS_COMMENT} AND trim(regexp_replace(x, {_text(f"[{_JAVA_SPACE}]+")}, '', 'g')) <> ''),
depths AS (SELECT *, lag(x) OVER w AS before_1,
    sum(CASE x WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) OVER w AS braces,
    sum(CASE x WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER w AS parens,
    count(*) FILTER (WHERE stops) OVER (PARTITION BY f ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seg
  FROM lexemes WINDOW w AS (PARTITION BY f ORDER BY pos)),
started AS (SELECT *, last_value(CASE WHEN before_1 IS NULL OR before_1 IN ('{{', '}}', ';') THEN line END IGNORE NULLS)
    OVER (PARTITION BY f ORDER BY pos) AS statement_line FROM depths),
said AS (SELECT f, seg, coalesce(string_agg(CASE WHEN starts_with(x, '"') OR starts_with(x, chr(39)) THEN '""' ELSE x END, ' '
    ORDER BY pos) FILTER (WHERE NOT stops), '') AS said FROM started GROUP BY f, seg),
stops AS (SELECT s.*, t.said, {_PEELED} AS peeled,
    CASE WHEN x IN ('{{', '}}') THEN 'b' WHEN x IN ('(', ')') THEN 'p' END AS family,
    CASE x WHEN '{{' THEN braces WHEN '}}' THEN braces + 1 WHEN '(' THEN parens WHEN ')' THEN parens + 1 END AS level
  FROM started s JOIN said t USING (f, seg) WHERE stops),
matched AS MATERIALIZED (SELECT *, lead(pos) OVER p AS partner, lag(pos) OVER p AS opener, lead(pos) OVER s AS next_pos,
    lag(pos) OVER s AS pos_before, lag(x) OVER s AS stop_before
  FROM stops WINDOW p AS (PARTITION BY f, family, level ORDER BY pos), s AS (PARTITION BY f ORDER BY pos)),
balanced AS (SELECT f FROM matched GROUP BY f
  HAVING sum(CASE x WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END) = 0 AND min(braces) >= 0
    AND sum(CASE x WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) = 0 AND min(parens) >= 0),
braces AS (SELECT e.f, e.pos, e.level, CASE
    WHEN e.said LIKE '%- >' THEN false
    WHEN regexp_matches(e.said, {_TYPE}) THEN true
    WHEN e.stop_before = ')' THEN e.said LIKE 'implements %' OR coalesce(regexp_matches(o.peeled, {_NEW})
      OR (regexp_matches(o.peeled, {_CALLED}) AND regexp_extract(o.peeled, '[^ ]+$') NOT IN ({_texts(CONTROL_WORDS)})), false)
    ELSE NOT regexp_matches(e.said, {_CODE}) END AS holds_members
  FROM matched e LEFT JOIN matched c ON c.f = e.f AND c.pos = e.pos_before AND c.x = ')'
    LEFT JOIN matched o ON o.f = c.f AND o.pos = c.opener AND o.x = '(' WHERE e.x = '{{'),
headers AS (SELECT h.f, h.pos, h.braces, regexp_extract(h.peeled, {_HEADER}, 2) AS method_name,
    h.statement_line AS first_line, e.line AS last_line
  FROM matched h JOIN balanced USING (f)
    JOIN matched c ON c.f = h.f AND c.pos = h.partner
    JOIN matched b ON b.f = h.f AND b.pos = c.next_pos AND b.x = '{{'
    JOIN matched e ON e.f = h.f AND e.pos = b.partner
  WHERE h.x = '(' AND regexp_matches(b.said, {_BODY}) AND regexp_matches(h.peeled, {_HEADER})
    AND regexp_extract(h.peeled, {_HEADER}, 1) NOT IN ({_texts(NOT_A_TYPE)})
    AND regexp_extract(h.peeled, {_HEADER}, 2) NOT IN ({_texts(CONTROL_WORDS)})),
enclosed AS (SELECT h.f, h.pos, arg_max(e.holds_members, e.pos) AS in_type FROM headers h JOIN braces e
    ON e.f = h.f AND e.level = h.braces AND e.pos < h.pos GROUP BY h.f, h.pos),
found AS (SELECT h.* FROM headers h LEFT JOIN enclosed USING (f, pos) WHERE h.braces = 0 OR in_type)
SELECT repo, branch, commit_hash, commit_seq, file_name,
  (row_number() OVER (PARTITION BY f ORDER BY pos) - 1)::INTEGER AS ordinal, method_name,
  array_to_string(string_split(source_code, chr(10))[first_line + 1:last_line + 1], chr(10)) AS method_code
FROM found JOIN files ON files.commit_seq = found.f
"""

_EXACT_SPLIT = """
WITH ranked AS (SELECT doc_id AS method_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS place,
  count(*) OVER () AS total FROM documents),
sized AS (SELECT *, ceil(total * 0.2) AS held_out, ceil(ceil(total * 0.2) * 0.5) AS tested FROM ranked)
SELECT method_id, CASE WHEN place < total - held_out THEN 'train' WHEN place < total - tested THEN 'val'
  ELSE 'test' END AS split FROM sized
"""

_QUICK_BUCKET = "(('0x' || substr(md5('43:' || method_id), 1, 8))::BIGINT % 10)"
_QUICK = f"""
SELECT method_id, CASE WHEN {_QUICK_BUCKET} < 8 THEN 'train' WHEN {_QUICK_BUCKET} = 8 THEN 'val' ELSE 'test' END AS split
FROM (SELECT p_partkey AS method_id, md5('42:' || p_partkey) AS place FROM part) q WHERE {_BUCKET} <> 9
ORDER BY place, method_id LIMIT 1000
"""

_QUICK_COMPARISON = f"""WITH corpus AS MATERIALIZED ({_tokenised(JAVA_METHODS)}),
quick AS MATERIALIZED (SELECT method_id, tokens,
    CASE WHEN {_QUICK_BUCKET} < 8 THEN 'train' WHEN {_QUICK_BUCKET} = 8 THEN 'val' ELSE 'test' END AS split
  FROM (SELECT * FROM corpus WHERE {_BUCKET} <> 9 ORDER BY md5('42:' || method_id), method_id LIMIT 1000) q),
{_comparison_of("quick")}"""

_PADDED = f"""
SELECT method_id, array_to_string(padded, chr(31)) AS tokens, len(padded)::INTEGER AS n_tokens
FROM (SELECT method_id, list_concat(list_concat(['<START>', '<START>'], tokens), ['<END>']) AS padded
  FROM ({_tokenised(JAVA_METHODS)}) t) p
"""

_LINES = rf"""SELECT row_number() OVER (ORDER BY doc_id, place) - 1 AS method_id, code
  FROM (SELECT doc_id, unnest(lines) AS code, generate_subscripts(lines, 1) AS place
    FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS lines FROM documents) d) l
  WHERE regexp_matches(code, '[^{_JAVA_SPACE}]')"""

_FREE = f"""{_TRIGRAM},
asked AS (SELECT method_id, pos::INTEGER AS pos, pos % 4 AS length, t_3 AS target, {_key(1, 2)} AS ctx_2,
    {_key(2, 2)} AS ctx_1, '' AS ctx_0 FROM ({_positions(4, 'docs', _TEST)}) p)
SELECT method_id, pos, target AS token,
  round(CASE length WHEN 0 THEN (coalesce(c_0, 0) + {K}) / (cc_0 + {K}::DOUBLE * v)
    WHEN 1 THEN CASE WHEN cc_1 IS NULL THEN 0 ELSE (coalesce(c_1, 0) + {K}) / (cc_1 + {K}::DOUBLE * v) END
    WHEN 2 THEN CASE WHEN cc_2 IS NULL THEN 0 ELSE (coalesce(c_2, 0) + {K}) / (cc_2 + {K}::DOUBLE * v) END
    ELSE 0 END, 10) AS raw,
  round(CASE length WHEN 0 THEN p_0 WHEN 1 THEN p_1 ELSE p_2 END, 10) AS p
FROM ({_with_probability(3, 'SELECT * FROM asked')}) s"""

_UNCOUNTED = f"""{_TRIGRAM}, words AS (SELECT unnest(tokens) AS token FROM docs WHERE {_TRAIN}
  UNION SELECT '<START>' UNION SELECT '<END>')
SELECT method_id, 3::INTEGER AS n, (SELECT min(token) FROM words) AS pred, round(1.0::DOUBLE / v, 10) AS p
FROM docs, size WHERE {_TEST}"""

ORACLE: dict[str, str] = {
    "tokenize_docs": _shown(_DOCUMENTS),
    "tokenize_conversations": _shown(_CONVERSATIONS),
    "tokenize_pages": _shown(_PAGES),
    "tokenize_java": _shown(JAVA_METHODS),
    "pad_tokens": _PADDED,
    "split_docs": f"SELECT method_id, {_SPLIT} AS split FROM ({_DOCUMENTS}) d",
    "split_docs_30": f"""SELECT method_id, CASE WHEN {_BUCKET_20} < 14 THEN 'train' WHEN {_BUCKET_20} < 17 THEN 'val'
      ELSE 'test' END AS split FROM ({_DOCUMENTS}) d""",
    "exact_split_docs": _EXACT_SPLIT,
    "quick_sample": _QUICK,
    "train_and_validation": f"SELECT method_id, {_SPLIT} AS split FROM ({_DOCUMENTS}) d WHERE {_BUCKET} < 9",
    "strip_comments": f"SELECT method_id, {_stripped('code')} AS code FROM ({JAVA_METHODS}) m",
    "normalise_whitespace": _NON_EMPTY,
    "dedup_code": _DISTINCT,
    "ascii_filter": f"SELECT * FROM ({_NON_EMPTY}) c WHERE {_IS_ASCII}",
    "length_bounds": _bounds(_DOCUMENTS),
    "length_trim": f"SELECT method_id FROM ({_trimmed(_DOCUMENTS)}) t",
    "boilerplate_filter": f"SELECT * FROM ({_NON_EMPTY}) c WHERE NOT {_IS_BOILERPLATE}",
    "clean_chain": _CHAIN,
    "clean_documents": _chain(_DOCUMENTS),
    "clean_funnel": _FUNNEL,
    "vocabulary": f"""{_DOCS} SELECT unnest(tokens) AS token FROM docs
      UNION SELECT '<START>' UNION SELECT '<END>'""",
    "ngram_counts": f"""{_ALL_COUNTS} SELECT 3::INTEGER AS n, m::INTEGER AS m, ctx, target, c,
      (first_seen // 2147483648)::BIGINT AS first_method, (first_seen % 2147483648)::INTEGER AS first_pos FROM ngrams""",
    "context_counts": f"{_ALL_COUNTS} SELECT 3::INTEGER AS n, m::INTEGER AS m, ctx, cc FROM contexts",
    "best_target": f"{_ALL_COUNTS} SELECT 3::INTEGER AS n, m::INTEGER AS m, ctx, pred FROM contexts",
    "raw_probability": f"""{_TRIGRAM} SELECT DISTINCT 3::INTEGER AS n, ctx_2 AS ctx, target,
      round(CASE WHEN cc_2 IS NULL THEN 0.0 ELSE (coalesce(c_2, 0) + {K}) / (cc_2 + {K}::DOUBLE * v) END, 10) AS p
      FROM ({_SCORED}) s""",
    "interpolated_probability": f"""{_TRIGRAM} SELECT DISTINCT 3::INTEGER AS n, ctx_2 AS ctx, target, round(p, 10) AS p
      FROM ({_SCORED}) s""",
    "predict_next": _PREDICT,
    "predict_next_loaded": _PREDICT,
    "free_contexts": _FREE,
    "predict_without_counts": _UNCOUNTED,
    "score_positions": _POSITIONS,
    "score_positions_loaded": _POSITIONS,
    "eval_metrics": _TRIGRAM_METRICS,
    "metrics_report": f"{_TRIGRAM} SELECT {_shown_metrics((3, 3))} FROM ({_metrics(3, _SCORED)}) m",
    "compare_n": f"{_COMPARISON} SELECT {_shown_metrics()} FROM comparison",
    "compare_n_conversations": f"{_compared(_CONVERSATIONS)} SELECT {_shown_metrics()} FROM comparison",
    "select_n": f"{_COMPARISON} SELECT n FROM comparison ORDER BY perplexity, n LIMIT 1",
    "final_model": _final(_COMPARISON),
    "quick_model": _final(_QUICK_COMPARISON),
    "csv_roundtrip": f"SELECT row_number() OVER (ORDER BY method_id) - 1 AS method_id, code FROM ({JAVA_METHODS}) m",
    "column_resolution": f"SELECT method_code AS code FROM ({_EXTRACTED}) e",
    "processed_roundtrip": _shown(_NUMBERED_CHAIN),
    "processed_parquet_roundtrip": _shown(_NUMBERED_CHAIN),
    "text_lines": _shown(_LINES),
    "model_roundtrip": _TRIGRAM_METRICS,
    "metrics_json": _TRIGRAM_METRICS,
    "comparison_json": f"{_COMPARISON} SELECT {_shown_metrics()} FROM comparison",
    "java_repos": _JAVA_REPOS,
    "repo_files": _REPO_FILES,
    "java_files": _JAVA_FILES,
    "extract_methods": _EXTRACTED,
    "method_provenance": f"""SELECT branch, commit_hash, file_name, method_name, method_code,
      concat('https://github.com/', repo, '/commit/', commit_hash) AS commit_link FROM ({_EXTRACTED}) e""",
    "method_cap": f"""SELECT * FROM ({_EXTRACTED}) e
      ORDER BY repo, commit_seq, file_name, ordinal LIMIT 500""",
    "method_cap_listed": f"""SELECT * FROM ({_EXTRACTED}) e
      ORDER BY repo DESC, commit_seq, file_name, ordinal LIMIT 500""",
}
