"""Harvesting: from a table of file snapshots to a table of methods.

A snapshot is `repo, branch, commit_hash, commit_seq, file_name, source_code`.
Each source text is cut in place into segments, each ending in one of `( ) { } ;`, so
only structural characters outside strings and comments become rows.  Segments are
dealt by blocks of their file.  A block is reduced to its line feeds, its net depths and the
brackets that it leaves open; a scan over those, one row per block, gives every block its offsets, and
brackets left open meet their partners by level.  So a file of any size is as many tasks' work as
it has blocks, and a method's text is put together from the blocks that hold its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramloom.functions.lexer import (
    BLOCK_COMMENT,
    CHARACTER,
    IDENTIFIER,
    LINE_COMMENT,
    STRING,
    WHITESPACE,
    unify_line_ends,
)
from gramloom.plans.scratch import write_table

# Fixed values.
MAX_METHODS = 25_000
LANGUAGE = "Java"
FILE_SUFFIX = ".java"
HOST = "https://github.com"

# A name before `(` that is no method name.
CONTROL_WORDS = ("if", "for", "while", "switch", "catch", "synchronized", "try", "return", "new", "throw",
                 "assert", "do", "else", "super", "this", "case", "instanceof", "yield")
# A word before the name that is no result type.
NOT_A_TYPE = ("new", "return", "throw", "else", "do", "case", "assert", "instanceof", "record",
              "public", "private", "protected")

_SPACE = f"[{WHITESPACE}]"
_SEGMENT = (
    rf"(?:[^\"'/(){{}};]++|{STRING}|{CHARACTER}|{LINE_COMMENT}|{BLOCK_COMMENT}|[\"'/])*+(?:[(){{}};]|\z)"
)
_LEADING_TRIVIA = rf"^(?:{_SPACE}++|{LINE_COMMENT}|{BLOCK_COMMENT})*+"
_LITERAL_OR_COMMENT = rf"({STRING}|{CHARACTER})|{LINE_COMMENT}|{BLOCK_COMMENT}"
# These look at a segment without its type arguments.
_HEADER = rf"({IDENTIFIER}(?={_SPACE})|\]){_SPACE}*({IDENTIFIER}){_SPACE}*\($"
_ANNOTATED_NAME = rf"@[\p{{L}}\p{{N}}_$.]+{_SPACE}+{IDENTIFIER}{_SPACE}*\($"
# A list of arguments or parameters before a brace that holds members: of a new object, a record, an enum constant.
_HOLDS_TYPE = rf"(?:^|[^\p{{L}}\p{{N}}_$])(?:new|record){_SPACE}+{IDENTIFIER}(?:{_SPACE}*\.{_SPACE}*{IDENTIFIER})*{_SPACE}*\($"
_CALLED = rf"^(?:,{_SPACE}*)?(?:@[\p{{L}}\p{{N}}_$.]+{_SPACE}+)*({IDENTIFIER}){_SPACE}*\($"
# What an opening brace ends.
_BODY_FOLLOWS = rf"^(?:\[{_SPACE}*\]{_SPACE}*)*(?:throws{_SPACE}[^;]*)?\{{$"
_LAMBDA = rf"->{_SPACE}*\{{$"
_TYPE = rf"(?:^|[{WHITESPACE}@])(?:class|interface|enum|record){_SPACE}+{IDENTIFIER}"
_IMPLEMENTS = rf"^implements{_SPACE}"
_BLOCK = rf"(?:^|[=\]:,]|(?:^|{_SPACE})(?:static|else|try|do|finally)){_SPACE}*\{{$"

_TEXT = "_text"
_STATEMENT_ENDS = ("{", "}", ";")

#: Segments of a file that are worked on together.
BLOCK = 512

#: Segments that one task sorts, on average at most; their rows take a few KB each while they are measured.
SEGMENTS_PER_TASK = 3 << 16


def java_repositories(repositories: DataFrame, language: str = LANGUAGE) -> DataFrame:
    return repositories.filter(F.col("mainLanguage") == language)


def repository_files(repositories: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The snapshots of each listed repository's default branch, with `listed` if the list has numbers.

    One repository may own a large part of all files.  Adaptive execution splits
    its partition into as many tasks as its bytes ask for, each with the one short
    row of the list beside it.
    """
    place = [c for c in repositories.columns if c == "listed"]
    listed = repositories.select(F.col("name").alias("repo"), F.col("defaultBranch").alias("branch"), *place)
    return snapshots.join(listed, ["repo", "branch"]).select(*snapshots.columns, *place)


def java_files(files: DataFrame, suffix: str = FILE_SUFFIX) -> DataFrame:
    return files.filter(F.col("file_name").endswith(suffix) & (F.length("source_code") > 0))


def _line_feeds(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def _described(items: DataFrame) -> DataFrame:
    """What is kept of a segment's text: line feeds, and what its bracket opens.

    A step at a time, so that no expression is evaluated twice, and only for the kinds that need it.
    `scope` says what an opening brace holds: code, members of a type, or it depends on the list before it.
    The line feeds that lead a segment are known where a statement starts.
    """
    segment, kind, bare, plain = F.col("segment"), F.col("kind"), F.col("bare"), F.col("plain")
    trimmed = F.btrim(F.regexp_replace(segment, _LITERAL_OR_COMMENT, "$1 "), F.lit(" \t\n\f"))
    after_list = F.coalesce(F.col("before") == ")", F.lit(False))
    scope = (
        F.when(bare.rlike(_LAMBDA), "code")
        .when(bare.rlike(_TYPE) | (after_list & bare.rlike(_IMPLEMENTS)), "type")
        .when(after_list, "list")
        .when(bare.rlike(_BLOCK), "code")
        .otherwise("type")
    )
    opens_statement = F.col("before").isNull() | F.col("before").isin(*_STATEMENT_ENDS)
    name, called = F.col("name"), F.col("called")
    declares = ~name.isin("", *CONTROL_WORDS) & ~F.col("word").isin(*NOT_A_TYPE)
    return (
        items.withColumns(
            {
                "feeds": _line_feeds(segment),
                "leading_feeds": F.when(opens_statement, _line_feeds(F.regexp_extract(segment, _LEADING_TRIVIA, 0))),
                "bare": F.when(kind.isin("(", "{"), trimmed),
            }
        )
        .withColumn("plain", F.when(kind == "(", _without_type_arguments(bare)))
        .withColumns(
            {
                "word": F.regexp_extract(plain, _HEADER, 1),
                "name": F.regexp_extract(plain, _HEADER, 2),
                "called": F.regexp_extract(plain, _CALLED, 1),
            }
        )
        .withColumns(
            {
                "name": F.when(declares & ~plain.rlike(_ANNOTATED_NAME), name),
                "holds_type": F.coalesce(~called.isin("", *CONTROL_WORDS) | plain.rlike(_HOLDS_TYPE), F.lit(False)),
                "body": (kind == "{") & after_list & bare.rlike(_BODY_FOLLOWS),
                "scope": F.when(kind == "{", scope),
            }
        )
        .drop("segment", "bare", "plain", "word", "called")
    )


def _without_type_arguments(bare: Column) -> Column:
    """The text with each `<...>` replaced by a space, the innermost first, however deep they nest."""
    openers = F.length(bare) - F.length(F.replace(bare, F.lit("<"), F.lit("")))
    peeled = F.aggregate(
        F.sequence(F.lit(1), F.greatest(openers, F.lit(1))), bare, lambda text, _: F.regexp_replace(text, "<[^<>]*>", " ")
    )
    return F.when(bare.contains("<"), peeled).otherwise(bare)


def cut_files(files: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of segments on shared storage: `file, block, segments, kinds, feeds, last_start, before, after, snapshot`.

    `kinds` holds the structural character that ends each segment, `feeds` the number of line feeds, and
    `last_start` the place of the statement that runs into the next block.  `before` and `after` are the
    structural characters on either side of the block, `snapshot` the columns of its file, `chunk` a number of its own.
    """
    # The line feed keeps what follows the last structural character apart from it.
    text = F.concat(unify_line_ends(F.col("source_code")), F.lit("\n"))
    snapshot = F.struct(*[c for c in files.columns if c != "source_code"])
    found = F.regexp_extract_all(text, F.lit(_SEGMENT), F.lit(0))
    # Through `explode(array(...))` the text is cut once, however often the segments are named below.
    lexed = files.select(
        F.monotonically_increasing_id().alias("file"), snapshot.alias("snapshot"), F.explode(F.array(found)).alias("found")
    )

    def edge(place: Column) -> Column:
        return F.right(F.get("found", place), F.lit(1))

    first = F.col("block") * block
    numbers = F.sequence(F.lit(0), F.floor((F.size("found") - 1) / block).cast("int"))
    blocks = lexed.withColumn("block", F.explode(numbers)).select(
        "file", "block", F.slice("found", first + 1, F.lit(block)).alias("segments"),
        edge(first - 1).alias("before"), edge(first + block).alias("after"), "snapshot",
    )
    # The text may end in a segment without a structural character, which is no kind.
    kinds = F.array_join(F.transform("segments", lambda s: F.when(_is_stop(s), F.right(s, F.lit(1))).otherwise(" ")), "")
    ended = F.length(F.regexp_extract("kinds", r"^[\s\S]*[{};]", 0))
    starts = (ended > 0) | F.col("before").isNull() | F.col("before").isin(*_STATEMENT_ENDS)
    return write_table(
        blocks.withColumns({"kinds": kinds, "feeds": _line_feeds(F.array_join("segments", ""))}).withColumns(
            {"last_start": F.when(starts & (ended < F.size("segments")), ended), "chunk": F.monotonically_increasing_id()}
        ),
        "segments",
    )


def _is_stop(segment: Column) -> Column:
    return F.right(segment, F.lit(1)).isin("(", ")", "{", "}", ";")


def _dealt(blocks: DataFrame, per_task: int = SEGMENTS_PER_TASK) -> DataFrame:
    """Blocks dealt out so that a task's segments are bounded, however many there are.

    Adaptive execution merges partitions by the bytes of the packed texts, which say little about the rows made of them,
    so from some size on the number of partitions is given.
    """
    spark = blocks.sparkSession
    tasks = (blocks.agg(F.sum(F.size("segments"))).head()[0] or 0) // per_task + 1
    if tasks <= spark.sparkContext.defaultParallelism:
        return blocks.repartition("chunk")
    return blocks.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "chunk")


def _segments(blocks: DataFrame) -> DataFrame:
    """A row per segment: its chunk, place `at` in it, and what it opens; no texts."""
    at = F.col("at")
    # Blocks move to their windows before they are cut up, so texts are searched in as many tasks as there are partitions.
    rows = _dealt(blocks).select(
        "chunk", "before", "after", "kinds", "last_start", F.posexplode("segments").alias("at", "segment")
    )
    edges = {
        "kind": F.substring("kinds", at + 1, F.lit(1)),
        "before": F.when(at == 0, F.col("before")).otherwise(F.substring("kinds", at, F.lit(1))),
        "after": F.when(at == F.length("kinds") - 1, F.col("after")).otherwise(F.substring("kinds", at + 2, F.lit(1))),
        "carries": F.coalesce(at == F.col("last_start"), F.lit(False)),
    }
    return _described(rows.withColumns(edges).drop("kinds", "last_start"))


def _measured(segments: DataFrame) -> DataFrame:
    """Lines, depths, statement starts and partners within each block, all counted from the block's start."""
    place = Window.partitionBy("chunk").orderBy("at")
    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kind = F.col("kind")

    def depth(opener: str, closer: str) -> Column:
        return F.sum(F.when(kind == opener, 1).when(kind == closer, -1).otherwise(0)).over(so_far)

    lined = segments.withColumns({"line": F.sum("feeds").over(so_far), "braces": depth("{", "}"), "parens": depth("(", ")")})
    first_line = F.col("line") - F.col("feeds") + F.col("leading_feeds")
    # Levels of parentheses are odd, those of braces even.
    level = (
        F.when(kind == "{", 2 * F.col("braces"))
        .when(kind == "}", 2 * F.col("braces") + 2)
        .when(kind == "(", 2 * F.col("parens") + 1)
        .when(kind == ")", 2 * F.col("parens") + 3)
    )
    started = lined.withColumns({"statement": F.last(first_line, ignorenulls=True).over(so_far), "level": level})
    partners = Window.partitionBy("chunk", "level").orderBy("at")
    enclosing = Window.partitionBy("chunk", "braces").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    brace = F.when(kind == "{", F.struct("at", "scope"))
    # Statements end between all brackets; only those carried on matter from here.
    return (
        started.filter((kind != ";") | F.col("carries"))
        .withColumns(
            {
                "partner": F.when(kind.isin("{", "("), F.lead(F.struct("at", "line", "after")).over(partners)),
                "matched": F.when(kind.isin("}", ")"), F.lag("at").over(partners).isNotNull()),
            }
        )
        .withColumn("outer", F.last(brace, ignorenulls=True).over(enclosing))
    )


def _block_offsets(blocks: DataFrame) -> DataFrame:
    """What the blocks before each block add up to: a scan over one row per block.

    `starts` is where the first line of the block starts and `ends` where its last one ends, each a
    block and a line of that block.
    """

    def net(opener: str, closer: str) -> Column:
        def count(c: str) -> Column:
            return F.length("kinds") - F.length(F.replace("kinds", F.lit(c), F.lit("")))

        return count(opener) - count(closer)

    sums = blocks.select(
        "file", "block", "chunk", F.col("feeds").cast("bigint").alias("block_feeds"),
        net("{", "}").alias("braces"), net("(", ")").alias("parens"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("file").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    breaks = F.col("block_feeds") > 0
    nothing = F.lit(0).cast("bigint")
    last_break = F.last(F.when(breaks, F.struct("block", F.col("block_feeds").alias("line"))), ignorenulls=True)
    next_break = F.last(F.when(breaks, F.struct("block", nothing.alias("line"))), ignorenulls=True)
    last_block = F.struct(F.coalesce(F.first("block").over(later), F.col("block")).alias("block"), F.col("block_feeds").alias("line"))
    return sums.select(
        "file",
        "block",
        "chunk",
        "block_feeds",
        F.coalesce(F.sum("braces").over(earlier), F.lit(0)).alias("braces_before"),
        F.coalesce(F.sum("parens").over(earlier), F.lit(0)).alias("parens_before"),
        F.coalesce(last_break.over(earlier), F.struct(F.lit(0).alias("block"), nothing.alias("line"))).alias("starts"),
        F.coalesce(next_break.over(later), last_block).alias("ends"),
    )


def _brackets(blocks: DataFrame, block: int) -> DataFrame:
    """The brackets that matter, at their places in the file, on shared storage.

    They are parameter lists before a brace, bodies, brackets whose partner is in another block, and
    the segments where the statements start that run from block to block.
    """
    placed = _measured(_segments(blocks)).join(_block_offsets(blocks), "chunk")
    kind, partner = F.col("kind"), F.col("partner")
    loose = F.when(kind.isin("{", "("), partner.isNull()).when(kind.isin("}", ")"), ~F.col("matched")).otherwise(False)
    header = (kind == "(") & (F.col("name").isNotNull() | F.col("holds_type")) & (partner["after"] == "{")
    first = F.col("block").cast("bigint") * block

    def closed(at: Column, line: Column, after: Column) -> Column:
        """A closing bracket: its place, where its line ends, and what structural character follows it."""
        end = F.when(line < F.col("block_feeds"), F.struct("block", line.alias("line"))).otherwise(F.col("ends"))
        return F.struct((first + at).alias("pos"), end.alias("end"), after.alias("after"))

    before = F.when(F.col("level") % 2 == 0, F.col("braces_before")).otherwise(F.col("parens_before"))
    outer = F.struct((first + F.col("outer.at")).alias("pos"), F.col("outer.scope").alias("scope"))
    line = F.col("statement")
    start = F.when(line > 0, F.struct("block", line.cast("bigint").alias("line"))).when(line == 0, F.col("starts"))
    kept = placed.filter(F.coalesce(header, F.lit(False)) | F.col("body") | loose | F.col("carries"))
    return write_table(
        kept.select(
            "file",
            (first + F.col("at")).alias("pos"),
            "kind",
            (F.col("level") + 2 * before).alias("level"),
            (F.col("braces") + F.col("braces_before")).alias("depth"),
            "name",
            "holds_type",
            "body",
            "carries",
            "scope",
            loose.alias("loose"),
            closed(F.col("at"), F.col("line"), F.col("after")).alias("own"),
            F.when(partner.isNotNull(), closed(partner["at"], partner["line"], partner["after"])).alias("partner"),
            start.alias("start"),
            F.when(F.col("outer").isNotNull(), outer).alias("outer"),
        ),
        "brackets",
    )


def _partnered(brackets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All openers with their partners, and the files whose brackets do not balance.

    What the blocks leave open meets per file and level, where openers and closers take turns.
    """
    loose = brackets.filter("loose")
    turns = Window.partitionBy("file", "level").orderBy("pos")
    opens = F.col("kind").isin("{", "(")
    met = loose.withColumns(
        {
            "opens": opens,
            "next_opens": F.lead(opens).over(turns),
            "previous_opens": F.lag(opens).over(turns),
            "partner": F.lead("own").over(turns),
        }
    )
    single = F.when(opens, F.coalesce(F.col("next_opens"), F.lit(True))).otherwise(
        ~F.coalesce(F.col("previous_opens"), F.lit(False))
    )
    broken = met.filter(single).select("file").distinct()
    matched = brackets.filter(F.col("kind").isin("{", "(") & ~F.col("loose"))
    return matched.unionByName(met.filter("opens").select(*brackets.columns)), broken


def _started(found: DataFrame, brackets: DataFrame) -> DataFrame:
    """The methods with the start of their statement, the last one carried on where it lies in an earlier block."""
    carried = brackets.filter("carries").select("file", "pos", F.col("start").alias("carried"))
    in_file = Window.partitionBy("file").orderBy("pos")
    return (
        found.unionByName(carried, allowMissingColumns=True)
        .withColumn("start", F.coalesce("start", F.last("carried", ignorenulls=True).over(in_file)))
        .filter(F.col("carried").isNull())
        .drop("carried")
    )


def _in_types(found: DataFrame, brackets: DataFrame, holders: DataFrame) -> DataFrame:
    """The methods whose innermost enclosing brace holds the members of a type, or that no brace encloses.

    A brace that its block did not see is the last one that stands open at the method's depth.
    """
    braces = brackets.filter("loose and kind = '{'").select(
        "file", (F.col("level") / 2).cast("bigint").alias("depth"), "pos", F.struct("pos", "scope").alias("open")
    )
    nested = Window.partitionBy("file", "depth").orderBy("pos")
    enclosed = (
        found.unionByName(braces, allowMissingColumns=True)
        .withColumn("outer", F.coalesce("outer", F.last("open", ignorenulls=True).over(nested)))
        .filter(F.col("open").isNull())
        .withColumn("listed", F.col("outer.pos") - 1)
    )
    # A brace after a parameter list holds members if the list belongs to a new object, a record or an enum constant.
    listed = holders.select("file", F.col("partner.pos").alias("listed"), F.lit(True).alias("held"))
    scope = F.col("outer.scope")
    in_type = (F.col("depth") == 0) | (scope == "type") | ((scope == "list") & F.col("held"))
    return enclosed.join(listed.hint("merge"), ["file", "listed"], "left").filter(in_type).drop("depth", "outer", "open", "listed", "held")


def _sliced(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add each method's text: its lines out of the blocks that hold them, joined where there are several."""
    texts = blocks.select("file", "block", F.array_join("segments", "").alias("text"), "snapshot")
    at_start, at_end = F.col("block") == F.col("start.block"), F.col("block") == F.col("end.block")
    first = F.when(at_start, F.col("start.line")).otherwise(0).cast("int")
    lines = F.col("lines")
    count = F.when(at_end, F.col("end.line") + 1).otherwise(F.size(lines)).cast("int") - first
    piece = F.array_join(F.slice(lines, first + 1, count), "\n")

    def cut(methods: DataFrame) -> DataFrame:
        split = F.explode(F.array(F.split("text", "\n"))).alias("lines")
        held = texts.join(methods.hint("shuffle_hash"), ["file", "block"])
        return held.select("file", "block", "snapshot", "ordinal", "method_name", "start", "end", split).withColumn("piece", piece)

    kept = ["file", "ordinal", "method_name", "snapshot"]
    within = F.col("start.block") == F.col("end.block")
    single = cut(found.filter(within).withColumn("block", F.col("start.block")))
    several = cut(found.filter(~within).withColumn("block", F.explode(F.sequence("start.block", "end.block"))))
    pieces = several.groupBy(*kept).agg(F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("pieces"))
    code = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return single.select(*kept, F.col("piece").alias("method_code")).unionByName(pieces.select(*kept, code.alias("method_code")))


def extract_methods(files: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per method with a body: the snapshot's columns, `ordinal, method_name, method_code`.

    A method is a name that is no control word, after a result type, before a
    parameter list that a body or a `throws` clause follows, among the members of a type;
    so constructors are left out, generic ones too, and methods of nested and nameless types are found.
    Its text runs from the line on which its declaration starts, annotations included, through the
    line of its closing brace.  A file whose braces or parentheses do not balance yields no rows.
    Other columns of `files` stay beside the six.
    """
    blocks = cut_files(files, block)
    brackets = _brackets(blocks, block)
    openers, broken = _partnered(brackets)
    lists = openers.filter((F.col("kind") == "(") & (F.col("partner.after") == "{"))
    bodies = openers.filter("body").select("file", F.col("pos").alias("body_pos"), F.col("partner.end").alias("end"))
    declared = lists.filter(F.col("name").isNotNull()).select(
        "file", "pos", "depth", "outer", "start", F.col("name").alias("method_name"), (F.col("partner.pos") + 1).alias("body_pos")
    )
    # The tables on the right are as long as the input, but the packed files they come from look short enough to broadcast.
    found = declared.join(bodies.hint("merge"), ["file", "body_pos"]).drop("body_pos")
    members = _in_types(found, brackets, lists.filter("holds_type")).join(broken.hint("merge"), "file", "left_anti")
    in_file = Window.partitionBy("file").orderBy("pos")
    numbered = _started(members, brackets).withColumn("ordinal", F.row_number().over(in_file) - 1)
    return _sliced(write_table(numbered, "found"), blocks).select("snapshot.*", "ordinal", "method_name", "method_code")


def with_provenance(methods: DataFrame, host: str = HOST) -> DataFrame:
    """The harvested columns `branch, commit_hash, file_name, method_name, method_code, commit_link`."""
    link = F.concat(F.lit(f"{host}/"), F.col("repo"), F.lit("/commit/"), F.col("commit_hash"))
    return methods.select(
        "branch", "commit_hash", "file_name", "method_name", "method_code", link.alias("commit_link")
    )


def cap_methods(methods: DataFrame, limit: int) -> DataFrame:
    """The first `limit` methods in order of repository, commit, file and place in the file.

    Repositories come in the order of the list, if the methods carry `listed`, else of their names.
    Nulls come first; methods that still tie are ordered by branch, commit hash and a hash of their text.
    A top-k over the rows would send `limit` texts per partition to one task.
    Instead the cut is located by counting, one level of the order after the
    other, with at most `limit` counts each; the rows are then only filtered.
    """
    text = [F.xxhash64("method_code").alias(_TEXT)] if "method_code" in methods.columns else []
    table = write_table(methods.select("*", *text), "methods")
    at_cut, kept = F.lit(True), F.lit(False)
    levels = ("listed", "repo", "commit_seq", "file_name", "ordinal", "branch", "commit_hash", _TEXT)
    for level in [c for c in levels if c in table.columns]:
        if limit <= 0:
            return table.filter(kept).drop(_TEXT)
        counts = table.filter(at_cut).groupBy(level).count().orderBy(F.asc_nulls_first(level)).limit(limit).collect()
        here = None
        for row in counts:
            if row["count"] > limit:
                here = row
                break
            limit -= row["count"]
        if here is None:
            if counts:
                last = counts[-1][level]
                kept = kept | (at_cut & (_before(level, last) | F.col(level).eqNullSafe(F.lit(last))))
            return table.filter(kept).drop(_TEXT)
        kept = kept | (at_cut & _before(level, here[level]))
        at_cut = at_cut & F.col(level).eqNullSafe(F.lit(here[level]))
    copies = table.filter(at_cut).limit(limit)
    return table.filter(kept).unionByName(copies).drop(_TEXT)


def _before(level: str, value) -> Column:
    """Whether a column stands before a value, nulls first."""
    if value is None:
        return F.lit(False)
    return F.col(level).isNull() | (F.col(level) < F.lit(value))
