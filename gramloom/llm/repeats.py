"""Removal of long repeated strings, by interval expansion on Burrows-Wheeler transforms.

A byte goes if it lies in a string of LENGTH bytes that also starts earlier: in
a document of smaller id, or earlier in the same one.

Equal strings must meet, and no task can hold a transform of all texts.  Every
string of LENGTH bytes therefore takes the smallest hash of the GRAM-byte grams in it,
which its own bytes alone decide.  Strings that start in a row and take the same hash
form a segment.  Segments whose hash occurs once cannot hold a repeat and are left where
they are; equal segments become one row, of which only the first keeps anything.  The
distinct segments of a hash go to one task, which builds the transform of a
block of them and finds all their common strings: intervals of equal prefixes
are extended to the left breadth first, each level fixes the common prefixes of one
more byte, and at LENGTH the rest is known to be repeats.  A hash with more
segments than a block holds is dealt over blocks, and the strings that are first
in their block are compared once more by an aggregation.

Null text: empty.  Texts shorter than LENGTH lose nothing.  Texts of any length
are cut into parts that overlap.  Equal rows are one document: each gets the
same result.  Rows of one id but different texts are documents of their own, in
the order of a hash of their texts.  A null id comes before all others.  Empty
table: no rows.  Only doc_id and text are read; `without_repeats` passes other columns on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gramloom.llm import ranks
from gramloom.llm.common import run_starts, shuffle_partitions, signed, stage
from gramloom.plans.scratch import drop_tables

LENGTH = 100
GRAM = 32
#: Strings of one segment at most; contents stay below this plus LENGTH bytes.
SEGMENT = 4096
#: Bytes of one hash's segments that are compared in one transform; a hash with more is dealt over blocks.
BLOCK = 1 << 20
#: Bytes of segments from which on a transform takes no further hash; small enough for a processor's cache.
_BATCH = 1 << 17
#: Bytes of texts that are hashed together, as small for the same reason; places in them fit _PLACE_BITS.
_BUFFER = 1 << 18
_PLACE_BITS = np.uint64(24)
#: Strings of a dealt block that leave a task at once.
_STRINGS = 1 << 14
#: Places of one document at most.
_PLACES = 1 << 40
#: Length of prefixes that sorting groups before the expansion starts.
_SEED = 8

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


# -- segments ----------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, by doubling."""
    found = (data.astype(np.uint64) + np.uint64(1)) * _MIX[0]
    width = 1
    while width < GRAM:
        longer = found[:-width] * _MIX[1]
        longer += found[width:]
        longer ^= longer >> np.uint64(29)
        longer *= _MIX[0]
        found, width = longer, 2 * width
    found ^= found >> np.uint64(32)
    return found


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first string, strings and places of the hash (1, or 2 for more) of each segment.

    `data` holds texts end to end, `ends` where each ends; strings do not cross ends.
    """
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    hashes = _gram_hashes(data)
    least = (hashes >> _PLACE_BITS) << _PLACE_BITS
    least |= np.arange(len(least), dtype=np.uint64)
    window, width = LENGTH - GRAM + 1, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if window > width:
        rest = window - width
        least = np.minimum(least[:-rest], least[rest:])
    place = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    taken = hashes[place]
    new = np.empty(len(taken), bool)
    new[0] = True
    np.not_equal(taken[1:], taken[:-1], out=new[1:])
    new[ends[ends < len(new)]] = True
    crossing = np.zeros(len(new) + 1, np.int32)
    np.add.at(crossing, np.maximum(np.append(0, ends[:-1]), np.minimum(ends - LENGTH + 1, len(new))).clip(max=len(new)), 1)
    np.add.at(crossing, np.minimum(ends, len(new)), -1)
    inside = np.cumsum(crossing[:-1]) == 0
    new[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(new)
    stop = np.append(first[1:], len(new))
    own = inside[first]
    first, stop = first[own], stop[own]
    moves = np.cumsum(np.append(0, place[1:] != place[:-1]))
    places = np.where(moves[stop - 1] > moves[first], 2, 1)
    if len(first) and (stop - first).max() > SEGMENT:
        parts = -(-(stop - first) // SEGMENT)
        at = np.repeat(first - (np.cumsum(parts) - parts) * SEGMENT, parts) + np.arange(parts.sum()) * SEGMENT
        stop, places = np.minimum(at + SEGMENT, np.repeat(stop, parts)), np.repeat(places, parts)
        first = at
    return taken[first], first, stop - first, places


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts end to end: bytes, ends, keys and the place in its document where each begins."""
    held: list[bytes] = []
    keys: list[int] = []
    begins: list[int] = []
    size = 0

    def out() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum([len(x) for x in held])
        return np.frombuffer(b"".join(held), np.uint8), ends, np.array(keys, np.int64), np.array(begins, np.int64)

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = memoryview(text.as_buffer()) if text.is_valid else b""
            for at in range(0, max(len(raw) - LENGTH + 1, 0), _BUFFER):
                part = bytes(raw[at : at + _BUFFER + LENGTH - 1])
                held.append(part)
                keys.append(key)
                begins.append(at)
                size += len(part)
                if size >= _BUFFER:
                    yield out()
                    held, keys, begins, size = [], [], [], 0
    if held:
        yield out()


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for data, ends, keys, begins in _buffers(batches):
        hashes, first, count, places = segments(data, ends)
        doc = np.searchsorted(ends, first, "right")
        start = first - np.append(0, ends[:-1])[doc] + begins[doc]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[doc]), pa.array(signed(hashes)), pa.array(start), pa.array(count.astype(np.int32)),
             pa.array(places.astype(np.int32))],
            ["key", "anchor", "start", "n", "places"],
        )


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of each candidate segment; of those equal within a batch the first alone."""
    for batch in batches:
        first: dict[tuple[int, bytes], tuple[int, int]] = {}
        for key, text, refs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            raw = memoryview(text.as_buffer())
            fields = refs.values
            columns = [fields.field(k).to_pylist() for k in range(3)]
            for anchor, start, n in sorted(zip(*columns, strict=True), key=lambda ref: ref[1]):
                name = (anchor, bytes(raw[start : start + n + LENGTH - 1]))
                at = (key, start)
                if first.setdefault(name, at) > at:
                    first[name] = at
        names, places = list(first), list(first.values())
        for at in range(0, len(names), 1 << 14):
            part, where = names[at : at + (1 << 14)], places[at : at + (1 << 14)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in part], pa.int64()), pa.array([c for _, c in part], pa.binary()),
                 pa.array([k for k, _ in where], pa.int64()), pa.array([s for _, s in where], pa.int64())],
                ["anchor", "content", "key", "start"],
            )


# -- the transform ---------------------------------------------------------------


def _sorted_suffixes(symbols: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of at least their first LENGTH symbols, and their _SEED-symbol groups.

    The second array says of each place in the order whether a new group of equal prefixes of
    _SEED symbols begins there.
    """
    n = len(symbols)
    key = np.zeros(n, np.uint64)
    for k in range(4):
        key[: n - k] |= symbols[k:].astype(np.uint64) << np.uint64(bits * (3 - k))
    order = np.argsort(key, kind="stable")
    width, seeds = 4, None
    while True:
        ordered = key[order]
        new = np.empty(n, bool)
        new[0] = True
        np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
        if width == _SEED:
            seeds = new
        if width >= LENGTH or new.all():
            return order, seeds if seeds is not None else new
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new).astype(np.uint64)
        key = rank << np.uint64(32)
        key[: n - width] |= rank[width:]
        # Only suffixes in groups of several still change places.
        group = np.cumsum(new)
        several = np.bincount(group)[group] > 1
        moving = order[several]
        order[several] = moving[np.argsort(key[moving], kind="stable")]
        width *= 2


def repeated(symbols: np.ndarray, bits: int, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and which share their first `length` symbols with the one before.

    `short[q]` becomes true when the common prefix of the suffixes at q - 1 and q turns
    out to be shorter.  Intervals of suffixes with a common prefix of one
    length are extended by the symbol to the left of each suffix; an extended interval
    whose right border is known already cannot tell anything new and is dropped.
    """
    n = len(symbols)
    order, seeds = _sorted_suffixes(symbols, bits)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    left = order - 1
    before = symbols[left]  # the transform
    follow = place[left]
    del place, left
    short = np.append(seeds, True)
    begin = np.flatnonzero(seeds)
    size = np.diff(np.append(begin, n))
    for _ in range(_SEED, length):
        if not len(begin):
            break
        total = np.cumsum(size)
        rows = np.arange(total[-1]) + np.repeat(begin - (total - size), size)
        source = np.repeat(np.arange(len(begin)), size)
        at = follow[rows]
        sort = np.argsort(at)
        at, source, symbol = at[sort], source[sort], before[rows[sort]]
        new = np.empty(len(at), bool)
        new[0] = True
        new[1:] = (at[1:] != at[:-1] + 1) | (source[1:] != source[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.flatnonzero(new)
        begin = at[first]
        size = np.diff(np.append(first, len(at)))
        open_ = ~short[begin + size]
        begin, size = begin[open_], size[open_]
        short[begin + size] = True
    return order, ~short[:-1]


def first_strings(contents: list[bytes], order_of: np.ndarray) -> np.ndarray:
    """For contents end to end, each with one place behind it, which places start a string's first occurrence.

    `order_of` ranks the contents by where they stand in the corpus.
    """
    m = len(contents)
    lengths = np.fromiter(map(len, contents), np.int64, m)
    ends = np.cumsum(lengths + 1)
    n = int(ends[-1])
    own = np.repeat(np.arange(m), lengths + 1)
    symbols = np.frombuffer(b"\0".join([*contents, b""]), np.uint8).astype(np.uint32) + np.uint32(m)
    symbols[ends - 1] = np.arange(m)  # no two ends are equal, and none is equal to a byte
    order, same = repeated(symbols, max(1, int(m + 255).bit_length()))
    starts = np.arange(n) + LENGTH <= np.repeat(ends - 1, lengths + 1)
    groups = np.flatnonzero(~same)
    groups = groups[np.append(same[groups[1:] - 1], same[-1]) & (np.diff(np.append(groups, n)) > 1)]
    in_group = same.copy()
    in_group[groups] = True
    members = order[in_group]
    standing = order_of[own[members]].astype(np.int64) * n + members  # by content, then by place in it
    begins = np.flatnonzero(~same[in_group])
    if len(members):
        least = np.minimum.reduceat(standing, begins)
        later = standing != np.repeat(least, np.diff(np.append(begins, len(members))))
        starts[members[later]] = False
    return starts


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, start, n, string): runs of first occurrences; where the hash is dealt over blocks, one by one with the string."""
    names = ["key", "start", "n", "string"]

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        contents = table["content"].to_pylist()
        keys, starts = table["key"].to_numpy(), table["start"].to_numpy()
        ranked = np.empty(len(keys), np.int64)
        ranked[np.lexsort((starts, keys))] = np.arange(len(keys))
        first = first_strings(contents, ranked)
        begins = np.cumsum([0, *[len(c) + 1 for c in contents[:-1]]])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], first.view(np.int8), [0]])))
        begin, stop = edges[::2], edges[1::2]
        dealt = table["blocks"].to_numpy() > 1
        own = np.searchsorted(begins, begin, "right") - 1
        one = dealt[own]
        single = np.concatenate([np.arange(b, e) for b, e in zip(begin[one], stop[one], strict=True)]) if one.any() else begin[:0]
        begin, stop, own = begin[~one], stop[~one], own[~one]
        runs = [keys[own], starts[own] + begin - begins[own], stop - begin]
        yield pa.RecordBatch.from_arrays([*map(pa.array, runs), pa.nulls(len(own), pa.binary())], names)
        # Nearly every byte of a dealt block may start a string, so these go out by parts.
        for at in range(0, len(single), _STRINGS):
            part = single[at : at + _STRINGS]
            whose = np.searchsorted(begins, part, "right") - 1
            offsets = part - begins[whose]
            strings = [contents[c][o : o + LENGTH] for c, o in zip(whose, offsets, strict=True)]
            runs = [keys[whose], starts[whose] + offsets, np.ones(len(part), np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, runs), pa.array(strings, pa.binary())], names)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        runs = run_starts(*[table[k].to_numpy() for k in ("anchor", "block")])
        sizes = np.append(0, np.cumsum(np.array(pc.binary_length(table["content"]))))
        done = 0
        for k in range(1, len(runs) - 1):
            if sizes[runs[k]] - sizes[done] >= min(_BATCH, BLOCK):
                yield from solve(table.slice(done, int(runs[k]) - done))
                done = int(runs[k])
        held = table.slice(done).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        if table.num_rows:
            yield from solve(table)


# -- documents ---------------------------------------------------------------------


def keyed(docs: DataFrame) -> DataFrame:
    """`docs` with `key`, a number for each document in the order of ids.

    Ids that are unique and not null are keys as they are; others are numbered.
    """
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.filter("n > 1 or doc_id is null").isEmpty():
        return docs.withColumn("key", F.col("doc_id"))
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    texts = docs.select("doc_id", digest.alias("digest"), F.lit(0).alias("all")).distinct()
    texts = texts.withColumn("has_id", F.col("doc_id").isNotNull())
    numbers = ranks.numbered(texts, "all", ["has_id", "doc_id", "digest"], "key")
    numbers = stage(numbers.select(F.col("doc_id").alias("id"), "digest", "key"), "keys")
    named = docs.withColumn("digest_", digest)
    return named.join(
        numbers, named["doc_id"].eqNullSafe(numbers["id"]) & (named["digest_"] == numbers["digest"])
    ).drop("digest_", "digest", "id")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, spans): removed runs of bytes, from candidate strings and those to keep."""
    for batch in batches:
        keys, out = [], []
        for key, refs, kept in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            starts, counts = (np.asarray(refs.values.field(k).to_numpy(zero_copy_only=False), np.int64) for k in (1, 2))
            length = int((starts + counts).max())
            change = np.zeros(length + 1, np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + counts, -1)
            gone = np.cumsum(change[:-1]) > 0
            if kept.is_valid:
                first, many = (np.asarray(kept.values.field(k).to_numpy(zero_copy_only=False), np.int64) for k in (0, 1))
                change[:] = 0
                np.add.at(change, first, 1)
                np.add.at(change, first + many, -1)
                gone &= np.cumsum(change[:-1]) == 0
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            begin, stop = edges[::2], edges[1::2] + LENGTH - 1
            if not len(begin):
                continue
            apart = np.append(True, begin[1:] > stop[:-1])
            last = np.append(apart[1:], True)
            keys.append(key)
            out.append([{"begin": int(b), "end": int(e)} for b, e in zip(begin[apart], stop[last], strict=True)])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, kind)], ["key", "spans"])


def _place() -> F.Column:
    """(key, start) as one number of the same order, so that its minimum is aggregated in hash tables."""
    return (F.col("key").cast("decimal(20,0)") * F.lit(_PLACES).cast("decimal(14,0)") + F.col("start")).cast("decimal(38,0)")


def _key_and_start(place: str) -> list[F.Column]:
    start = F.expr(f"cast(pmod({place}, cast({_PLACES} as decimal(38,0))) as bigint)")
    key = F.expr(f"cast(({place} - pmod({place}, cast({_PLACES} as decimal(38,0)))) div {_PLACES} as bigint)")
    return [key.alias("key"), start.alias("start")]


def removed_spans(texts: DataFrame) -> DataFrame:
    """(key, spans) of the documents that lose bytes; `texts` has (key, text)."""
    spark = texts.sparkSession
    parts = shuffle_partitions(spark)
    anchors = texts.select("key", "text").mapInArrow(
        _anchors, "key bigint, anchor bigint, start bigint, n int, places int"
    )
    anchors = stage(anchors, "anchors")
    # Each shuffle's files are gone before those of the next are written, which bounds the disk taken.
    often = anchors.groupBy("anchor").agg(F.sum("places").alias("times")).filter("times > 1").select("anchor")
    often = stage(often, "often")
    ref = F.struct("anchor", "start", "n")
    refs = anchors.join(often, "anchor", "left_semi").groupBy("key").agg(F.collect_list(ref).alias("refs"))
    refs = stage(refs, "refs")
    drop_tables(anchors, often)
    contents = texts.select("key", "text").join(refs, "key").select("key", "text", "refs").mapInArrow(
        _contents, "anchor bigint, content binary, key bigint, start bigint"
    )
    contents = stage(contents, "contents")
    distinct = contents.groupBy("anchor", "content").agg(F.min(_place()).alias("first"))
    distinct = stage(distinct, "distinct")
    drop_tables(contents)
    sizes = distinct.groupBy("anchor").agg(F.sum(F.length("content")).alias("size"))
    sizes = sizes.select("anchor", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    blocks = distinct.join(sizes, "anchor").withColumn(
        "block", F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    )
    at = ["anchor", "block"]
    blocks = blocks.select(*at, "blocks", "content", *_key_and_start("first"))
    kept = blocks.repartition(parts, *at).sortWithinPartitions(*at).mapInArrow(
        _kept, "key bigint, start bigint, n bigint, string binary"
    )
    held = kept = stage(kept, "kept")
    drop_tables(distinct)
    compared = kept.filter("string is not null").groupBy("string").agg(F.min(_place()).alias("first"))
    compared = compared.select(*_key_and_start("first"), F.lit(1).cast("bigint").alias("n"))
    kept = kept.filter("string is null").select("key", "start", "n").unionByName(compared)
    kept = kept.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("kept"))
    both = refs.join(kept, "key", "left").select("key", "refs", "kept")
    spans = stage(both.mapInArrow(_spans, "key bigint, spans array<struct<begin:bigint,end:bigint>>"), "spans")
    drop_tables(refs, held)
    return spans


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*[batch.column(k) for k in range(3)], strict=True):
            raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
            digest, at, removed = hashlib.sha256(), 0, 0
            found = spans.as_py() or []
            for span in found:
                digest.update(raw[at : span["begin"]])
                at = span["end"]
                removed += at - span["begin"]
            digest.update(raw[at:])
            rows.append((doc_id.as_py(), len(raw), removed, len(found), digest.hexdigest()))
        if rows:
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def repeat_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per input row."""
    texts = keyed(docs.select("doc_id", "text"))
    spans = removed_spans(texts)
    return texts.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        _digests, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


def _cut(text: str, spans: list[dict]) -> str:
    """The text without the characters that lie whole in a span of bytes."""
    raw = text.encode()
    pieces, at = [], 0
    for span in spans:
        begin, end = span["begin"], span["end"]
        while begin < end and raw[begin] & 0xC0 == 0x80:
            begin += 1
        while end > begin and end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        pieces.append(raw[at:begin])
        at = end
    pieces.append(raw[at:])
    return b"".join(pieces).decode()


@F.pandas_udf(StringType())
def _cut_texts(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([None if text is None else _cut(text, found) for text, found in zip(texts, spans, strict=True)])


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with the text, and `n_chars` if it is there, of what stays.

    A character goes if all its bytes do, so texts stay valid.
    """
    columns = [c for c in docs.columns if c != "text"]
    rows = keyed(docs.select("doc_id", "text", F.struct(*[docs[c] for c in columns]).alias("row")))
    rows = rows.join(removed_spans(rows.select("key", "text")), "key", "left")
    # One join serves texts that are cut and those that stay, which go to no worker; so texts are dealt once.
    cut = _cut_texts(F.when(F.col("spans").isNotNull(), F.col("text")), "spans")
    rows = rows.withColumn("text", F.coalesce(cut, "text"))
    length = F.coalesce(F.length("text"), F.lit(0))
    out = []
    for c in docs.columns:
        value = F.col("text") if c == "text" else F.col("row").getField(c)
        if c == "n_chars":
            value = length.cast(docs.schema[c].dataType)
        out.append(value.alias(c))
    return rows.select(*out)
