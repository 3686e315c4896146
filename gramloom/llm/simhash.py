"""SimHash near-duplicates through a table of distances to reference fingerprints.

A fingerprint is described by its Hamming distances to reference fingerprints.
References come in families: the zero fingerprint and, for each bit of one of
five blocks, the fingerprint of that bit alone.  The difference of a
fingerprint's distances to the two tells that bit, and a changed bit changes
no other difference.  Two fingerprints that differ in three bits or fewer
therefore have all differences of at least two families in common, so candidates are
those with equal coordinates in some two of the five families: no link is lost.
Candidates are then compared by the distances to further references, spread
over all bits: a distance moves by at most the number of differing bits, so a pair
with one coordinate further apart is discarded.  Survivors are verified.

Equal fingerprints are one row from the start.  Buckets of any size are handled:
beyond TILE rows they are compared tile by tile, and a task reports
a spanning forest of its links, never all pairs.

Null and empty texts have no words and fingerprint zero, and link like others.
Texts of any length are hashed part by part.  Repeated rows share their
fingerprint; a null id is never a component's id unless all its ids are null.  Empty
table: no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramloom.llm import repeats
from gramloom.llm.common import Forest, run_starts, shuffle_partitions, stage, unsigned, whole_runs
from gramloom.llm.components import components

WORDS = 3
SEED = 42
DIFFERING = 3
#: First bit of each family's block, and the end.
FAMILIES = (0, 13, 26, 39, 52, 64)
#: References spread over all bits.
REFERENCES = 16
TILE = 4096
_PART = 1 << 16


def references(n: int = REFERENCES) -> np.ndarray:
    """Fixed pseudo-random fingerprints."""
    return np.array([xxhash.xxh64_intdigest(f"reference {i}", SEED) for i in range(n)], np.uint64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Bits that are set in over half the hashes of the word shingles of a text."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    width = min(words, len(parts))
    starts, ends = starts[: len(parts) - width + 1], ends[width - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _PART):
        spans = zip(starts[at : at + _PART].tolist(), ends[at : at + _PART].tolist(), strict=True)
        hashes = np.array([digest(joined[b:e], SEED) for b, e in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    over = counts * 2 > len(starts)
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(text) for text in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row, fp being the fingerprint as a signed number."""
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    return texts.mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def _family(i: int) -> F.Column:
    begin, end = FAMILIES[i], FAMILIES[i + 1]
    return F.shiftrightunsigned("fp", begin).bitwiseAND(F.lit((1 << end - begin) - 1))


def buckets(distinct: DataFrame) -> DataFrame:
    """(bucket, fp): a row per pair of families, which name its coordinates."""
    names = [
        (F.lit(n << 32) + F.shiftleft(_family(i), 13) + _family(j)).cast("bigint")
        for n, (i, j) in enumerate(combinations(range(len(FAMILIES) - 1), 2))
    ]
    return distinct.select("fp", F.explode(F.array(*names)).alias("bucket"))


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links within each bucket, or between two tiles of one."""
    spread = references()
    for table in whole_runs(batches, ["bucket", "low", "high"]):
        keys = [table[k].to_numpy() for k in ("bucket", "low", "high")]
        fps = unsigned(table["fp"].to_numpy())
        tiles = table["tile"].to_numpy()
        starts = run_starts(*keys)
        run = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        distances = np.bitwise_count(fps[:, None] ^ spread).astype(np.int8)
        place = run * 128 + distances[:, 0]
        order = np.argsort(place, kind="stable")
        place, fps, tiles, distances = place[order], fps[order], tiles[order], distances[order]
        across = (keys[1] != keys[2])[order]
        stop = np.searchsorted(place, place + DIFFERING, "right")
        count = stop - np.arange(len(place)) - 1
        total = np.cumsum(count)
        forest = Forest(len(fps))
        at = 0
        while at < len(fps):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 20), "right")))
            left = np.repeat(np.arange(at, end), count[at:end])
            right = np.arange(len(left)) - np.repeat(total[at:end] - count[at:end] - (total[at - 1] if at else 0), count[at:end])
            right += left + 1
            near = ~across[left] | (tiles[left] != tiles[right])
            left, right = left[near], right[near]
            for k in range(1, distances.shape[1]):
                near = np.abs(distances[left, k] - distances[right, k]) <= DIFFERING
                left, right = left[near], right[near]
            near = np.bitwise_count(fps[left] ^ fps[right]) <= DIFFERING
            forest.link(left[near], right[near])
            at = end
        hung = np.flatnonzero(forest.root != np.arange(len(fps)))
        signed = fps.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed[hung]), pa.array(signed[forest.root[hung]])], ["a", "b"])


def links(distinct: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect what is connected."""
    rows = stage(buckets(distinct), "buckets")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    rows = rows.join(sizes, "bucket").withColumn("tiles", tiles)
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "bucket", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "fp"
    )
    keys = ["bucket", "low", "high"]
    dealt = rows.repartition(shuffle_partitions(distinct.sparkSession), *keys).sortWithinPartitions(*keys, "fp")
    return dealt.mapInArrow(_links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row."""
    prints = stage(fingerprints(docs), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    hung = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    named = distinct.join(hung, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    rows = distinct.count()
    named = stage(named, "named", rows)
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stage(named.join(smallest, "component").select("fp", "component_id"), "components", rows)
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of `docs` of each component: that of the smallest id, a null id only if all are null.

    Of rows that share this id the one of the smallest digest of its text stays, of
    rows that share the text too the one of the smallest hash.
    """
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = repeats.keyed(docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), whole))
    found = near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("of"), "component_id").distinct()
    ids = keyed.select("key", F.col("doc_id").isNull().alias("no_id")).distinct()
    first = ids.join(found, ids["key"] == found["of"]).groupBy("component_id").agg(F.min(F.struct("no_id", "key")).alias("first"))
    kept = keyed.join(first.select(F.col("first.key").alias("kept")), F.col("key") == F.col("kept"), "left_semi")
    if keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return kept.select("row.*")
    return kept.groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
