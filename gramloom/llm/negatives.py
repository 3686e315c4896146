"""Hard negatives by the threshold algorithm over sorted lists of each dimension.

Candidates are cut into blocks of one vector length.  In a block every dimension has a list of the
rows in the order of that component.  An anchor reads the lists of its nonzero dimensions from
the end that its component's sign favours, all to the same depth, and every row met for the first time is
scored in full: an integer inner product, looked up by row.  What has not been met is at most the
threshold, the anchor's product with the next entries of its lists.  Reading stops where the threshold
falls strictly below the k-th score of what is asked, so that no tie is lost.  The best so far go along
from block to block, so a later block is often left at its heads.

Two passes are made.  The first finds an anchor's positives, the best other rows of its label, in lists of that
label's rows alone.  The second finds, for each positive, the best rows of other labels
whose score s fits least * p <= 100 * s <= most * p, with p the positive's score; it stops below the smallest
score that still matters to any of the anchor's windows.

Anchors are dealt in packs.  A task reads a pack and some of the blocks, one after the
other, so it holds one block and one pack, and reports a few rows per anchor; those are
merged by ranking.  A label with a third of all rows is in many blocks and tasks like any other.  Blocks that can
hold no answer for a pack, those without its labels in the first pass, are not sent to it.

Rows with a null label, a null vector, or null or non-finite components take no part.  Vectors of unequal
length have no product and do not meet.  Components become floor(scale * x), bounded so that every score fits a
long (beyond about 10^8 for 64 dimensions).  Equal scores are in the order of vec_id, null ids last, then of no
stated order.  Repeated rows are rows of their own: a copy of an anchor is another row, and an anchor
that repeats is mined as often.  Rows with a null id are never anchors by a condition on it.  An anchor
without positives, or whose windows are empty (as for a negative p), has no rows.  An anchor of zeros
scores every row.  Empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramloom.llm.common import run_starts, shuffle_partitions, stage
from gramloom.llm.ranks import numbered

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST, MOST = 80, 100
BLOCK = 2048
PACK = 4096
#: Blocks that one task reads for a pack at most, which bounds its time; more are dealt to more tasks.
BLOCKS_PER_TASK = 8192
_FIRST_DEPTH = 8
_LAST_ID = 2**63 - 1

_BLOCK_SCHEMA = (
    "length int, block bigint, size int, labels array<bigint>, anchors array<int>, all_labels binary, "
    "ids binary, null_ids binary, numbers binary"
)
_ANCHOR_SCHEMA = "length int, anchor bigint, anchor_id bigint, label bigint, numbers binary"
_RESULT_SCHEMA = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
)
_FOUND_SCHEMA = "anchor bigint, anchor_id bigint, window bigint, row bigint, id bigint, score bigint"


def _quantised(vectors: np.ndarray, scale: float) -> np.ndarray:
    bound = float(math.isqrt(2**62 // max(1, vectors.shape[1])))
    return np.floor(np.clip(vectors * scale, -bound, bound)).astype(np.int64)


def _packed(numbers: np.ndarray) -> bytes:
    """The numbers in the fewest bytes each that hold them all."""
    largest = int(np.abs(numbers).max(initial=0))
    kind = next(k for k in (np.int16, np.int32, np.int64) if largest <= np.iinfo(k).max)
    return numbers.astype(kind).tobytes()


def _unpacked(data: bytes, rows: int, length: int) -> np.ndarray:
    each = len(data) // (rows * length) if rows * length else 8
    return np.frombuffer(data, f"<i{each}").astype(np.int64).reshape(rows, length)


def _cut(batches: Iterator[pa.RecordBatch], scale: float, size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of up to `size` rows of one length, from rows in the order of length and label."""
    number = TaskContext.get().partitionId() << 32
    held: list[pa.Table] = []
    rows, length = 0, None

    def out() -> pa.RecordBatch:
        table = pa.concat_tables(held).combine_chunks()
        flat = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        labels = table["label"].to_numpy()
        columns = [
            length, number, rows, np.unique(labels).tolist(),
            np.flatnonzero(table["anchor"].to_numpy(zero_copy_only=False)).tolist(), labels.astype("<i8").tobytes(),
            table["vec_id"].combine_chunks().fill_null(_LAST_ID).to_numpy().astype("<i8").tobytes(),
            table["vec_id"].combine_chunks().is_null().to_numpy(zero_copy_only=False).tobytes(),
            _packed(_quantised(flat.reshape(rows, length), scale)),
        ]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32())] + [pa.binary()] * 4
        names = [part.split()[0] for part in _BLOCK_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, types, strict=True)], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = run_starts(batch["length"].to_numpy())
        for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            of = batch["length"][begin].as_py()
            while begin < end:
                if held and (of != length or rows == size):
                    yield out()
                    held, rows, number = [], 0, number + 1
                length = of
                taken = min(end - begin, size - rows)
                held.append(pa.Table.from_batches([batch.slice(begin, taken)]))
                rows, begin = rows + taken, begin + taken
    if held:
        yield out()


class _Block:
    """Rows of a block: labels, ids, whether an id is null, numbers; `row` names a row over all blocks."""

    def __init__(self, row: dict):
        n = row["size"]
        self.name, self.length = row["block"], row["length"]
        self.labels = np.frombuffer(row["all_labels"], "<i8")
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.null_ids = np.frombuffer(row["null_ids"], bool)
        self.numbers = _unpacked(row["numbers"], n, self.length)

    def row(self, at: np.ndarray) -> np.ndarray:
        # Parts and blocks are counted in 2^31 and 2^32, rows of a block in 2^12, of 2^63 in all.
        return (self.name >> 32 << 43) + ((self.name & 0x7FFFFFFF) << 12) + at


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _ANCHOR_SCHEMA.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block(row)
            rows = [
                (
                    block.length, int(block.row(at)), None if block.null_ids[at] else int(block.ids[at]),
                    int(block.labels[at]), block.numbers[at].astype("<i8").tobytes(),
                )
                for at in row["anchors"]
            ]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


class _Lists:
    """Rows in the order of each dimension, to read from either end."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        self.order = np.argsort(numbers, axis=0, kind="stable")
        self.values = np.take_along_axis(numbers, self.order, axis=0)
        self.largest = int(np.abs(numbers).max(initial=0))

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        numbers = self.numbers[rows]
        if self.largest * int(np.abs(anchor).max(initial=0)) * max(1, len(anchor)) < 2**53:
            return (numbers.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
        return numbers @ anchor

    def walk(self, anchor: np.ndarray, floor: Callable[[], float], offer: Callable[[np.ndarray, np.ndarray], None]) -> None:
        """Offer rows with their scores until no row that is left can reach `floor()`."""
        n = len(self.numbers)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            offer(np.arange(n), np.zeros(n, np.int64))
            return
        met, left, depth = np.zeros(n, bool), n, 0
        while left:
            threshold = int(anchor[up] @ self.values[n - 1 - depth, up] + anchor[down] @ self.values[depth, down])
            if threshold < floor():
                return
            deeper = min(n, max(2 * depth, _FIRST_DEPTH))
            here = np.zeros(n, bool)
            here[self.order[n - deeper : n - depth, up]] = True
            here[self.order[depth:deeper, down]] = True
            new = np.flatnonzero(here & ~met)
            if len(new):
                met[new] = True
                left -= len(new)
                offer(new, self.scores(new, anchor))
            depth = deeper


@dataclass
class _Best:
    """The k best rows with scores from `low` to `high`, as (-score, null id, id, row)."""

    k: int
    window: int = 0
    low: float = -math.inf
    high: float = math.inf
    rows: list[tuple] = field(default_factory=list)

    def floor(self) -> float:
        """The smallest score that still matters; equal ones do, for a smaller id."""
        return max(self.low, -self.rows[-1][0]) if len(self.rows) == self.k else self.low

    def offer(self, block: _Block, at: np.ndarray, scores: np.ndarray) -> None:
        fit = np.flatnonzero((scores >= self.floor()) & (scores <= self.high))
        if not len(fit):
            return
        at, scores = at[fit], scores[fit]
        first = np.lexsort((block.ids[at], block.null_ids[at], -scores))[: self.k]
        at, scores = at[first], scores[first]
        found = zip((-scores).tolist(), block.null_ids[at].tolist(), block.ids[at].tolist(), block.row(at).tolist(), strict=True)
        self.rows = sorted([*self.rows, *found])[: self.k]


@dataclass
class _Anchor:
    row: int
    id: int | None
    label: int
    numbers: np.ndarray
    best: list[_Best]


def _positives(block: _Block, anchors: list[_Anchor]) -> None:
    starts = run_starts(block.labels)
    runs = {int(block.labels[b]): (b, e) for b, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)}
    lists: dict[int, _Lists] = {}
    for anchor in anchors:
        if anchor.label not in runs:
            continue
        begin, end = runs[anchor.label]
        if anchor.label not in lists:
            lists[anchor.label] = _Lists(block.numbers[begin:end])
        best = anchor.best[0]

        def offer(at: np.ndarray, scores: np.ndarray, begin: int = begin, best: _Best = best, own: int = anchor.row) -> None:
            other = block.row(at + begin) != own
            best.offer(block, (at + begin)[other], scores[other])

        lists[anchor.label].walk(anchor.numbers, best.floor, offer)


def _negatives(block: _Block, anchors: list[_Anchor]) -> None:
    lists = _Lists(block.numbers)
    for anchor in anchors:
        different = block.labels != anchor.label
        if not anchor.best or not different.any():
            continue

        def floor(windows: list[_Best] = anchor.best) -> float:
            return min(w.floor() for w in windows)

        def offer(at: np.ndarray, scores: np.ndarray, windows: list[_Best] = anchor.best, different: np.ndarray = different) -> None:
            kept = different[at]
            at, scores = at[kept], scores[kept]
            for w in windows:
                w.offer(block, at, scores)

        lists.walk(anchor.numbers, floor, offer)


def _mined(
    batches: Iterator[pa.RecordBatch], look: Callable[[_Block, list[_Anchor]], None], windows: Callable[[list], list[_Best]]
) -> Iterator[pa.RecordBatch]:
    """The best rows of each pack's anchors in the blocks that follow it, packs in turn."""
    pack, anchors, known = None, [], set()

    def out() -> pa.RecordBatch:
        rows = [
            (a.row, a.id, best.window, row, None if null else id, -score)
            for a in anchors for best in a.best for score, null, id, row in best.rows
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        names = [part.split()[0] for part in _FOUND_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            if row["pack"] != pack:
                if anchors:
                    yield out()
                pack, anchors, known = row["pack"], [], set()
            if row["anchor"] is None:
                look(_Block(row), anchors)
            elif row["anchor"] not in known:  # a pack comes once for each share of its blocks
                known.add(row["anchor"])
                numbers = _unpacked(row["numbers"], 1, row["length"])[0]
                anchors.append(_Anchor(row["anchor"], row["anchor_id"], row["label"], numbers, windows(row["scores"] or [])))
    if anchors:
        yield out()


def _dealt(anchors: DataFrame, blocks: DataFrame, pairs: DataFrame, shares: int) -> DataFrame:
    """Packs and their blocks, together in one partition for each share of a pack's blocks, the pack first."""
    spark = blocks.sparkSession
    share = F.pmod(F.xxhash64("block"), F.lit(shares)).cast("int")
    placed = pairs.withColumn("share", share)
    sent = blocks.join(placed.select("pack", "block", "share"), "block").drop("labels", "anchors")
    tasks = placed.select("pack", "share").distinct()
    packs = anchors.join(tasks, "pack")
    both = packs.unionByName(sent, allowMissingColumns=True)
    both = both.repartition(shuffle_partitions(spark), "pack", "share")
    order = ["pack", "share", F.col("anchor").isNull(), "anchor", "block"]
    return both.sortWithinPartitions(*order)


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of what tasks report for each anchor and window, with their rank from 1."""
    first = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    scale: float = SCALE,
    block: int = BLOCK,
    pack: int = PACK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of `vec_id, label, embedding`.

    `anchors` is a condition on those three columns; `rank` counts from 1 within an anchor and positive.
    """
    if not 0 < block <= 4096 or min(positives, negatives, pack) < 1:
        raise ValueError("positives, negatives and pack must be at least 1, block between 1 and 4096")
    spark = vectors.sparkSession
    parts = shuffle_partitions(spark)
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(
        vectors["vec_id"].cast("bigint").alias("vec_id"), vectors["label"].cast("bigint").alias("label"),
        vectors["embedding"].cast("array<double>").alias("embedding"),
    )
    rows = rows.filter(F.coalesce(F.col("label").isNotNull() & finite, F.lit(False))).select(
        F.size("embedding").alias("length"), "label", "vec_id", F.coalesce(anchors, F.lit(False)).alias("anchor"), "embedding"
    )
    order = ["length", "label", "vec_id"]
    blocks = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = stage(blocks.mapInArrow(lambda b: _cut(b, scale, block), _BLOCK_SCHEMA), "blocks")

    asking = blocks.filter(F.size("anchors") > 0).mapInArrow(_anchors, _ANCHOR_SCHEMA)
    asking = numbered(asking, "length", ["label", "anchor"], "place")
    number = F.col("length").cast("bigint") * F.lit(2**32) + F.floor(F.col("place") / pack)
    asking = stage(asking.withColumn("pack", number).drop("place"), "anchors")
    # Two tasks or so for each partition, if there are blocks enough, and more where a pack would meet too many.
    n_blocks, n_packs = blocks.count(), asking.select("pack").distinct().count()
    if not n_packs:
        return spark.createDataFrame([], _RESULT_SCHEMA)
    shares = max(-(-n_blocks // BLOCKS_PER_TASK), min(n_blocks, -(-2 * parts // n_packs)))

    labels = blocks.select("length", "block", F.explode("labels").alias("label"))
    pairs = labels.join(asking.select("length", "pack", "label").distinct(), ["length", "label"])
    pairs = pairs.select("pack", "block").distinct()
    plain = asking.withColumn("scores", F.lit(None).cast("array<bigint>"))
    found = _dealt(plain, blocks, pairs, shares).mapInArrow(
        lambda b: _mined(b, _positives, lambda _: [_Best(positives)]), _FOUND_SCHEMA
    )
    best = stage(_best_of(found, positives).select("anchor", "anchor_id", "rank", "id", "score"), "positives")

    def windows(scores: list[int]) -> list[_Best]:
        bounds = [(i, -(-least * p // 100), most * p // 100) for i, p in enumerate(scores)]
        return [_Best(negatives, i, low, high) for i, low, high in bounds if low <= high]

    # Place i of the scores is the positive of rank i + 1.
    scores = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"])
    asked = asking.join(best.groupBy("anchor").agg(scores.alias("scores")), "anchor")
    pairs = blocks.select("length", "block").join(asked.select("length", "pack").distinct(), "length").drop("length")
    found = _dealt(asked, blocks, pairs, shares).mapInArrow(lambda b: _mined(b, _negatives, windows), _FOUND_SCHEMA)
    hard = _best_of(found, negatives).withColumn("place", (F.col("window") + 1).cast("int"))
    named = best.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
