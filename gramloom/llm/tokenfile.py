"""Token ids in directly addressable codes.

An id is split into chunks of eight bits.  Level 0 holds the lowest chunk of
every id; a bitmap beside it says which ids go on, and level k + 1 holds the
next chunk of those that do, in order.  A rank directory counts the set bits before each
block of a bitmap, so the place of an id's next chunk is a count away and any
token is found without decoding what stands before it.

Files are Parquet, written by Spark to any storage it reaches.  A row is a
segment: whole documents in ascending id order, with their ends, and the
levels, bitmaps and directories of their ids.

Null text: empty, only the end id.  Null ids come first.  Rows of one id are in the order of a hash of their
texts, so repeated rows stand one after another, files and places are the same in every run, and different texts of one id, or
of none, are dealt over tasks.  Empty table: files without segments, no rows.  A text of any
length stays in one segment.  Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gramloom.llm.common import shuffle_partitions
from gramloom.llm.wordids import encoder
from gramloom.plans.scratch import scratch_path

END = 1
#: Documents join a segment until it has so many ids.
SEGMENT_IDS = 1 << 20
SEGMENT_DOCS = 1 << 16
CHUNK_BITS = 8
#: Bits of a bitmap that share one entry of its rank directory; a multiple of 8.
BLOCK_BITS = 512

FILE_SCHEMA = (
    "part int, segment int, n_ids bigint, doc_ids array<bigint>, doc_ends array<bigint>, "
    "levels array<binary>, bitmaps array<binary>, ranks array<binary>"
)
ROW_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

_SET_BITS = np.array([bin(i).count("1") for i in range(256)], np.int64)


class Codes:
    """The levels of one list of ids."""

    def __init__(self, levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self.levels = [np.frombuffer(x, np.uint8) for x in levels]
        self.bitmaps = [np.frombuffer(x, np.uint8) for x in bitmaps]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        levels, bitmaps, ranks = [], [], []
        rest = ids.astype(np.uint32)
        while True:
            levels.append((rest & 255).astype(np.uint8).tobytes())
            rest = rest >> CHUNK_BITS
            more = rest > 0
            bits = np.packbits(more, bitorder="little")
            bitmaps.append(bits.tobytes())
            blocks = np.add.reduceat(_SET_BITS[bits], np.arange(0, len(bits), BLOCK_BITS // 8)) if len(bits) else bits
            ranks.append((np.cumsum(blocks) - blocks).astype("<u4").tobytes())
            rest = rest[more]
            if not len(rest):
                return cls(levels, bitmaps, ranks)

    def rank(self, level: int, at: int) -> int:
        """Set bits of a bitmap before bit `at`."""
        bitmap = self.bitmaps[level]
        block = at // BLOCK_BITS
        if block >= len(self.ranks[level]):  # just behind the last bit of a full block
            return len(self.levels[level + 1]) if level + 1 < len(self.levels) else 0
        whole = bitmap[block * BLOCK_BITS // 8 : at // 8]
        count = int(self.ranks[level][block]) + int(_SET_BITS[whole].sum())
        return count + (int(_SET_BITS[bitmap[at // 8] & ((1 << at % 8) - 1)]) if at % 8 else 0)

    def __getitem__(self, at: int) -> int:
        """The id at a place."""
        value, level = 0, 0
        while True:
            value |= int(self.levels[level][at]) << CHUNK_BITS * level
            if not self.bitmaps[level][at // 8] >> at % 8 & 1:
                return value
            at, level = self.rank(level, at), level + 1

    def slice(self, begin: int, end: int) -> np.ndarray:
        """The ids from one place to another; only their own chunks are read."""
        out = np.zeros(end - begin, np.uint32)
        places, level = np.arange(end - begin), 0
        while begin < end:
            out[places] |= self.levels[level][begin:end].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            bits = np.unpackbits(self.bitmaps[level][begin // 8 : -(-end // 8)], bitorder="little")
            more = bits[begin % 8 : begin % 8 + end - begin].astype(bool)
            places = places[more]
            begin = self.rank(level, begin)
            end, level = begin + len(places), level + 1
        return out


def _segments(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode
    part = TaskContext.get().partitionId()
    docs: list = []
    lists: list[np.ndarray] = []
    held = number = 0
    schema = pa.schema(
        [("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
         ("doc_ends", pa.list_(pa.int64()))] + [(n, pa.list_(pa.binary())) for n in ("levels", "bitmaps", "ranks")]
    )

    def out() -> pa.RecordBatch:
        codes = Codes.of(np.concatenate(lists))
        ends = np.cumsum([len(x) for x in lists])
        parts = [[x.tobytes() for x in arrays] for arrays in (codes.levels, codes.bitmaps, codes.ranks)]
        row = [part, number, held, docs, ends.tolist(), *parts]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    stop = np.array([end], np.uint32)
    for batch in batches:
        for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
            docs.append(doc_id)
            lists.append(np.concatenate([ids, stop]))
            held += len(ids) + 1
            if held >= SEGMENT_IDS or len(docs) >= SEGMENT_DOCS:
                yield out()
                docs, lists, held, number = [], [], 0, number + 1
    if docs:
        yield out()


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end: int = END) -> None:
    """Write the ids of all texts, documents in ascending id order over parts and segments."""
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    texts = texts.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    texts.mapInArrow(lambda batches: _segments(batches, tokenizer, end), FILE_SCHEMA).write.parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            codes = Codes(row["levels"], row["bitmaps"], row["ranks"])
            ends = np.array(row["doc_ends"], np.int64)
            begins = np.append(0, ends[:-1])
            sums = [
                zlib.crc32(codes.slice(b, e).astype("<u4").tobytes())
                for b, e in zip(begins.tolist(), ends.tolist(), strict=True)
            ]
            columns = [row["doc_ids"], row["base"] + begins, ends - begins, sums]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )


def segment_bases(segments: DataFrame) -> DataFrame:
    """(part, segment, base): ids before each segment, from one total per part."""
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return (
        segments.select("part", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside"))
        .join(before, "part")
        .select("part", "segment", (F.col("inside") + F.col("before")).alias("base"))
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the files."""
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    bases = segment_bases(files.select("part", "segment", "n_ids"))
    return files.drop("n_ids").join(bases, ["part", "segment"]).mapInArrow(_read, ROW_SCHEMA)


def _read_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            codes = Codes(row["levels"], row["bitmaps"], row["ranks"])
            inside = np.sort(np.array(row["asked"], np.int64))
            document = np.searchsorted(np.array(row["doc_ends"], np.int64), inside, "right")
            ids = [row["doc_ids"][i] for i in document.tolist()]
            columns = [row["base"] + inside, ids, [codes[at] for at in inside.tolist()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["place", "doc_id", "token"])


def tokens_at(spark: SparkSession, folder: str, places: DataFrame) -> DataFrame:
    """(place, doc_id, token) for the column `place` of a table: single ids by their places in all of the corpus.

    A place finds its segment by an equi-join of bins.  Only segments that are asked go on, and of those only the chunks
    of the asked ids are read.  A place that is asked several times is answered once, one
    that is null or outside the corpus not at all.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    sizes = files.select("part", "segment", "n_ids")
    bin_of = F.floor(F.col("at") / SEGMENT_IDS)
    last = F.col("base") + F.col("n_ids") - 1
    bins = F.sequence(F.floor(F.col("base") / SEGMENT_IDS), F.floor(last / SEGMENT_IDS))
    held = sizes.join(segment_bases(sizes), ["part", "segment"]).select("part", "segment", "base", last.alias("last"), F.explode(bins).alias("bin"))
    asked = places.select(places["place"].cast("bigint").alias("at")).distinct().withColumn("bin", bin_of)
    met = asked.join(held, "bin").filter("at between base and last")
    each = met.groupBy("part", "segment", "base").agg(F.collect_list(F.col("at") - F.col("base")).alias("asked"))
    return files.drop("n_ids").join(each, ["part", "segment"]).mapInArrow(_read_places, "place bigint, doc_id bigint, token bigint")


def roundtrip(docs: DataFrame, tokenizer: str) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, folder)
    return read_tokens(docs.sparkSession, folder)
