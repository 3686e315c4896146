"""Language-model scores by stupid backoff, from counts of the whole corpus.

A document is scored by the counts of all others: its own occurrences are taken
off every count.  A word's score is the count of the longest n-gram up to it
that another document holds, over the count of the n-gram's context, times
BACKOFF for each shorter order; a word that no other document holds scores as if it
stood once in the corpus.

Documents are dealt into blocks of bounded size.  A block's n-grams are counted before they leave
it, then shuffled by hash, where the count table forms: one row per
n-gram and block, and the total beside each.  Totals go back to the blocks that
asked, but only for n-grams of several blocks, since a block knows the rest, and under their
place in the block, packed by block before they are shuffled; there they are joined to
the n-grams of each document and summed.  An n-gram has at most one row per block, so frequent ones make
no hot key.  n-grams are told apart by 64-bit hashes.

Null and empty texts have no words and a null score.  Blocks are made by id and text, so documents
without an id, or with one id, are dealt out unless their texts are equal too.  Repeated rows are
documents of their own, so a copy's n-grams count for the other.  Empty table: no rows.  A
long text is a block of its own size.  Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gramloom.llm.common import run_starts, signed, stage

ORDER = 2
BACKOFF = 0.4
#: Bytes of text in a block, on average.
BLOCK = 1 << 23
#: Words of a block that are scored at a time, on average.
PART = 1 << 17
#: The n-grams are counted in so many shares of their hashes, one after another: a
#: share's shuffle is over before the next begins, which bounds the disk taken.
WAVES = 2
#: Totals that are sorted by block and packed together, in rows.
PACKED = 1 << 20
#: Stands for the number of words in place of an n-gram's hash.
_ALL = 0

SCHEMA = "doc_id bigint, n_words bigint, n_backoff bigint, score double"


def _words(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, texts end to end, and each word's text.

    Arrow cuts the texts and numbers the words, so that each distinct word alone is hashed.
    """
    whole = pc.fill_null(texts.cast(pa.large_string()).combine_chunks(), "")
    lists = pc.ascii_split_whitespace(whole)
    counts = np.diff(lists.offsets.to_numpy())
    coded = lists.flatten().dictionary_encode()
    known = coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
    places, doc = coded.indices.to_numpy(), np.repeat(np.arange(len(counts)), counts)
    # White space at the edge of a text leaves an empty word there.
    empty = [place for place, word in enumerate(known) if not word]
    if empty:
        real = places != empty[0]
        places, doc = places[real], doc[real]
    return hashes[places], doc


def _grams(words: np.ndarray, doc: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1..order: hashes of n-grams by their last word, and where there is one."""
    out = [(words, np.ones(len(words), bool))]
    for n in range(2, order + 1):
        gram, whole = np.zeros(len(words), np.uint64), np.zeros(len(words), bool)
        if len(words) >= n:
            longer = (out[-1][0][:-1] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            longer ^= longer >> np.uint64(31)
            longer = (longer + words[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
            longer ^= longer >> np.uint64(29)
            gram[1:] = longer
            whole[n - 1 :] = doc[n - 1 :] == doc[: len(doc) - n + 1]
        out.append((gram, whole))
    return out


def _count(table: pa.Table, order: int, wave: int, waves: int) -> pa.Table:
    """(block, at, gram, n): `at` is an n-gram's place among those of its block and wave, of the words' number -1."""
    words, doc = _words(table["text"])
    hashes, counts, first = [], [], 0
    if not wave:
        hashes, counts, first = [np.array([_ALL], np.uint64)], [np.array([len(words)])], -1
    for gram, whole in _grams(words, doc, order):
        found, n = np.unique(gram[whole & (gram % np.uint64(waves) == wave)], return_counts=True)
        hashes.append(found)
        counts.append(n)
    block = table["block"][0].as_py()
    hashes, counts = np.concatenate(hashes), np.concatenate(counts)
    at = np.arange(first, first + len(hashes), dtype=np.int32)
    return pa.table(
        {"block": np.full(len(hashes), block, np.int32), "at": at, "gram": signed(hashes), "n": counts.astype(np.int32)}
    )


def _counter(order: int, wave: int, waves: int) -> Callable[[pa.Table], pa.Table]:
    return lambda table: _count(table, order, wave, waves)


def _packed(batches: Iterator[pa.RecordBatch], wave: int) -> Iterator[pa.RecordBatch]:
    """(block, wave, places, totals): a row per block for about PACKED totals, places as differences."""

    def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        block, at, total = (table[c].to_numpy() for c in ("block", "at", "total"))
        order = np.lexsort((at, block))
        block, at, total = block[order], at[order], total[order]
        starts = run_starts(block)
        spans = list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))
        squeeze = zstandard.ZstdCompressor(level=1).compress
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block[starts[:-1]], pa.int32()),
                pa.array(np.full(len(spans), wave, np.int32)),
                pa.array([squeeze(np.diff(at[b:e], prepend=0).astype("<i4").tobytes()) for b, e in spans], pa.binary()),
                pa.array([squeeze(total[b:e].astype("<i8").tobytes()) for b, e in spans], pa.binary()),
            ],
            ["block", "wave", "places", "totals"],
        )

    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= PACKED:
            yield out(held)
            held, rows = [], 0
    if held:
        yield out(held)


def _packer(wave: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    return lambda batches: _packed(batches, wave)


def _unpacked(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(wave, places, totals) of each packed row."""
    spread = zstandard.ZstdDecompressor().decompress
    for row in table.select(["wave", "places", "totals"]).to_pylist():
        at = np.cumsum(np.frombuffer(spread(row["places"]), "<i4"), dtype=np.int64)
        yield row["wave"], at, np.frombuffer(spread(row["totals"]), "<i8")


def _known(words: np.ndarray, doc: np.ndarray, totals: pa.Table, order: int, waves: int) -> tuple[list, int]:
    """For n = 1..order the block's n-grams in the order of their hashes and the corpus count of each; all words."""
    known = [np.unique(gram[whole], return_counts=True) for gram, whole in _grams(words, doc, order)]
    grams, counts = (np.concatenate(of) for of in zip(*known, strict=True))
    counts = counts.astype(np.int64)
    everything = len(words)
    places = [np.flatnonzero(grams % np.uint64(waves) == w) for w in range(waves)]
    for wave, at, total in _unpacked(totals):
        if len(at) and at[0] < 0:
            everything, at, total = int(total[0]), at[1:], total[1:]
        counts[places[wave][at]] = total
    cuts = np.cumsum([len(found) for found, _ in known])[:-1]
    return list(zip(np.split(grams, cuts), np.split(counts, cuts), strict=True)), everything


def _score_part(words: np.ndarray, doc: np.ndarray, n_docs: int, known: list, everything: int) -> list[np.ndarray]:
    """Numbers of words and of words backed off, and sums of scores, of documents numbered from 0."""
    lengths = np.bincount(doc, minlength=n_docs)
    elsewhere = []
    for (gram, whole), (found, totals) in zip(_grams(words, doc, len(known)), known, strict=True):
        others = np.zeros(len(words), np.int64)
        at = np.searchsorted(found, gram[whole])
        _, own, times = np.unique(at * n_docs + doc[whole], return_inverse=True, return_counts=True)
        others[whole] = totals[at] - times[own]
        elsewhere.append(others)
    rest = everything - lengths[doc]
    score = np.log(np.maximum(elsewhere[0], 1) / np.maximum(rest + (elsewhere[0] == 0), 1))
    steps = np.zeros(len(words), np.int64)
    position = np.arange(len(words)) - (np.cumsum(lengths) - lengths)[doc]
    for n in range(2, len(known) + 1):
        possible = position >= n - 1
        seen = possible & (elsewhere[n - 1] > 0)
        context = np.roll(elsewhere[n - 2], 1)
        score = np.where(seen, np.log(np.maximum(elsewhere[n - 1], 1) / np.maximum(context, 1)), score)
        steps = np.where(seen, 0, steps + possible)
    score += steps * math.log(BACKOFF)
    return [lengths, np.bincount(doc, steps > 0, n_docs), np.bincount(doc, score, n_docs)]


def _score(table: pa.Table, totals: pa.Table, order: int, waves: int) -> pa.Table:
    """Scores of a block's documents, worked out for about PART words at a time."""
    words, doc = _words(table["text"])
    known, everything = _known(words, doc, totals, order, waves)
    # Where each document begins; parts are cut between documents.
    begins = np.searchsorted(doc, np.arange(table.num_rows + 1))
    cuts = np.unique(np.append(np.searchsorted(begins, np.arange(0, len(words), PART)), [0, table.num_rows]))
    parts = []
    for first, last in zip(cuts[:-1], cuts[1:], strict=True):
        of = slice(begins[first], begins[last])
        parts.append(_score_part(words[of], doc[of] - first, last - first, known, everything))
    lengths, backoff, sums = (np.concatenate(column) for column in zip(*parts, strict=True))
    return pa.table(
        {
            "doc_id": table["doc_id"],
            "n_words": lengths.astype(np.int64),
            "n_backoff": backoff.astype(np.int64),
            "score": pa.array(sums / np.maximum(lengths, 1), mask=lengths == 0),
        }
    )


def score(docs: DataFrame, order: int = ORDER, block: int = BLOCK, waves: int = WAVES) -> DataFrame:
    """(doc_id, n_words, n_backoff, score): mean log score of a document's words."""
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, math.ceil(size / block))
    # By the text too, so that documents without an id do not come together by their length.
    name = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"], name.alias("block"))
    same = Window.partitionBy("gram")
    parts = []
    for wave in range(waves):
        counts = texts.groupBy("block").applyInArrow(_counter(order, wave, waves), "block int, at int, gram bigint, n int")
        table = counts.withColumns({"total": F.sum("n").over(same), "blocks": F.count(F.lit(1)).over(same)})
        table = table.filter("blocks > 1").select("block", "at", "total")
        packed = table.mapInArrow(_packer(wave), "block int, wave int, places binary, totals binary")
        parts.append(stage(packed, "totals"))
    totals = reduce(DataFrame.unionByName, parts)
    return texts.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        lambda t, of: _score(t, of, order, waves), SCHEMA
    )
