"""Each operator against a brute-force version, on rows with nulls, ties, copies and clashing names."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from gramloom.llm import components, embeddings, licenses, lm, mix, pack, quality, repeats, shards, simhash, tokenfile
from gramloom.llm.wordids import WordEncoder, encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, source string, key string, row int, block int, n int"


def odd_texts():
    rng = random.Random(7)
    words = ["the", "of", "Ünï", "a", "sea,", "x1", "<|endoftext|>", "don't", "ÉTÉ.", "\x1cq", "b" * 300]
    prose = [" ".join(rng.choices(words, k=k)) for k in (1, 2, 3, 19, 20, 40, 300)]
    line = "one two three four five six seven eight nine ten\n"
    return [None, "", " \t\n", *prose, prose[5], prose[5] + " end", line * 30, "=" * 5000, "é" * 200, "q " + "é" * 200, "a\x0bb\x0cc\rd"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "s1", "s2", "s3"][i % 4], "k", i, 1, 2) for i, t in enumerate(odd_texts())]
    rows += [rows[5], (None, "null id", "s1", "k", 0, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_mix(docs, empty):
    rows = docs.collect()
    plan = mix.mix_plan(docs).collect()
    assert len(plan) == len(rows) and mix.mix_plan(empty).collect() == []
    assert sorted(map(str, plan)) == sorted(map(str, mix.mix_plan(docs.repartition(7)).collect()))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(words(r.text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, rest, live = {}, Fraction(3, 2) * sum(sizes.values()), set(order)
    while True:
        over = [s for s in live if rest * weight[s] / sum(weight[x] for x in live) > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = Fraction(2 * sizes[s])
            live.discard(s)
        rest = Fraction(3, 2) * sum(sizes.values()) - sum(target.values())
    target |= {s: rest * weight[s] / sum(weight[x] for x in live) for s in live}
    by_source = defaultdict(set)
    for r in plan:
        by_source[r.source_size].add(r.target)
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
    for s in order:
        assert any(abs(t - float(target[s])) < 1e-6 for t in by_source[sizes[s]])
    mixed = mix.mixed(docs)
    assert mixed.columns == docs.columns
    unique = docs.filter("doc_id <> 5")
    copies = {r.doc_id: r.copies for r in mix.mix_plan(unique).collect()}
    assert Counter(r.doc_id for r in mix.mixed(unique).collect()) == Counter({k: v for k, v in copies.items() if v})


def test_mix_is_near_target(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 50), f"s{i % 5}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    totals = mix.mix_plan(frame).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 100 for r in totals)


def test_quality(docs, empty):
    rows = docs.collect()
    found = quality.judge(docs).collect()
    assert len(found) == len(rows) and quality.judge(empty).collect() == []
    expected = Counter()
    for r in rows:
        text, w = r.text or "", words(r.text)
        places = defaultdict(list)
        for i in range(len(w) - 7):
            places[tuple(w[i : i + 8])].append(i)
        covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
        lines = [x for x in text.split("\n") if words(x)]
        expected[
            (r.doc_id, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        ] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns


def test_host_verdicts(spark):
    good, bad = " ".join(f"w{i}" for i in range(40)), "too short"
    rows = [(i, good if i % 10 else bad, "fine") for i in range(100)]
    rows += [(1000 + i, bad if i % 20 else good, "junk") for i in range(100)]
    rows += [(2000 + i, good, f"host{i}") for i in range(30)] + [(3000, good, None)]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert not found[1000].kept and not found[1000].base_failed
    assert found[1].kept and found[2000].kept and found[3000].kept


def test_rows_that_share_an_id(spark):
    rng = random.Random(3)
    good = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(5)]
    rows = [(None, good[0], "a"), (None, good[1], "a"), (None, "few", "a"), (4, good[2], "a"), (4, "few", "a"), (5, good[3], "b"),
            (6, good[4], "a"), (6, good[4], "a"), (7, good[4], "b"), (None, good[4], "b"), (None, good[0], "b")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = quality.kept_documents(frame)
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in frame.collect() if r.text != "few")
    once = simhash.deduplicated(kept)
    assert once.dtypes == frame.dtypes
    assert Counter((r.doc_id, r.text) for r in once.collect()) == Counter(
        [(None, good[0]), (None, good[1]), (4, good[2]), (5, good[3]), (6, good[4])]
    )


def test_shards(docs, empty, spark):
    rows = docs.collect()
    found = shards.assign(docs).collect()
    assert len(found) == len(rows) and shards.assign(empty).collect() == []
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    rng = random.Random(3)
    many = [(i, "hot" if i % 3 == 0 else "w " * rng.randint(0, 40) + str(i % 800)) for i in range(6000)]
    found = shards.assign(spark.createDataFrame(many, "doc_id bigint, text string")).collect()
    for dimension in (lambda r: r["size"], lambda r: 1):
        totals = defaultdict(int)
        for r in found:
            totals[r.shard] += dimension(r)
        assert len(totals) == 8 and max(totals.values()) < 1.05 * sum(totals.values()) / 8
    text = dict(many)
    where = defaultdict(set)
    for r in found:
        where[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for t, s in where.items() if t != "hot")


@pytest.mark.parametrize("ids", ["null", "one", "own"])
def test_shards_of_a_hot_text_are_even_whatever_its_ids(spark, ids):
    name = {"null": lambda i: None, "one": lambda i: 7, "own": lambda i: i}[ids]
    rows = [(name(i), "the hot text") if i % 3 == 0 else (i, "w" * (i % 50) + str(i)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"row": F.lit("x"), "number": F.lit(1)})
    found = shards.assign(docs).collect()
    assert len(found) == 6000 and Counter(r.doc_id for r in found) == Counter(d for d, _ in rows)
    for measure in (lambda r: r["size"], lambda r: 1):
        totals = Counter()
        for r in found:
            totals[r.shard] += measure(r)
        mean = sum(totals.values()) / 8
        assert len(totals) == 8 and 0.95 * mean < min(totals.values()) and max(totals.values()) < 1.05 * mean
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found))) for s in range(8))


def test_place_against_a_plain_loop():
    rng = random.Random(2)
    items = [[rng.random() / 50 for _ in range(3)] for _ in range(400)]
    left, expected = [[1.0] * 3 for _ in range(8)], []
    for item in items:
        fits = [sum(r * x * w for r, x, w in zip(row, item, (1.0, 0.5, 0.5), strict=True)) for row in left]
        best = max(range(8), key=lambda s: (round(fits[s], 12), -s))
        expected.append(best)
        left[best] = [r - x for r, x in zip(left[best], item, strict=True)]
    assert shards.place(np.array(items), np.ones((8, 3))).tolist() == expected


def cosine_links(rows, least):
    unit = {}
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, float) / max(map(abs, v))
            unit[i] = a / np.linalg.norm(a)
    return {
        (i, j) for i in unit for j in unit
        if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least
    }


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(150):
        centre = rng.standard_normal(32)
        for _ in range(4):
            near = centre + rng.standard_normal(32) * rng.choice([0.05, 0.15, 0.25])
            rows.append((len(rows), near.tolist(), int(rng.integers(2))))
    rows += [(len(rows) + i, rows[0][1], rows[0][2]) for i in range(5)]
    odd = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] * 32, [None] + [1.0] * 31]
    rows += [(5000 + i, v, 0) for i, v in enumerate(odd)] + [(6000, rows[0][1], None), (6001, [1.0, 2.0], 0), (6002, [2.0, 4.0], 0)]
    rows += [(6003, [1e300] * 32, 1), (6004, [1e-300] * 32, 1), (None, [5.0] * 32, 7)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("list", F.lit("x"))
    truth = cosine_links(rows, 0.93)
    expected = Counter(x for pair in truth for x in pair)
    for tile in (embeddings.TILE, 4):
        found = {r.vec_id: r for r in embeddings.near_duplicates(frame, tile=tile).collect()}
        assert len(found) == len(rows)
        links = [found[rows[i][0]].n_links for i in range(len(rows))]
        assert all(links[i] <= expected[i] for i in range(len(rows)))
        assert sum(links) >= 0.97 * sum(expected.values())
        assert found[6002].component_id == 6001 and found[6004].component_id == 6003 and found[5000].n_links == 0
        assert found[0].n_links >= 5 and all(r.kept == (r.vec_id == r.component_id) for r in found.values() if r.vec_id is not None)
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


@pytest.mark.parametrize(("share", "cosine"), [(3, 0.96), (3, 0.94), (1, 0.96), (3, 0.7)])
def test_embeddings_of_a_hot_group(spark, share, cosine):
    """One in `share` rows in one group of unequal vectors at this cosine from each other."""
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre, n = unit(rng.standard_normal(64)), 1800
    hot = unit(centre + np.sqrt(1 / cosine - 1) * unit(rng.standard_normal((n // share, 64))))
    others = unit(rng.standard_normal((n - len(hot), 64)))
    twins = unit(np.concatenate([hot, others])[::10] + 0.2 * unit(rng.standard_normal((n // 10, 64))))
    vectors = np.concatenate([hot, others, twins])
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>, label int")
    expected = (vectors @ vectors.T >= 0.93).sum(axis=1) - 1
    for tile in (embeddings.TILE, 300):
        found = {r.vec_id: r.n_links for r in embeddings.near_duplicates(frame, tile=tile).collect()}
        links = np.array([found[i] for i in range(len(vectors))])
        assert (links <= expected).all() and links.sum() >= 0.97 * expected.sum()
        if cosine > 0.9:
            assert (links[: len(hot)] == expected[: len(hot)]).all()


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(500 + i, 501 + i) for i in range(60)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = dict(components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {x: find(x) for x in root if find(x) != x}


def test_few_links_are_written_in_few_files(spark):
    """As many files as the links ask for, not as there are partitions, each of which costs a task its file."""
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = components.components(spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint"))
        assert dict(found.collect()) == dict.fromkeys(range(1, 201), 0)
        assert len(found.inputFiles()) == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_licenses(docs, empty, spark):
    assert licenses.scan(docs).collect() == licenses.scan(empty).collect() == []
    notice = dict(licenses.TEMPLATES)["GPL-3.0"]
    rows = [(1, "prose\n" + notice + "\nmore"), (2, notice.upper()), (3, notice.replace("work", "thing")), (4, "license version"),
            (5, notice[:70] + "\n" + notice[70:] + "\n\nother"), (6, "Released under the MIT License.\nReleased under the MIT License.")]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert set(found) == {1, 2, 3, 5, 6} and found[6].license == "MIT" and found[6].n_passages == 1
    assert found[1].license == found[5].license == "GPL-3.0" and found[1].dice == 1.0 and 0.8 <= found[3].dice < 1
    scanner, rng = licenses.Scanner(licenses.TEMPLATES, 0.8), random.Random(4)
    for _, text in licenses.TEMPLATES:
        for _ in range(20):
            passage = licenses.words(text)
            for _ in range(rng.randrange(4)):
                passage[rng.randrange(len(passage))] = "other"
            best = defaultdict(float)
            for name, template in licenses.TEMPLATES:
                a, b = licenses.bag(passage), licenses.bag(licenses.words(template))
                best[name] = max(best[name], 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values())))
            top = max(best.values())
            names, dice = scanner.closest(" ".join(passage))
            assert (sorted(names), dice) == (sorted(n for n, d in best.items() if d == top), top) if top >= 0.8 else names == []


def test_usual_and_embedded_licenses(spark):
    gpl = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'
    prose = "The river ran under the old bridge and the work of the day was done. " * 8
    expected = {
        1: ("See the notes below. Released under the MIT License. Contributions welcome.", {"MIT"}),
        2: (prose + "This work is licensed\nunder the GNU General Public\nLicense, version 3. " + prose, {"GPL-3.0"}),
        3: (gpl, {"GPL-3.0"}), 4: (prose + gpl + "\n" + prose, {"GPL-3.0"}), 5: (bsd, {"BSD-2-Clause", "BSD-3-Clause"}),
        6: (mpl, {"MPL-2.0"}), 7: (apache, {"Apache-2.0"}), 8: (prose + apache + prose + mpl, {"Apache-2.0", "MPL-2.0"}),
        9: ("// SPDX-License-Identifier: MIT", {"MIT"}), 10: ("x\n/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-3-Clause */\ny", {"GPL-2.0", "BSD-3-Clause"}),
        11: ("SPDX-License-Identifier: Foo-1.0 MIT", set()), 12: (prose, set()),
        13: (prose + "Licensed under the Apache License, Version 1.1. " + prose, set()),
    }
    rows = [(i, text) for i, (text, _) in expected.items()]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for i, (_, names) in expected.items():
        assert {r.license for r in found if r.doc_id == i} == names, i
    assert all(r.dice >= 0.8 for r in found) and [r.n_passages for r in found if r.doc_id == 1] == [1]


def test_word_encoder():
    own = WordEncoder(PATH)
    for text, ids in zip(odd_texts(), own.encode(odd_texts()), strict=True):
        assert ids.tolist() == own.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_token_file(docs, empty):
    rows = docs.collect()
    found = tokenfile.roundtrip(docs, PATH).collect()
    assert tokenfile.roundtrip(empty, PATH).collect() == [] and len(found) == len(rows)
    tokens = encoder(PATH).tokenizer
    expected = Counter()
    for r in rows:
        ids = np.array([*tokens.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        expected[(r.doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == expected
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ordered = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda x: (x is not None, x or 0))


def test_tokens_by_place(spark, docs, empty, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "SEGMENT_IDS", 50)
    folder, none = str(tmp_path / "tokens"), str(tmp_path / "none")
    tokenfile.write_tokens(docs, PATH, folder)
    tokens = encoder(PATH).tokenizer
    texts = {}
    for r in docs.collect():
        ids = [*tokens.encode(r.text or "", add_special_tokens=False).ids, 1]
        texts[(r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] = ids
    expected = {}
    for r in tokenfile.read_tokens(spark, folder).collect():
        for at, token in enumerate(texts[(r.doc_id, r.n_tokens, r.ids_crc32)]):
            expected[r.start + at] = (r.doc_id, token)
    n = len(expected)
    assert sorted(expected) == list(range(n)) and n > 100
    found = tokenfile.tokens_at(spark, folder, spark.range(-5, n + 5).select(F.col("id").alias("place"))).collect()
    assert len(found) == n and {r.place: (r.doc_id, r.token) for r in found} == expected
    some = spark.createDataFrame([(n - 1,), (0,), (None,), (0,), (n,)], "place int")
    found = tokenfile.tokens_at(spark, folder, some).collect()
    assert sorted((r.place, r.doc_id, r.token) for r in found if r.place) == [(n - 1, *expected[n - 1])] and len(found) == 2
    tokenfile.write_tokens(empty, PATH, none)
    assert tokenfile.tokens_at(spark, none, some).collect() == []


def test_texts_of_one_id_have_one_order(spark):
    rows = [(None if i % 3 else 7, f"text number {i % 40}") for i in range(300)]
    first, second = (
        tokenfile.roundtrip(spark.createDataFrame(r, "doc_id bigint, text string").repartition(k), PATH)
        for r, k in ((rows, 3), (rows[::-1], 7))
    )
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))


def test_codes():
    rng = np.random.default_rng(1)
    for n in (1, 511, 512, 513, 5000):
        ids = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 33, n, dtype=np.uint64)).astype(np.uint32)
        codes = tokenfile.Codes.of(ids)
        assert all(codes[i] == ids[i] for i in rng.integers(0, n, 50))
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert codes.slice(a, b).tolist() == ids[a:b].tolist()


def test_pack(docs, empty, spark):
    assert pack.pack(empty, PATH).collect() == []
    rows = docs.collect()
    tokens = encoder(PATH).tokenizer
    for capacity, most in ((64, 3), (2048, 1024)):
        found = pack.pack(docs, PATH, capacity, 0, most).collect()
        expected = Counter()
        for r in rows:
            ids = np.array([*tokens.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
            for piece, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start : start + capacity]
                expected[(r.doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
        sequences = defaultdict(list)
        for r in found:
            sequences[r.sequence_id].append((r.offset, r.length))
        for pieces in sequences.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= capacity


def test_open_bins():
    bins = pack.OpenBins(10, 2)
    assert [bins.take(n) for n in (6, 7, 3, 9, 4, 1)] == [(0, 0), (1, 0), (1, 7), (2, 0), (0, 6), (2, 9)]
    bins = pack.OpenBins(10, 1)
    assert [bins.take(n) for n in (6, 7, 4)] == [(0, 0), (1, 0), (2, 0)]


def test_lm(docs, empty):
    """Rows with null and repeated ids are documents of their own."""
    assert lm.score(empty).collect() == []
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in docs.collect()]
    assert any(d is None for d, _ in rows) and len({d for d, _ in rows}) < len(rows)

    def grams(w, n):
        return Counter(zip(*[w[i:] for i in range(n)], strict=False))

    def shown(doc_id, n_words, score):
        return doc_id is None, doc_id or 0, n_words, score is None, round(score or 0.0, 8)

    for order, block, waves in ((2, 1 << 12, 2), (3, 1 << 20, 1), (3, 1 << 11, 3)):
        counts = {n: sum((grams(w, n) for _, w in rows), Counter()) for n in range(1, order + 1)}
        total = sum(len(w) for _, w in rows)
        expected = []
        for doc_id, w in rows:
            others = {n: counts[n] - grams(w, n) for n in counts}
            rest, sums = total - len(w), 0.0
            for k in range(len(w)):
                value = 1.0
                for n in range(min(order, k + 1), 0, -1):
                    gram = tuple(w[k - n + 1 : k + 1])
                    c = others[n][gram]
                    if n == 1:
                        value *= c / rest if c else 1 / (rest + 1)
                    elif c:
                        value *= c / others[n - 1][gram[:-1]]
                        break
                    else:
                        value *= lm.BACKOFF
                sums += math.log(value)
            expected.append(shown(doc_id, len(w), sums / len(w) if w else None))
        found = [shown(r.doc_id, r.n_words, r.score) for r in lm.score(docs, order, block, waves).collect()]
        assert len(found) == len(expected)
        for one, other in zip(sorted(found), sorted(expected), strict=True):
            assert one[:4] == other[:4] and abs(one[4] - other[4]) < 1e-7


def test_lm_deals_out_documents_without_ids(spark):
    texts = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.format_string("w%05d x", "id").alias("text"))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(40))
    sizes = [r["count"] for r in texts.groupBy(block).count().collect()]
    assert len(sizes) == 40 and max(sizes) < 2 * 3000 / 40
    found = lm.score(texts, block=1 << 9).collect()
    assert len(found) == 3000 and len({round(r.score, 9) for r in found}) == 1


def plain_fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty):
    assert simhash.near_duplicates(empty).collect() == []
    rows = docs.collect()
    found = simhash.near_duplicates(docs).collect()
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    assert Counter((r.doc_id, r.fingerprint) for r in found) == Counter((d, format(p, "016x")) for d, p in prints)
    group = {p: {q for _, q in prints if (p ^ q).bit_count() <= 3} for _, p in prints}
    for r in found:
        seen, todo = set(), [int(r.fingerprint, 16)]
        while todo:
            if (p := todo.pop()) not in seen:
                seen.add(p)
                todo += group[p]
        assert r.component_id == min((d for d, p in prints if p in seen and d is not None), default=None)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in found}


@pytest.mark.parametrize("tile", [simhash.TILE, 8])
def test_simhash_links(spark, tile):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for b in base[:20]:
        for _ in range(10):
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                b ^= 1 << bit
            prints.add(b)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), tile)
    found = dict(components.components(links).collect())
    named = [found.get(p, p) for p in signed]
    near = [[j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 3] for p in prints]
    for i in range(len(prints)):
        seen, todo = set(), [i]
        while todo:
            if (k := todo.pop()) not in seen:
                seen.add(k)
                todo += near[k]
        assert {k for k in range(len(prints)) if named[k] == named[i]} == seen


def removed(texts):
    first, out = {}, []
    for d, t in enumerate(texts):
        for i in range(len(t) - 99):
            first.setdefault(t[i : i + 100], (d, i))
    for d, t in enumerate(texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 99):
            if first[t[i : i + 100]] != (d, i):
                gone[i : i + 100] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("block", [repeats.BLOCK, 400])
def test_repeats(docs, empty, block, monkeypatch, spark):
    monkeypatch.setattr(repeats, "BLOCK", block)
    assert repeats.repeat_report(empty).collect() == []
    rng = random.Random(6)
    passage = "".join(rng.choices("abcdefgh é", k=400))
    more = [(100 + i, "x" * rng.randint(0, 60) + str(i) + passage[rng.randint(0, 90) : rng.randint(150, 400)] + str(i), "s", "k", 0, 0, 0) for i in range(25)]
    frame = docs.unionByName(spark.createDataFrame(more, SCHEMA))
    rows = frame.collect()
    distinct = sorted(
        {(r.doc_id is not None, r.doc_id or 0, hashlib.sha256(r.text.encode()).hexdigest() if r.text is not None else "", r.text or "") for r in rows}
    )
    expected = {}
    for (has, doc_id, _, text), gone in zip(distinct, removed([d[3].encode() for d in distinct]), strict=True):
        raw = np.frombuffer(text.encode(), np.uint8)
        edges = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        kept = hashlib.sha256(raw[~gone].tobytes()).hexdigest()
        expected[(doc_id if has else None, len(raw), int(gone.sum()), int((edges == 1).sum()), kept)] = 1
    found = [tuple(r) for r in repeats.repeat_report(frame).collect()]
    assert len(found) == len(rows) and set(found) == set(expected)
    cut = repeats.without_repeats(frame)
    assert cut.columns == frame.columns and cut.count() == len(rows)


def test_first_strings():
    rng = np.random.default_rng(0)
    for letters in (1, 2, 26):
        base = rng.integers(97, 97 + letters, 700, dtype=np.uint8)
        contents = []
        for _ in range(8):
            at = int(rng.integers(0, 500))
            part = base[at : at + int(rng.integers(80, 200))].copy()
            part[int(rng.integers(len(part)))] = 90
            contents.append(part.tobytes())
        first, expected = {}, []
        for d, t in enumerate(contents):
            expected += [len(t) - i >= 100 and first.setdefault(t[i : i + 100], (d, i)) == (d, i) for i in range(len(t) + 1)]
        assert repeats.first_strings(contents, np.arange(8)).tolist() == expected


def test_transforms_of_repeats_fit_a_cache(monkeypatch):
    rng, sizes, solve = random.Random(3), [], repeats.first_strings
    contents = [rng.randbytes(150) for _ in range(4000)]
    monkeypatch.setattr(repeats, "first_strings", lambda held, ranks: sizes.append(sum(map(len, held))) or solve(held, ranks))
    numbers = pa.array(range(len(contents)))
    one = pa.array([1] * len(contents), pa.int32())
    batch = pa.RecordBatch.from_arrays(
        [numbers, one, one, pa.array(contents), numbers, numbers], ["anchor", "block", "blocks", "content", "key", "start"]
    )
    kept = [b for b in repeats._kept(iter([batch]))]
    assert sum(sum(b["n"].to_pylist()) for b in kept) == 51 * len(contents)
    assert len(sizes) > 1 and max(sizes) < 2 * repeats._BATCH


def test_shuffles_of_repeats_end_one_by_one(docs, monkeypatch):
    names, write = [], repeats.stage
    monkeypatch.setattr(repeats, "stage", lambda frame, name: names.append(name) or write(frame, name))
    repeats.removed_spans(docs.filter("doc_id is not null").select(F.col("doc_id").alias("key"), "text"))
    assert names == ["anchors", "often", "refs", "contents", "distinct", "kept", "spans"]


def test_strings_of_dealt_blocks_leave_by_parts():
    contents = [random.Random(k).randbytes(4195) for k in range(12)]
    numbers, one = pa.array(range(len(contents))), pa.array([1] * len(contents), pa.int32())
    two = pa.array([2] * len(contents), pa.int32())
    batch = pa.RecordBatch.from_arrays(
        [one, one, two, pa.array(contents), numbers, one], ["anchor", "block", "blocks", "content", "key", "start"]
    )
    kept = list(repeats._kept(iter([batch])))
    assert max(b.nbytes for b in kept) < 1 << 22
    found = [row for b in kept for row in zip(*[c.to_pylist() for c in b.columns], strict=True)]
    assert found == [(k, 1 + o, 1, c[o : o + 100]) for k, c in enumerate(contents) for o in range(4096)]


def test_texts_without_repeats_are_dealt_once(spark):
    passage = "".join(random.Random(8).choices("abcdefgh", k=150))
    texts = ["one " + passage, None, "", "two " + passage + " end", passage, "short"]
    rows = [(i, t, None if t is None else len(t)) for i, t in enumerate(texts)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = repeats.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int"))
        assert cut._jdf.queryExecution().sparkPlan().toString().count("Join") == 1
        found = sorted(map(tuple, cut.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    left = ["one " + passage, None, "", "two end", "", "short"]
    assert found == [(i, t, len(t or "")) for i, t in enumerate(left)]


def test_words_of_scores_are_those_of_bytes():
    texts = [*odd_texts(), "  a\x0bb\x0c c\r\n", "x y\x1cz\x00", "\u2003wide a", "a"]
    for cut in (0, 3, len(texts)):
        held = pa.chunked_array([pa.array(texts[:cut], pa.string()), pa.array(texts[cut:], pa.string())])
        words = [(xxhash.xxh64_intdigest(w), i) for i, t in enumerate(texts) for w in (t or "").encode().split()]
        hashes, doc = lm._words(held)
        assert list(zip(hashes.tolist(), doc.tolist(), strict=True)) == words
    assert [len(a) for a in lm._words(pa.chunked_array([], pa.string()))] == [0, 0]
