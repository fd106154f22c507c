import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeromill.llm import packing


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_capacity(rule):
    r = random.Random(1)
    for _ in range(60):
        histogram = {length: r.randrange(1, 7) for length in r.sample(range(1, 65), 9)}
        docs, cost = r.randrange(2, 9), r.randrange(4096, 5000)
        rows, bins = packing.plan(histogram, capacity=64, max_docs=docs, max_cost=cost, rule=rule)
        placed = defaultdict(list)
        for length, n in histogram.items():
            mine = rows[rows[:, 0] == length]
            for k in range(n):
                x = mine[np.searchsorted(mine[:, 1], k, "right") - 1]
                nth = k - x[1]
                placed[x[3] + nth // x[2]].append((x[4] + nth % x[2] * length, length))
        assert sorted(placed) == list(range(bins))
        for entries in placed.values():
            at = 0
            for offset, length in sorted(entries):
                assert offset == at
                at += length
            assert at <= 64 and len(entries) <= docs and sum(n * n for _, n in entries) <= cost


def test_plan_is_close_to_the_bound():
    r = np.random.default_rng(3)
    lengths = np.minimum(2048, r.lognormal(6, 1, 50_000).astype(int) + 1)
    histogram = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True)), strict=True))
    _, bins = packing.plan(histogram)
    assert bins <= 1.005 * lengths.sum() / 2048 + 1
    with pytest.raises(ValueError):
        packing.plan({2049: 1})
    assert packing.plan({})[1] == 0


def test_ids_are_the_library_ids():
    from tokenizers import Tokenizer

    path = packing.vocabulary()
    library, mine = Tokenizer.from_file(path), packing.Tokeniser(path)
    r = random.Random(7)
    texts = ["", " ", "It's DON'T we'll\x85a\xa0b\x1cc", "<|endoftext|> x", "ΑΣ Σ", "é ́", "naïve ½ ²3 ªµß"]
    texts += ["".join(chr(r.choice([r.randrange(256), r.randrange(32, 127), 32, 39])) for _ in range(r.randrange(40))) for _ in range(500)]
    for t in texts:
        assert np.frombuffer(mine.ids(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_long_texts_go_in_chunks(monkeypatch):
    from tokenizers import Tokenizer

    path = packing.vocabulary()
    library, mine = Tokenizer.from_file(path), packing.Tokeniser(path)
    monkeypatch.setattr(packing, "CHUNK", 20)
    r = random.Random(9)
    for extra in ("", "Σé́", "<|endoftext|>"):
        for _ in range(60):
            text = "".join(r.choices(["don't ", "x", "\n\n", " ", "12 ", "...", "naïve\xa0", "word " * 3, extra], k=60)) + extra
            assert np.frombuffer(mine.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
            assert "".join(packing.chunks(text, 20)) == text


def least_bins(lengths, capacity):
    """The least number of bins, by trying all ways."""
    best = len(lengths)

    def put(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= lengths[k]:
                put(k + 1, [*rooms[:i], rooms[i] - lengths[k], *rooms[i + 1 :]])
        put(k + 1, [*rooms, capacity - lengths[k]])

    put(0, [])
    return best


def test_plan_against_the_optimum():
    r = random.Random(2)
    more = 0
    for _ in range(80):
        lengths = sorted((r.randrange(1, 21) for _ in range(r.randrange(1, 9))), reverse=True)
        histogram = {n: lengths.count(n) for n in lengths}
        best, bins = least_bins(lengths, 20), packing.plan(histogram, capacity=20)[1]
        assert best <= bins <= best + 1
        more += bins - best
    assert more <= 8


def test_many_pieces_of_one_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_PIECES", 7)
    docs = spark.createDataFrame([(i, "same text") for i in range(200)] + [(500, "other, longer text")], "doc_id long, text string")
    out = packing.op7(docs, packing.vocabulary()).collect()
    fill = defaultdict(int)
    for p in sorted(out, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill[p.sequence_id]
        fill[p.sequence_id] += p.length
    assert len(out) == 201 and len(fill) == 1


def test_pack(spark):
    r = random.Random(5)
    words = ["alpha", "beta", "gamma,", "delta's", "x"]
    rows = [(i, " ".join(r.choices(words, k=r.choice([0, 1, 5, 300, 5000])))) for i in range(120)] + [(500, None), (500, None), (None, "x y"), (7, "a" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("x")).withColumn("part", F.lit(1))
    out = packing.pack(docs, packing.vocabulary()).collect()
    mine = packing.Tokeniser(packing.vocabulary())
    want = sorted(zlib.crc32(mine.ids(t or "") + bytes(4)) for _, t in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in out:
        assert p.length <= 2048 and len(p.ids) == 4 * p.length and zlib.crc32(p.ids) == p.ids_crc32 and p.start == 2048 * p.piece
        by_sequence[p.sequence_id].append(p)
        if p.doc_id not in (500, None, 7):
            by_doc[p.doc_id].append(p)
    texts = dict(rows)
    for doc_id, pieces in by_doc.items():
        assert b"".join(p.ids for p in sorted(pieces, key=lambda p: p.piece)) == mine.ids(texts[doc_id]) + bytes(4) or doc_id == 7
    assert len(out) >= len(want)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    total = sum(p.length for p in out)
    assert len(by_sequence) <= -(-total // 2048) * 1.1 + 2
    assert packing.op7(spark.createDataFrame([], "doc_id long, text string"), packing.vocabulary()).count() == 0
