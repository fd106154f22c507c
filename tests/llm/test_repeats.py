import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeromill.llm import repeats


def brute_force(rows: list[tuple[int, str | None]], length: int = repeats.LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """The same by counting every window of every text, for small inputs."""
    seen: dict[bytes, int] = {}
    texts = {d: (t or "").encode() for d, t in rows}
    for t in texts.values():
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = {}
    for d, t in texts.items():
        cut = repeats.merged([(i, i + length) for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1])
        gone = set().union(*[range(a, b) for a, b in cut]) if cut else set()
        kept = bytes(b for i, b in enumerate(t) if i not in gone)
        out[d] = (len(t), len(gone), len(cut), hashlib.sha256(kept).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def corpus(seed, n=60):
    r = random.Random(seed)
    alphabet = r.choice(["ab", "abcdefgh é", "abcdefghijklmnopqrstuvwxyz ß"])
    passage = ["".join(r.choices(alphabet, k=r.randrange(150, 900))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randrange(4)):
            p = r.choice(passage)
            a = r.randrange(len(p))
            parts.append(r.choice([p, p[a:], p[:a], "".join(r.choices(alphabet, k=r.randrange(300)))]))
        rows.append((i, "".join(parts)))
    rows += [(n, None), (n + 1, ""), (n + 2, "a" * 199), (n + 3, "a" * 201), (n + 4, "xyz" * 400), (n + 5, rows[1][1]), (n + 6, "q" * 200)]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_windows(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("place", F.lit(1)).repartition(5)
    assert got(repeats.op1(docs)) == brute_force(rows)


def test_collections_and_many_chunks(spark, monkeypatch):
    rows = corpus(4, 20)
    monkeypatch.setattr(repeats, "CHUNK", 4)
    c = repeats.Collection(10, 20, 5)
    c.add(7, 0, 2, b"abcdefghijklmnopqrstu")
    c.add(7, 0, 2, b"Xbcdefghijklmnopqrstu")
    c.add(8, 0, 2, b"Xbcdefghijklmnopqrstu")
    found = c.repeated()
    assert found.sum() == 2 and found[0, 1] and found[1, 1]
    assert got(repeats.op1(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_force(rows)


def test_edge_of_a_passage_that_many_share(spark):
    r = random.Random(12)
    letters = "abcdefghijklmnop"
    passage = "".join(r.choices(letters, k=700))
    tails = ["".join(r.choices(letters, k=400)) for _ in range(12)]
    rows = [(i, "".join(r.choices(letters, k=r.randrange(300))) + passage + r.choice(tails)[: r.randrange(400)]) for i in range(60)]
    out = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), split=5).collect()
    assert {x.doc_id: hashlib.sha256(bytes(x.kept)).hexdigest() for x in out} == {d: w[3] for d, w in brute_force(rows).items()}


@pytest.mark.parametrize("split", [1, 3])
def test_busy_anchors_are_split(spark, split):
    rows = corpus(6, 40)
    out = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), split=split).collect()
    want = brute_force(rows)
    assert {r.doc_id: (r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed)) for r in out} == {d: w[:3] for d, w in want.items()}


def test_range_min():
    r = np.random.default_rng(0)
    v = r.integers(0, 99, 50)
    start = r.integers(0, 49, 200)
    end = np.array([r.integers(a + 1, 51) for a in start])
    assert (repeats._range_min(v, start, end) == [v[a:b].min() for a, b in zip(start, end, strict=True)]).all()


def test_no_rows_null_and_repeated_ids(spark):
    assert repeats.op1(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = "".join(random.Random(9).choices("abcdef", k=300))
    rows = [(None, text), (5, text), (5, text), (5, "z" + text[:250]), (6, "tail")]
    out = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeats.op1(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == [(0, 300, 300), (5, 251, 250), (5, 300, 300), (5, 300, 300), (6, 4, 0)]
