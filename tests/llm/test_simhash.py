import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aeromill.llm import simhash
from aeromill.llm.graph import components


def brute(rows):
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    comp = list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    return sorted((d, f"{prints[i]:016x}", min(groups[root(i)])) for i, (d, _) in enumerate(rows))


def corpus(n, seed):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    rows = []
    for i in range(n):
        if rows and r.random() < 0.5:
            text = (r.choice(rows)[1] or "").split()
            for _ in range(r.randrange(3)):
                if text:
                    text[r.randrange(len(text))] = r.choice(words)
            rows.append((i, " ".join(text)))
        else:
            rows.append((i, " ".join(r.choices(words, k=r.choice([0, 1, 2, 3, 60, 300])))))
    return [*rows, (n, None), (n + 1, ""), (n + 2, "A b\tC\x0bd"), (n + 3, "a B c\x0cD")]


def test_against_all_pairs(spark):
    rows = corpus(120, 1)
    got = simhash.op6(spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("component", F.lit("x")))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_small_blocks_split_groups(spark):
    rows = corpus(80, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(docs, block=3)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == sorted((d, c) for d, _, c in brute(rows))


def jaccard(a, b, words=5):
    a, b = (set(simhash.shingle_hashes(t or "", words)) for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def groups(rows, similarity=0.8):
    """Least id of each row's group, by all pairs; nulls last."""
    root = {d: d for d, _ in rows}
    changed = True
    while changed:
        changed = False
        for d, t in rows:
            for e, u in rows:
                if root[e] < root[d] and jaccard(t, u) >= similarity:
                    root[d], changed = root[e], True
    return root


@pytest.mark.parametrize("block,shingles", [(2048, 1 << 19), (4, 300)])
def test_verified_similarity_against_all_pairs(spark, block, shingles):
    r = random.Random(8)
    words = ["v%d" % i for i in range(3000)]
    rows = []
    for i in range(40):
        text = r.choices(words, k=r.choice([8, 30, 120, 300]))
        rows.append((3 * i, " ".join(text)))
        for k in (1, 2):  # at and about the similarity that counts
            for _ in range(r.randrange(1, 2 + len(text) // 40)):
                text[r.randrange(len(text))] = "x%d" % r.randrange(99)
            rows.append((3 * i + k, " ".join(text)))
    rows += [(900, ""), (901, None), (902, "one two"), (903, "two one"), (904, rows[7][1]), (905, " ".join(words[:200])), (906, " ".join(words[12:212]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets, named = simhash.similar_groups(docs, block=block, shingles=shingles)
    got = {x.id: x.first.id for x in sets.join(named, sets["node"] == named["c_node"]).collect()}
    want = groups(rows)
    assert got == want and len(set(want.values())) < len(rows) - 20
    assert sorted(x.doc_id for x in simhash.keep_first(docs, block=block, shingles=shingles).collect()) == sorted(set(want.values()))


def test_similar_groups_go_through_the_pivot_table(spark):
    """Pairs within three bits meet without a shingle key; pairs that their stored distances tell apart are discarded."""
    fp, far = 0x0123456789ABCDEF, (1 << 40) - 1
    rows = [(1, fp, 90, [11]), (2, fp ^ 0b101, 95, [12]), (3, fp ^ (far & 0x1FFF), 92, [11]), (4, fp ^ far, 91, [11]), (5, fp ^ 1, 20, [11])]
    classes = simhash.pivot_table(spark.createDataFrame(rows, "node long, fp long, n long, keys array<long>"))
    edges = simhash.loose_links(classes, 0.8, 16, 2048).collect()
    assert _roots(edges) == {1: 1, 2: 1, 3: 1}
    moved = F.when(F.col("node") == 3, F.expr("unhex(repeat('00', 16))")).otherwise(F.col("distances"))
    assert _roots(simhash.loose_links(classes.withColumn("distances", moved), 0.8, 16, 2048).collect()) == {1: 1, 2: 1}


def test_more_classes_get_longer_keys(spark):
    for n, keys, bits in ((1000, 4, 16), (1 << 24, 10, 25), (1 << 40, 35, 35)):
        found = simhash.choices(n, 3)
        assert len(found) == keys and abs(sum(w for _, w in found[0]) - bits) < 3
    with pytest.raises(ValueError):
        simhash.choices(10, 64)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << k for k in r.sample(range(64), n)) for b in base for n in (0, 1, 2, 3, 3)}
    classes = simhash.pivot_table(spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long"))
    wide = simhash.choices
    try:
        simhash.choices = lambda n, radius: wide(1 << 40, radius)
        edges = simhash.fingerprint_links(classes).collect()
    finally:
        simhash.choices = wide
    plain = simhash.fingerprint_links(classes).collect()
    assert len(set(_roots(edges).values())) <= 40 < len(_roots(edges)) and _roots(edges) == _roots(plain)


def _roots(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for e in edges:
        a, b = sorted((find(e.a), find(e.b)))
        root[b] = a
    return {x: find(x) for x in root}


def test_fingerprint_matches_engine_hash(spark):
    text = "Alpha beta GAMMA"
    (h,) = spark.range(1).select(F.xxhash64(F.lit("alpha beta gamma"))).first()
    assert simhash.signed(simhash.fingerprint(text)) == h  # one shingle: its own hash


def test_links_find_every_close_pair():
    r = np.random.default_rng(0)
    base = r.integers(0, 2**64, 60, dtype=np.uint64)
    flips = np.uint64(1) << r.integers(0, 64, (60, 3)).astype(np.uint64)
    fps = np.concatenate((base, base ^ flips[:, 0] ^ flips[:, 1], base ^ flips[:, 2]))
    table = simhash.distance_table(fps, simhash.pivots())
    i, j = simhash.links(fps, fps, table, table)
    want = {(a, b) for a in range(len(fps)) for b in range(len(fps)) if (int(fps[a]) ^ int(fps[b])).bit_count() <= 3}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want


@pytest.mark.parametrize("edges,want", [([], {}), ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}), ([(5, 9), (9, 7), (1, 2)], {5: 5, 9: 5, 7: 5, 1: 1, 2: 1})])
def test_components(spark, edges, want):
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want


def test_empty_and_null_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.op6(none).count() == 0
    rows = spark.createDataFrame([(None, "x y z"), (4, "x y z"), (4, "x y z")], "doc_id long, text string")
    assert [r.component_id for r in simhash.op6(rows).collect()] == [4, 4, 4]
    assert isinstance(simhash.op6(rows).toPandas(), pd.DataFrame)
