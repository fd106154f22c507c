import numpy as np
import pytest
from pyspark.sql import functions as F

from aeromill.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, n, seed, hot=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(20, 16)) * 2
    x = (centres[r.integers(0, 20, n)] + r.normal(size=(n, 16)) * 0.6).astype(np.float32)
    if hot:
        x[n - hot :] = x[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def exact(rows, k=10, every=100):
    ok = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    ids, x = np.array([i for i, _ in ok]), np.stack([v for _, v in ok])
    out = {}
    for i, v in ok:
        if i % every == 0:
            d = np.sqrt(((x - v) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_exact_where_every_cell_is_probed(spark):
    rows, df = table(spark, 400, 1, hot=40)
    rows += [(1000, None, 0), (1100, [0.0] * 16, 0), (1200, [float("nan")] * 16, 0), (1300, [1.0, None] + [0.0] * 14, 0), (1400, [1.0], 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("x")).withColumn("v", F.lit(1))
    got = found(neighbours.search(df, block=64, target=1.0))
    assert got == exact([r for r in rows if r[0] not in (1400,)])


def test_recall_over_parts(spark):
    rows, df = table(spark, 6000, 2, hot=1500)
    got, want = found(neighbours.search(df, sample=2000, part_rows=500, block=256)), exact(rows)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    distance = {q: dict(v) for q, v in want.items()}
    assert all(abs(distance[q].get(i, s) - s) < 1e-12 for q, v in got.items() for i, s in v)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    assert got == found(neighbours.search(df.repartition(3), sample=2000, part_rows=500, block=256))


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (100, [0.0, 2.0], 0), (7, [1.0, 0.0], 0)], SCHEMA)
    assert found(neighbours.search(df)) == {0: [(7, 0.0), (100, 5**0.5)], 100: [(0, 5**0.5), (7, 5**0.5)]}
    assert neighbours.search(spark.createDataFrame([], SCHEMA)).count() == 0
    assert neighbours.search(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)).count() == 0


@pytest.mark.parametrize("n,part_rows,shape", [(500, 3000, (8, 1)), (4000, 60, (67, 1)), (4000, 8, (63, 2))])
def test_method_runs_on_every_size(spark, n, part_rows, shape):
    rows, df = table(spark, n, 3)
    index, router = neighbours.build_index(neighbours.valid_vectors(df), sample=1024, part_rows=part_rows)
    assert (router.parts, router.depth) == neighbours.shape(n, 1024, part_rows) and router.depth == shape[1] and router.parts > 1
    assert index.count() == n and index.select("cell").distinct().count() > router.parts / 2
    got, want = found(neighbours.search(df, sample=1024, part_rows=part_rows)), exact(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert all(len(v) == 10 for v in got.values()) and hits / sum(map(len, want.values())) >= 0.9


def test_repeated_rows_are_candidates_and_queries(spark):
    rows = [(0, [1.0, 0.0], 0)] * 3 + [(0, [5.0, 5.0], 0), (7, [2.0, 0.0], 0)]
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in neighbours.search(spark.createDataFrame(rows, SCHEMA)).collect())
    three = [(0, 1, 0, 0.0), (0, 2, 0, 0.0), (0, 3, 7, 1.0), (0, 4, 0, 6.403124)]
    other = [(0, 1, 7, 5.830952), *[(0, k, 0, 6.403124) for k in (2, 3, 4)]]
    assert got == sorted(3 * three + other)


def test_probable_cells_are_ordered_and_complete():
    r = np.random.default_rng(2)
    router = neighbours.learn(r.normal(size=(300, 4)), 5, 2)
    x = r.normal(size=(6, 4))
    for own, cells, few in zip(router.cells(x), router.probable(x, 25), router.probable(x, 3), strict=True):
        assert cells[0] == own and sorted(cells) == sorted(5 * a + b for a in range(5) for b in range(5) if a != b) and few[0] == own


@pytest.mark.parametrize("parts", [2, 7])
def test_balance(parts):
    x = np.random.default_rng(1).normal(size=(900, 8))
    sizes = np.bincount(neighbours.balanced_parts(x, neighbours.knn(x, 10), parts), minlength=parts)
    assert sizes.max() <= np.ceil(1.1 * 900 / parts) and sizes.min() > 0
