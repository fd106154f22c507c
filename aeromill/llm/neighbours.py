"""Approximate nearest neighbours over learned partitions.

A bounded sample gives a neighbour graph; the graph is cut into balanced parts (projection
bisection, then moves that raise the number of edges inside parts, under a size limit). A small
network learns to tell a vector's part. The cell of a vector is the list of its ``depth`` most
probable parts, in that order; parts and depth follow from the number of vectors, so that a cell
holds about PART_ROWS of them however many there are, and nothing of the index grows on the driver.

A query looks into its ``probes`` most probable cells and measures every vector there exactly. How
many is set on held-out vectors: the fewest that hold ``target`` of their true neighbours in the
whole table, found by brute force in one pass over it. A query whose cells hold fewer than k others
looks into four times as many until it has k, or all.

Cells are cut into blocks of about BLOCK vectors by a hash of the id, so a cell that many equal
vectors make large is searched by many tasks; each block returns its k best for a query, and the
best of those are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromill.llm.common import materialise

#: Vectors at most (about) that the graph and the classifier are made from.
SAMPLE = 8192
#: Of the sample, one in HELD_OUT is kept from learning; at most CALIBRATION of those set the probes.
HELD_OUT, CALIBRATION = 5, 512
#: Vectors a cell holds on average, and bounds of the number of parts.
PART_ROWS = 3000
MIN_PARTS, MAX_PARTS = 8, 256
BLOCK = 4096
GRAPH_K = 10


def knn(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row, by blocked products."""
    norms, out = (x * x).sum(axis=1), []
    for at in range(0, len(x), 512):
        d = norms[None, :] - 2.0 * (x[at : at + 512] @ x.T)
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out.append(np.argpartition(d, min(k, len(x) - 1) - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, neighbours: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 25) -> np.ndarray:
    """Part of each row: few graph edges between parts, no part above ``slack`` times the mean size."""
    label = np.zeros(len(x), int)

    def bisect(rows: np.ndarray, first: int, n: int) -> None:
        if n == 1:
            label[rows] = first
            return
        centred = x[rows] - x[rows].mean(axis=0)
        axis = np.ones(x.shape[1])
        covariance = centred.T @ centred
        for _ in range(30):
            axis = covariance @ axis
            axis /= np.linalg.norm(axis) + 1e-30
        order = rows[np.argsort(centred @ axis, kind="stable")]
        half = n // 2
        cut = len(rows) * half // n
        bisect(order[:cut], first, half)
        bisect(order[cut:], first + half, n - half)

    bisect(np.arange(len(x)), 0, parts)
    a, b = np.repeat(np.arange(len(x)), neighbours.shape[1]), neighbours.ravel()
    limit = int(np.ceil(slack * len(x) / parts))
    for _ in range(rounds):
        inside = np.zeros((len(x), parts))
        np.add.at(inside, (a, label[b]), 1.0)
        np.add.at(inside, (b, label[a]), 1.0)
        best = inside.argmax(axis=1)
        gain = inside[np.arange(len(x)), best] - inside[np.arange(len(x)), label]
        sizes, moved = np.bincount(label, minlength=parts), 0
        least = int(len(x) / parts / slack / 2)
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < limit and sizes[label[i]] > least:
                sizes[best[i]] += 1
                sizes[label[i]] -= 1
                label[i] = best[i]
                moved += 1
        if moved < len(x) // 500:
            break
    return label


@dataclass
class Router:
    """One hidden layer: standardised vector -> probability of each part."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    depth: int = 1
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.b2)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row: its most probable parts as digits, the first one highest."""
        order = np.argsort(-self.logits(x), axis=1, kind="stable")[:, : self.depth]
        return order @ self.parts ** np.arange(self.depth - 1, -1, -1)

    def probable(self, x: np.ndarray, count: int) -> list[np.ndarray]:
        """For each row its ``count`` most probable cells, most probable first.

        Parts are drawn one after the other without putting back; of each further level the
        ``count`` best beginnings are followed.
        """
        logits = self.logits(x)
        logits -= logits.max(axis=1, keepdims=True)
        share = np.exp(logits)
        share /= share.sum(axis=1, keepdims=True)
        out = []
        for p in share:
            cell, chance, rest = np.zeros(1, np.int64), np.ones(1), np.ones(1)
            used = np.zeros((1, self.parts), bool)
            for _ in range(self.depth):
                following = np.where(used, -1.0, chance[:, None] * p / np.maximum(rest, 1e-12)[:, None])
                best = np.argsort(-following.ravel(), kind="stable")[:count]
                best = best[following.ravel()[best] >= 0]
                row, part = np.divmod(best, self.parts)
                cell, chance, rest = cell[row] * self.parts + part, following.ravel()[best], rest[row] - p[part]
                used = used[row]
                used[np.arange(len(row)), part] = True
            out.append(cell)
        return out


def train_router(x: np.ndarray, label: np.ndarray, parts: int, hidden: int = 128, epochs: int = 40, rate: float = 3e-3, seed: int = 0) -> Router:
    """Adam on the cross-entropy, with a fixed seed: the same sample gives the same router."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), 1.0 / (x.std() + 1e-12)
    z = (x - mean) * scale
    p = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs) + 1e-5
        order = rng.permutation(len(z))
        for at in range(0, len(z), 128):
            rows = order[at : at + 128]
            h = np.maximum(z[rows] @ p[0] + p[1], 0)
            out = h @ p[2] + p[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            out /= out.sum(axis=1, keepdims=True)
            out[np.arange(len(rows)), label[rows]] -= 1
            out /= len(rows)
            back = (out @ p[2].T) * (h > 0)
            t += 1
            for k, g in enumerate((z[rows].T @ back, back.sum(axis=0), h.T @ out, out.sum(axis=0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= step * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Router(mean, scale, *p)


def shape(n: int, sample: int, part_rows: int) -> tuple[int, int]:
    """(parts, depth) for so many vectors: the fewest levels on which cells hold about ``part_rows``.

    On a second level and below, about a quarter of the parts follow on a given one.
    """
    most, depth = max(MIN_PARTS, min(MAX_PARTS, sample // 16)), 1
    while n > 2 * part_rows * most * (most / 4) ** (depth - 1):
        depth += 1
    wanted = (max(1.0, n / part_rows) * 4 ** (depth - 1)) ** (1 / depth)
    return max(MIN_PARTS, min(most, int(np.ceil(wanted)))), depth


def learn(x: np.ndarray, parts: int, depth: int = 1) -> Router:
    """Router of a sample of different vectors; fewer parts where there are not as many vectors."""
    parts = max(1, min(parts, len(x) // 2))
    if parts == 1:
        zeros = np.zeros
        return Router(zeros(x.shape[1]), 1.0, zeros((x.shape[1], 1)), zeros(1), zeros((1, 1)), zeros(1))
    near = knn(x, min(GRAPH_K, len(x) - 1))
    router = train_router(x, balanced_parts(x, near, parts), parts)
    router.depth = min(depth, parts)
    return router


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v: array<double>): rows that take part, all of the most frequent dimension."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .where("vec_id IS NOT NULL AND v IS NOT NULL")
        .where(~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda e: e != 0))
    )
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (top[0]["d"] if top else 0))


_INDEXED = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("cell", T.LongType())])
_NEAR = T.StructType([T.StructField("asked", T.IntegerType()), T.StructField("cell", T.LongType()), T.StructField("score", T.DoubleType())])
_PROBES = T.StructType([*_INDEXED.fields[:2], T.StructField("copies", T.LongType()), T.StructField("cells", T.ArrayType(T.LongType()))])
_BEST = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("query_hash", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def build_index(rows: DataFrame, sample: int = SAMPLE, part_rows: int = PART_ROWS, target: float = 0.97) -> tuple[DataFrame, Router | None]:
    """(vec_id, v, cell) of every valid vector, and the router, its probes set; None without vectors."""
    n = rows.count()
    if not n:
        return rows.withColumn("cell", F.lit(0).cast("long")), None
    share = min(1.0, sample / n)
    bucket = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 20))
    held = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(HELD_OUT)) == 0
    picked = rows.where(bucket < int(share * (1 << 20)) + 1).select("vec_id", "v", held.alias("held")).orderBy("vec_id", "v").collect()
    different = lambda found: np.unique(np.array([r["v"] for r in found], float).reshape(len(found), -1), axis=0)
    learned = [r for r in picked if not r["held"]] or picked
    x = different(learned) if learned else np.array([rows.orderBy("vec_id").first()["v"]], float)
    router = learn(x, *shape(n, sample, part_rows))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(router.cells(_matrix(batch.column(1))), pa.int64())], names=_INDEXED.names)

    indexed = materialise(rows.select("vec_id", "v").mapInArrow(assign, _INDEXED), "indexed")
    asked = [r for r in picked if r["held"]] or picked
    router.probes = calibrated(indexed, router, different(asked[:: -(-len(asked) // CALIBRATION)]), target) if asked else 1
    return indexed, router


def calibrated(indexed: DataFrame, router: Router, asked: np.ndarray, target: float, k: int = GRAPH_K) -> int:
    """The fewest probes that hold ``target`` of the true neighbours of ``asked`` in the whole table.

    Each task keeps the k best of its rows for each of the (boundedly many) vectors.
    """
    if router.parts == 1 or target >= 1:  # everywhere
        return router.parts**router.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.zeros((len(asked), 0))
        cell = np.zeros((len(asked), 0), np.int64)
        norms = (asked**2).sum(axis=1)[:, None]
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = _matrix(part.column(1))
                near = np.maximum(norms + (x * x).sum(axis=1) - 2.0 * (asked @ x.T), 0.0)
                near[near <= 1e-9 * norms] = np.inf  # the vector itself and its copies
                score = np.concatenate((score, near), axis=1)
                cell = np.concatenate((cell, np.broadcast_to(part.column(2).to_numpy(), near.shape)), axis=1)
                if score.shape[1] > k:
                    best = np.argpartition(score, k - 1, axis=1)[:, :k]
                    score, cell = np.take_along_axis(score, best, axis=1), np.take_along_axis(cell, best, axis=1)
        i, j = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(cell[i, j], pa.int64()), pa.array(score[i, j], pa.float64())], names=_NEAR.names)

    nearest_first = Window.partitionBy("asked").orderBy("score", "cell")
    true = indexed.mapInArrow(run, _NEAR).withColumn("r", F.row_number().over(nearest_first)).where(F.col("r") <= k).select("asked", "cell").collect()
    if not true:
        return 1
    most = min(router.parts**router.depth, 4096)
    place = [{c: p for p, c in enumerate(cells.tolist(), 1)} for cells in router.probable(asked, most)]
    ranks = np.sort([place[r["asked"]].get(r["cell"], most) for r in true])
    return int(ranks[min(len(ranks) - 1, int(np.ceil(target * len(ranks))) - 1)])


def nearest(ids: np.ndarray, x: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact distances of the k nearest rows but the query's own; ties to smaller ids.

    Of rows that repeat the query's id and vector one is its own. A product ranks all rows; those
    within rounding of the k-th are measured exactly, so equal vectors tie exactly.
    """
    rough = ((x * x).sum(axis=1) + query @ query) - 2.0 * (x @ query)
    same = np.flatnonzero(ids == own)
    mine = same[(x[same] == query).all(axis=1)][:1]
    rough[mine] = np.inf
    if len(ids) - len(mine) > k:
        cut = np.partition(rough, k - 1)[k - 1]
        near = np.flatnonzero(rough <= cut + 1e-9 * (abs(cut) + query @ query + 1e-30) + 1e-12)
    else:
        near = np.flatnonzero(np.isfinite(rough))
    exact = np.sqrt(((x[near] - query) ** 2).sum(axis=1))
    order = np.lexsort((ids[near], exact))[:k]
    return ids[near][order], exact[order]


def probed(queries: DataFrame, router: Router, probes: int) -> DataFrame:
    """``queries`` (vec_id, v, copies) with their ``probes`` most probable cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cells = router.probable(_matrix(part.column(1)), probes)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([c.tolist() for c in cells], pa.list_(pa.int64()))], names=_PROBES.names)

    return queries.mapInArrow(run, _PROBES)


def look(indexed: DataFrame, sizes: DataFrame, queries: DataFrame, k: int, block: int) -> DataFrame:
    """_BEST: the k nearest of each query (vec_id, v, cells) in each block of its cells."""
    own_block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    candidates = indexed.join(sizes, "cell").select(
        "cell", own_block.alias("block"), F.lit(0).alias("is_query"), "vec_id", F.lit(0).cast("long").alias("query_hash"), "v"
    )
    asked = (
        queries.select("vec_id", "v", F.explode("cells").alias("cell")).join(sizes, "cell")
        .withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .select("cell", "block", F.lit(1).alias("is_query"), "vec_id", F.xxhash64("v").alias("query_hash"), "v")
    )
    dealt = candidates.unionByName(asked).repartition("cell", "block").sortWithinPartitions("cell", "block", "is_query", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, ids, x = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            own, hashes, v = batch.column(3).to_numpy(), batch.column(4).to_numpy(), _matrix(batch.column(5))
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if key != tuple(keys[a, :2]):
                    key, held, ids, x = tuple(keys[a, :2]), [], np.zeros(0, np.int64), np.zeros((0, v.shape[1]))
                if keys[a, 2] == 0:
                    held.append((own[a:b], v[a:b]))
                    continue
                if held:
                    ids, x = np.concatenate([ids, *[h[0] for h in held]]), np.concatenate([x, *[h[1] for h in held]])
                    held = []
                out = [(own[i], hashes[i], *nearest(ids, x, v[i], own[i], k)) for i in range(a, b)]
                n = [len(o[2]) for o in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([o[0] for o in out], n), pa.int64()), pa.array(np.repeat([o[1] for o in out], n), pa.int64()),
                        pa.array(np.concatenate([o[2] for o in out]), pa.int64()), pa.array(np.concatenate([o[3] for o in out]), pa.float64()),
                    ], names=_BEST.names,
                )

    order = Window.partitionBy("query_id", "query_hash").orderBy("score", "vec_id")
    return dealt.mapInArrow(run, _BEST).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame, every: int = 100, k: int = 10, sample: int = SAMPLE, part_rows: int = PART_ROWS, block: int = BLOCK, target: float = 0.97
) -> DataFrame:
    """The k nearest found for each query: rows of ``vectors`` whose vec_id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id, score (Euclidean distance of the original vectors in
    double precision), ties to the smaller vec_id. Candidates are all rows but the query's own, so
    a row that repeats the query's id, or id and vector, is one. Vectors that are null, zero, of
    another than the most frequent dimension (there is no distance between dimensions), or hold
    null or non-finite components take no part, nor do null ids. A query whose cells hold fewer
    than k others probes on until it has k or all. Rows that repeat a query are queries of their
    own with the same results; queries that share an id but not a vector are ranked apart. No rows
    give none; other columns are ignored.
    """
    indexed, router = build_index(valid_vectors(vectors), sample, part_rows, target)
    empty = indexed.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    if router is None:
        return empty
    sizes = materialise(indexed.groupBy("cell").agg(F.ceil(F.count("*") / block).alias("blocks")), "cells")
    queries = materialise(indexed.where(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(F.count("*").alias("copies")), "queries")
    wanted = min(k, indexed.count() - 1)
    probes, most, open_queries, out = router.probes, router.parts**router.depth, queries, empty
    while True:
        best = materialise(look(indexed, sizes, probed(open_queries, router, probes), k, block), "nearest")
        counts = best.groupBy("query_id", "query_hash").agg(F.count("*").alias("n"))
        got = counts.where(F.col("n") >= (wanted if probes < most else 0)).select("query_id", "query_hash")
        done = open_queries.withColumns({"query_id": F.col("vec_id"), "query_hash": F.xxhash64("v")}).join(got, ["query_id", "query_hash"])
        rows = best.join(done.select("query_id", "query_hash", "copies"), ["query_id", "query_hash"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        out = rows.select("query_id", "rank", "vec_id", "score") if out is empty else out.unionByName(rows.select("query_id", "rank", "vec_id", "score"))
        if probes >= most:
            return out
        rest = open_queries.join(done.select("vec_id", "v"), ["vec_id", "v"], "left_anti")
        rest = materialise(rest, "queries")
        if not rest.limit(1).count():
            return out
        open_queries, probes = rest, min(4 * probes, most)
