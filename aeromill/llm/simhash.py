"""SimHash near-duplicates with pivot distance tables.

``near_duplicates`` links fingerprints at ``radius`` or fewer differing bits. Equal fingerprints are
one class, so copies never meet each other. The Hamming distances of every class to the reference
fingerprints are computed once and written with it (the pivot table). To bring the two ends of a
link together, the 64 bits are cut into ``radius + c`` blocks: two fingerprints within ``radius``
agree on at least ``c`` of them, so the classes are dealt by every choice of ``c`` blocks, ``c`` such
that a group stays small however many classes there are. (The pivot tables alone give no key to deal
rows by: every fingerprint is about 32 bits from every pivot; the README has figures.) Inside a
group pairs whose pivot distances differ by more than ``radius`` anywhere are discarded, by the
triangle inequality, and only survivors are compared bit by bit.

``similar_groups`` links texts whose shingle sets have a Jaccard similarity of ``similarity`` or
more, which is verified. Different sets are classes, written with their pivot table. Classes are dealt
by bit blocks, as above, so that all pairs within RADIUS bits meet, and, as such links are further
apart, by their ``keys`` least shingle hashes: the least hash of both sets together is in both with a
probability of their similarity, so a link of 0.8 has no such hash in common in about 0.2 ** keys of
cases, 3 in a million for 8. In a group pairs are discarded by size and by the pivot table, and
survivors are compared bit by bit: within RADIUS or, for shingle hashes, ``radius`` bits (a link of
0.8 is about 9.7 bits apart, with a deviation of 2.9, so 16 bits hold 99 % of the links of just 0.8 and
all but a few in a thousand of the others) they are loose links. The members of their components, few
of all texts, are dealt again with their pivot table and whole sets; pairs that the table leaves and
that are not yet connected are verified.

Groups are cut into blocks, and every pair of blocks is a task of its own, so no task holds an
unbounded group and no pair is skipped. A task returns a spanning forest of its links (at most one
edge per class), never the pairs, and compares ROWS of a block at a time.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromill.llm.arrow import map_rows
from aeromill.llm.common import NULL_ID, id_key, materialise
from aeromill.llm.graph import components

RADIUS = 3
PIVOTS = 16
BLOCK = 2048
#: Rows of a block that are compared with a whole block at a time.
ROWS = 256
#: Classes that a group holds on average at most, where fingerprints are spread evenly.
GROUP = 64
#: Differing bits up to which pairs are looked at for a similarity of 0.8, and shingles that a block holds.
LOOSE, SHINGLES = 16, 1 << 19

FINGERPRINTS = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "text_hash", "fp")])


def shingle_hashes(text: str, words: int = 3) -> list[int]:
    """XXH64 (seed 42) of the text's word shingles, repeats included; of all words if there are fewer."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space only
    if not found:
        return []
    flat = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return [digest(flat, 42)]
    return [digest(flat[a:b], 42) for a, b in zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]


def fingerprint(text: str, words: int = 3) -> int:
    """64-bit SimHash of the text's word shingles (repeats counted); 0 without words."""
    return vote(shingle_hashes(text, words))


def vote(hashes: list[int]) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    n, votes = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        bits = np.unpackbits(np.array(hashes[at : at + 4096], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def signed(x: int) -> int:
    return x - (x >> 63 << 64)


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """FINGERPRINTS of every row of ``docs`` (doc_id, text); a null text is empty."""

    def make():
        return lambda doc_id, text_hash, text: [(doc_id, text_hash, signed(fingerprint(text, words)))]

    return map_rows(_texts(docs), make, FINGERPRINTS)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), text_hash(), F.coalesce(F.col("text"), F.lit("")))


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed, spread over the space by a seeded generator."""
    return np.random.default_rng(64).integers(0, 2**64, n, dtype=np.uint64)


def distance_table(fps: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each reference, one row per reference."""
    return np.bitwise_count(fps[None, :] ^ reference[:, None]).astype(np.int8)


def links(left: np.ndarray, right: np.ndarray, table_l: np.ndarray, table_r: np.ndarray, radius: int = RADIUS, alive: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with Hamming distance of left[i], right[j] at most ``radius``, of those ``alive`` if given.

    The first rows of the pivot tables discard pairs over a whole block at once (one byte a pair),
    the other rows only what is left; survivors are verified on the fingerprints.
    """
    alive = np.ones((len(left), len(right)), bool) if alive is None else alive.copy()
    for row in range(min(4, len(table_l))):
        alive &= np.abs(table_l[row][:, None] - table_r[row][None, :]) <= radius
    i, j = np.nonzero(alive)
    for row in range(4, len(table_l)):
        if not len(i):
            break
        near = np.abs(table_l[row][i] - table_r[row][j]) <= radius
        i, j = i[near], j[near]
    near = np.bitwise_count(left[i] ^ right[j]) <= radius
    return i[near], j[near]


def spread(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Root labels (least member) after the links (i, j) have joined the components."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


def within(n: int, find) -> np.ndarray:
    """Root of each of ``n`` entries of a block; ``find(rows, columns)`` gives the links of two slices."""
    label = np.arange(n)
    for at in range(0, n, ROWS):
        i, j = find(slice(at, at + ROWS), slice(at, n))
        label = spread(label, i + at, j + at)
    return label


def forest(nodes: np.ndarray, n_row: int, find) -> tuple[np.ndarray, np.ndarray]:
    """Edges that a task gives for ``nodes``: a star per component if they are one block, or, if the
    first ``n_row`` are one block and the others another, those that join components of the one with
    components of the other. The inside of either is left to its own task, so a group of n entries
    gives about n edges however many blocks it has."""
    n = len(nodes)
    if n_row == n:
        inside = np.arange(n)
        label = within(n, find)
    else:
        shifted = lambda rows, columns: find(slice(rows.start + n_row, rows.stop + n_row), slice(columns.start + n_row, columns.stop + n_row))
        row = within(n_row, lambda r, c: find(slice(r.start, min(r.stop, n_row)), c))
        inside = np.concatenate((row, within(n - n_row, shifted) + n_row))
        label = inside.copy()
        for at in range(0, n_row, ROWS):
            i, j = find(slice(at, min(at + ROWS, n_row)), slice(n_row, n))
            label = spread(label, i + at, j + n_row)
    moved = np.flatnonzero((label != inside) & (inside == np.arange(n)))
    return nodes[moved], nodes[label[moved]]


EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
_GROUP = ["key_no", "bits", "row_block", "col_block"]


Rows = dict[str, np.ndarray]


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, Rows]]:
    """(key, columns) of each run of equal keys in sorted batches; binary columns as objects."""
    held: list[Rows] = []
    key: tuple | None = None

    def whole() -> Rows:
        return held[0] if len(held) == 1 else {name: np.concatenate([h[name] for h in held]) for name in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {name: c.to_numpy(zero_copy_only=False) for name, c in zip(batch.schema.names, batch.columns, strict=True)}
        keys = np.stack([columns[name].astype(np.int64) for name in batch.schema.names[:n_keys]], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        firsts = keys[cuts[:-1]].tolist()
        for a, b, first in zip(cuts, cuts[1:], firsts, strict=False):
            if held and key != tuple(first):
                yield key, whole()
                held = []
            key = tuple(first)
            held.append({name: c[a:b] for name, c in columns.items()})
    if held:
        yield key, whole()


def in_blocks(keyed: DataFrame, blocks: DataFrame, columns: list[str], keys: list[str], node: str) -> DataFrame:
    """``keyed`` rows for each pair of blocks of their group, dealt and sorted by it, with ``own`` block.

    ``blocks`` (``keys``, blocks: a power of two, so that groups with nearly the same members have
    the same blocks, and so the same edges) is written: a group that is hot is split by Spark.
    """
    own = keyed.join(blocks, keys).withColumn("own", F.pmod(F.xxhash64(node), F.col("blocks")).cast("int"))
    tasks = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    by = [*keys, "row_block", "col_block"]
    dealt = tasks.select(*keys, F.least("own", "other").alias("row_block"), F.greatest("own", "other").alias("col_block"), "own", *columns)
    return dealt.repartition(*by).sortWithinPartitions(*by)


def _power(n: Column, size: int) -> Column:
    """Blocks for ``n``, as a power of two, of about ``size`` each."""
    return F.pow(F.lit(2), F.greatest(F.ceil(F.log2(n / size)), F.lit(0))).cast("int").alias("blocks")


def _task(rows: Rows, key: tuple) -> tuple[Rows, int]:
    """The rows of a task, those of its row block first and in a fixed order, and how many those are."""
    second = rows["own"] != key[-2]
    order = np.lexsort((rows["node"], second))
    return {name: c[order] for name, c in rows.items()}, int((~second).sum())


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], names=["a", "b"])


def choices(n: int, radius: int) -> list[list[tuple[int, int]]]:
    """Blocks (first bit, width) that a key takes together, for each key, for so many classes."""
    for c in range(1, min(8, 64 - radius) + 1):
        total = radius + c
        edges = [64 * k // total for k in range(total + 1)]
        blocks = list(zip(edges, np.diff(edges).tolist(), strict=False))
        if c == min(8, 64 - radius) or n <= GROUP << sum(sorted(w for _, w in blocks)[:c]):
            return [list(x) for x in itertools.combinations(blocks, c)]
    raise ValueError("so wide a radius has no blocks")


def block_keys(n: int, radius: int) -> list[Column]:
    """The bits of ``fp`` under each key, for so many classes."""

    def bits(blocks: list[tuple[int, int]]) -> Column:
        out = F.lit(0).cast("long")
        for first, width in blocks:
            out = F.shiftleft(out, width).bitwiseOR(F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1)))
        return out

    return [bits(k) for k in choices(n, radius)]


def _tables(distances: np.ndarray) -> np.ndarray:
    """The pivot table of a task's rows, one row per reference."""
    return np.frombuffer(b"".join(distances), np.int8).reshape(len(distances), -1).T


def fingerprint_links(classes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect all linked fingerprints of ``classes`` (fp, distances; distinct, materialised)."""
    keyed = classes.select(F.col("fp").alias("node"), "distances", F.posexplode(F.array(*block_keys(classes.count(), radius))).alias("key_no", "bits"))
    sizes = keyed.groupBy("key_no", "bits").agg(F.count("*").alias("n")).where("n > 1")
    blocks = materialise(sizes.select("key_no", "bits", _power(F.col("n"), block)), "groups")
    dealt = in_blocks(keyed, blocks, ["node", "distances"], _GROUP[:2], "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in grouped(batches, len(_GROUP)):
            if len(rows["node"]) < 2:
                continue
            rows, n_row = _task(rows, key)
            if not n_row:
                continue
            nodes = rows["node"]
            fps = nodes.view(np.uint64)
            table = _tables(rows["distances"])
            a, b = forest(nodes, n_row, lambda r, c: links(fps[r], fps[c], table[:, r], table[:, c], radius))  # noqa: B023
            if len(a):
                yield _edge_batch(a, b)

    return dealt.mapInArrow(run, EDGES)


def pivot_table(classes: DataFrame, n_pivots: int = PIVOTS) -> DataFrame:
    """``classes`` (with fp) with ``distances``: one byte for the distance to each reference."""
    schema = T.StructType([*classes.schema.fields, T.StructField("distances", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reference = pivots(n_pivots)
        for batch in batches:
            table = distance_table(batch.column("fp").to_numpy().view(np.uint64), reference).T
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.tobytes() for x in table], pa.binary())], names=schema.names)

    return classes.mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = RADIUS, n_pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """Components of near-duplicates: one row per row of ``docs`` (doc_id, text).

    Returns doc_id, fp (signed 64-bit) and component_id, the smallest doc_id that can be reached
    over links (itself included). Null and empty texts have fingerprint 0 and link like any
    other. A null doc_id never names a component unless the component has no other id. Repeated
    rows give repeated results; no rows give none; other columns are ignored.
    """
    prints = materialise(fingerprints(docs, words), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))  # null if there is no other id
    classes = materialise(pivot_table(classes, n_pivots), "classes")
    joined = components(fingerprint_links(classes, radius, block))
    labelled = classes.join(joined, classes["fp"] == joined["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    names = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialise(labelled.join(names, "component").select(F.col("fp").alias("c_fp"), "component_id"), "components")
    return prints.join(named, F.col("fp") == F.col("c_fp")).select("doc_id", "fp", "component_id")


def op6(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every row of ``docs``.

    A null or empty text, or one without words, has fingerprint zero and links like any other. The
    smallest doc_id names a component, a null one only where there is no other. Repeated rows give
    repeated results, no rows none; other columns are ignored, whatever their names.
    """
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---- groups by verified similarity

_SETS = T.StructType(
    [*[T.StructField(c, T.LongType()) for c in ("id", "text_hash", "node", "fp", "n")], T.StructField("keys", T.ArrayType(T.LongType()))]
)
_MEMBER = T.StructType([*[T.StructField(c, T.LongType()) for c in ("node", "fp", "n", "component")], *[T.StructField(c, T.BinaryType()) for c in ("distances", "hashes")]])


def shingle_set(text: str, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def shingle_sets(docs: DataFrame, words: int, keys: int) -> DataFrame:
    """_SETS of ``docs`` (id, text_hash, text): ``node`` stands for the set, ``n`` is its size."""

    def make():
        import xxhash

        def one(key, text_hash, text):
            hashes = shingle_hashes(text, words)
            different = np.unique(np.array(hashes, np.uint64))
            node = xxhash.xxh3_64_intdigest(different.tobytes())
            return [(key, text_hash, signed(node), signed(vote(hashes)), len(different), [signed(h) for h in heapq.nsmallest(keys, different.tolist())])]

        return one

    return map_rows(docs, make, _SETS)


def near_in_size(left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of such sizes can be so similar, for all pairs."""
    return np.minimum(left[:, None], right[None, :]) >= similarity * np.maximum(left[:, None], right[None, :])


def loose_links(classes: DataFrame, similarity: float, radius: int, block: int) -> DataFrame:
    """Edges between classes (node, fp, n, keys, distances; materialised) of nearly one size: those within
    ``radius`` that have a key in common, and all within RADIUS."""
    by_bits = [F.struct(F.lit(k).alias("key_no"), bits.alias("bits")) for k, bits in enumerate(block_keys(classes.count(), RADIUS), 1)]
    by_shingle = F.transform("keys", lambda h: F.struct(F.lit(0).alias("key_no"), h.alias("bits")))
    keyed = classes.select("node", "fp", "n", "distances", F.explode(F.concat(by_shingle, F.array(*by_bits))).alias("key")).select("node", "fp", "n", "distances", "key.*")
    sizes = keyed.groupBy("key_no", "bits").agg(F.count("*").alias("size")).where("size > 1")
    blocks = materialise(sizes.select("key_no", "bits", _power(F.col("size"), block)), "groups")
    dealt = in_blocks(keyed, blocks, ["node", "fp", "n", "distances"], _GROUP[:2], "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in grouped(batches, len(_GROUP)):
            if len(rows["node"]) < 2:
                continue
            rows, n_row = _task(rows, key)
            if not n_row:
                continue
            fps, n, table, reach = rows["fp"].view(np.uint64), rows["n"], _tables(rows["distances"]), RADIUS if key[0] else radius

            def find(r, c):
                return links(fps[r], fps[c], table[:, r], table[:, c], reach, near_in_size(n[r], n[c], similarity))  # noqa: B023

            a, b = forest(rows["node"], n_row, find)
            if len(a):
                yield _edge_batch(a, b)

    return dealt.mapInArrow(run, EDGES)


def verified_links(members: DataFrame, similarity: float, radius: int, shingles: int) -> DataFrame:
    """Edges that connect the ``members`` (_MEMBER, materialised) whose sets are ``similarity`` alike.

    Pairs of a loose component that the pivot table leaves and that are within ``radius`` are verified
    on the whole sets unless they are connected already.
    """
    sizes = members.groupBy("component").agg(F.sum("n").alias("size"))
    blocks = materialise(sizes.select("component", _power(F.col("size"), shingles)), "groups")
    dealt = in_blocks(members, blocks, ["node", "fp", "n", "distances", "hashes"], ["component"], "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in grouped(batches, 3):
            if len(rows["node"]) < 2:
                continue
            rows, n_row = _task(rows, key)
            if not n_row:
                continue
            nodes, fps, n, table = rows["node"], rows["fp"].view(np.uint64), rows["n"], _tables(rows["distances"])
            sets = [np.frombuffer(h, np.uint64) for h in rows["hashes"]]
            label = np.arange(len(nodes))

            def root(i):
                while label[i] != i:  # noqa: B023
                    label[i] = label[label[i]]  # noqa: B023
                    i = label[i]  # noqa: B023
                return i

            def find(r, c):
                first, second = np.arange(len(fps))[r], np.arange(len(fps))[c]  # noqa: B023
                i, j = links(fps[r], fps[c], table[:, r], table[:, c], radius, near_in_size(n[r], n[c], similarity))  # noqa: B023
                keep = []
                for k, (p, q) in enumerate(zip(first[i].tolist(), second[j].tolist(), strict=True)):
                    a, b = root(p), root(q)
                    if a == b:
                        continue
                    common = len(np.intersect1d(sets[p], sets[q], assume_unique=True))  # noqa: B023
                    if common >= similarity * (len(sets[p]) + len(sets[q]) - common):  # noqa: B023
                        label[max(a, b)] = min(a, b)  # noqa: B023
                        keep.append(k)
                return i[keep], j[keep]

            a, b = forest(nodes, n_row, find)
            if len(a):
                yield _edge_batch(a, b)

    return dealt.mapInArrow(run, EDGES)


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = LOOSE, keys: int = 8, n_pivots: int = PIVOTS, block: int = BLOCK, shingles: int = SHINGLES) -> tuple[DataFrame, DataFrame]:
    """Groups of rows of ``docs`` (doc_id, text) that chains of similar texts connect.

    Returns (id, text_hash, node) of every row, and (c_node, component, first: id and text_hash of
    the group's first row, null ids last) of every class of texts with one set of shingles.
    """
    texts = docs.select(id_key("doc_id").alias("id"), text_hash(), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = materialise(shingle_sets(texts, words, keys), "sets")
    first = F.min(F.struct((F.col("id") == F.lit(NULL_ID)).alias("unnamed"), "id", "text_hash")).alias("least")
    classes = materialise(pivot_table(rows.groupBy("node", "fp", "n", "keys").agg(first), n_pivots), "classes")
    loose = components(loose_links(classes, similarity, radius, block))
    # One text of each class that has a loose link.
    some = classes.join(loose, "node").select("node", "component", "distances", F.col("least.id").alias("m_id"), F.col("least.text_hash").alias("m_hash"))

    def make():
        def one(node, component, distances, text):
            hashes = shingle_hashes(text, words)
            different = np.unique(np.array(hashes, np.uint64))
            return [(node, signed(vote(hashes)), len(different), component, distances, different.tobytes())]

        return one

    held = texts.join(some, F.expr("id = m_id AND text_hash = m_hash")).select("node", "component", "distances", "text")
    members = materialise(map_rows(held, make, _MEMBER).dropDuplicates(["node"]), "members")
    joined = components(verified_links(members, similarity, radius, shingles))
    labelled = classes.join(joined, "node", "left").select(F.col("node").alias("c_node"), "least", F.coalesce("component", "node").alias("component"))
    names = labelled.groupBy("component").agg(F.min("least").alias("first"))
    return rows, materialise(labelled.join(names, "component").select("c_node", "component", "first"), "components")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of similar texts, all columns: the first by doc_id (null last).

    Texts without words are alike. Rows are found again by id and text hash, so copies of one text
    do not meet in one task; of rows that repeat both, one stays. No rows give none.
    """
    _, named = similar_groups(docs, **options)
    kept = named.select("component", "first.id", "first.text_hash").distinct().select(F.col("id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_key("doc_id").alias("r_id"), text_hash().alias("r_hash"))
    return rows.join(kept, F.expr("r_id = k_id AND r_hash = k_hash")).dropDuplicates(["r_id", "r_hash"]).select("row.*")
