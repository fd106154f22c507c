"""Exact removal of long repeated byte strings, by column-wise suffix sorting of many documents.

A byte goes if a string of LENGTH bytes that covers it starts anywhere else too.

1. Every LENGTH-byte window of a text names an *anchor*: the GRAM-byte string in it whose hash is
   least (the first of equals). Equal windows name equal anchors at equal places, so only texts
   around equal anchors need to be compared. Consecutive windows mostly share an anchor; their
   union is a *segment*. Each window lies in exactly one segment, about one segment per
   ``(LENGTH - GRAM) / 2`` bytes.
2. Anchors that occur once in the corpus are dropped. Segments that occur several times are kept
   once, with their weight; all their windows repeat.
3. Anchors with different segments make a collection: its documents are the segments, lined up at
   the anchor. Suffixes can share LENGTH bytes only if they start in the same column, so the
   Burrows-Wheeler construction runs by column, from the last to the first, and inserts one symbol
   of every document a round: the documents, in the order of their suffixes so far, are sorted
   stably by their new symbol, and the common prefix of neighbours is one more than the least one
   between them a round before (or 0 where symbols differ). The column of symbols in that order is
   the column's transform. A window repeats if its suffix shares LENGTH bytes with a neighbour.
   That sort is the transform's own rank: a document's next place is the number of smaller symbols
   plus the rank of its symbol in the transform so far.
   An anchor with more than SPLIT different segments (the edge of a passage that very many documents
   share) is split by the bytes beside it: of the windows around it those with their anchor at
   nearly the same place all hold the bytes from there to the anchor and as many after it, so these
   make a longer anchor, and the segment of these windows alone goes to that one's collection. Where
   that is still too busy, the anchor becomes the whole window. The construction stays the same.
4. Ranges go back to all occurrences of a segment and are cut out of the texts.

Anchors are found by hash, but windows are compared byte by byte; a whole segment is known by
two 64-bit hashes. A collection is bounded, so its columns are held in memory; the sequential files
between the steps are tables in the shared folder (segments, anchors, kinds of segments, pieces).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromill.llm.arrow import map_rows, slices
from aeromill.llm.common import NULL_ID, id_key, materialise
from aeromill.llm.line_dedup import merged

LENGTH = 200
GRAM = 40
#: Segments that are sorted together at least, where there are so many.
CHUNK = 8192
#: Anchors with more different segments than this are split; how many window starts each part has.
SPLIT = 2048
STEPS = (20, 1)
_END = 256  # sorts after every byte; ends share no prefix

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


class _Hashes:
    """Polynomial hashes of all substrings of a text, for two multipliers (modulo 2 ** 64)."""

    def __init__(self):
        rng = np.random.default_rng(200)
        self.values = [rng.integers(1, 2**64, 256, dtype=np.uint64) for _ in _MULTIPLIERS]
        self.size = 0

    def grow(self, n: int) -> None:
        if n >= self.size:
            self.size = max(2 * self.size, n + 1, 1 << 16)
            self.powers, self.inverses = [], []
            for m in _MULTIPLIERS:
                for out, base in ((self.powers, m), (self.inverses, pow(m, -1, 2**64))):
                    p = np.full(self.size, base, np.uint64)
                    p[0] = 1
                    out.append(np.cumprod(p, dtype=np.uint64))

    def sums(self, data: np.ndarray, which: int) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[which][data] * self.powers[which][: len(data)], out=out[1:])
        return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def segments(data: np.ndarray, hashes: _Hashes, length: int = LENGTH, gram: int = GRAM):
    """(start, windows, lead, anchor, digest) of the segments of a text, as arrays.

    ``lead`` is the anchor's place in the segment; ``anchor`` its hash, ``digest`` that of the
    whole segment.
    """
    if len(data) < length:
        return None
    hashes.grow(len(data))
    sums = hashes.sums(data, 0)
    grams = _mixed((sums[gram:] - sums[:-gram]) * hashes.inverses[0][: len(data) - gram + 1])
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, least = 1, order
    while 2 * width <= length - gram + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = length - gram + 1 - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
    windows = np.diff(np.append(start, len(place)))
    lead = place[start] - start
    sums = hashes.sums(data, 1)
    whole = (sums[start + windows + length - 1] - sums[start]) * hashes.inverses[1][start]
    digest = _mixed(whole + _mixed((windows * 1024 + lead).astype(np.uint64)))
    return start, windows, lead, grams[place[start]].view(np.int64), digest.view(np.int64)


SEGMENTS = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "text_hash", "place", "anchor", "digest")])


def segment_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """SEGMENTS of every row of ``docs`` (id, text_hash, raw); place is start, windows and lead in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for whole in batches:
            for batch in slices(whole):
                out = []
                for key, text_hash, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    found = segments(np.frombuffer(raw, np.uint8), hashes, length, gram)
                    if found:
                        start, windows, lead, anchor, digest = found
                        place = (start << 24) | (windows << 12) | lead
                        out.append((np.full(len(start), key), np.full(len(start), text_hash), place, anchor, digest))
                if out:
                    columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=SEGMENTS.names)

    return docs.mapInArrow(run, SEGMENTS)


class Collection:
    """Documents lined up at their anchors, as columns of symbols."""

    def __init__(self, capacity: int, length: int = LENGTH, gram: int = GRAM):
        self.length, self.before = length, length - gram
        self.width = self.before + 2 * length - gram + 1
        self.n = 0
        self.columns = np.full((self.width, capacity), _END, np.int16)
        self.group = np.zeros(capacity, np.int64)
        self.lead = np.zeros(capacity, np.int64)
        self.windows = np.zeros(capacity, np.int64)

    def add(self, group: int, lead: int, windows: int, text: bytes) -> None:
        first = self.before - lead
        self.columns[first : first + len(text), self.n] = np.frombuffer(text, np.uint8)
        self.group[self.n], self.lead[self.n], self.windows[self.n] = group, lead, windows
        self.n += 1

    def repeated(self) -> np.ndarray:
        """Whether the window at each place of each document starts another document's window too."""
        n, found = self.n, np.zeros((self.n, self.before + 1), bool)
        order = np.argsort(self.group[:n], kind="stable")
        key = np.unique(self.group[order], return_inverse=True)[1].astype(np.int64) * 512 if n else order
        common = np.zeros(n + 1, np.int32)  # with the document before; one more 0 at the end
        for column in range(self.width - 1, -1, -1):
            symbols = self.columns[column, :n][order]
            if (symbols == _END).all():
                common[:] = 0
                continue
            keys = key + symbols
            sorting = np.argsort(keys, kind="stable")
            keys = keys[sorting]
            same = np.flatnonzero((keys[1:] == keys[:-1]) & (symbols[sorting[1:]] != _END)) + 1
            shared = np.zeros(n + 1, np.int32)
            shared[same] = 1 + _range_min(common, sorting[same - 1] + 1, sorting[same] + 1)
            order, common = order[sorting], shared
            near = np.flatnonzero(np.maximum(common[:-1], common[1:]) >= self.length)
            if len(near):
                docs = order[near]
                at = column - self.before + self.lead[docs]
                inside = (at >= 0) & (at < self.windows[docs])
                found[docs[inside], at[inside]] = True
        return found


def _range_min(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimum of values[start:end] for each pair, by tables of doubling width."""
    out, wide = values[start].copy(), end - start
    level, table = 1, values
    while len(wide) and 2 * level <= wide.max():
        table = np.minimum(table[:-level], table[level:])
        level *= 2
        now = np.flatnonzero((wide >= level) & (wide < 2 * level))
        out[now] = np.minimum(table[start[now]], table[end[now] - level])
    return out


def ranges_of(flags: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges that the flagged window starts cover."""
    starts = np.flatnonzero(flags)
    return merged([(int(s), int(s) + length) for s in starts])


_RANGE = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_FOUND = T.StructType([T.StructField("f_anchor", T.LongType()), T.StructField("f_digest", T.LongType()), T.StructField("ranges", _RANGE)])
_PIECES = T.StructType(
    [*[T.StructField(c, T.LongType()) for c in ("anchor", "digest", "kinds", "weight", "windows", "lead")], T.StructField("piece", T.BinaryType())]
)


def sort_collections(pieces: DataFrame, length: int, gram: int) -> DataFrame:
    """Ranges that repeat in each segment of ``pieces`` (_PIECES). Groups are whole in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Collection | None = None
        keys: list[tuple] = []

        def finish():
            flags = held.repeated()
            rows = [(a, d, [(0, w + length - 1)] if many else ranges_of(f, length)) for (a, d, w, many), f in zip(keys, flags, strict=True)]
            rows = [r for r in rows if r[2]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in r[2]] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ], names=_FOUND.names,
            )

        for batch in batches:
            for anchor, digest, kinds, weight, windows, lead, piece in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held is None or (keys[-1][0] != anchor and held.n + kinds > len(held.group)):
                    if held is not None:
                        yield from finish()
                    held, keys = Collection(max(CHUNK, kinds), length, gram), []
                held.add(anchor, lead, windows, piece)
                keys.append((anchor, digest, windows, weight > 1))
        if held is not None:
            yield from finish()

    return pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _FOUND)


_PARTS = T.StructType([*[T.StructField(c, T.LongType()) for c in ("p_anchor", "p_digest", "at")], *[f for f in _PIECES.fields if f.name != "kinds"]])


def parts_of(pieces: DataFrame, step: int, length: int, gram: int) -> DataFrame:
    """_PARTS of every piece: the segment of each ``step`` window starts, under its longer anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        before = length - gram
        for whole in batches:
            for batch in slices(whole, 1 << 18):  # parts take far more room than their piece
                out = []
                columns = [batch.column(c).to_pylist() for c in ("anchor", "digest", "weight", "windows", "lead", "piece")]
                for anchor, digest, weight, windows, lead, piece in zip(*columns, strict=True):
                    for low in range(0, before + 1, step):
                        high = min(low + step - 1, before)
                        first, last = max(0, lead - high), min(windows - 1, lead - low)
                        if first > last:
                            continue
                        context = piece[lead - low : lead + gram + before - high]
                        part = piece[first : last + length]
                        place = lead - low - first
                        own = xxhash.xxh3_64_intdigest(context, (low << 1 | 1) ^ anchor & (2**64 - 1))
                        shape = xxhash.xxh3_64_intdigest(part, place << 16 | (last - first))
                        out.append((anchor, digest, first, own - (own >> 63 << 64), shape - (shape >> 63 << 64), weight, last - first + 1, place, part))
                if out:
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.binary())], names=_PARTS.names)

    return pieces.mapInArrow(run, _PARTS)


def collection_ranges(pieces: DataFrame, steps: tuple[int, ...], split: int, length: int, gram: int) -> DataFrame:
    """_FOUND of ``pieces`` (_PIECES, materialised): collections of up to ``split`` of them are sorted, others split."""
    ranges = sort_collections(pieces.where(F.col("kinds") <= split) if steps else pieces, length, gram)
    busy = pieces.where(F.col("kinds") > split)
    if not steps or not busy.limit(1).count():
        return ranges
    step = steps[0]
    parts = materialise(parts_of(busy, step, length, gram), "parts")
    pick = [F.first(c).alias(c) for c in ("windows", "lead", "piece")]
    different = materialise(parts.groupBy("anchor", "digest").agg(F.sum("weight").alias("weight"), *pick), "different-parts")
    per_anchor = materialise(different.groupBy("anchor").agg(F.count("*").alias("kinds")), "kinds-of-parts")
    finer = materialise(different.join(per_anchor, "anchor").select(*_PIECES.names), "finer-pieces")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), (F.col("windows") + length - 1).alias("end")))
    alone = finer.where("kinds = 1 AND weight > 1").select(F.col("anchor").alias("f_anchor"), F.col("digest").alias("f_digest"), whole.alias("ranges"))
    # Of ``step`` consecutive window starts all hold so many bytes together.
    inside = collection_ranges(materialise(finer.where("kinds > 1"), "finer-collections"), steps[1:], split, length, length - step + 1)
    moved = F.transform("ranges", lambda r: F.struct((r["start"] + F.col("at")).alias("start"), (r["end"] + F.col("at")).alias("end")))
    found = alone.unionByName(inside)
    back = (
        parts.select("p_anchor", "p_digest", "at", "anchor", "digest").join(found, F.expr("anchor = f_anchor AND digest = f_digest"))
        .groupBy("p_anchor", "p_digest").agg(F.flatten(F.collect_list(moved)).alias("ranges"))
        .select(F.col("p_anchor").alias("f_anchor"), F.col("p_digest").alias("f_digest"), "ranges")
    )
    return ranges.unionByName(back)


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("removed", _RANGE),
        T.StructField("kept", T.BinaryType()),
    ]
)


def _unpacked(place: str):
    at = F.col(place)
    return F.shiftright(at, 24).alias("start"), F.shiftright(at, 12).bitwiseAND(F.lit(4095)).alias("windows"), at.bitwiseAND(F.lit(4095)).alias("lead")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, split: int = SPLIT) -> DataFrame:
    """Remove the bytes of all repeated ``length``-byte strings: one row per row of ``docs`` (doc_id, text).

    Returns doc_id, n_bytes, removed (maximal byte ranges) and kept (the other bytes). Matches
    never cross documents; a null text is empty; texts shorter than ``length`` keep all. Rows that
    repeat an id are documents of their own, and so are rows that repeat id and text: both lose
    what they share. No rows give none; other columns are ignored, whatever their names.
    """
    raw = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    keyed = docs.select(id_key("doc_id").alias("id"), F.xxhash64(raw).alias("text_hash"), raw.alias("raw"))
    found = materialise(segment_rows(keyed, length, gram), "segments")

    # Written, so that both sides of the join are exchanges that Spark can split at a hot anchor.
    repeated = materialise(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    shared = materialise(found.join(repeated, "anchor", "left_semi"), "shared")
    kinds = shared.groupBy("anchor", "digest").agg(F.count("*").alias("weight"), F.min(F.struct("id", "text_hash", "place")).alias("first"))
    per_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).select(F.col("anchor").alias("k_anchor"), "kinds")
    known = materialise(
        kinds.join(per_anchor, F.expr("anchor = k_anchor")).select("anchor", "digest", "weight", "kinds", "first.*"), "kinds"
    )
    # A collection of one document, several times: all of it repeats.
    alone = known.where("kinds = 1").select(
        F.col("anchor").alias("f_anchor"),
        F.col("digest").alias("f_digest"),
        F.array(F.struct(F.lit(0).cast("long").alias("start"), (_unpacked("place")[1] + length - 1).alias("end"))).alias("ranges"),
    )
    wanted = (
        known.where("kinds > 1")
        .groupBy(F.col("id").alias("w_id"), F.col("text_hash").alias("w_hash"))
        .agg(F.collect_list(F.struct("anchor", "digest", "kinds", "weight", *_unpacked("place"))).alias("wanted"))
    )

    def cutter():
        def one(raw, wanted):
            return [
                (w["anchor"], w["digest"], w["kinds"], w["weight"], w["windows"], w["lead"], raw[w["start"] : w["start"] + w["windows"] + length - 1])
                for w in wanted
            ]

        return one

    # Rows that repeat id and text would each give the pieces of the one that is wanted.
    texts = keyed.join(wanted, F.expr("id = w_id AND text_hash = w_hash")).select("raw", "wanted")
    pieces = materialise(map_rows(texts, cutter, _PIECES).dropDuplicates(["anchor", "digest"]), "pieces")
    ranges = alone.unionByName(collection_ranges(pieces, STEPS, split, length, gram))

    spans = (
        shared.join(ranges, F.expr("anchor = f_anchor AND digest = f_digest"))
        .withColumn("start", _unpacked("place")[0])
        .select("id", "text_hash", F.transform("ranges", lambda r: F.struct((r["start"] + F.col("start")).alias("start"), (r["end"] + F.col("start")).alias("end"))).alias("at"))
        .groupBy(F.col("id").alias("s_id"), F.col("text_hash").alias("s_hash"))
        .agg(F.flatten(F.collect_list("at")).alias("spans"))
    )
    joined = keyed.join(spans, F.expr("id = s_id AND text_hash = s_hash"), "left").select("id", "raw", "spans")

    def make():
        def one(key, raw, spans):
            cut = merged([(s["start"], s["end"]) for s in spans or []])
            parts, at = [], 0
            for start, end in cut:
                parts.append(raw[at:start])
                at = end
            kept = b"".join([*parts, raw[at:]])
            return [(None if key == NULL_ID else key, len(raw), [{"start": a, "end": b} for a, b in cut], kept)]

        return one

    return map_rows(joined, make, RESULT)


def op1(docs: DataFrame) -> DataFrame:
    """Digest columns of the removal of repeated 200-byte strings, for every row of ``docs``.

    A null or empty text has no bytes. Rows that repeat an id, or id and text, are documents of their
    own. Ties do not arise: all of a repeated string goes, everywhere. No rows give none; other
    columns are ignored, whatever their names.
    """
    return remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
