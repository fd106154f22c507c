"""Best-fit packing of tokenised documents under several capacities at once.

A bin (sequence) has three capacities: tokens, documents and attention cost (the sum of squared
lengths). Pieces of one length have the same demand on all three, so the packing is planned on
the histogram of lengths, which has at most ``capacity`` rows whatever the corpus size: lengths
go from long to short, and each is put into the feasible bins whose weighted residual norm after
placing is least (or whose residual has the greatest weighted dot product with the demand). Bins
in equal state are kept as one group with a count. The plan says, for the r-th piece of a length,
which bin and offset it gets; the executors number the pieces of each length (two-level, so that
a length that most pieces share is still dealt over many tasks) and look their places up. The
result is one global packing that does not depend on how the rows are partitioned.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromill.llm.arrow import map_rows
from aeromill.llm.common import materialise

CAPACITY = 2048
#: Pieces of one length are numbered in parts of about so many.
PART_PIECES = 20_000
#: Words whose ids a worker remembers, and characters that are split into words at a time.
CACHE_WORDS, CHUNK = 200_000, 1 << 16

_CACHES: dict[str, tuple] = {}


#: Letters (lower case), numbers and white space of Latin-1 as the vocabulary's rules see them.
_L, _N, _S = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
#: The vocabulary's pre-tokeniser, for lower-case Latin-1 text.
_BLANK = re.compile("[ \n]")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")


def _byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Tokeniser:
    """Ids of whole texts by the word-end vocabulary.

    For Latin-1 text the normaliser is lower case alone, so the text is split here and each word's
    ids are remembered (at most CACHE_WORDS a worker); any other text, or one that spells a
    special token, goes through the library. Both ways give the library's ids. Long texts go chunk
    by chunk, cut at white space, where the rules always split, so that no list of all words is made.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        if path not in _CACHES:
            _CACHES[path] = (Tokenizer.from_file(path), {})
        self.tokenizer, self.known = _CACHES[path]
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()

    def _word(self, word: str) -> bytes:
        mapped = word if word.isascii() and word.isalpha() else "".join(map(self.alphabet.__getitem__, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        try:
            text.encode("latin-1")
            plain = "<|" not in text
        except UnicodeEncodeError:
            plain = False
        one = self._plain if plain else self._library
        return one(text) if len(text) <= CHUNK else b"".join(map(one, chunks(text)))

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        words, known = _WORDS.findall(text.lower()), self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            pass
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in set(words):
            if word not in known:
                known[word] = self._word(word)
        return b"".join(map(known.__getitem__, words))


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Consecutive parts of the text that begin, all but the first, with a blank; of ``size`` characters, or one word more."""
    at = 0
    while at < len(text):
        stop = _BLANK.search(text, at + size) if at + size < len(text) else None
        end = stop.start() if stop else len(text)
        yield text[at:end]
        at = end


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file; it lies in the same place on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """The pieces of every whole text: its ids, then ``end_id``, cut only where longer than ``capacity``.

    ``vocabulary`` is a path that every executor can read. ``ids`` (little-endian unsigned 32-bit)
    is null unless ``with_ids``. A null or empty text is one piece that holds ``end_id`` alone.
    """

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokeniser, end = Tokeniser(vocabulary), np.array([end_id], "<u4").tobytes()

        def one(doc_id, text):
            ids = tokeniser.ids(text or "") + end
            out = []
            for i, at in enumerate(range(0, len(ids), capacity * 4)):
                part = ids[at : at + capacity * 4]
                out.append((doc_id, i, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            return out

        return one

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, PIECES)


def plan(
    histogram: Mapping[int, int],
    capacity: int = CAPACITY,
    max_docs: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25),
    rule: str = "norm",
) -> tuple[np.ndarray, int]:
    """Places for the pieces of each length, and the number of bins.

    ``histogram`` has the number of pieces by length. Rows of the result: length, first rank,
    pieces a bin, first bin, first offset. Ranks of a length run on from row to row. ``max_docs``
    and ``max_cost`` bind no bin if left out (``capacity`` pieces, ``capacity ** 2``).
    """
    max_docs = capacity if max_docs is None else max_docs
    max_cost = capacity * capacity if max_cost is None else max_cost
    if rule not in ("norm", "dot"):
        raise ValueError("rule is 'norm' or 'dot'")
    limits = np.array([capacity, max_docs, max_cost], np.int64)
    scale = np.array(weights, float) / limits
    open_bins = _Groups()
    bins, rows = 0, []
    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        demand = np.array([length, 1, length * length], np.int64)
        if length < 1 or (demand > limits).any():
            raise ValueError(f"a piece of {length} tokens fits no bin")
        open_bins.compact()
        rest, rank = int(histogram[length]), 0
        while rest:
            fits = open_bins.feasible(demand)
            if not len(fits):
                need = -(-rest // int((limits // demand).min()))
                fits = np.array([open_bins.add(limits, bins, need, 0)])
                bins += need
            left = open_bins.left[fits]
            if rule == "norm":
                best = fits[np.argmin((((left - demand) * scale) ** 2).sum(axis=1))]
            else:
                best = fits[np.argmax((left * scale * (demand * scale)).sum(axis=1))]
            # As one by one: a bin just filled stays the best one while it has room.
            residual, used = open_bins.left[best].copy(), int(open_bins.used[best])
            each = int((residual // demand).min())
            full = min(int(open_bins.count[best]), rest // each)
            for n, k in ((full, each), (1, min(each, rest - full * each))):
                if n and k and open_bins.count[best]:
                    begin = open_bins.take(best, n)
                    rows.append((length, rank, k, begin, used))
                    open_bins.add(residual - k * demand, begin, n, used + k * length)
                    rank, rest = rank + n * k, rest - n * k
    return np.array(rows, np.int64).reshape(-1, 5), bins


class _Groups:
    """Groups of consecutive bins in equal state: residual capacities, first bin, bins, tokens used."""

    def __init__(self):
        self.n = 0
        self.left, self.first = np.zeros((256, 3), np.int64), np.zeros(256, np.int64)
        self.count, self.used = np.zeros(256, np.int64), np.zeros(256, np.int64)

    def _each(self):
        return ("left", "first", "count", "used")

    def add(self, left: np.ndarray, first: int, count: int, used: int) -> int:
        if self.n == len(self.first):
            for name in self._each():
                old = getattr(self, name)
                setattr(self, name, np.concatenate((old, np.zeros_like(old))))
        self.left[self.n], self.first[self.n], self.count[self.n], self.used[self.n] = left, first, count, used
        self.n += 1
        return self.n - 1

    def take(self, at: int, count: int) -> int:
        """Remove the first ``count`` bins of a group; the number of the first of them."""
        first = int(self.first[at])
        self.first[at] += count
        self.count[at] -= count
        return first

    def feasible(self, demand: np.ndarray) -> np.ndarray:
        return np.flatnonzero((self.count[: self.n] > 0) & (self.left[: self.n] >= demand).all(axis=1))

    def compact(self) -> None:
        """Forget groups without bins or without room."""
        live = np.flatnonzero((self.count[: self.n] > 0) & (self.left[: self.n] > 0).all(axis=1))
        for name in self._each():
            array = getattr(self, name)
            array[: len(live)] = array[live]
        self.n = len(live)


def place(pieces: DataFrame, **options) -> DataFrame:
    """Sequence and offset of every piece (PIECES plus sequence_id, offset).

    ``pieces`` must be materialised: its histogram and its rows are read in separate jobs.
    Pieces of one length are numbered by (part, doc_id, piece): counts per (length, part) give each
    part's first number, and a window inside a part the rest. A length has as many parts as its
    pieces fill, so a task numbers about PART_PIECES of them however many a length has. The plan (a
    few rows per length, so a few thousand at most) goes with the tasks.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # One number per length, so at most ``capacity`` of them.
    parts = F.lit([-(-histogram.get(k, 1) // PART_PIECES) for k in range(1, max(histogram, default=1) + 1)])
    share = F.element_at(parts, F.col("length").cast("int")).cast("long")
    parted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), share))
    rows, _ = plan(histogram, **options)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    counts = parted.groupBy("length", "part").agg(F.count("*").alias("n"))
    running = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("length").alias("s_length"), F.col("part").alias("s_part"), F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        parted.withColumn("within", F.row_number().over(inside) - 1)
        .join(starts, F.expr("length = s_length AND part = s_part"))
        .withColumn("rank", F.col("before") + F.col("within"))
    )
    keys = (rows[:, 0] << 40) + rows[:, 1]
    schema = T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 40) + rank, "right") - 1
            nth = rank - rows[at, 1]
            sequence = rows[at, 3] + nth // rows[at, 2]
            offset = rows[at, 4] + nth % rows[at, 2] * length
            columns = [batch.column(f.name) for f in PIECES.fields]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], schema=arrow)

    return ranked.select(*PIECES.names, "rank").mapInArrow(look_up, schema)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, with_ids: bool = True, **options) -> DataFrame:
    """Pack all ``docs`` (doc_id, text) into sequences: PIECES plus sequence_id and offset.

    Numbers of sequences run from 0; offsets in a sequence are gapless from 0. A null or empty
    text is one piece with the end id. Repeated rows are packed once each; no rows give none.
    Other columns are ignored, whatever their names.
    """
    capacity = options.get("capacity", CAPACITY)
    pieces = materialise(token_pieces(docs, vocabulary, end_id, capacity, with_ids), "pieces")
    return place(pieces, **options)


def op7(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digest columns of the packing under token, document and cost capacities that the token capacity implies.

    A null or empty text is one piece, the end id alone. Repeated rows are packed once each; pieces
    that are equal in every column are interchangeable, so ties do not show. No rows give none; other
    columns are ignored, whatever their names.
    """
    return pack(docs, vocabulary, with_ids=False).drop("ids")
