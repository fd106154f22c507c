"""Substring dedup by hashing lines and runs of sentences.

A text is cut into pieces: its lines, and inside a line its sentences (they end at ``.``, ``!`` or
``?`` before white space, or at a full-width stop). A piece of more than LONG words, which has no
such end, is cut after the words that their hash chooses (one in PIECE), so that equal passages
inside it are cut alike. A unit is the shortest run of whole pieces that counts ``min_words`` words,
from each piece forwards and from each piece backwards, within a line or over several. So a line or
sentence that is long enough is a unit by itself, a short one only together with its neighbours, and
of a repeated passage of ``min_words`` words or more every whole piece is part of a unit.

A unit is normalised (lower case, runs of white space as one space) and digested to 128 bits. The
digests are grouped over the whole corpus; of the occurrences of one digest the first by (doc_id,
offset) is kept and the others are removed. Removed spans are offsets (code points, end exclusive)
into the original text; a span that begins with a line takes the line break after it along.

A word counts as WORD characters; where there are no spaces (scripts without them, tokens of more
than TOKEN characters) characters are counted, and long pieces are cut between characters chosen by
the hash of GRAM of them.

A digest that a third of all documents hold is counted map-side first, and the occurrences meet
their one kept place in a join that Spark can split.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromill.llm.arrow import map_rows, slices
from aeromill.llm.common import NULL_ID, id_key, materialise

#: Words of a unit. Lines and sentences of fewer words repeat by chance, so alone they stay.
MIN_WORDS = 16
#: A piece of more words is cut; one word in PIECE ends a part.
LONG, PIECE = 48, 8
#: What a word counts, in characters, and a character of a script without spaces.
WORD, WIDE = 6, 3
#: Tokens of more characters are not taken for words; GRAM characters choose where they are cut.
TOKEN, GRAM = 32, 4

_RUN = re.compile(r"\S+")
#: Thai to Burmese, Khmer, kana, Han and their extensions; Korean has spaces.
_WIDE = re.compile("[฀-໿က-႟ក-៿々-〇぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff]")
_LONG = re.compile(r"\S{%d}" % (TOKEN + 1))
_END = re.compile(r"(?<=[.!?])\s+|\n|(?<=[。！？])")

UNITS = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "text_hash", "high", "low", "span")])


def unspaced(text: str) -> bool:
    """Whether some stretch of the text is to be counted in characters."""
    return not text.isascii() and _WIDE.search(text) is not None or _LONG.search(text) is not None


def n_words(words: list[str]) -> int:
    """How many words these count as, by their characters where there are no spaces."""
    n = 0
    for word in words:
        wide = 0 if word.isascii() else len(_WIDE.findall(word))
        n += WIDE * wide + len(word) - wide if wide or len(word) > TOKEN else WORD
    return n // WORD


def _chosen(key: str) -> bool:
    return zlib.crc32(key.encode("utf-8", "surrogatepass")) % PIECE == 0


def cuts(piece: str) -> list[int]:
    """Ends of the parts of a long piece: after chosen words, and inside unspaced stretches."""
    out = []
    for m in _RUN.finditer(piece):
        word = m[0]
        if len(word) > TOKEN or (not word.isascii() and _WIDE.search(word)):
            folded = [c.lower() for c in word]
            out += [m.start() + k for k in range(GRAM, len(word)) if _chosen("".join(folded[k - GRAM : k]))]
        elif _chosen(word.lower()):
            out.append(m.end())
    if not out or out[-1] < len(piece):
        out.append(len(piece))
    return out


def pieces(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, words, normalised text) of the lines' sentences and of the parts of long ones."""
    out, at = [], 0
    count = n_words if unspaced(text) else len
    for stop, after in [*[m.span() for m in _END.finditer(text)], (len(text), 0)]:
        raw, begin, at = text[at:stop], at, after
        words = raw.lower().split()
        if not words:
            continue
        n = count(words)
        begin += len(raw) - len(raw.lstrip())
        raw = raw.strip()
        if n <= LONG:
            out.append((begin, begin + len(raw), n, " ".join(words)))
            continue
        a = 0
        for b in cuts(raw):
            part = raw[a:b]
            words = part.lower().split()
            if words:
                first = a + len(part) - len(part.lstrip())
                out.append((begin + first, begin + b, max(1, count(words)), " ".join(words)))
            a = b
    return out


def runs(sizes: list[int], least: int) -> list[tuple[int, int]]:
    """Shortest runs [i, j) of consecutive pieces that count ``least`` words, from either side."""
    out, n, j = set(), 0, 0
    for i in range(len(sizes)):
        while n < least and j < len(sizes):
            n += sizes[j]
            j += 1
        if n < least:
            break
        out.add((i, j))
        n -= sizes[i]
    n, i = 0, len(sizes)
    for j in range(len(sizes), 0, -1):
        while n < least and i > 0:
            i -= 1
            n += sizes[i]
        if n < least:
            break
        out.add((i, j))
        n -= sizes[j - 1]
    return sorted(out)


def units(text: str, min_words: int = MIN_WORDS) -> list[tuple[str, int, int]]:
    """(normalised unit, start, end) of a text, in order."""
    found = pieces(text)
    flat = " ".join(p[3] for p in found)
    starts, at = [], 0
    for p in found:
        starts.append(at)
        at += len(p[3]) + 1
    starts.append(at)
    return [(flat[starts[i] : starts[j] - 1], found[i][0], found[j - 1][1]) for i, j in runs([p[2] for p in found], min_words)]


def unit_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """UNITS of every row of ``docs`` (id, text_hash, text), and one of span -1 whose ``low`` is their number.

    A span is start and end in one long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for whole in batches:
            for batch in slices(whole, 1 << 20):
                ids, hashes, sizes, digests, spans = [], [], [], [], []
                for key, text_hash, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    found = units(text, min_words)
                    ids.append(key)
                    hashes.append(text_hash)
                    sizes.append(len(found) + 1)
                    digests.append(bytes(8) + len(found).to_bytes(8, "big"))
                    digests += [digest(u.encode("utf-8", "surrogatepass")) for u, _, _ in found]
                    spans.append(-1)
                    spans += [start << 32 | end for _, start, end in found]
                both = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
                columns = [np.repeat(ids, sizes), np.repeat(hashes, sizes), both[:, 0], both[:, 1], spans]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=UNITS.names)

    return docs.mapInArrow(run, UNITS)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with overlapping or touching ones joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def closed(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans of the units: joined over white space, with the space or line break after them."""
    out: list[tuple[int, int]] = []
    for start, end in merged(spans):
        if out and not text[out[-1][1] : start].strip():
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    for k, (start, end) in enumerate(out):
        after = end
        while after < len(text) and text[after].isspace() and text[after] != "\n":
            after += 1
        if after < len(text) and text[after] == "\n":
            after = after + 1 if start == 0 or text[start - 1] == "\n" else end
        out[k] = (start, after)
    return merged(out)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the (sorted, disjoint) spans."""
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at:start])
        at = end
    return "".join(parts) + text[at:]


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_units", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("removed_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept_text", T.StringType()),
    ]
)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Remove repeated units: one row per row of ``docs`` (doc_id, text).

    Returns doc_id, n_units, n_removed (removed units, nested ones counted too), removed_spans
    (sorted, disjoint) and kept_text. A null or empty text has no unit and keeps "". Null ids rank
    first. Rows that repeat an id are told apart by a hash of the text; rows that repeat id and
    text are one document: its units are not repeats of themselves across those rows. No rows
    give none; other columns are ignored, whatever their names.
    """
    keyed = docs.select(
        id_key("doc_id").alias("id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    written = materialise(unit_rows(keyed, min_words), "units")
    # Most digests occur once: half of each, counted alone, tells which rows go any further.
    often = written.where("span >= 0").groupBy("low").agg(F.count("*").alias("n")).where("n > 1").select(F.col("low").alias("o_low"))
    often = materialise(often, "often")
    found = materialise(written.where("span >= 0").join(often, F.expr("low = o_low")).drop("o_low"), "repeated")
    place = F.struct("id", "text_hash", "span")
    # Written, so that both sides of the join are exchanges that Spark can split at a hot digest.
    kept = materialise(
        found.groupBy("high", "low")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1")  # rows that repeat a document hold only its first places, and nothing goes
        .select(F.col("high").alias("k_high"), F.col("low").alias("k_low"), "first"),
        "first-places",
    )
    removed = (
        found.join(kept, F.expr("high = k_high AND low = k_low"))
        .where(place != F.col("first"))
        .select("id", "text_hash", "span", F.lit(None).cast("long").alias("n_units"))
        .unionByName(written.where("span < 0").select("id", "text_hash", F.lit(None).cast("long").alias("span"), F.col("low").alias("n_units")))
        .groupBy("id", "text_hash")
        .agg(F.collect_set("span").alias("spans"), F.max("n_units").alias("n_units"))
        .select(F.col("id").alias("r_id"), F.col("text_hash").alias("r_hash"), "spans", "n_units")
    )
    joined = keyed.join(removed, F.expr("id = r_id AND text_hash = r_hash"), "left").select("id", "text", "spans", "n_units")

    def make():
        def one(key, text, spans, n_units):
            cut = closed(text, [(s >> 32, s & 0xFFFFFFFF) for s in spans or []])
            doc_id = None if key == NULL_ID else key
            return [(doc_id, n_units, len(spans or []), [{"start": a, "end": b} for a, b in cut], without(text, cut))]

        return one

    return map_rows(joined, make, RESULT)


def op4(docs: DataFrame) -> DataFrame:
    """Digest columns of the line and sentence dedup, for every row of ``docs``.

    A null or empty text has no unit and keeps the empty string. Of equal units the first by
    (doc_id, offset) stays, null ids first. Rows that repeat id and text are one document. No rows
    give none; other columns are ignored, whatever their names.
    """
    spans = F.transform("removed_spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return dedup_lines(docs).select(
        "doc_id", "n_units", "n_removed", F.array_join(spans, ",").alias("removed_spans"), F.sha2("kept_text", 256).alias("kept_sha256")
    )
