"""ISO media containers: a writer for raw frames and a reader that never decodes payloads.

The reader walks nested boxes, decodes the sample tables (``stsz``/``stz2``, ``stsc``, ``stco``/``co64``,
``stts``, ``stss``) and the track runs of fragments (``moof``), and gives, per track, the codec,
duration and byte range of every sample and of the key frames. It reads only the boxes' headers and
tables; payload bytes are addressed, not decoded. Counts are checked against the bytes that are there
before anything of their size is made, and boxes are walked with a stack, so a malformed container
gives a ValueError whatever it says.

The writer stores bytes losslessly as the frames of one video track with codec ``raw `` (8-bit
grey, 64 samples a frame), with a key frame every ``KEY_EVERY`` frames.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromill.llm.arrow import map_rows

FRAME = 64
KEY_EVERY = 32
FRAMES_PER_CHUNK = 256
TIMESCALE = 25

#: Boxes that hold boxes (fixed values).
CONTAINERS = frozenset({b"moov", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"mvex"})


@dataclass
class Track:
    number: int = 0
    codec: str = ""
    handler: str = ""
    timescale: int = 0
    duration: int = 0
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def seconds(self) -> float:
        return self.duration / self.timescale if self.timescale else 0.0

    def ranges(self) -> list[tuple[int, int]]:
        """Merged byte ranges [start, end) of all samples, in sample order."""
        return _merge(self.offsets, self.sizes)

    def key_ranges(self) -> list[tuple[int, int]]:
        """Byte range of each key frame."""
        return [(int(o), int(o + s)) for o, s in zip(self.offsets[self.keys], self.sizes[self.keys], strict=True)]


def _merge(offsets: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    if not len(offsets):
        return []
    ends = offsets + sizes
    first = np.concatenate(([0], np.flatnonzero(offsets[1:] != ends[:-1]) + 1))
    last = np.concatenate((first[1:] - 1, [len(offsets) - 1]))
    return [(int(a), int(b)) for a, b in zip(offsets[first], ends[last], strict=True)]


def boxes(data: bytes, start: int = 0, end: int | None = None):
    """(kind, payload start, payload end) of the boxes in ``data[start:end]``.

    64-bit sizes, boxes that run to the end (size 0) and ``uuid`` boxes are read; a box whose
    size does not fit raises ValueError.
    """
    end = len(data) if end is None else end
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if start + 16 > end:
                raise ValueError("truncated 64-bit box size")
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        if kind == b"uuid":
            head += 16
        if size < head or start + size > end:
            raise ValueError(f"box {kind!r} of {size} bytes does not fit")
        yield kind, start + head, start + size
        start += size


def read(data: bytes) -> list[Track]:
    """The tracks of a container. Payload bytes are not touched."""
    tracks: list[dict] = []  # of each track, where its tables lie
    defaults: dict[int, tuple[int, ...]] = {}
    fragments: list[tuple[int, int, int]] = []
    stack = [(boxes(data), None)]
    while stack:
        found = next(stack[-1][0], None)
        if found is None:
            stack.pop()
            continue
        (kind, a, b), tables = found, stack[-1][1]
        if kind == b"trak":
            tracks.append({})
            stack.append((boxes(data, a, b), tracks[-1]))
        elif kind in CONTAINERS:
            stack.append((boxes(data, a, b), tables))
        elif kind == b"trex":
            number, _, *rest = struct.unpack_from(">5I", data, a + 4)
            defaults[number] = tuple(rest)
        elif kind == b"moof":
            fragments.append((a - 8, a, b))
        elif tables is not None:
            tables[kind] = (a, b)
    out = [_track(data, at) for at in tracks]
    if fragments:
        _add_fragments(data, out, defaults, fragments)
    return out


def _track(data: bytes, at: dict) -> Track:
    def rows(kind: bytes, columns: int, skip: int = 8, width: str = ">u4") -> np.ndarray:
        if kind not in at:
            return np.zeros((0, columns), np.int64)
        a, b = at[kind]
        n = struct.unpack_from(">I", data, a + skip - 4)[0]
        if a + skip + n * columns * int(width[-1]) > b:
            raise ValueError(f"table {kind!r} is longer than its box")
        return np.frombuffer(data, width, n * columns, a + skip).astype(np.int64).reshape(n, columns)

    def halves() -> np.ndarray:
        a, b = at[b"stz2"]
        width, n = data[a + 7], struct.unpack_from(">I", data, a + 8)[0]
        if width not in (4, 8, 16) or a + 12 + (n * width + 7) // 8 > b:
            raise ValueError("table b'stz2' is longer than its box")
        raw = np.frombuffer(data, ">u2" if width == 16 else "u1", n if width > 4 else (n + 1) // 2, a + 12).astype(np.int64)
        return raw if width > 4 else np.stack((raw >> 4, raw & 15), axis=1).ravel()[:n]

    track = Track()
    if b"tkhd" in at:
        a = at[b"tkhd"][0]
        track.number = struct.unpack_from(">I", data, a + (20 if data[a] else 12))[0]
    if b"mdhd" in at:
        a = at[b"mdhd"][0]
        if data[a]:
            track.timescale, track.duration = struct.unpack_from(">IQ", data, a + 20)
        else:
            track.timescale, track.duration = struct.unpack_from(">II", data, a + 12)
    if b"hdlr" in at:
        track.handler = data[at[b"hdlr"][0] + 8 : at[b"hdlr"][0] + 12].decode("latin-1")
    if b"stsd" in at:
        track.codec = data[at[b"stsd"][0] + 12 : at[b"stsd"][0] + 16].decode("latin-1")
    if b"stsz" in at:
        constant, n = struct.unpack_from(">II", data, at[b"stsz"][0] + 4)
        if constant * n > len(data):
            raise ValueError("more samples than bytes")
        track.sizes = np.full(n, constant, np.int64) if constant else rows(b"stsz", 1, 12)[:, 0]
    elif b"stz2" in at:
        track.sizes = halves()
    n = len(track.sizes)
    chunks = (rows(b"co64", 1, width=">u8") if b"co64" in at else rows(b"stco", 1))[:, 0]
    runs = rows(b"stsc", 3)
    if n:
        if not len(runs) or not len(chunks) or (chunks < 0).any():
            raise ValueError("sample tables disagree")
        # The chunk of each sample, from the samples up to the end of each chunk.
        lengths = np.diff(np.append(runs[:, 0], len(chunks) + 1))
        if runs[0, 0] != 1 or (lengths < 0).any():
            raise ValueError("chunk runs are out of order")
        upto = np.cumsum(np.repeat(np.minimum(runs[:, 1], n), lengths))
        if upto[-1] < n:
            raise ValueError("sample tables disagree")
        chunk = np.searchsorted(upto, np.arange(n), "right")
        before = np.cumsum(track.sizes) - track.sizes
        first = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
        track.offsets = chunks[chunk] + before - np.repeat(before[first], np.diff(np.append(first, n)))
    if not track.duration:
        track.duration = sum(int(k) * int(d) for k, d in rows(b"stts", 2))
    track.keys = rows(b"stss", 1)[:, 0] - 1 if b"stss" in at else np.arange(n)
    if len(track.keys) and not (0 <= track.keys.min() and track.keys.max() < n):
        raise ValueError("a key frame is no sample")
    return track


def _add_fragments(data: bytes, tracks: list[Track], defaults: dict[int, tuple[int, ...]], fragments: list[tuple[int, int, int]]) -> None:
    """The samples of ``moof`` boxes, after those of the sample tables."""
    by_number = {t.number: t for t in tracks}
    found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for origin, a, b in fragments:
        for kind, start, end in boxes(data, a, b):
            if kind != b"traf":
                continue
            number = at = None
            base = origin
            duration = size = flags = 0
            for inner, p, q in boxes(data, start, end):
                if inner == b"tfhd":
                    given, number = struct.unpack_from(">II", data, p)
                    duration, size, flags = defaults.get(number, (0, 0, 0))
                    p += 8
                    if given & 1:
                        base, p = struct.unpack_from(">Q", data, p)[0], p + 8
                    p += 4 if given & 2 else 0
                    for bit in (8, 16, 32):
                        if given & bit:
                            value, p = struct.unpack_from(">I", data, p)[0], p + 4
                            duration, size, flags = (value if bit == 8 else duration), (value if bit == 16 else size), (value if bit == 32 else flags)
                    at = base
                elif inner == b"trun" and number in by_number:
                    given, n = struct.unpack_from(">II", data, p)
                    given &= 0xFFFFFF
                    p += 8
                    if given & 1:
                        at, p = base + struct.unpack_from(">i", data, p)[0], p + 4
                    first = None
                    if given & 4:
                        first, p = struct.unpack_from(">I", data, p)[0], p + 4
                    fields = [bit for bit in (0x100, 0x200, 0x400, 0x800) if given & bit]
                    if p + 4 * n * len(fields) > q or (not fields and n > len(data)):
                        raise ValueError("a track run is longer than its box")
                    table = np.frombuffer(data, ">u4", n * len(fields), p).astype(np.int64).reshape(n, len(fields))
                    column = lambda bit, default: table[:, fields.index(bit)] if bit in fields else np.full(n, default, np.int64)  # noqa: B023, E731
                    sizes, marks = column(0x200, size), column(0x400, flags).copy()
                    if first is not None and n:
                        marks[0] = first
                    offsets = at + np.cumsum(sizes) - sizes
                    if n and (offsets.min() < 0 or base > 1 << 62):
                        raise ValueError("a track run begins before the file")
                    at += int(sizes.sum())
                    by_number[number].duration += int(column(0x100, duration).sum())
                    found.setdefault(number, []).append((offsets, sizes, marks & 0x10000 == 0))
    for number, parts in found.items():
        track = by_number[number]
        offsets, sizes, keys = (np.concatenate(x) for x in zip(*parts, strict=True))
        track.keys = np.concatenate((track.keys, np.flatnonzero(keys) + len(track.sizes)))
        track.offsets, track.sizes = np.concatenate((track.offsets, offsets)), np.concatenate((track.sizes, sizes))


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def _full(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", flags), *parts)


_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def write(payload: bytes) -> bytes:
    """A container that holds ``payload`` (a positive multiple of FRAME bytes) as raw frames."""
    n = len(payload) // FRAME
    if n < 1 or n * FRAME != len(payload):
        raise ValueError(f"the payload must be a positive multiple of {FRAME} bytes")
    head = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"iso2")
    wide = len(payload) + 16 > 0xFFFFFFFF
    start = len(head) + (16 if wide else 8)
    mdat = struct.pack(">I4sQ", 1, b"mdat", 16 + len(payload)) if wide else struct.pack(">I4s", 8 + len(payload), b"mdat")
    chunks = np.arange(0, n, FRAMES_PER_CHUNK, dtype=np.int64) * FRAME + start
    last = n - (len(chunks) - 1) * FRAMES_PER_CHUNK
    runs = [(1, FRAMES_PER_CHUNK)] if len(chunks) > 1 else []
    if not runs or last != FRAMES_PER_CHUNK:
        runs.append((len(chunks), last))
    keys = np.arange(1, n + 1, KEY_EVERY)
    entry = _box(
        b"raw ",
        bytes(6) + struct.pack(">H", 1) + bytes(16) + struct.pack(">HHII", FRAME, 1, 0x480000, 0x480000)
        + bytes(4) + struct.pack(">H", 1) + bytes(32) + struct.pack(">Hh", 8, -1),
    )
    stbl = _box(
        b"stbl",
        _full(b"stsd", struct.pack(">I", 1), entry),
        _full(b"stts", struct.pack(">III", 1, n, 1)),
        _full(b"stss", struct.pack(">I", len(keys)), keys.astype(">u4").tobytes()),
        _full(b"stsc", struct.pack(">I", len(runs)), *[struct.pack(">III", a, k, 1) for a, k in runs]),
        _full(b"stsz", struct.pack(">II", FRAME, n)),
        _full(b"co64", struct.pack(">I", len(chunks)), chunks.astype(">u8").tobytes()),
    )
    dinf = _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1)))
    minf = _box(b"minf", _full(b"vmhd", bytes(8), flags=1), dinf, stbl)
    mdia = _box(
        b"mdia",
        _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, n, 0x55C4, 0)),
        _full(b"hdlr", bytes(4), b"vide", bytes(12), b"text\0"),
        minf,
    )
    tkhd = _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(16), _MATRIX, struct.pack(">II", FRAME << 16, 1 << 16), flags=3)
    mvhd = _full(b"mvhd", struct.pack(">IIII", 0, 0, TIMESCALE, n), struct.pack(">IH", 0x10000, 0x100), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2))
    return head + mdat + payload + _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))


def padded(raw: bytes, unit: int = FRAME) -> bytes:
    return raw + bytes(-len(raw) % unit if raw else unit)


def feature(track: Track) -> str:
    """codec, handler, duration, sample and key-frame counts, extent of the samples and CRC of the key-frame ranges."""
    keys = np.stack((track.offsets[track.keys], track.offsets[track.keys] + track.sizes[track.keys]), axis=1)
    first, last = (f"{a}-{b}" for a, b in (keys[0], keys[-1])) if len(keys) else ("", "")
    return (
        f"codec={track.codec.strip()};handler={track.handler};seconds={track.seconds:.2f};samples={len(track.sizes)};"
        f"keys={len(keys)};first_key={first};last_key={last};key_ranges_crc32={zlib.crc32(keys.astype('<i8').tobytes())}"
    )


_RANGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
TRACK = T.StructType(
    [
        T.StructField("codec", T.StringType()),
        T.StructField("handler", T.StringType()),
        T.StructField("timescale", T.LongType()),
        T.StructField("duration", T.LongType()),
        T.StructField("n_samples", T.LongType()),
        T.StructField("key_ranges", T.ArrayType(_RANGE)),
    ]
)


def media_columns(df: DataFrame, column: str, key: str) -> DataFrame:
    """Codec, duration and key-frame byte ranges of a column of containers (binary).

    Returns (key, error, tracks). A null container has null tracks; one that cannot be read has
    null tracks and an error; other columns are ignored.
    """
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("error", T.StringType()), T.StructField("tracks", T.ArrayType(TRACK))])

    def make():
        def one(k, data):
            if data is None:
                return [(k, None, None)]
            try:
                rows = [
                    {"codec": t.codec, "handler": t.handler, "timescale": t.timescale, "duration": min(t.duration, 2**63 - 1), "n_samples": len(t.sizes),
                     "key_ranges": [{"start": a, "end": b} for a, b in t.key_ranges()]}
                    for t in read(bytes(data))
                ]
            except (ValueError, struct.error, IndexError, OverflowError) as e:
                return [(k, str(e) or type(e).__name__, None)]
            return [(k, None, rows)]

        return one

    return map_rows(df.select(F.col(key).alias("key"), F.col(column).alias("data")), make, schema).withColumnRenamed("key", key)


CONTAINER_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])


def containers(docs: DataFrame) -> DataFrame:
    """The container of every whole text (doc_id, n_bytes, media); a null text is empty."""

    def make():
        def one(doc_id, raw):
            raw = raw or b""
            return [(doc_id, len(raw), write(padded(raw)))]

        return one

    return map_rows(_bytes(docs), make, CONTAINER_SCHEMA)


def _bytes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("raw"))


OP5_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_sha256", T.StringType()),
        T.StructField("tail_crc32", T.LongType()),
        T.StructField("media_bytes", T.LongType()),
        T.StructField("media_sha256", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("codec", T.StringType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("key_ranges", T.StringType()),
    ]
)


def op5(docs: DataFrame) -> DataFrame:
    """Store every whole text as a container, read the stored bytes back and digest both.

    Codec, duration and the byte range of every key frame come back as columns. One row per row of
    ``docs``; a null or empty text is one frame of zero bytes. Equal texts give equal values, no
    rows give none; other columns are ignored. No shuffle.
    """

    def make():
        def one(doc_id, n_bytes, media):
            track = read(media)[0]
            payload = b"".join(media[a:b] for a, b in track.ranges())
            return [
                (
                    doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]),
                    len(media), hashlib.sha256(media).hexdigest(), feature(track),
                    track.codec.strip(), track.seconds, ",".join(f"{a}-{b}" for a, b in track.key_ranges()),
                )
            ]

        return one

    return map_rows(containers(docs), make, OP5_SCHEMA)
