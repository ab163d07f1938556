"""Media columns: ISO base media files, written and walked without decoding samples.

store_media() puts texts into files, describe_media() walks the boxes of any column of files, whole or fragmented, and
returns codec, duration and the byte ranges of the key frames of every track; media_columns() does both at once and
digests the payload that the sample tables give back.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One sample is an uncompressed 8 x 8 picture of 8-bit grey values.
SIDE = 8
FRAME = SIDE * SIDE
TIMESCALE, FRAME_TICKS, KEY_EVERY, CHUNK_FRAMES = 25, 1, 16, 32
CODEC = b"raw "
_UNITY = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
#: Boxes whose payload is boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"mvex", b"moof", b"traf"}


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 2**32:
        return struct.pack(">I", len(body) + 8) + kind + body
    return struct.pack(">I", 1) + kind + struct.pack(">Q", len(body) + 16) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def padded(data: bytes) -> bytes:
    """data with zero bytes up to a positive multiple of FRAME."""
    return data.ljust(max(1, -(-len(data) // FRAME)) * FRAME, b"\0")


def write_media(payload: bytes) -> bytes:
    """A file with one grey video track whose samples are the payload's frames."""
    frames = len(payload) // FRAME
    chunks = -(-frames // CHUNK_FRAMES)
    ticks = frames * FRAME_TICKS
    last = frames - (chunks - 1) * CHUNK_FRAMES
    runs = [(1, CHUNK_FRAMES)] * (chunks > 1) + [(chunks, last)] * (chunks == 1 or last != CHUNK_FRAMES)
    keys = range(1, frames + 1, KEY_EVERY)
    entry = struct.pack(">6xH16xHHIIIH", 1, SIDE, SIDE, 0x480000, 0x480000, 0, 1) + b"\0" * 32 + struct.pack(">Hh", 8, -1)

    def moov(first: int) -> bytes:
        offsets = [first + i * CHUNK_FRAMES * FRAME for i in range(chunks)]
        wide = first + len(payload) >= 2**32
        table = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), _box(CODEC, entry)),
            _full(b"stts", struct.pack(">III", 1, frames, FRAME_TICKS)),
            _full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", a, n, 1) for a, n in runs)),
            _full(b"stsz", struct.pack(">II", FRAME, frames)),
            _full(b"co64" if wide else b"stco", struct.pack(f">I{chunks}{'Q' if wide else 'I'}", chunks, *offsets)),
        )
        minf = _box(b"minf", _full(b"vmhd", b"\0" * 8, flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), table)
        mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, ticks, 0x55C4, 0)), _full(b"hdlr", struct.pack(">I4s12x", 0, b"vide"), b"text\0"), minf)
        tkhd = _full(b"tkhd", struct.pack(">IIIII8xHHHH", 0, 0, 1, 0, ticks, 0, 0, 0, 0), _UNITY, struct.pack(">II", SIDE << 16, SIDE << 16), flags=3)
        mvhd = _full(b"mvhd", struct.pack(">IIIIIH10x", 0, 0, TIMESCALE, ticks, 0x10000, 0x100), _UNITY, b"\0" * 24, struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"iso2")
    head = 8 if len(payload) + 8 < 2**32 else 16
    size = len(moov(0))
    return ftyp + moov(len(ftyp) + size + head) + _box(b"mdat", payload)


def boxes(data: memoryview, start: int = 0, end: int | None = None) -> Iterator[tuple[bytes, int, int]]:
    """(type, payload start, payload end) of the boxes in a range; a box that overruns it raises ValueError."""
    end = len(data) if end is None else end
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if start + 16 > end:
                raise ValueError("box overruns its parent")
            (size,), head = struct.unpack_from(">Q", data, start + 8), 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise ValueError("box overruns its parent")
        yield kind, start + head, start + size
        start += size


def tree(data: memoryview, start: int, end: int) -> dict[bytes, list]:
    """Type -> payload ranges; a container's entry holds its own tree as third item."""
    out: dict[bytes, list] = {}
    for kind, a, b in boxes(data, start, end):
        out.setdefault(kind, []).append((a, b, tree(data, a, b) if kind in CONTAINERS else None))
    return out


def _numbers(data: memoryview, at: int, end: int, count: int, kind: str = ">u4") -> np.ndarray:
    if at + count * np.dtype(kind).itemsize > end:
        raise ValueError("table overruns its box")
    return np.frombuffer(data, kind, count, at).astype(np.int64)


def _sizes(data: memoryview, stbl: dict) -> np.ndarray:
    if b"stsz" in stbl:
        a, b, _ = stbl[b"stsz"][0]
        size, count = _numbers(data, a + 4, b, 2).tolist()
        if size and count * size > len(data):
            raise ValueError("samples lie beyond the file")
        return np.full(count, size, np.int64) if size else _numbers(data, a + 12, b, count)
    a, b, _ = stbl[b"stz2"][0]
    field, count = data[a + 7], int(_numbers(data, a + 8, b, 1)[0])
    if field == 4:
        return _numbers(data, a + 12, b, (count + 1) // 2, "u1").repeat(2)[:count] >> np.tile([4, 0], (count + 1) // 2)[:count] & 15
    return _numbers(data, a + 12, b, count, "u1" if field == 8 else ">u2")


def sample_ranges(data: memoryview, stbl: dict) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and sizes of all samples, from stsz or stz2, stsc and stco or co64."""
    sizes = _sizes(data, stbl)
    wide = b"co64" in stbl
    a, b, _ = stbl[b"co64" if wide else b"stco"][0]
    chunks = _numbers(data, a + 8, b, int(_numbers(data, a + 4, b, 1)[0]), ">i8" if wide else ">u4")
    a, b, _ = stbl[b"stsc"][0]
    runs = _numbers(data, a + 8, b, 3 * int(_numbers(data, a + 4, b, 1)[0])).reshape(-1, 3)
    if len(sizes) and (not len(runs) or runs[0, 0] != 1 or (np.diff(runs[:, 0]) <= 0).any()):
        raise ValueError("chunk runs are out of order")
    per = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(chunks) + 1))) if len(runs) else np.zeros(0, np.int64)
    ends = np.minimum(np.cumsum(per), len(sizes))
    counts = np.diff(np.append(0, ends))
    if counts.sum() != len(sizes):
        raise ValueError("chunks hold fewer samples than there are sizes")
    sums = np.concatenate([[0], np.cumsum(sizes)])
    offsets = np.repeat(chunks[: len(counts)] - sums[ends - counts], counts) + sums[:-1]
    if len(sizes) and ((offsets < 0).any() or (offsets + sizes).max() > len(data)):
        raise ValueError("sample lies beyond the file")
    return offsets, sizes


def _flags(data: memoryview, at: int) -> int:
    return int.from_bytes(data[at + 1 : at + 4], "big")


#: The bit of sample flags that says a sample is no key frame.
NOT_SYNC = 0x10000


def _fragments(data: memoryview, top: list[tuple[bytes, int, int]], defaults: dict[int, tuple[int, int, int]]) -> dict[int, list]:
    """By track: (offsets, sizes, durations, key frames) of the runs of movie fragments."""
    out: dict[int, list] = {}
    for kind, start, end in top:
        if kind != b"moof":
            continue
        moof = start - 8
        for _, _, traf in tree(data, start, end).get(b"traf", []):
            a, b, _ = traf[b"tfhd"][0]
            flags, track = _flags(data, a), int(_numbers(data, a + 4, b, 1)[0])
            duration, size, own = defaults.get(track, (0, 0, 0))
            at, base = a + 8, moof
            if flags & 0x1:
                base, at = int(_numbers(data, at, b, 1, ">i8")[0]), at + 8
            at += 4 * bool(flags & 0x2)
            for bit in (0x8, 0x10, 0x20):
                if flags & bit:
                    value, at = int(_numbers(data, at, b, 1)[0]), at + 4
                    duration, size, own = (value if bit == 0x8 else duration), (value if bit == 0x10 else size), (value if bit == 0x20 else own)
            where = base
            for a, b, _ in traf.get(b"trun", []):
                flags, count, at = _flags(data, a), int(_numbers(data, a + 4, b, 1)[0]), a + 8
                if flags & 0x1:
                    where, at = base + int(_numbers(data, at, b, 1, ">i4")[0]), at + 4
                first = None
                if flags & 0x4:
                    first, at = int(_numbers(data, at, b, 1)[0]), at + 4
                fields = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
                table = _numbers(data, at, b, count * len(fields)).reshape(count, len(fields))
                column = lambda bit, default, table=table, fields=fields, count=count: table[:, fields.index(bit)] if bit in fields else np.full(count, default, np.int64)
                sizes, marks = column(0x200, size), column(0x400, own).copy()
                if first is not None and count and 0x400 not in fields:
                    marks[0] = first
                offsets = where + np.cumsum(sizes) - sizes
                if count and (where < 0 or offsets[-1] + sizes[-1] > len(data)):
                    raise ValueError("sample lies beyond the file")
                out.setdefault(track, []).append((offsets, sizes, column(0x100, duration), marks & NOT_SYNC == 0))
                where += int(sizes.sum())
    return out


def read_media(data: bytes) -> list[dict]:
    """Per track: handler, codec, timescale, duration (ticks), offsets and sizes of all samples, numbers of the key frames, width, height.

    A damaged file raises ValueError.
    """
    view = memoryview(data)
    top = list(boxes(view, 0, len(view)))
    out = []
    try:
        for moov in (tree(view, a, b) for kind, a, b in top if kind == b"moov"):
            defaults = {}
            for a, b, _ in [x for _, _, mvex in moov.get(b"mvex", []) for x in mvex.get(b"trex", [])]:
                track, _, duration, size, flags = _numbers(view, a + 4, b, 5).tolist()
                defaults[track] = (duration, size, flags)
            runs = _fragments(view, top, defaults)
            for _, _, trak in moov.get(b"trak", []):
                out.append(_track(view, trak, runs))
    except (KeyError, IndexError, TypeError, struct.error, StopIteration) as e:
        raise ValueError("a box that is needed is missing or short") from e
    return out


def _track(view: memoryview, trak: dict, runs: dict[int, list]) -> dict:
    mdia = trak[b"mdia"][0][2]
    a, b, _ = trak[b"tkhd"][0]
    number = int(_numbers(view, a + (20 if view[a] == 1 else 12), b, 1)[0])
    a, _, _ = mdia[b"mdhd"][0]
    timescale, duration = struct.unpack_from(">IQ" if view[a] == 1 else ">II", view, a + (20 if view[a] == 1 else 12))
    stbl = mdia[b"minf"][0][2][b"stbl"][0][2]
    a, b, _ = stbl[b"stsd"][0]
    codec, at, _ = next(boxes(view, a + 8, b))
    offsets, sizes = sample_ranges(view, stbl)
    a, b, _ = stbl[b"stts"][0]
    times = _numbers(view, a + 8, b, 2 * int(_numbers(view, a + 4, b, 1)[0])).reshape(-1, 2)
    played = int((times[:, 0] * times[:, 1]).sum())
    keys = np.arange(len(offsets))
    if b"stss" in stbl:
        a, b, _ = stbl[b"stss"][0]
        keys = _numbers(view, a + 8, b, int(_numbers(view, a + 4, b, 1)[0])) - 1
        if len(keys) and (keys.min() < 0 or keys.max() >= len(offsets)):
            raise ValueError("a key frame is no sample")
    for own_offsets, own_sizes, ticks, sync in runs.get(number, []):
        keys = np.append(keys, len(offsets) + np.flatnonzero(sync))
        offsets, sizes = np.append(offsets, own_offsets), np.append(sizes, own_sizes)
        played += int(ticks.sum())
    handler = bytes(view[(h := mdia[b"hdlr"][0][0]) + 8 : h + 12])
    width, height = struct.unpack_from(">HH", view, at + 24) if handler == b"vide" else (0, 0)
    return {"handler": handler.decode("latin-1"), "codec": codec.decode("latin-1"), "timescale": timescale, "duration": duration or played, "played": played, "offsets": offsets, "sizes": sizes, "keyframes": keys, "width": width, "height": height}


def payload_of(data: bytes, track: dict) -> bytes:
    """Bytes of a track's samples in order; adjoining ones are taken at once."""
    offsets, sizes = track["offsets"], track["sizes"]
    if not len(offsets):
        return b""
    breaks = np.flatnonzero(offsets[1:] != offsets[:-1] + sizes[:-1]) + 1
    first, last = np.concatenate([[0], breaks]), np.append(breaks, len(offsets)) - 1
    return b"".join(data[a:b] for a, b in zip(offsets[first].tolist(), (offsets[last] + sizes[last]).tolist(), strict=True))


_RANGES = pa.list_(pa.struct([("offset", pa.int64()), ("size", pa.int64())]))


def key_ranges(track: dict) -> list[dict]:
    k = track["keyframes"]
    return [{"offset": a, "size": n} for a, n in zip(track["offsets"][k].tolist(), track["sizes"][k].tolist(), strict=True)]


def media_row(text: str | None) -> tuple:
    data = text.encode("utf-8", "surrogatepass") if text else b""
    stored = write_media(padded(data))
    track = read_media(stored)[0]
    payload, ranges = payload_of(stored, track), key_ranges(track)
    keys = ",".join(f"{r['offset']}+{r['size']}" for r in ranges)
    feature = f"codec={track['codec'].strip()};size={track['width']}x{track['height']};timescale={track['timescale']};duration={track['duration']};samples={len(track['offsets'])};keyframes={len(ranges)};ranges={hashlib.sha256(keys.encode()).hexdigest()[:16]}"
    return len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-FRAME:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, ranges


def media_columns(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, keyframes.

    The text's UTF-8 bytes (null: none), padded with zeros to a positive multiple of FRAME, become the frames of an ISO
    media file; payload figures come from the stored file's sample tables. feature states codec, picture size,
    timescale, duration, samples, keyframes and a digest of the keyframes' byte ranges, which keyframes lists. Repeated
    rows and equal texts get equal values; other columns are ignored.
    """
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, keyframes array<struct<offset:bigint,size:bigint>>"
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "keyframes"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), _RANGES]

    def run(batches):
        for batch in batches:
            rows = [media_row(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def store_media(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, media: the stored file of every text, as media_columns() makes it."""

    def run(batches):
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):  # a file at a time
                data = text.encode("utf-8", "surrogatepass") if text else b""
                yield pa.RecordBatch.from_arrays([pa.array([doc_id.as_py()], pa.int64()), pa.array([len(data)]), pa.array([write_media(padded(data))], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


_TRACK = "struct<handler:string,codec:string,timescale:bigint,duration:bigint,samples:bigint,width:int,height:int,keyframes:array<struct<offset:bigint,size:bigint>>>"
_TRACKS = pa.list_(pa.struct([("handler", pa.string()), ("codec", pa.string()), ("timescale", pa.int64()), ("duration", pa.int64()), ("samples", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("keyframes", _RANGES)]))


def describe_media(files: DataFrame, key: str, column: str) -> DataFrame:
    """(key, tracks, damage): of every file in a binary column its tracks with codec, duration and key frames' byte ranges.

    Fragmented files are read with their runs. damage says what is wrong with a file that cannot be walked, whose
    tracks are then null; a null file has neither.
    """

    def run(batches):
        for batch in batches:
            tracks, damage = [], []
            for data in batch.column(1).to_pylist():
                try:
                    found = None if data is None else [{**{n: t[n] for n in ("handler", "codec", "timescale", "duration", "width", "height")}, "samples": len(t["offsets"]), "keyframes": key_ranges(t)} for t in read_media(data)]
                    tracks.append(found)
                    damage.append(None)
                except ValueError as e:
                    tracks.append(None)
                    damage.append(str(e))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tracks, _TRACKS), pa.array(damage, pa.string())], [key, "tracks", "damage"])

    plain = files.select(F.col(key).alias(key), F.col(column).cast("binary").alias("file"))
    return plain.mapInArrow(run, f"`{key}` {plain.schema[0].dataType.simpleString()}, tracks array<{_TRACK}>, damage string")
