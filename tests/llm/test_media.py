import hashlib
import struct
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from scriptorium.llm import media
from scriptorium.llm.media import FRAME, KEY_EVERY, boxes, describe_media, media_columns, media_row, padded, payload_of, read_media, store_media, write_media


@given(st.binary(max_size=6000))
def test_round_trip(data):
    stored = write_media(padded(data))
    track = read_media(stored)[0]
    ranges = list(zip(track["offsets"].tolist(), track["sizes"].tolist(), strict=True))
    assert b"".join(stored[a : a + n] for a, n in ranges) == padded(data) == payload_of(stored, track)
    assert track["keyframes"].tolist() == list(range(len(ranges)))[::KEY_EVERY] and track["played"] == track["duration"] == len(ranges)
    assert (track["codec"], track["handler"], track["width"]) == ("raw ", "vide", 8)


def test_rows_from_plain_bytes(spark):
    texts = ["", None, "a" * 64, "é" * 33, "x" * 200_000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, "", "y")], "doc_id long, text string, feature string")
    rows = media_columns(docs).collect()
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        payload = data + b"\0" * (max(1, -(-len(data) // 64)) * 64 - len(data))
        assert (r.n_bytes, r.payload_bytes) == (len(data), len(payload)) and len(payload) % FRAME == 0
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        stored = write_media(payload)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        frames = len(payload) // 64
        assert [k.size for k in r.keyframes] == [64] * -(-frames // KEY_EVERY)
        assert [stored[k.offset : k.offset + k.size] for k in r.keyframes] == [payload[i * 64 : i * 64 + 64] for i in range(0, frames, KEY_EVERY)]
    files = {(r.doc_id, r.n_bytes): bytes(r.media) for r in store_media(docs).collect()}
    assert all(files[r.doc_id, r.n_bytes] == write_media(padded((texts[r.doc_id] or "").encode())) for r in rows)
    assert media_row("") == media_row(None)
    assert media_columns(docs.limit(0)).collect() == []


def test_wide_boxes_compact_sizes_and_damage():
    wide = struct.pack(">I4sQ", 1, b"free", 20) + b"abcd" + struct.pack(">I4s", 0, b"mdat") + b"rest"
    assert [(k, b - a) for k, a, b in boxes(memoryview(wide))] == [(b"free", 4), (b"mdat", 4)]
    stored = write_media(padded(b"x" * 500))
    with pytest.raises(ValueError):
        read_media(stored[:-100])
    with pytest.raises(ValueError):
        list(boxes(memoryview(struct.pack(">I4s", 4, b"free"))))


def fragmented(frames):
    """A file whose samples stand in movie fragments: one fragment for each list of (bytes, whether it is a key frame)."""
    full, box = media._full, media._box
    empty = media._box(b"stbl", full(b"stsd", struct.pack(">I", 1), box(b"raw ", struct.pack(">6xH16xHHIIIH", 1, 8, 8, 0, 0, 0, 1) + b"\0" * 36)), full(b"stts", struct.pack(">I", 0)), full(b"stsc", struct.pack(">I", 0)), full(b"stsz", struct.pack(">II", 0, 0)), full(b"stco", struct.pack(">I", 0)))
    mdia = box(b"mdia", full(b"mdhd", struct.pack(">IIIIHH", 0, 0, 25, 0, 0x55C4, 0)), full(b"hdlr", struct.pack(">I4s12x", 0, b"vide"), b"v\0"), box(b"minf", empty))
    tkhd = full(b"tkhd", struct.pack(">IIIII8xHHHH", 0, 0, 7, 0, 0, 0, 0, 0, 0), b"\0" * 44)
    out = box(b"ftyp", b"iso5") + box(b"moov", box(b"trak", tkhd, mdia), box(b"mvex", full(b"trex", struct.pack(">IIIII", 7, 1, 2, 0, 0x10000))))
    for run in frames:
        entries = b"".join(struct.pack(">I", len(data)) for data, _ in run)
        first = struct.pack(">I", 0 if run[0][1] else 0x10000)
        size = len(box(b"moof", box(b"traf", full(b"tfhd", struct.pack(">I", 7)), full(b"trun", struct.pack(">Ii", len(run), 0), first, entries))))
        out += box(b"moof", box(b"traf", full(b"tfhd", struct.pack(">I", 7), flags=0x20000), full(b"trun", struct.pack(">Ii", len(run), size + 8), first, entries, flags=0x205)))
        out += box(b"mdat", b"".join(data for data, _ in run))
    return out


def test_fragments_and_any_column_of_files(spark):
    runs = [[(b"abc", True), (b"defgh", False)], [(b"ij", False)], [(b"klmno", True)]]
    data = fragmented(runs)
    (track,) = read_media(data)
    assert payload_of(data, track) == b"abcdefghijklmno" and track["keyframes"].tolist() == [0, 3] and track["played"] == track["duration"] == 8
    plain = write_media(padded(b"x" * 500))
    files = spark.createDataFrame([("a", data), ("b", plain), ("c", None), ("d", data[:-3]), ("e", b"no file"), ("f", b"")], "name string, file binary")
    got = {r.name: r for r in describe_media(files, "name", "file").collect()}
    assert [(t.codec, t.duration, t.samples, [data[k.offset : k.offset + k.size] for k in t.keyframes]) for t in got["a"].tracks] == [("raw ", 8, 4, [b"abc", b"klmno"])]
    assert got["b"].tracks[0].samples == 8 and got["c"].tracks is None and got["c"].damage is None
    assert got["d"].tracks is None and "overruns" in got["d"].damage and got["f"].tracks == [] and got["e"].tracks is not None or got["e"].damage


@given(st.integers(0, 3000), st.integers(0, 255))
def test_damage_is_a_value_error(at, byte):
    data = bytearray(write_media(padded(b"y" * 900)))
    data[at % len(data)] = byte
    try:
        read_media(bytes(data))
    except ValueError:
        pass
