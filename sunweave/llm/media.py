"""Operator 2: media columns, whose true types come from signatures and not from what is declared.

``encode_wave`` stores a payload losslessly as 8-bit mono samples in a RIFF/WAVE container. ``sniff`` finds media in a
binary column: an Aho-Corasick automaton over all magic bytes locates candidates in one pass, a validator of the format
then confirms structure and length, so that chance hits in other data fall away. What starts at byte 0 gives the value's
true type, whatever was declared; the others are carved as embedded media with offset and length.

A candidate costs what its validator reads of it: terminators that a format looks for (end of a PDF) are found once for
each value and bisected, compressed data is fed in small parts and never copied, and pages of a stream aren't candidates.

Defined results: null media is treated as empty; nothing found gives the type "unknown"; of several formats at one place
the first in FORMATS order counts; embedded media inside an embedded one are listed too; values of any length are taken
whole, one of them at least in a batch; ill-formed UTF-8 in a text is mended before it is stored; a null key stays null; an
empty table gives an empty table; repeated rows each get a row; further columns, whatever their names, are left out.
``carve`` joins by key and needs unique ones.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunweave.llm.arrow import slices, utf8

BATCH_BYTES = 8 << 20
UNIT = 192
RATE = 8000


def encode_wave(payload: bytes, rate: int = RATE) -> bytes:
    """The payload as unsigned 8-bit mono PCM samples; odd lengths get the container's pad byte."""
    form = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, rate, rate, 1, 8)
    data = struct.pack("<4sI", b"data", len(payload)) + payload + b"\0" * (len(payload) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(form) + len(data)) + b"WAVE" + form + data


def pad(data: bytes, unit: int = UNIT) -> bytes:
    """The data with spaces to a positive multiple of unit."""
    return data.ljust(max(1, -(-len(data) // unit)) * unit, b" ")


# --- validators: length of the media at a place of the data, or 0 ---------------------------------------------------------


class Marks:
    """Where byte strings stand in a value, each looked for once."""

    def __init__(self, data: bytes):
        self.data, self.found = data, {}

    def __call__(self, mark: bytes) -> list[int]:
        if mark not in self.found:
            places, at = [], self.data.find(mark)
            while at >= 0:
                places.append(at)
                at = self.data.find(mark, at + len(mark))
            self.found[mark] = places
        return self.found[mark]

    def between(self, mark: bytes, low: int, high: int) -> list[int]:
        """The first and the last place within [low, high), if any."""
        places = self(mark)
        a, b = bisect.bisect_left(places, low), bisect.bisect_left(places, high)
        return [places[a], places[b - 1]] if a < b else []


def _riff_chunks(d: bytes, at: int) -> tuple[int, dict[bytes, tuple[int, int]]]:
    if len(d) < at + 12:
        return 0, {}
    end = at + 8 + struct.unpack_from("<I", d, at + 4)[0]
    if end > len(d):
        return 0, {}
    found, p = {}, at + 12
    while p + 8 <= end:
        name, n = struct.unpack_from("<4sI", d, p)
        if p + 8 + n > end:
            return 0, {}
        found.setdefault(name, (p + 8, n))
        p += 8 + n + (n & 1)
    return (end - at if p == end else 0), found


def _wave(d: bytes, at: int, marks: Marks) -> int:
    n, chunks = _riff_chunks(d, at) if d[at + 8 : at + 12] == b"WAVE" else (0, {})
    return n if b"fmt " in chunks and chunks[b"fmt "][1] >= 16 and b"data" in chunks else 0


def _webp(d: bytes, at: int, marks: Marks) -> int:
    n, chunks = _riff_chunks(d, at) if d[at + 8 : at + 12] == b"WEBP" else (0, {})
    return n if chunks.keys() & {b"VP8 ", b"VP8L", b"VP8X"} else 0


def _avi(d: bytes, at: int, marks: Marks) -> int:
    n, chunks = _riff_chunks(d, at) if d[at + 8 : at + 12] == b"AVI " else (0, {})
    return n if b"LIST" in chunks else 0


def _png(d: bytes, at: int, marks: Marks) -> int:
    p, first = at + 8, True
    while p + 12 <= len(d):
        n, name = struct.unpack_from(">I4s", d, p)
        if p + 12 + n > len(d) or first != (name == b"IHDR" and n == 13) or zlib.crc32(d[p + 4 : p + 8 + n]) != struct.unpack_from(">I", d, p + 8 + n)[0]:
            return 0
        p, first = p + 12 + n, False
        if name == b"IEND":
            return p - at
    return 0


def _gif(d: bytes, at: int, marks: Marks) -> int:
    if len(d) < at + 13:
        return 0
    width, height, flags = struct.unpack_from("<HHB", d, at + 6)
    p = at + 13 + (3 << (flags & 7) + 1 if flags & 128 else 0)
    if not width or not height:
        return 0
    while p < len(d):
        kind = d[p]
        if kind == 0x3B:
            return p + 1 - at
        if kind == 0x21:
            p += 2
        elif kind == 0x2C and p + 10 <= len(d):
            p += 10 + (3 << (d[p + 9] & 7) + 1 if d[p + 9] & 128 else 0) + 1
        else:
            return 0
        while p < len(d) and d[p]:
            p += d[p] + 1
        p += 1
    return 0


def _jpeg(d: bytes, at: int, marks: Marks) -> int:
    p, frame = at + 2, False
    while p + 4 <= len(d) and d[p] == 0xFF:
        mark = d[p + 1]
        n = struct.unpack_from(">H", d, p + 2)[0]
        if mark < 0xC0 or n < 2 or p + 2 + n > len(d):
            return 0
        frame |= 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC)
        p += 2 + n
        if mark == 0xDA:
            if not frame:
                return 0
            while (p := d.find(b"\xff", p)) >= 0 and p + 1 < len(d):
                if d[p + 1] == 0xD9:
                    return p + 2 - at
                if d[p + 1] and not 0xD0 <= d[p + 1] <= 0xD7 and d[p + 1] != 0xFF:
                    break
                p += 1 if d[p + 1] == 0xFF else 2
            else:
                return 0
    return 0


def _bmp(d: bytes, at: int, marks: Marks) -> int:
    if len(d) < at + 30:
        return 0
    size, zero, offset, header, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", d, at + 2)
    good = zero == 0 and header in (40, 52, 56, 108, 124) and planes == 1 and bits in (1, 4, 8, 16, 24, 32) and width > 0 and height
    return size if good and 14 + header <= offset < size <= len(d) - at else 0


def _crc_table(bits: int, polynomial: int) -> list[int]:
    table = []
    for x in range(256):
        x <<= bits - 8
        for _ in range(8):
            x = x << 1 ^ (polynomial if x >> bits - 1 else 0)
            x &= (1 << bits) - 1
        table.append(x)
    return table


_CRC8, _CRC16 = _crc_table(8, 0x07), _crc_table(16, 0x8005)


def _flac_header(d: bytes, at: int) -> tuple[int, int]:
    """(bytes, samples) of a frame header at a place, (0, 0) if there is none that its checksum confirms."""
    if len(d) < at + 6 or d[at] != 0xFF or d[at + 1] & 0xFE != 0xF8 or d[at + 3] & 1 or d[at + 2] >> 4 == 0 or d[at + 2] & 15 == 15:
        return 0, 0
    lead = d[at + 4]
    p = at + 5 + (0 if lead < 0x80 else max(0, 8 - (lead ^ 0xFF).bit_length() - 1))
    size, rate = d[at + 2] >> 4, d[at + 2] & 15
    wide = {6: 1, 7: 2}.get(size, 0)
    samples = 192 if size == 1 else 144 << size if size < 6 else 1 << size if size > 7 else int.from_bytes(d[p : p + wide], "big") + 1
    p += wide + {12: 1, 13: 2, 14: 2}.get(rate, 0)
    crc = 0
    for x in d[at:p]:
        crc = _CRC8[crc ^ x]
    return (p + 1 - at, samples) if p < len(d) and d[p] == crc else (0, 0)


def _flac(d: bytes, at: int, marks: Marks) -> int:
    """Blocks of metadata, then frames whose checksums hold, until all samples are there or no other frame follows."""
    p, last, first, total = at + 4, False, True, 0
    while not last and p + 4 <= len(d):
        last, kind, n = bool(d[p] & 128), d[p] & 127, int.from_bytes(d[p + 1 : p + 4], "big")
        if first and (kind, n) != (0, 34) or kind == 127 or p + 4 + n > len(d):
            return 0
        if first:
            total = int.from_bytes(d[p + 17 : p + 22], "big") & (1 << 36) - 1
        p, first = p + 4 + n, False
    if not last:
        return 0
    seen = 0
    while not total or seen < total:
        n, samples = _flac_header(d, p)
        if not n:
            break
        crc, end = 0, 0
        for q in range(p, len(d)):
            crc = (crc & 0xFF) << 8 ^ _CRC16[crc >> 8 ^ d[q]]
            # A frame ends where its checksum comes out even and another frame, or nothing more of this stream, follows.
            if not crc and q >= p + n + 2 and (total and seen + samples >= total or q + 1 == len(d) or _flac_header(d, q + 1)[0]):
                end = q + 1
                break
        if not end:
            break
        p, seen = end, seen + samples
    return p - at if not total or seen >= total else 0


def _ogg(d: bytes, at: int, marks: Marks) -> int:
    """From the page that begins a stream to the one that ends it, or the last whole one."""
    p, end = at, False
    if len(d) < at + 27 or not d[at + 5] & 2:
        return 0
    while not end and d[p : p + 4] == b"OggS" and p + 27 <= len(d) and d[p + 4] == 0:
        segments = d[p + 26]
        n = 27 + segments + sum(d[p + 27 : p + 27 + segments])
        if p + n > len(d):
            break
        end, p = bool(d[p + 5] & 4), p + n
    return p - at


def _mp4(d: bytes, at: int, marks: Marks) -> int:
    p, kinds = at, set()
    while p + 8 <= len(d):
        n, name = struct.unpack_from(">I4s", d, p)
        n = struct.unpack_from(">Q", d, p + 8)[0] if n == 1 and p + 16 <= len(d) else n
        if n < 8 or p + n > len(d) or name not in (b"ftyp", b"moov", b"mdat", b"free", b"skip", b"meta", b"moof", b"sidx", b"uuid", b"wide"):
            break
        kinds.add(name)
        p += n
    return p - at if kinds & {b"moov", b"mdat", b"meta", b"moof"} else 0


def _pdf(d: bytes, at: int, marks: Marks) -> int:
    """Up to the last end mark before another file begins; an updated file has several."""
    if not d[at + 5 : at + 6].isdigit():
        return 0
    later = marks.between(b"%PDF-", at + 5, len(d))
    ends = marks.between(b"%%EOF", at, later[0] if later else len(d))
    return ends[1] + 5 - at if ends and marks.between(b"startxref", at, ends[1]) else 0


def _gzip(d: bytes, at: int, marks: Marks) -> int:
    if len(d) < at + 18 or d[at + 3] & 0xE0:
        return 0
    box, view, p = zlib.decompressobj(31), memoryview(d), at
    try:
        while p < len(d) and not box.eof:
            part = bytes(view[p : p + 4096])
            p += len(part)
            while part and not box.eof:
                box.decompress(part, 1 << 16)
                part = box.unconsumed_tail
        return p - at - len(box.unused_data) if box.eof else 0
    except zlib.error:
        return 0


# Magic bytes, the place of the magic within the media, and the type's name.
FORMATS: tuple[tuple[bytes, int, str, Callable[[bytes, int, Marks], int]], ...] = (
    (b"\x89PNG\r\n\x1a\n", 0, "image/png", _png),
    (b"\xff\xd8\xff", 0, "image/jpeg", _jpeg),
    (b"GIF87a", 0, "image/gif", _gif),
    (b"GIF89a", 0, "image/gif", _gif),
    (b"BM", 0, "image/bmp", _bmp),
    (b"RIFF", 0, "audio/wav", _wave),
    (b"RIFF", 0, "image/webp", _webp),
    (b"RIFF", 0, "video/x-msvideo", _avi),
    (b"fLaC", 0, "audio/flac", _flac),
    (b"OggS", 0, "audio/ogg", _ogg),
    (b"ftyp", 4, "video/mp4", _mp4),
    (b"%PDF-", 0, "application/pdf", _pdf),
    (b"\x1f\x8b\x08", 0, "application/gzip", _gzip),
)


def automaton() -> ahocorasick.Automaton:
    """Over the magic bytes as Latin-1; a magic's value is the indexes of its formats."""
    out = ahocorasick.Automaton()
    by: dict[bytes, list[int]] = {}
    for i, (magic, *_) in enumerate(FORMATS):
        by.setdefault(magic, []).append(i)
    for magic, which in by.items():
        out.add_word(magic.decode("latin-1"), (len(magic), tuple(which)))
    out.make_automaton()
    return out


def sniff_value(data: bytes, searcher: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(offset, length, type) of all confirmed media, by offset."""
    found: dict[int, tuple[int, int, str]] = {}
    marks = Marks(data)
    for last, (n, which) in searcher.iter(data.decode("latin-1")):
        for i in which:
            at = last + 1 - n - FORMATS[i][1]
            if at >= 0 and at not in found and (size := FORMATS[i][3](data, at, marks)):
                found[at] = (at, size, FORMATS[i][2])
    return [found[at] for at in sorted(found)]


_FOUND = "found array<struct<offset: long, length: long, type: string>>"


def sniff(rows: DataFrame, media: str = "media", key: str = "doc_id", declared: str | None = None) -> DataFrame:
    """(key, declared, true_type, mismatch, found): found has all media of the value, the one at byte 0 included."""
    columns = [F.col(key).alias("key"), F.col(media).alias("media"), (F.col(declared) if declared else F.lit(None).cast("string")).alias("declared")]
    part = rows.select(*columns)
    kind = part.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = automaton()
        for b in slices(batches, "media", BATCH_BYTES):
            all_found = [sniff_value(x or b"", searcher) for x in b.column("media").to_pylist()]
            true = [f[0][2] if f and f[0][0] == 0 else "unknown" for f in all_found]
            wrong = [d is not None and d != t for d, t in zip(b.column("declared").to_pylist(), true, strict=True)]
            listed = pa.array([[{"offset": o, "length": n, "type": t} for o, n, t in f] for f in all_found], pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string())])))
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("declared"), pa.array(true, pa.string()), pa.array(wrong, pa.bool_()), listed], names=["key", "declared", "true_type", "mismatch", "found"])

    return part.mapInArrow(run, f"key {kind}, declared string, true_type string, mismatch boolean, {_FOUND}").withColumnRenamed("key", key)


def carve(rows: DataFrame, found: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """(key, offset, type, bytes) of all media that ``sniff`` confirmed, cut from the values by SQL substrings.

    Keys must be unique; rows of null keys have no media; an empty table gives none.
    """
    spans = found.select(key, F.inline("found"))
    return rows.select(key, media).join(spans, key).select(key, "offset", "type", F.expr(f"substring({media}, cast(offset as int) + 1, cast(length as int))").alias("bytes"))


def store_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, declared, media): each text padded and stored as samples; it is declared as plain text."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", BATCH_BYTES):
            data = utf8(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array([len(x) for x in data], pa.int64()), pa.array(["text/plain"] * len(data), pa.string()), pa.array([encode_wave(pad(x)) for x in data], pa.binary())],
                names=["key", "n_bytes", "declared", "media"],
            )

    return rows.mapInArrow(run, f"key {kind}, n_bytes long, declared string, media binary").withColumnRenamed("key", key)


_FEATURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, true_type string, mismatch boolean, n_embedded long"


def features(stored: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sniffs the stored values, takes the payload from the confirmed container and computes digests and a feature.

    The feature names the true type, rate, samples, their least, greatest and mean value (thousandths) and the number of
    embedded media. A value that isn't a wave after all raises: what was stored must be read back.
    """
    rows = stored.select(F.col(key).alias("key"), "n_bytes", "declared", "media")
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        searcher = automaton()
        for b in slices(batches, "media", BATCH_BYTES):
            out = []
            for k, n, declared, media in zip(*(b.column(c).to_pylist() for c in ("key", "n_bytes", "declared", "media")), strict=True):
                found = sniff_value(media, searcher)
                if not found or found[0][:2] != (0, len(media)) or found[0][2] != "audio/wav":
                    raise ValueError("a stored value is no longer a whole wave")
                chunks = _riff_chunks(media, 0)[1]
                at, size = chunks[b"data"]
                rate = struct.unpack_from("<I", media, chunks[b"fmt "][0] + 4)[0]
                payload = media[at : at + size]
                samples = np.frombuffer(payload, np.uint8)
                mean = int(samples.sum(dtype=np.int64)) * 1000 // max(1, size)
                feature = f"audio/wav rate={rate} samples={size} min={samples.min()} max={samples.max()} mean={mean} embedded={len(found) - 1}"
                out.append((k, n, size, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, found[0][2], declared != found[0][2], len(found) - 1))
            columns = list(zip(*out, strict=True))
            types = [b.column("key").type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64()]
            names = ["key", *(x.split()[0] for x in _FEATURES.split(", "))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return rows.mapInArrow(run, f"key {kind}, {_FEATURES}").withColumnRenamed("key", key)
