"""Media columns: AVI motion-JPEG.

write_avi() stores bytes as 8-bit samples in a standard AVI file of baseline JPEG frames: a sample is
an 8x8 block of one grey, so a frame of 24 x 24 samples is 192 x 192 pixels and nothing is lost (the
DC quantiser is 8, a block's level is the sample less 128).  The Huffman tables give every block the
same number of bits, which lets numpy read all blocks of all frames at once; any other baseline
tables go through the general decoder.

read_avi() walks the RIFF index, decodes every intra frame, and detects shots: the difference of two
frames' histograms is a cut if it exceeds the mean of the last differences by some deviations, and a
least difference that alone decides on the first.

Defined results: a null or empty payload is stored as one padding frame; bytes that are no AVI file
give null, and no clip rows; equal payloads give equal files, so repeated rows and ties are alike;
payloads are stored whole, however long; an empty table gives an empty result.  Other columns are not
touched, but for ones that have the names asked for, which are replaced.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import fresh, small_batches

SIDE = 24  #: samples on a frame's side
FRAME = SIDE * SIDE
PAD = 255
FPS = 25
#: Shots: bins of the histogram, differences looked back on, deviations and least difference of a cut.
BINS, BACK, DEVIATIONS, LEAST = 16, 8, 3.0, 0.10

# Categories 8 to 0 of the DC difference have codes of 1 to 9 bits, so code and value together take 9.
DC_LENGTHS, DC_SYMBOLS = bytes([1] * 9 + [0] * 7), bytes(range(8, -1, -1))
AC_LENGTHS, AC_SYMBOLS = bytes([1] + [0] * 15), b"\0"


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def jpeg_head(width: int, height: int) -> bytes:
    return b"".join((
        b"\xff\xd8", _segment(0xDB, b"\0" + bytes([8]) + bytes([1] * 63)),
        _segment(0xC0, struct.pack(">BHHB", 8, height, width, 1) + bytes([1, 0x11, 0])),
        _segment(0xC4, b"\x00" + DC_LENGTHS + DC_SYMBOLS), _segment(0xC4, b"\x10" + AC_LENGTHS + AC_SYMBOLS),
        _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
    ))


def _dc_codes() -> np.ndarray:
    """The ten bits of a block by its DC difference (-255 to 255): code, value, end of block."""
    codes = []
    for d in range(-255, 256):
        k = abs(d).bit_length()
        ones = 8 - k  # ones before the code's zero
        value = d if d >= 0 else d + (1 << k) - 1
        codes.append((((1 << ones) - 1) << (k + 1) | value) << 1)
    return np.array(codes, np.uint64)


_DC = _dc_codes()
_HEAD = jpeg_head(8 * SIDE, 8 * SIDE)
_SHIFT = np.array([30, 20, 10, 0], np.uint64)


def frames_of(payload: bytes) -> list[bytes]:
    """A JPEG file for each FRAME bytes of the payload."""
    level = np.frombuffer(payload, np.uint8).reshape(-1, FRAME).astype(np.int16) - 128
    codes = _DC[np.diff(level, axis=1, prepend=0) + 255].reshape(-1, 4)
    words = (codes << _SHIFT).sum(axis=1, dtype=np.uint64).astype(">u8")
    scans = np.ascontiguousarray(words.view(np.uint8).reshape(-1, 8)[:, 3:]).reshape(len(level), -1)
    return [_HEAD + s.tobytes().replace(b"\xff", b"\xff\0") + b"\xff\xd9" for s in scans]


def padded(data: bytes) -> bytes:
    return data + bytes([PAD]) * ((-len(data)) % FRAME or (0 if data else FRAME))


def avi_of(payload: bytes) -> bytes:
    """An AVI file: header lists, the frames as 00dc chunks, and an idx1 index."""
    frames = frames_of(payload)
    chunks, index, at = [], [], 4
    for f in frames:
        chunks.append(b"00dc" + struct.pack("<I", len(f)) + f + b"\0" * (len(f) & 1))
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(f)))
        at += len(chunks[-1])
    side = 8 * SIDE
    avih = struct.pack("<14I", 1_000_000 // FPS, 0, 0, 0x10, len(frames), 0, 1, 0, side, side, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, len(frames), 0, 0xFFFFFFFF, 0, 0, 0, side, side)
    strf = struct.pack("<IiiHH4sIiiII", 40, side, side, 1, 24, b"MJPG", side * side * 3, 0, 0, 0, 0)
    chunk = lambda name, body: name + struct.pack("<I", len(body)) + body
    hdrl = chunk(b"LIST", b"hdrl" + chunk(b"avih", avih) + chunk(b"LIST", b"strl" + chunk(b"strh", strh) + chunk(b"strf", strf)))
    return chunk(b"RIFF", b"AVI " + hdrl + chunk(b"LIST", b"movi" + b"".join(chunks)) + chunk(b"idx1", b"".join(index)))


def riff_frames(data: bytes) -> tuple[list[bytes], float]:
    """The video chunks of an AVI file by its index (or, without one, in file order), and microseconds a frame."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("no AVI file")
    movi = index = None
    micros, at, end = 1_000_000 / FPS, 12, min(len(data), 8 + struct.unpack_from("<I", data, 4)[0])
    while at + 8 <= end:
        name, size = data[at:at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"LIST" and data[at + 8:at + 12] == b"movi":
            movi = (at + 8, at + 8 + size)
        elif name == b"LIST" and data[at + 8:at + 12] == b"hdrl" and data[at + 12:at + 16] == b"avih":
            micros = float(struct.unpack_from("<I", data, at + 20)[0] or micros)
        elif name == b"idx1":
            index = np.frombuffer(data, "S4,<u4,<u4,<u4", size // 16, at + 8)
        at += 8 + size + (size & 1)
    if movi is None:
        raise ValueError("no frames")
    if index is not None:
        return [data[movi[0] + int(a) + 8:movi[0] + int(a) + 8 + int(n)] for c, _, a, n in index if c[2:] in (b"dc", b"db")], micros
    frames, at = [], movi[0] + 4
    while at + 8 <= movi[1]:
        size = struct.unpack_from("<I", data, at + 4)[0]
        if data[at + 2:at + 4] in (b"dc", b"db"):
            frames.append(data[at + 8:at + 8 + size])
        at += 8 + size + (size & 1)
    return frames, micros


class Tables:
    """What a JPEG's segments before its scan say."""

    def __init__(self, data: bytes):
        self.quant, self.huff, self.scan, self.restart, at = {}, {}, {}, 0, 2
        while True:
            marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4:at + 2 + size]
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quant[body[0] & 15] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1).astype(np.int64)
                    body = body[1 + 64 * (1 + wide):]
            elif marker == 0xC0:
                self.height, self.width, n = struct.unpack_from(">HHB", body, 1)
                self.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("not a baseline JPEG")
            elif marker == 0xC4:
                while body:
                    lengths = body[1:17]
                    code, k, table = 0, 17, {}
                    for bits in range(1, 17):
                        for _ in range(lengths[bits - 1]):
                            table[bits, code] = body[k]
                            code, k = code + 1, k + 1
                        code <<= 1
                    self.huff[body[0]] = table
                    body = body[k:]
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == 0xDA:
                self.scan = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])}
                self.at = at + 2 + size
                return
            at += 2 + size

    def stride(self) -> int:
        """Bits of every block if they are all alike: one part, no AC values, equal DC lengths; else 0."""
        if len(self.parts) != 1 or self.restart:
            return 0
        dc, ac = (self.huff[a | b << 4] for a, b in zip(self.scan[self.parts[0][0]], (0, 1), strict=True))
        lengths = {bits + category for (bits, _), category in dc.items()}
        return lengths.pop() + next(iter(ac))[0] if len(lengths) == 1 and list(ac.values()) == [0] else 0


_ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
_COS = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (0.5 if u else 0.5 / np.sqrt(2)) for u in range(8)] for x in range(8)])


def decoded_grey(data: bytes, tables: Tables) -> np.ndarray:
    """The first part's pixels of a baseline JPEG with any Huffman tables, restarts and sampling."""
    end = data.rfind(b"\xff\xd9")
    scans = [x.replace(b"\xff\0", b"\xff") for x in re.split(b"\xff[\xd0-\xd7]", data[tables.at:end if end > tables.at else len(data)])]
    most_h, most_v = max(p[1] for p in tables.parts), max(p[2] for p in tables.parts)
    if len(tables.parts) == 1:
        tables.parts[0] = (tables.parts[0][0], most_h := 1, most_v := 1, tables.parts[0][3])
    across, down = -(-tables.width // (8 * most_h)), -(-tables.height // (8 * most_v))
    _, h0, v0, q0 = tables.parts[0]
    blocks = np.zeros((down * v0, across * h0, 64), np.int64)
    unit = 0
    for scan in scans:
        bits, at, end = int.from_bytes(scan, "big"), 0, 8 * len(scan)

        def take(n: int) -> int:
            nonlocal at
            at += n
            return (bits >> (end - at)) & ((1 << n) - 1) if at <= end else 0

        def symbol(table: dict) -> int:
            code = 0
            for n in range(1, 17):
                code = code << 1 | take(1)
                if (n, code) in table:
                    return table[n, code]
            raise ValueError("bad Huffman code")

        def value(n: int) -> int:
            v = take(n)
            return v if not n or v >> (n - 1) else v - (1 << n) + 1

        last = dict.fromkeys(tables.scan, 0)
        for _ in range(tables.restart or across * down):
            if unit >= across * down:
                break
            for p, (name, h, v, _) in enumerate(tables.parts):
                dc, ac = tables.huff[tables.scan[name][0]], tables.huff[tables.scan[name][1] | 16]
                for j in range(h * v):
                    last[name] += value(symbol(dc))
                    block = np.zeros(64, np.int64)
                    block[0], k = last[name], 1
                    while k < 64:
                        s = symbol(ac)
                        if s == 0:
                            break
                        k += s >> 4
                        if s & 15:
                            block[k] = value(s & 15)
                        k += 1
                    if p == 0:
                        blocks[unit // across * v0 + j // h, unit % across * h0 + j % h] = block
            unit += 1
    level = np.zeros(blocks.shape)
    level[..., _ZIGZAG] = blocks * tables.quant[q0]
    pixels = np.einsum("xu,abuv,yv->abxy", _COS, level.reshape(*blocks.shape[:2], 8, 8), _COS) + 128
    pixels = np.clip(np.rint(pixels), 0, 255).astype(np.uint8).transpose(0, 2, 1, 3)
    return pixels.reshape(blocks.shape[0] * 8, -1)[: tables.height * v0 // most_v, : tables.width * h0 // most_h]


def _flat_blocks(frames: list[bytes], tables: Tables, stride: int) -> np.ndarray:
    """Samples of frames whose blocks all take stride bits: one row a frame, one sample a block."""
    n = -(-tables.width // 8) * -(-tables.height // 8)
    rows = b"".join(f[tables.at:-2].replace(b"\xff\0", b"\xff")[: (n * stride + 7) // 8].ljust((n * stride + 7) // 8, b"\0") for f in frames)
    dc = tables.huff[tables.scan[tables.parts[0][0]][0]]
    width = stride - next(iter(tables.huff[16 | tables.scan[tables.parts[0][0]][1]]))[0]
    values = np.zeros(1 << width, np.int16)
    for (bits, code), k in dc.items():
        v = np.arange(1 << k)
        values[(code << k) + v] = np.where(v >> max(k - 1, 0), v, v - (1 << k) + 1) if k else 0
    data = np.frombuffer(rows, np.uint8).reshape(len(frames), -1)
    if stride == 10 and n % 4 == 0:
        words = np.zeros((len(frames) * n // 4, 8), np.uint8)
        words[:, 3:] = data.reshape(-1, 5)
        codes = (words.view(">u8").astype(np.uint64) >> _SHIFT).reshape(len(frames), n).astype(np.int64) & 1023
    else:
        bits = np.unpackbits(data, axis=1)[:, : n * stride].reshape(len(frames), n, stride)
        codes = bits @ (1 << np.arange(stride - 1, -1, -1))
    level = np.cumsum(values[codes >> (stride - width)], axis=1) * int(tables.quant[tables.parts[0][3]][0]) / 8
    return np.clip(np.rint(level) + 128, 0, 255).astype(np.uint8)


def samples_of(frames: list[bytes]) -> list[np.ndarray]:
    """Per frame its samples: blocks of one grey give one sample each, other frames their pixels."""
    heads: dict[bytes, tuple[Tables, int]] = {}
    out: list[np.ndarray] = [None] * len(frames)
    alike: dict[bytes, list[int]] = {}
    for i, f in enumerate(frames):
        head = f[: len(_HEAD)]
        if head not in heads:
            heads[head] = (t := Tables(f), t.stride() if t.at == len(head) else 0)
        if heads[head][1]:
            alike.setdefault(head, []).append(i)
        else:
            out[i] = decoded_grey(f, Tables(f)).reshape(-1)
    for head, own in alike.items():
        for i, row in zip(own, _flat_blocks([frames[i] for i in own], *heads[head]), strict=True):
            out[i] = row
    return out


def shot_starts(samples: list[np.ndarray]) -> list[int]:
    """First frames of shots: 0 and every cut."""
    hist = np.stack([np.bincount(s >> 4, minlength=BINS) / max(len(s), 1) for s in samples])
    diff = np.abs(np.diff(hist, axis=0)).sum(axis=1) / 2
    if not len(diff):
        return [0]
    one, two = np.cumsum(np.r_[0, diff]), np.cumsum(np.r_[0, diff * diff])
    i = np.arange(len(diff))
    a = np.maximum(i - BACK, 0)
    n = np.maximum(i - a, 1)
    mean = (one[i] - one[a]) / n
    dev = np.sqrt(np.maximum((two[i] - two[a]) / n - mean * mean, 0))
    cut = (diff > mean + DEVIATIONS * dev) & (diff > LEAST)
    return [0, *(np.flatnonzero(cut) + 1).tolist()]


def read_one(data: bytes | None) -> dict | None:
    """Payload and clips of one AVI file; null if it is none."""
    try:
        frames, micros = riff_frames(data or b"")
        samples = samples_of(frames)
    except (ValueError, KeyError, IndexError, struct.error):
        return None
    if not samples:
        return {"payload": b"", "n_frames": 0, "clips": []}
    starts = shot_starts(samples)
    ends = [*starts[1:], len(samples)]
    clips = [
        {"clip": k, "first_frame": a, "end_frame": b, "start_ms": int(a * micros // 1000), "end_ms": int(b * micros // 1000), "mean_level": round(float(np.mean([samples[i].mean() for i in range(a, b)])), 3)}
        for k, (a, b) in enumerate(zip(starts, ends, strict=True))
    ]
    return {"payload": b"".join(s.tobytes() for s in samples), "n_frames": len(samples), "clips": clips}


CLIP = T.StructType([T.StructField(n, t()) for n, t in (("clip", T.IntegerType), ("first_frame", T.IntegerType), ("end_frame", T.IntegerType), ("start_ms", T.LongType), ("end_ms", T.LongType), ("mean_level", T.DoubleType))])
READ = T.StructType([T.StructField("payload", T.BinaryType()), T.StructField("n_frames", T.IntegerType()), T.StructField("clips", T.ArrayType(CLIP))])
_CLIP = pa.struct([("clip", pa.int32()), ("first_frame", pa.int32()), ("end_frame", pa.int32()), ("start_ms", pa.int64()), ("end_ms", pa.int64()), ("mean_level", pa.float64())])


@F.arrow_udf(T.BinaryType())
def _write(payloads: pa.Array) -> pa.Array:
    return pa.array((avi_of(padded(p.as_py() or b"")) for p in payloads), pa.binary(), size=len(payloads))


@F.arrow_udf(READ)
def _read(files: pa.Array) -> pa.Array:
    return pa.array((read_one(x.as_py()) for x in files), pa.struct([("payload", pa.binary()), ("n_frames", pa.int32()), ("clips", pa.list_(_CLIP))]), size=len(files))


def write_avi(df: DataFrame, payload: str = "payload", media: str = "media") -> DataFrame:
    """df with media: the AVI file that holds payload (binary), padded with 255 to whole frames."""
    return small_batches(df).withColumn(media, _write(F.coalesce(F.col(payload), F.lit(b""))))


def read_avi(df: DataFrame, media: str = "media", read: str = "read") -> DataFrame:
    """df with read: payload, n_frames and clips of the AVI file in media."""
    return small_batches(df).withColumn(read, _read(F.col(media)))


def clip_rows(df: DataFrame, *keys: str, media: str = "media") -> DataFrame:
    """Timed clip rows: the keys, then one row per shot."""
    (read,) = fresh(df, "el_read")
    return read_avi(df, media, read).select(*keys, F.inline(f"{read}.clips"))
