"""Media column: baseline JPEG storage of byte payloads, DC-only luminance thumbnails and their hashes, in numpy.

``encode`` stores every payload byte as one 8x8 block of a grey baseline JPEG: the block's DC level is the byte less
128 under a quantiser of 8, so all 64 samples of the block equal the byte and nothing is lost. ``thumbnails`` reads
any baseline JPEG (grey or colour, subsampled, with or without restart markers, several scans): it parses the markers,
Huffman-decodes the scans and rebuilds the luminance DC plane, 1/8 of the size. All restart segments of all images of
a batch are decoded together, one symbol of each per numpy step.

Defined results: a null or empty text is a payload of 192 spaces; a payload over ``24 * 256 * 8191`` bytes becomes
several images one after the other; equal texts give equal rows; null doc_ids and repeated rows pass through.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.common import as_batch, batches, text_bytes

UNIT, INTERVAL, COLUMNS, MAX_ROWS = 192, 48, 24, 8191
FRAME = COLUMNS * 256 * MAX_ROWS // UNIT * UNIT
#: Code counts by length, and symbols: DC categories, and an AC table of the end-of-block symbol alone.
DC_BITS, DC_SYMBOLS = bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]), bytes(range(12))
AC_BITS, AC_SYMBOLS = bytes([1] + [0] * 15), b"\0"


def canonical(bits: bytes, symbols: bytes) -> list[tuple[int, int, int]]:
    """(code, length, symbol) of a Huffman table given as counts by length."""
    out, code, at = [], 0, 0
    for length, count in enumerate(bits, 1):
        for _ in range(count):
            out.append((code, length, symbols[at]))
            code, at = code + 1, at + 1
        code <<= 1
    return out


def _symbol_tables() -> tuple[np.ndarray, np.ndarray]:
    """Bits and length of (DC difference, end of block), by difference + 255."""
    codes = {s: (c, n) for c, n, s in canonical(DC_BITS, DC_SYMBOLS)}
    value, length = np.zeros(511, np.uint16), np.zeros(511, np.uint16)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, n = codes[size]
        extra = d if d >= 0 else d + (1 << size) - 1
        value[d + 255], length[d + 255] = ((code << size) | extra) << 1, n + size + 1
    return value, length


_VALUE, _LENGTH = _symbol_tables()
_VALID = np.arange(16) < np.arange(17)[:, None]


def _shape(n: int) -> tuple[int, int]:
    columns = COLUMNS
    while n > columns * MAX_ROWS:
        columns *= 2
    return columns, -(-n // columns)


def _header(columns: int, rows: int) -> bytes:
    def part(marker: int, body: bytes) -> bytes:
        return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body

    frame = b"\x08" + (rows * 8).to_bytes(2, "big") + (columns * 8).to_bytes(2, "big") + b"\x01\x01\x11\x00"
    return b"\xff\xd8" + part(0xDB, b"\x00" + b"\x08" * 64) + part(0xC0, frame) + part(0xC4, b"\x00" + DC_BITS + DC_SYMBOLS) + part(0xC4, b"\x10" + AC_BITS + AC_SYMBOLS) + part(0xDD, INTERVAL.to_bytes(2, "big")) + part(0xDA, b"\x01\x01\x00\x00\x3f\x00")


def encode(payloads: list[bytes]) -> list[bytes]:
    """A baseline JPEG (several, for huge payloads) for every payload, whose length is a positive multiple of 192."""
    frames, owner = [], []
    for i, p in enumerate(payloads):
        for at in range(0, len(p), FRAME):
            frames.append(p[at : at + FRAME])
            owner.append(i)
    shapes = [_shape(len(f)) for f in frames]
    # a frame's last row is filled up with spaces; readers know the payload's length from the text
    frames = [f + b" " * (-len(f) % UNIT) + b" " * (c * r - len(f) - (-len(f) % UNIT)) for f, (c, r) in zip(frames, shapes)]
    segments = np.array([len(f) // INTERVAL for f in frames])
    data = np.frombuffer(b"".join(frames), np.uint8).astype(np.int16).reshape(-1, INTERVAL)
    diff = np.empty_like(data)
    diff[:, 0] = data[:, 0] - 128
    diff[:, 1:] = data[:, 1:] - data[:, :-1]
    diff += 255
    value, length = _VALUE[diff], _LENGTH[diff]
    total = length.sum(axis=1, dtype=np.int64)
    pad = -total & 7
    # left-justified 16-bit words, a last one of 1-bits to fill the byte; their valid bits in a row are the stream
    words = np.empty((len(data), INTERVAL + 1), ">u2")
    words[:, :-1] = value << (16 - length)
    words[:, -1] = 0xFFFF
    lengths = np.hstack([length, pad[:, None]]).astype(np.uint8).ravel()
    bits = np.unpackbits(words.view(np.uint8))
    flat = np.packbits(bits[_VALID[lengths].ravel()])
    n_bytes = (total + pad) >> 3
    # every segment is followed by a marker: RST0..7 in turn, or the end of the image
    stuffed = flat == 0xFF
    grown = np.cumsum(1 + stuffed)
    last_of = np.cumsum(n_bytes) - 1
    marker_at = grown[last_of] + 2 * np.arange(len(data))
    out = np.zeros(int(grown[-1]) + 2 * len(data), np.uint8)
    segment = np.repeat(np.arange(len(data)), n_bytes)
    out[grown - 1 - stuffed + 2 * segment] = flat
    first = np.cumsum(segments) - segments
    turn = np.arange(len(data)) - np.repeat(first, segments)
    out[marker_at] = 0xFF
    out[marker_at + 1] = 0xD0 + turn % 8
    last = np.cumsum(segments) - 1
    out[marker_at[last] + 1] = 0xD9
    stops = marker_at[last] + 2
    images: list[list[bytes]] = [[] for _ in payloads]
    start = 0
    for i, shape, stop in zip(owner, shapes, stops.tolist()):
        images[i].append(_header(*shape) + out[start:stop].tobytes())
        start = stop
    return [b"".join(x) for x in images]


@dataclass
class Scan:
    """One scan: its restart segments (unstuffed), and by block of an MCU: component, DC and AC table."""

    segments: list[bytes]
    blocks: list[tuple[int, tuple, tuple]]
    mcus: int
    interval: int
    grid: tuple[int, int]


@dataclass
class Image:
    width: int = 0
    height: int = 0
    components: list[list[int]] = field(default_factory=list)
    scans: list[Scan] = field(default_factory=list)
    quant: dict[int, int] = field(default_factory=dict)


def parse(data: bytes, at: int = 0) -> tuple[Image, int]:
    """The image that begins at ``at``, and where it ends."""
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("not a JPEG image")
    image, tables, interval, at = Image(), {}, 0, at + 2
    while True:
        while data[at] == 0xFF and data[at + 1] == 0xFF:
            at += 1
        marker, at = data[at + 1], at + 2
        if marker == 0xD9:
            return image, at
        size = int.from_bytes(data[at : at + 2], "big")
        body, at = data[at + 2 : at + size], at + size
        if marker == 0xDB:
            i = 0
            while i < len(body):
                wide = body[i] >> 4
                image.quant[body[i] & 15] = int.from_bytes(body[i + 1 : i + 2 + wide], "big")
                i += 1 + 64 * (1 + wide)
        elif marker == 0xC4:
            i = 0
            while i < len(body):
                n = sum(body[i + 1 : i + 17])
                tables[body[i]] = (body[i + 1 : i + 17], body[i + 17 : i + 17 + n])
                i += 17 + n
        elif marker in (0xC0, 0xC1):
            image.height, image.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            image.components = [[body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]] for k in range(body[5])]
        elif 0xC2 <= marker <= 0xCF and marker != 0xCC:
            raise ValueError("only baseline JPEG is read")
        elif marker == 0xDD:
            interval = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            segments, start = [], at
            while True:
                at = data.index(b"\xff", at)
                follow = data[at + 1]
                if follow == 0:
                    at += 2
                elif 0xD0 <= follow <= 0xD7:
                    segments.append(data[start:at].replace(b"\xff\0", b"\xff"))
                    start = at = at + 2
                else:
                    segments.append(data[start:at].replace(b"\xff\0", b"\xff"))
                    break
            index = {c[0]: k for k, c in enumerate(image.components)}
            chosen = [(index[body[1 + 2 * k]], body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])]
            hmax, vmax = max(c[1] for c in image.components), max(c[2] for c in image.components)
            if len(chosen) == 1:
                c = image.components[chosen[0][0]]
                grid = (-(-image.width * c[1] // (8 * hmax)), -(-image.height * c[2] // (8 * vmax)))
                blocks = [(chosen[0][0], tables[chosen[0][1]], tables[16 + chosen[0][2]])]
            else:
                grid = (-(-image.width // (8 * hmax)), -(-image.height // (8 * vmax)))
                blocks = [(k, tables[d], tables[16 + a]) for k, d, a in chosen for _ in range(image.components[k][1] * image.components[k][2])]
            image.scans.append(Scan(segments, blocks, grid[0] * grid[1], interval, grid))


def _lookup(table: tuple[bytes, bytes]) -> np.ndarray:
    """Code length * 256 + symbol by the next 16 bits; 0 where no code fits."""
    entries = np.zeros(65536, np.int64)
    for code, n, symbol in canonical(*table):
        entries[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | symbol
    return entries


def dc_differences(scans: list[Scan]) -> list[list[np.ndarray]]:
    """By scan and segment, the DC differences of all its blocks in order; all segments advance together."""
    tables: dict[tuple, int] = {}
    patterns: dict[tuple, int] = {}
    lanes, raw, offset = [], [], 0
    for scan in scans:
        pattern = tuple((tables.setdefault(d, len(tables)), tables.setdefault(a, len(tables))) for _, d, a in scan.blocks)
        p = patterns.setdefault(pattern, len(patterns))
        left = scan.mcus
        for body in scan.segments:
            n = min(left, scan.interval or left)
            lanes.append((offset * 8, p, n * len(scan.blocks)))
            raw.append(body)
            offset += len(body)
            left -= n
    stream = np.frombuffer(b"".join(raw) + b"\0" * 8, np.uint8)
    words = np.zeros(len(stream) - 7, np.uint64)
    for k in range(8):
        words |= stream[k : len(stream) - 7 + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    looked = np.concatenate([_lookup(t) for t in tables])
    width = max(map(len, patterns))
    dc_of, ac_of, per = np.zeros((len(patterns), width), np.int64), np.zeros((len(patterns), width), np.int64), np.zeros(len(patterns), np.int64)
    for pattern, p in patterns.items():
        per[p] = len(pattern)
        for k, (d, a) in enumerate(pattern):
            dc_of[p, k], ac_of[p, k] = d << 16, a << 16
    state = np.array(lanes, np.int64)
    pos, pattern, count = state[:, 0].copy(), state[:, 1].copy(), state[:, 2].copy()
    first = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.int64)
    target, k, slot = first.copy(), np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
    stop = first + count
    alive = count > 0
    if not alive.all():
        pos, pattern, target, stop, k, slot = (x[alive] for x in (pos, pattern, target, stop, k, slot))
    one = dc_of.size == 1
    fresh = True  # every lane stands at the start of a block
    while len(pos):
        x = words[pos >> 3] << (pos & 7).view(np.uint64)
        dc, ac = (dc_of[0, 0], ac_of[0, 0]) if one else (dc_of[pattern, slot], ac_of[pattern, slot])
        starts = None if fresh else np.flatnonzero(k == 0)
        if fresh or len(starts):
            y = x if fresh else x[starts]
            entry = looked[(y >> np.uint64(48)).view(np.int64) + (dc if fresh or one else dc[starts])]
            n, size = entry >> 8, entry & 15
            extra = ((y << n.view(np.uint64)) >> np.uint64(1) >> (63 - size).view(np.uint64)).view(np.int64)
            half = (1 << size) >> 1
            extra -= np.where(extra < half, 2 * half - 1, 0)
            used = n + size
            if fresh:
                out[target] = extra
                x = x << used.view(np.uint64)
                pos += used
            else:
                out[target[starts]] = extra
                x[starts] <<= used.view(np.uint64)
                pos[starts] += used
                k[starts] = 1
        entry2 = looked[(x >> np.uint64(48)).view(np.int64) + ac]
        if (fresh or len(starts)) and not n.all() or not entry2.all():
            raise ValueError("broken Huffman code")
        symbol = entry2 & 255
        pos += (entry2 >> 8) + (symbol & 15)
        if fresh and not symbol.any():  # all blocks end here
            target += 1
            done = None
        else:
            if fresh:
                k = np.ones(len(pos), np.int64)
            k += np.where(symbol == 0, 64, np.where(symbol == 0xF0, 16, (symbol >> 4) + 1))
            done = k >= 64
            k[done] = 0
            target += done
        if not one:
            slot = (slot + 1) % per[pattern] if done is None else np.where(done, (slot + 1) % per[pattern], slot)
        ended = target >= stop
        if ended.any():
            rest = ~ended
            pos, pattern, target, stop, slot = (v[rest] for v in (pos, pattern, target, stop, slot))
            if done is not None:
                k = k[rest]
        fresh = done is None or not k.any()
        if done is None:
            k = np.zeros(len(pos), np.int64)
    parts, at = [], 0
    for scan in scans:
        mine = []
        for _ in scan.segments:
            mine.append(out[first[at] : first[at] + count[at]])
            at += 1
        parts.append(mine)
    return parts


def _plane(image: Image, scan: Scan, diffs: list[np.ndarray], component: int) -> np.ndarray:
    """The DC plane of one component, dequantised to samples."""
    mine = np.array([i for i, b in enumerate(scan.blocks) if b[0] == component])
    if len(scan.blocks) == 1 and len({len(d) for d in diffs}) == 1:
        levels = np.cumsum(np.stack(diffs), axis=1).ravel()
    else:
        levels = np.concatenate([np.cumsum(d.reshape(-1, len(scan.blocks))[:, mine].ravel()) for d in diffs])
    spec = image.components[component]
    columns, rows = scan.grid
    if len(scan.blocks) == 1:
        plane = levels.reshape(rows, columns)
    else:
        plane = levels.reshape(rows, columns, spec[2], spec[1]).transpose(0, 2, 1, 3).reshape(rows * spec[2], columns * spec[1])
    hmax, vmax = max(c[1] for c in image.components), max(c[2] for c in image.components)
    plane = plane[: -(-image.height * spec[2] // (8 * vmax)), : -(-image.width * spec[1] // (8 * hmax))]
    return np.clip(np.floor(plane * image.quant[spec[3]] / 8 + 128.5), 0, 255).astype(np.uint8)


def thumbnails(files: list[bytes]) -> list[list[tuple[int, int, np.ndarray]]]:
    """By file, (width, height, luminance thumbnail of 1/8 size) of each image in it."""
    images, owner = [], []
    for i, data in enumerate(files):
        at = 0
        while at < len(data):
            image, at = parse(data, at)
            images.append(image)
            owner.append(i)
    wanted = [next(s for s in image.scans if any(b[0] == 0 for b in s.blocks)) for image in images]
    out: list[list[tuple[int, int, np.ndarray]]] = [[] for _ in files]
    for i, image, scan, diffs in zip(owner, images, wanted, dc_differences(wanted) if wanted else []):
        out[i].append((image.width, image.height, _plane(image, scan, diffs, 0)))
    return out


def thumbnail_hash(plane: np.ndarray) -> str:
    """64 bits by 8x8 areas of a thumbnail, 1 where the area is at least as light as the mean area, as hex."""
    rows, columns = plane.shape
    r, c = np.arange(8) * rows // 8, np.arange(8) * columns // 8
    sums = np.add.reduceat(np.add.reduceat(plane.astype(np.int64), r, axis=0), c, axis=1)
    sizes = np.maximum(np.diff(np.append(r, rows)), 1)[:, None] * np.maximum(np.diff(np.append(c, columns)), 1)[None, :]
    means = sums / sizes
    return np.packbits(means >= means.mean()).tobytes().hex()


def payload(text: bytes) -> bytes:
    return text + b" " * (-len(text) % UNIT or (0 if text else UNIT))


def store(docs: DataFrame) -> DataFrame:
    """doc_id, the stored image and what is read back from it, for every row of ``docs``.

    Columns: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, width, height,
    feature ("width x height : thumbnail hash" of every image of the file, parted by semicolons: texts over the largest
    image are several; width is that of the widest, height that of all), media (the file).
    """

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, most=1_000_000):
            texts = batch.column(1).to_pylist()
            files = encode([payload(t) for t in texts])
            rows: dict[str, list] = {k: [] for k in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "width", "height", "feature")}
            for text, data, shown in zip(texts, files, thumbnails(files)):
                size = len(text) + (-len(text) % UNIT or (0 if text else UNIT))
                back = b"".join(plane.tobytes() for _, _, plane in shown)[:size]
                feature = ";".join(f"{width}x{height}:{thumbnail_hash(plane)}" for width, height, plane in shown)
                for key, value in zip(rows, (len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(data), hashlib.sha256(data).hexdigest(), max(w for w, _, _ in shown), sum(h for _, h, _ in shown), feature)):
                    rows[key].append(value)
            yield as_batch({"doc_id": batch.column(0), **{k: pa.array(v, pa.string() if k in ("payload_sha256", "media_sha256", "feature") else pa.int64()) for k, v in rows.items()}, "media": pa.array(files, pa.binary())})

    return text_bytes(docs, "doc_id").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, width long, height long, feature string, media binary")
