"""JPEG storage: exact round trips, a colour image with subsampling, odd rows."""

import hashlib
import zlib

import numpy as np
import pytest

from quillspark.llm import jpeg


@pytest.mark.parametrize("body", [b"", b"a", b"x" * 192, b"y" * 193, bytes(range(256)) * 40, np.random.default_rng(3).integers(0, 256, 250_000, dtype=np.uint8).tobytes()])
def test_round_trip(body):
    payload = jpeg.payload(body)
    assert len(payload) % 192 == 0 and payload.rstrip(b" ") == body.rstrip(b" ")
    file = jpeg.encode([payload])[0]
    ((width, height, plane),) = jpeg.thumbnails([file])[0]
    assert plane.tobytes()[: len(payload)] == payload and (width, height) == (plane.shape[1] * 8, plane.shape[0] * 8)


def bits_of(blocks):
    """A scan by the module's DC table and an AC table with 0x01 (one bit, no run) and end of block."""
    dc = {s: (c, n) for c, n, s in jpeg.canonical(jpeg.DC_BITS, jpeg.DC_SYMBOLS)}
    ac = {s: (c, n) for c, n, s in jpeg.canonical(bytes([0, 2] + [0] * 14), b"\x00\x01")}
    out = ""
    for diff, coefficients in blocks:
        size = abs(diff).bit_length()
        out += format(dc[size][0], f"0{dc[size][1]}b") + (format(diff if diff > 0 else diff + (1 << size) - 1, f"0{size}b") if size else "")
        out += "".join(format(ac[1][0], f"0{ac[1][1]}b") + "1" for _ in range(coefficients)) + format(ac[0][0], f"0{ac[0][1]}b")
    out += "1" * (-len(out) % 8)
    return int(out, 2).to_bytes(len(out) // 8, "big").replace(b"\xff", b"\xff\0")


def test_colour_image_with_subsampling_and_no_restarts():
    def part(marker, body):
        return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body

    # 32 x 16 pixels, luminance 2x2: two MCUs of four Y, one Cb and one Cr block
    y = [[10, 5, -3, 0], [7, -20, 1, 2]]
    blocks = [b for mcu in y for b in [*((d, 3) for d in mcu), (4, 0), (-4, 1)]]
    frame = b"\x08" + (16).to_bytes(2, "big") + (32).to_bytes(2, "big") + b"\x03\x01\x22\x00\x02\x11\x00\x03\x11\x00"
    file = b"\xff\xd8" + part(0xE0, b"JFIF\0") + part(0xDB, b"\0" + b"\x08" * 64) + part(0xC0, frame) + part(0xC4, b"\0" + jpeg.DC_BITS + jpeg.DC_SYMBOLS) + part(0xC4, b"\x10" + bytes([0, 2] + [0] * 14) + b"\x00\x01") + part(0xDA, b"\x03\x01\x00\x02\x00\x03\x00\x00\x3f\x00") + bits_of(blocks) + b"\xff\xd9"
    ((width, height, plane),) = jpeg.thumbnails([file])[0]
    level = np.cumsum([d for mcu in y for d in mcu]) + 128
    assert (width, height) == (32, 16)
    assert plane.tolist() == [[level[0], level[1], level[4], level[5]], [level[2], level[3], level[6], level[7]]]


def test_store(odd, none):
    rows = jpeg.store(odd).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in odd.collect() if r.doc_id}
    for r in rows:
        if r.doc_id:
            payload = jpeg.payload(texts[r.doc_id])
            assert (r.n_bytes, r.payload_bytes) == (len(texts[r.doc_id]), len(payload))
            assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-16:])
            assert r.media_bytes == len(r.media) and r.media_sha256 == hashlib.sha256(r.media).hexdigest()
    assert len(rows) == odd.count() and len({r.feature for r in rows if r.doc_id in (1, 2)}) == 1
    assert jpeg.store(none).count() == 0


def test_other_formats_are_refused():
    with pytest.raises(ValueError):
        jpeg.thumbnails([b"GIF89a"])


def test_features_cover_all_images_of_a_text(spark, monkeypatch):
    monkeypatch.setattr(jpeg, "FRAME", 24 * 16)
    one, two = b"a" * 1000, b"a" * 800 + b"z" * 20 + b"!" * 60 + b"a" * 120
    shown = [jpeg.thumbnails(jpeg.encode([jpeg.payload(t)]))[0] for t in (one, two)]
    assert len(shown[0]) > 1 and b"".join(p.tobytes() for _, _, p in shown[1])[:1000] == two
    assert [jpeg.thumbnail_hash(p) for _, _, p in shown[0]] != [jpeg.thumbnail_hash(p) for _, _, p in shown[1]]
