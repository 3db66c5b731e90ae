"""Round trips of stored payloads, and scans of other encoders' shape against a plain decoder's values."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from shroud.llm import media_jpeg as J


@pytest.mark.parametrize("data", [b"", b"a", b"\xff" * 577, bytes(range(256)) * 5, b"x" * (576 * 2731), random.Random(1).randbytes(9000)])
def test_round_trip(data):
    payload = J.pad(data)
    assert len(payload) % J.UNIT == 0 and payload.startswith(data) and set(payload[len(data) :]) <= {255}
    (media,) = J.encode([payload])
    ((back, images, pixels),) = J.read([media])
    assert back == payload
    assert sum(i.height for i in images) * 24 == len(payload) and pixels.shape == (len(payload) // 192, 3)
    first = np.frombuffer(payload, np.uint8).reshape(-1, 64)[:, 0].astype(int)
    dc = np.where(first < 128, first - 128, first - 127)
    assert np.array_equal(pixels.ravel(), np.clip(128 + np.round(dc / 8), 0, 255))


def test_many_at_once_equal_one_by_one():
    rng = random.Random(2)
    payloads = [J.pad(rng.randbytes(rng.randrange(0, 3000))) for _ in range(40)]
    together = J.encode(payloads)
    assert together == [J.encode([p])[0] for p in payloads]
    assert [r[0] for r in J.read(together)] == payloads


class Bits:
    def __init__(self):
        self.text = ""

    def put(self, value, n):
        self.text += format(value, f"0{n}b") if n else ""

    def bytes(self):
        whole = self.text + "1" * (-len(self.text) % 8)
        return bytes(int(whole[i : i + 8], 2) for i in range(0, len(whole), 8)).replace(b"\xff", b"\xff\x00")


def plain_jpeg(width, height, sampling, blocks, interval, quantiser):
    """A baseline JPEG of given coefficients (MCU order, scan order within a block), with zero runs and end-of-block codes."""
    symbols = list(range(12))
    ac = [r << 4 | s for r in range(16) for s in range(0, 11) if s or r in (0, 15)]
    dc_spec = bytes([0] * 3 + [12] + [0] * 12) + bytes(symbols)
    ac_spec = bytes([0] * 7 + [len(ac)] + [0] * 8) + bytes(ac)
    dc_codes, ac_codes = J.canonical(list(dc_spec[:16]), symbols), J.canonical(list(ac_spec[:16]), ac)

    def magnitude(out, v):
        s = abs(v).bit_length()
        out.put(v if v >= 0 else v + (1 << s) - 1, s)

    pattern = [k for k, (h, v) in enumerate(sampling) for _ in range(h * v)] if len(sampling) > 1 else [0]
    data, out, last, n = b"", Bits(), [0] * len(sampling), 0
    mcus = len(blocks) // len(pattern)
    for m in range(mcus):
        if interval and m and m % interval == 0:
            data += out.bytes() + bytes([0xFF, 0xD0 + n % 8])
            out, last, n = Bits(), [0] * len(sampling), n + 1
        for k, c in enumerate(pattern):
            b = [int(x) for x in blocks[m * len(pattern) + k]]
            d, last[c] = b[0] - last[c], b[0]
            out.put(*dc_codes[abs(d).bit_length()])
            magnitude(out, d)
            run = 0
            end = max([i for i in range(64) if b[i]], default=0)
            for v in b[1 : end + 1]:
                if v == 0:
                    run += 1
                    continue
                while run > 15:
                    out.put(*ac_codes[0xF0])
                    run -= 16
                out.put(*ac_codes[run << 4 | abs(v).bit_length()])
                magnitude(out, v)
                run = 0
            if end < 63:
                out.put(*ac_codes[0])
    data += out.bytes()
    frame = struct.pack(">BHHB", 8, height, width, len(sampling)) + b"".join(bytes([k + 1, h << 4 | v, 0]) for k, (h, v) in enumerate(sampling))
    scan = bytes([len(sampling)]) + b"".join(bytes([k + 1, 0]) for k in range(len(sampling))) + bytes([0, 63, 0])
    parts = [b"\xff\xd8", J._segment(0xE0, b"JFIF\0"), J._segment(0xDB, bytes([0, quantiser]) + bytes([9]) * 63), J._segment(0xC0, frame), J._segment(0xC4, b"\x00" + dc_spec), J._segment(0xC4, b"\x10" + ac_spec)]
    if interval:
        parts.append(J._segment(0xDD, struct.pack(">H", interval)))
    return b"".join([*parts, J._segment(0xDA, scan), data, b"\xff\xd9"])


@pytest.mark.parametrize("sampling,width,height", [([(1, 1)], 20, 33), ([(2, 2), (1, 1), (1, 1)], 40, 35), ([(2, 1), (1, 1), (1, 1)], 17, 8), ([(1, 1), (1, 1), (1, 1)], 9, 9)])
@pytest.mark.parametrize("interval", [0, 1, 3])
def test_other_scans(sampling, width, height, interval):
    rng = np.random.default_rng(4)
    most_h, most_v = (1, 1) if len(sampling) == 1 else (max(h for h, _ in sampling), max(v for _, v in sampling))
    across, down = -(-width // (8 * most_h)), -(-height // (8 * most_v))
    per = 1 if len(sampling) == 1 else sum(h * v for h, v in sampling)
    blocks = rng.integers(-60, 60, (across * down * per, 64)) * (rng.random((across * down * per, 64)) < 0.15)
    blocks[:, 0] = rng.integers(-100, 100, len(blocks))
    media = plain_jpeg(width, height, sampling, blocks, interval, 5)
    data = media + media  # two images in a row
    buffer = np.frombuffer(data + b"\0", np.uint8)
    (images,) = J.parse_all(data, buffer, [0], [len(data)])
    for image, got in zip(images, J.coefficients(images, buffer), strict=True):
        assert (image.width, image.height) == (width, height)
        assert np.array_equal(got, blocks)
        thumb = J.thumbnail(image, got)
        own_h, own_v = sampling[0] if len(sampling) > 1 else (1, 1)
        assert thumb.shape == (-(-height * own_v // (8 * most_v)), -(-width * own_h // (8 * most_h)))
        assert thumb[0, 0] == np.clip(128 + np.round(blocks[0, 0] * 5 / 8), 0, 255)


def plain_hash(pixels):
    flat = [int(p) for p in pixels.ravel()]
    while len(flat) % 9:
        flat.append(flat[len(flat) % pixels.size])
    rows = [flat[k : k + 9] for k in range(0, len(flat), 9)]
    bits = ""
    for band in range(8):
        low = min(band * len(rows) // 8, len(rows) - 1)
        some = rows[low : max((band + 1) * len(rows) // 8, low + 1)]
        cells = [sum(c) / len(some) for c in zip(*some, strict=True)]
        bits += "".join("1" if cells[c] < cells[(c + 1 + band) % 9] else "0" for c in range(8))
    return f"{int(bits, 2):016x}"


@pytest.mark.parametrize("shape", [(3, 3), (6, 3), (27, 3), (2700, 3), (1, 1), (2, 2), (8, 9), (7, 11)])
def test_feature_against_plain_cells(shape):
    rng = np.random.default_rng(sum(shape))
    for _ in range(20):
        pixels = rng.integers(0, 256, shape).astype(np.uint8)
        assert J.difference_hash(pixels) == plain_hash(pixels)


def test_all_bits_of_the_feature_are_used():
    rng = random.Random(3)
    hashes = [int(J.difference_hash(J.read(J.encode([J.pad(rng.randbytes(576))]))[0][2]), 16) for _ in range(200)]
    assert all(0.2 < sum(h >> bit & 1 for h in hashes) / 200 < 0.8 for bit in range(64)) and len(set(hashes)) > 190


def test_long_payloads_go_image_by_image(monkeypatch):
    payload, short = J.pad(random.Random(5).randbytes(5 * J.MOST_UNITS * J.UNIT + 7)), J.pad(b"short")
    whole, small = J.encode([payload, short])
    monkeypatch.setattr(J, "AT_ONCE", 1 << 20)
    assert J.encode([payload]) == [whole]
    (a, b) = J.read([whole, small])
    assert a[0] == payload and len(a[1]) == 6 and b[0] == short


def test_what_is_not_baseline_is_an_error():
    (media,) = J.encode([J.pad(b"x")])
    with pytest.raises(ValueError, match="baseline"):
        J.read([media.replace(b"\xff\xc0", b"\xff\xc2", 1)])
    with pytest.raises(ValueError, match="start"):
        J.read([b"\x00" + media])


def test_query(spark):
    texts = [None, "", "a", "Grüße 日本 " * 50, "x" * 300_000, "dup", "dup"]
    docs = spark.createDataFrame([(None if i == 2 else i, t, "m") for i, t in enumerate(texts)], "doc_id long, text string, media string").repartition(2)
    got = {(r.doc_id, r.n_bytes): r for r in J.describe(J.store(docs)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        data = (t or "").encode()
        r, payload = got[None if i == 2 else i, len(data)], J.pad(data)
        (media,) = J.encode([payload])
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
    assert got[5, 3].feature == got[6, 3].feature and len(got[4, 300_000].feature) == 16
    assert J.describe(J.store(docs.limit(0))).collect() == []
