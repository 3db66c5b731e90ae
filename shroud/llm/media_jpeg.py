"""Media columns of baseline JPEG: lossless storage of bytes, and DC-only thumbnails.

A payload is stored in the units that baseline JPEG keeps without loss, quantised coefficients: each
byte is a coefficient other than 0, a block holds 64, and UNIT bytes fill three rows of three blocks.
Images are grey, three blocks wide, with a restart marker after every block; a payload too high for one
image goes on in the next. The reader parses markers and decodes the Huffman codes of any baseline
scan: restart intervals, of all images of a batch, are decoded side by side in numpy, one symbol
of each at a step. Luminance thumbnails come from the DC coefficients alone.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shroud.llm.common import table, text_slices

UNIT, BLOCK, ACROSS = 576, 64, 3
#: Units of the highest image: a JPEG has at most 65535 lines.
MOST_UNITS = 65535 // (8 * UNIT // BLOCK // ACROSS)
#: Bytes that are encoded or decoded side by side: a longer payload goes image by image.
AT_ONCE = 4 << 20
#: Sizes of coefficients by falling use in text, and their code lengths; the code of ones alone stays free.
_SIZES, _LENGTHS = (5, 4, 7, 6, 3, 8, 1, 2), (1, 2, 3, 4, 5, 6, 8, 8)


def canonical(counts: list[int], symbols: list[int]) -> dict[int, tuple[int, int]]:
    """symbol: (code, length) of a table given as numbers of codes by length and symbols in order."""
    out, code, at = {}, 0, 0
    for length, many in enumerate(counts, 1):
        for symbol in symbols[at : at + many]:
            out[symbol] = (code, length)
            code += 1
        at += many
        code <<= 1
    return out


_COUNTS = [_LENGTHS.count(n) for n in range(1, 17)]
_TABLE = canonical(_COUNTS, list(_SIZES))


def _byte_codes() -> tuple[np.ndarray, np.ndarray]:
    codes, lengths = np.zeros(256, np.uint32), np.zeros(256, np.int64)
    for byte in range(256):
        value = byte - 128 if byte < 128 else byte - 127
        size = abs(value).bit_length()
        code, length = _TABLE[size]
        codes[byte] = code << size | (value if value > 0 else value + (1 << size) - 1)
        lengths[byte] = length + size
    return codes, lengths


_CODES, _BITS = _byte_codes()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _header(units: int) -> bytes:
    tables = bytes(_COUNTS) + bytes(_SIZES)
    height = 8 * units * UNIT // BLOCK // ACROSS
    return b"".join(
        [
            b"\xff\xd8",
            _segment(0xDB, bytes([0]) + bytes([1]) * 64),
            _segment(0xC0, struct.pack(">BHHB", 8, height, 8 * ACROSS, 1) + bytes([1, 0x11, 0])),
            _segment(0xC4, bytes([0x00]) + tables + bytes([0x10]) + tables),
            _segment(0xDD, struct.pack(">H", 1)),
            _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
        ]
    )


def pad(data: bytes) -> bytes:
    """The payload: data and bytes 255 up to a positive multiple of UNIT."""
    return data + b"\xff" * (-len(data) % UNIT if data else UNIT)


def encode(payloads: list[bytes]) -> list[bytes]:
    """The stored form of each payload: one JPEG, or several in a row. A very long payload is encoded image by image."""
    step = MOST_UNITS * UNIT  # one image
    if len(payloads) == 1 and len(payloads[0]) > max(AT_ONCE, step):
        return [b"".join(encode([payloads[0][at : at + step]])[0] for at in range(0, len(payloads[0]), step))]
    units = []  # of each image
    images = []  # of each payload
    for p in payloads:
        n = len(p) // UNIT
        parts = [min(MOST_UNITS, n - at) for at in range(0, n, MOST_UNITS)]
        images.append(len(parts))
        units += parts
    data = np.frombuffer(b"".join(payloads), np.uint8)
    blocks = np.array(units) * (UNIT // BLOCK)
    bits = _BITS[data].reshape(-1, BLOCK)
    ends = np.cumsum(bits, axis=1)
    whole = (ends[:, -1] + 7) // 8
    first = np.cumsum(whole) - whole
    start = (8 * first[:, None] + ends - bits).ravel()
    value = _CODES[data] << (24 - bits.ravel() - (start & 7)).astype(np.uint32)
    at, total = start >> 3, int(whole.sum())
    raw = sum(np.bincount(at + k, value >> np.uint32(16 - 8 * k) & np.uint32(255), total + 2)[:total] for k in range(3)).astype(np.uint8)
    raw[first + whole - 1] |= ((1 << (8 * whole - ends[:, -1])) - 1).astype(np.uint8)

    headers = [_header(n) for n in units]
    block_image = np.repeat(np.arange(len(units)), blocks)
    place = np.arange(len(block_image)) - np.repeat(np.cumsum(blocks) - blocks, blocks)  # of a block in its image
    inner = place < blocks[block_image] - 1
    head, stuffed = np.array([len(h) for h in headers]), raw == 255
    before = np.cumsum(head) + 2 * np.arange(len(units))  # headers and ends so far
    block_shift = before[block_image] + 2 * (np.cumsum(inner) - inner)
    to = np.arange(total) + np.cumsum(stuffed) - stuffed + np.repeat(block_shift, whole)
    out = np.zeros(total + int(stuffed.sum() + 2 * inner.sum() + head.sum()) + 2 * len(units), np.uint8)
    out[to] = raw
    last = first + whole - 1
    after = to[last] + 1 + stuffed[last]  # behind each block
    out[after], out[after + 1] = 0xFF, np.where(inner, 0xD0 + place % 8, 0xD9)
    stops = after[~inner] + 2
    for h, stop in zip(headers, np.concatenate([[0], stops[:-1]]), strict=True):
        out[stop : stop + len(h)] = np.frombuffer(h, np.uint8)
    bounds = [0, *stops[np.cumsum(images) - 1].tolist()]
    return [out[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]


@dataclass
class Image:
    """One image's frame and scan: components are (id, h, v, quantiser of DC, DC table, AC table)."""

    width: int
    height: int
    components: list[tuple[int, int, int, int, bytes, bytes]]
    interval: int
    scan: int  # where the coded data start
    end: int = 0  # where they end

    @property
    def most(self) -> tuple[int, int]:
        return max(c[1] for c in self.components), max(c[2] for c in self.components)

    @property
    def mcus(self) -> tuple[int, int]:
        """MCUs across and down; blocks themselves if there is one component."""
        h, v = (1, 1) if len(self.components) == 1 else self.most
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))

    @property
    def pattern(self) -> list[int]:
        """Component of each block of an MCU."""
        if len(self.components) == 1:
            return [0]
        return [k for k, c in enumerate(self.components) for _ in range(c[1] * c[2])]


def parse(data: bytes, at: int, ends: np.ndarray) -> Image:
    """The image whose markers start at a position; ``ends`` are the positions of markers that end scans."""
    quantisers: dict[int, int] = {}
    tables: dict[int, bytes] = {}
    frame, interval = None, 0
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no start of image")
    at += 2
    while True:
        while data[at] == 0xFF and data[at + 1] == 0xFF:
            at += 1
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        if data[at] != 0xFF:
            raise ValueError("no marker")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quantisers[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                many = sum(body[1:17])
                tables[body[0]] = body[1 : 17 + many]
                body = body[17 + many :]
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xC0:
            bits, height, width, n = struct.unpack(">BHHB", body[:6])
            if bits != 8:
                raise ValueError("samples of other than 8 bits")
            frame = (width, height, [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)])
        elif 0xC1 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            raise ValueError("not baseline")
        elif marker == 0xDA:
            chosen = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
            if frame is None or len(chosen) != len(frame[2]):
                raise ValueError("scans of some components only aren't read")
            parts = [(c, h, v, quantisers[q], tables[chosen[c] >> 4], tables[0x10 | chosen[c] & 15]) for c, h, v, q in frame[2]]
            return Image(frame[0], frame[1], parts, interval, at, int(ends[np.searchsorted(ends, at)]))


def parse_all(data: bytes, buffer: np.ndarray, starts: list[int], stops: list[int]) -> list[list[Image]]:
    """The images between each start and stop."""
    mark = np.flatnonzero(buffer[:-1] == 255)
    code = buffer[mark + 1]
    ends = mark[(code != 0) & (code != 255) & ((code < 0xD0) | (code > 0xD7))]
    out = []
    for at, stop in zip(starts, stops, strict=True):
        found = []
        while at < stop:
            image = parse(data, at, ends)
            if data[image.end + 1] != 0xD9:
                raise ValueError("more than one scan")
            found.append(image)
            at = image.end + 2
        out.append(found)
    return out


_tables: dict[bytes, np.ndarray] = {}


def _lookup(spec: bytes) -> np.ndarray:
    """Of every 16 bits to come: length of the code * 256 + symbol; 0 where no code is."""
    if spec not in _tables:
        found = np.zeros(1 << 16, np.uint16)
        for symbol, (code, length) in canonical(list(spec[:16]), list(spec[16:])).items():
            found[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
        _tables[spec] = found
    return _tables[spec]


def coefficients(images: list[Image], buffer: np.ndarray) -> list[np.ndarray]:
    """Quantised coefficients (blocks x 64, in scan order) of every image, all restart intervals side by side."""
    specs = sorted({t for image in images for c in image.components for t in c[4:]})
    table = np.concatenate([_lookup(s) for s in specs])
    longest = max(len(image.pattern) for image in images)
    inside = np.zeros(len(buffer) + 1, np.int8)
    np.add.at(inside, [image.scan for image in images], 1)
    np.add.at(inside, [image.end for image in images], -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    mark = np.flatnonzero((buffer[:-1] == 255) & inside[:-1])
    code = buffer[mark + 1]
    restarts = mark[(code >= 0xD0) & (code <= 0xD7)]
    keep = inside.copy()
    keep[mark[code == 0] + 1] = False
    keep[restarts] = keep[restarts + 1] = False
    moved = np.cumsum(keep) - keep
    raw = np.concatenate([buffer[keep], np.full(8, 255, np.uint8)]).astype(np.uint64)
    window = np.zeros(len(raw) - 5, np.uint64)
    for k in range(5):
        window = window << np.uint64(8) | raw[k : k + len(window)]

    begin, blocks, of, pieces = [], [], [], []
    total = 0
    for number, image in enumerate(images):
        across, down = image.mcus
        n = across * down
        per = image.interval or n
        many = -(-n // per)
        low = np.searchsorted(restarts, image.scan)
        inner = restarts[low : np.searchsorted(restarts, image.end)]
        if len(inner) != many - 1:
            raise ValueError("restart markers don't fit the image")
        begin.append(np.concatenate([moved[[image.scan]], moved[np.minimum(inner + 2, len(moved) - 1)]]))
        size = np.full(many, per * len(image.pattern))
        size[-1] = (n - per * (many - 1)) * len(image.pattern)
        blocks.append(size)
        of.append(np.full(many, number))
        pieces.append((total, total + int(size.sum())))
        total = pieces[-1][1]
    begin, blocks, of = (np.concatenate(x) for x in (begin, blocks, of))
    first = np.cumsum(blocks) - blocks
    which = np.zeros((len(images), longest, 2), np.int64)  # tables of each block of an MCU
    part = np.zeros((len(images), longest), np.int64)
    length = np.array([len(image.pattern) for image in images])
    for number, image in enumerate(images):
        for k, c in enumerate(image.pattern):
            which[number, k] = [specs.index(t) << 16 for t in image.components[c][4:]]
            part[number, k] = c
    out = np.zeros(total * BLOCK, np.int16)
    lane = np.arange(len(begin))
    bit, block, k = begin * 8, np.zeros(len(lane), np.int64), np.zeros(len(lane), np.int64)
    last = np.zeros((len(lane), int(part.max()) + 1), np.int64)  # DC of each component
    simple = longest == 1 and int(part.max()) == 0
    of_lane, end_lane = of, blocks
    while len(lane):
        ahead = window[bit >> 3] >> (np.uint64(8) - (bit & 7).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
        slot = 0 if simple else block % length[of_lane]
        base = which[of_lane, slot, np.minimum(k, 1)]
        hit = table[base + (ahead >> np.uint64(16)).astype(np.int64)].astype(np.int64)
        used, run, size = hit >> 8, hit >> 4 & 15, hit & 15
        if not used.all():
            raise ValueError("no such Huffman code")
        dc = k == 0
        extra = ((ahead << used.astype(np.uint64) & np.uint64(0xFFFFFFFF)) >> (32 - size).astype(np.uint64)).astype(np.int64)
        value = np.where(extra < (1 << size >> 1), extra - (1 << size) + 1, extra)
        k = np.where(dc, 0, k + run)
        if dc.any():
            c = 0 if simple else part[of_lane, slot]
            total_dc = last[lane, c] + value
            value = np.where(dc, total_dc, value)
            last[lane, c] = np.where(dc, total_dc, last[lane, c])
        stored = dc | (size > 0)
        if stored.all():
            out[(first[lane] + block) * BLOCK + k] = value
        else:
            out[((first[lane] + block) * BLOCK + k)[stored]] = value[stored]
        bit = bit + used + size
        k = np.where(~dc & (size == 0) & (run == 0), BLOCK, k + 1)
        done = k >= BLOCK
        if done.any():
            block, k = block + done, np.where(done, 0, k)
            left = block < end_lane
            if not left.all():
                lane, bit, block, k = lane[left], bit[left], block[left], k[left]
                of_lane, end_lane = of[lane], blocks[lane]
    out = out.reshape(-1, BLOCK)
    return [out[a:b] for a, b in pieces]


def _decoded(images: list[Image], buffer: np.ndarray) -> list[np.ndarray]:
    """``coefficients`` of images that stand in order, a few at a time, so that long texts take no more memory than their own size."""
    out, first = [], 0
    while first < len(images):
        last = first + 1
        while last < len(images) and images[last].end - images[first].scan <= AT_ONCE:
            last += 1
        low, high = images[first].scan, images[last - 1].end + 2
        moved = [replace(i, scan=i.scan - low, end=i.end - low) for i in images[first:last]]
        out += coefficients(moved, buffer[low:high])
        first = last
    return out


def thumbnail(image: Image, blocks: np.ndarray) -> np.ndarray:
    """Luminance of the first component, one pixel for each of its blocks, from DC coefficients alone."""
    across, down = image.mcus
    _, h, v, quantiser, *_ = image.components[0]
    if len(image.components) == 1:
        h = v = 1
    own = [k for k, c in enumerate(image.pattern) if c == 0]
    dc = blocks[:, 0].reshape(down, across, len(image.pattern))[:, :, own].reshape(down, across, v, h)
    grid = dc.transpose(0, 2, 1, 3).reshape(down * v, across * h).astype(np.int64)
    most_h, most_v = (1, 1) if len(image.components) == 1 else image.most
    grid = grid[: -(-image.height * v // (8 * most_v)), : -(-image.width * h // (8 * most_h))]
    return np.clip(128 + np.round(grid * quantiser / 8), 0, 255).astype(np.uint8)


def difference_hash(pixels: np.ndarray) -> str:
    """64 bits as hex: the thumbnail's pixels in scan order, folded into 8 bands of 9 cells; in band r, is a cell darker than the one r + 1 to its right, around the end.

    Fewer than 9 pixels are repeated, and fewer rows of 9 than bands share their rows among the bands,
    so each bit compares two cells that hold different pixels wherever there are 9.
    """
    flat = np.resize(pixels.ravel().astype(np.int64), -(-max(pixels.size, 1) // 9) * 9).reshape(-1, 9)
    bounds = np.arange(9) * len(flat) // 8
    low = np.minimum(bounds[:-1], len(flat) - 1)
    high = np.maximum(bounds[1:], low + 1)
    sums = np.concatenate([np.zeros((1, 9), np.int64), flat.cumsum(axis=0)])
    cells = (sums[high] - sums[low]) / (high - low)[:, None]
    column = np.arange(8)
    other = (column[None, :] + 1 + column[:, None]) % 9
    return np.packbits(cells[:, :8] < np.take_along_axis(cells, other, axis=1)).tobytes().hex()


def read(media: list[bytes]) -> list[tuple[bytes, list[Image], np.ndarray]]:
    """(payload, images, thumbnail over all of its images) of each stored form; AT_ONCE bytes of scans are decoded side by side."""
    data = b"".join(media)
    buffer = np.frombuffer(data + b"\0", np.uint8)
    stops = np.cumsum([len(m) for m in media]).tolist()
    found = parse_all(data, buffer, [0, *stops[:-1]], stops)
    blocks, at, out = _decoded([i for images in found for i in images], buffer), 0, []
    for images in found:
        own = blocks[at : at + len(images)]
        at += len(images)
        values = np.concatenate([b.ravel() for b in own])
        payload = (values + np.where(values < 0, 128, 127)).astype(np.uint8).tobytes()
        out.append((payload, images, np.concatenate([thumbnail(i, b) for i, b in zip(images, own, strict=True)])))
    return out


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes and the ``media`` column of every row; a null text is stored as the empty one.

    Repeated rows and null ids come back as they are, and equal texts get equal forms; a very long text
    is stored as images in a row. Other columns aren't read, so their names may clash; an empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "data"):
                payloads = [pad(p or b"") for p in part.column("data").to_pylist()]
                sizes = [len(p or b"") for p in part.column("data").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(sizes, pa.int64()), pa.array(encode(payloads), pa.binary())], names=[id_col, "n_bytes", "media"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.selectExpr(f"`{id_col}`", f"CAST(`{text_col}` AS BINARY) AS data").mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, media binary")


def describe(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of stored media, from the stored bytes alone: sizes and hashes of payload and stored form, ``feature``, dimensions.

    ``feature`` is the difference hash of the thumbnail; width and height are those of all images
    below each other. Repeated rows and null ids come back as they are. Equal texts give equal values.
    An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "media"):
                media = part.column("media").to_pylist()
                rows = []
                for stored_form, (payload, images, pixels) in zip(media, read(media), strict=True):
                    size = (images[0].width, sum(i.height for i in images))
                    rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored_form), hashlib.sha256(stored_form).hexdigest(), difference_hash(pixels), *size))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column(id_col), part.column("n_bytes"), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names=names)

    names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height"]
    kind = stored.schema[id_col].dataType.simpleString()
    return stored.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width long, height long")


def query() -> Callable:
    """The registered query over the whole table of documents."""
    return lambda spark, sf_dir: describe(store(table(spark, sf_dir, "documents")))
