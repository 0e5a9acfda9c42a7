"""Media columns as baseline JPEG.

``encoded`` stores bytes losslessly in the DC terms of a greyscale baseline
JPEG: one byte is one 8x8 block (quantiser 8, all AC terms zero), 64 blocks are
a block row and a restart interval.  ``described`` reads any baseline JPEG
column back: it parses the markers, Huffman-decodes the scan, rebuilds the DC-only
luminance thumbnail (one pixel for each block) in numpy, and reports dimensions,
thumbnail hashes and the digests of the thumbnail's samples.

Decoding runs over all restart intervals of all images of a slice together: a
lane is an interval, and a step decodes one Huffman symbol in every lane.  Images
with few intervals are decoded symbol by symbol instead.

A JPEG is at most 65,535 samples high, so longer payloads become several JPEG
streams, one after the other, in the same cell.

Edge cases: null is the empty text, whose payload is 64 zero bytes; equal inputs
have equal outputs; an empty table gives no rows; other columns are ignored; a
null media cell gives null results; a stream that is not baseline JPEG raises.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrollspark.llm.bytesops import slices, tidied, utf8

BLOCKS = 64  # blocks in a row, and MCUs in a restart interval
MAX_ROWS = 65_535 // 8
SLICE = 1 << 20

# Fixed values of the JPEG standard (Annex K.3.1): luminance DC codes by number of lengths 1 to 16, and symbols.
DC_BITS = bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0])
DC_SYMBOLS = bytes(range(12))
# Only "end of block" is needed: one code of one bit.
AC_BITS = bytes([1] + [0] * 15)
AC_SYMBOLS = bytes([0])


def codes(bits: bytes, symbols: bytes) -> list[tuple[int, int, int]]:
    """(symbol, code, length) in canonical order."""
    out, code, at = [], 0, 0
    for length, count in enumerate(bits, 1):
        for _ in range(count):
            out.append((symbols[at], code, length))
            code, at = code + 1, at + 1
        code <<= 1
    return out


def lookup(bits: bytes, symbols: bytes) -> np.ndarray:
    """For each 16-bit look-ahead: length * 256 + symbol, 0 where no code fits."""
    table = np.zeros(1 << 16, np.uint16)
    for symbol, code, length in codes(bits, symbols):
        table[code << 16 - length : code + 1 << 16 - length] = length * 256 + symbol
    return table


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def header(rows: int) -> bytes:
    return b"".join((
        b"\xff\xd8",
        _segment(0xDB, b"\0" + bytes([8] * 64)),
        _segment(0xC0, struct.pack(">BHHBBBB", 8, rows * 8, BLOCKS * 8, 1, 1, 0x11, 0)),
        _segment(0xC4, b"\x00" + DC_BITS + DC_SYMBOLS),
        _segment(0xC4, b"\x10" + AC_BITS + AC_SYMBOLS),
        _segment(0xDD, struct.pack(">H", BLOCKS)),
        _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
    ))


HEADER = len(header(1))
_DC = {s: (c, n) for s, c, n in codes(DC_BITS, DC_SYMBOLS)}


def _block_codes() -> tuple[np.ndarray, np.ndarray]:
    """For each difference + 255: all bits of the block (DC code, difference, end of block), and how many."""
    value, length = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, n = _DC[size]
        extra = d if d >= 0 else d + (1 << size) - 1
        value[d + 255], length[d + 255] = (code << size | extra) << 1, n + size + 1
    return value, length


BLOCK_BITS, BLOCK_LENGTH = _block_codes()


def encode_rows(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded, stuffed bytes of all rows [n, BLOCKS], one after the other, and the length of each."""
    n = len(samples)
    levels = samples.astype(np.int16)
    diff = np.empty((BLOCKS, n), np.int16)  # by column: the rows are the lanes
    diff[0] = levels[:, 0] + (255 - 128)
    diff[1:] = (levels[:, 1:] - levels[:, :-1]).T + np.int16(255)
    bits = BLOCK_LENGTH[diff]
    total = bits.sum(axis=0)
    size = (total + 7) >> 3
    begin = np.cumsum(size) - size
    packed = np.zeros(int(size.sum()) + 3, np.uint8)
    at = begin << 3
    for j in range(BLOCKS):
        length = bits[j]
        shifted = BLOCK_BITS[diff[j]] << (24 - (at & 7) - length).astype(np.uint32)
        byte = at >> 3
        packed[byte] |= (shifted >> np.uint32(16)).astype(np.uint8)
        packed[byte + 1] |= (shifted >> np.uint32(8)).astype(np.uint8)
        packed[byte + 2] |= shifted.astype(np.uint8)
        at = at + length
    packed = packed[:-3]
    packed[begin + size - 1] |= ((1 << (size * 8 - total)) - 1).astype(np.uint8)
    full = np.flatnonzero(packed == 0xFF)
    stuffed = np.zeros(len(packed) + len(full), np.uint8)
    keep = np.ones(len(stuffed), bool)
    keep[full + np.arange(1, len(full) + 1)] = False
    stuffed[keep] = packed
    return stuffed, size + np.diff(np.searchsorted(full, np.append(begin, len(packed))))


def encode_payloads(payloads: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """payloads: all bytes, each payload a positive multiple of 64 long."""
    stuffed, size = encode_rows(payloads.reshape(-1, BLOCKS))
    data, ends = stuffed.tobytes(), np.append(0, np.cumsum(size)).tolist()
    out, row = [], 0
    for rows in (lengths // BLOCKS).tolist():
        parts: list[bytes] = []
        for first in range(row, row + rows, MAX_ROWS):
            here = min(MAX_ROWS, row + rows - first)
            parts.append(header(here))
            for i in range(here):
                parts.append(data[ends[first + i] : ends[first + i + 1]])
                parts.append(RESTARTS[i & 7])
            parts[-1] = b"\xff\xd9"
        out.append(b"".join(parts))
        row += rows
    return out


RESTARTS = [bytes([0xFF, 0xD0 + i]) for i in range(8)]


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row followed by zero bytes up to a positive multiple of 64."""
    length = np.diff(offsets)
    size = np.maximum(1, -(-length // BLOCKS)) * BLOCKS
    out = np.zeros(int(size.sum()), np.uint8)
    shift = (np.cumsum(size) - size) - offsets[:-1]
    out[np.arange(len(data)) + np.repeat(shift, length)] = data
    return out, size


def encoded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes (of the unpadded UTF-8), media (the JPEG streams)."""
    id_type = df.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, SLICE):
                part = offsets[a : b + 1]
                media = encode_payloads(*padded(data[part[0] : part[-1]], part - part[0]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(part)), pa.array(media, pa.binary())], [id_col, "n_bytes", "media"])

    return df.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(tidied(run), f"`{id_col}` {id_type}, n_bytes bigint, media binary")


@dataclass
class Frame:
    """One JPEG stream: where its scan stands and what is needed to decode it."""

    width: int = 0
    height: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, h, v, quantiser
    quantisers: dict[int, int] = field(default_factory=dict)  # of the DC term
    tables: dict[int, bytes] = field(default_factory=dict)  # by class * 16 + id
    restart: int = 0
    scan: list[tuple[int, int, int]] = field(default_factory=list)  # component's place, DC table, AC table
    begin: int = 0
    end: int = 0

    def grid(self) -> tuple[int, int, int, int]:
        """MCUs across and down; luminance blocks across and down in an MCU."""
        if len(self.scan) == 1 and self.components:
            hmax, vmax = max(c[1] for c in self.components), max(c[2] for c in self.components)
            _, h, v, _ = self.components[self.scan[0][0]]
            return -(-(-(-self.width * h // hmax)) // 8), -(-(-(-self.height * v // vmax)) // 8), 1, 1
        hmax, vmax = max(c[1] for c in self.components), max(c[2] for c in self.components)
        return -(-self.width // (8 * hmax)), -(-self.height // (8 * vmax)), self.components[0][1], self.components[0][2]


def parse(data: bytes, at: int = 0, scan_end: int | None = None) -> tuple[Frame, int]:
    """Reads one stream's markers up to the end of the luminance scan, and where the stream ends."""
    frame, start = Frame(), at
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError(f"no JPEG stream at {start}")
    at += 2
    while True:
        if at + 2 > len(data) or data[at] != 0xFF:
            raise ValueError(f"no marker at {at}")
        marker = data[at + 1]
        at += 2
        if marker == 0xFF:
            at -= 1
            continue
        if marker == 0xD9:
            if not frame.end:
                raise ValueError("a stream without a scan")
            return frame, at
        (size,) = struct.unpack_from(">H", data, at)
        body = data[at + 2 : at + size]
        at += size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                frame.quantisers[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                frame.tables[body[0]] = body[1 : 17 + n]
                body = body[17 + n :]
        elif marker == 0xC0 or marker == 0xC1:
            precision, frame.height, frame.width, n = struct.unpack_from(">BHHB", body)
            if precision != 8:
                raise ValueError("only 8-bit samples")
            frame.components = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif 0xC2 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            raise ValueError(f"not baseline: marker {marker:#x}")
        elif marker == 0xDD:
            (frame.restart,) = struct.unpack(">H", body)
        elif marker == 0xDA:
            ids = [c[0] for c in frame.components]
            scan = [(ids.index(body[1 + 2 * i]), body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
            begin = at
            while True:
                at = data.find(b"\xff", at)
                if at < 0 or at + 1 >= len(data):
                    raise ValueError("the scan does not end")
                if data[at + 1] == 0 or 0xD0 <= data[at + 1] <= 0xD7:
                    at += 2
                    continue
                break
            if scan[0][0] == 0:
                frame.scan, frame.begin, frame.end = scan, begin, at


def _lane_starts(scan: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The scan without stuffing and restart markers, and where its intervals start."""
    full = np.flatnonzero(scan[:-1] == 0xFF)
    after = scan[full + 1]
    marks = full[(after >= 0xD0) & (after <= 0xD7)]
    keep = np.ones(len(scan), bool)
    keep[full[after == 0] + 1] = False
    keep[marks] = keep[marks + 1] = False
    gone = np.flatnonzero(~keep)
    starts = np.append(0, marks + 2)
    return scan[keep], starts - np.searchsorted(gone, starts)


def _tables(frame: Frame) -> dict[int, np.ndarray]:
    return {k: lookup(v[:16], v[16:]) for k, v in frame.tables.items()}


def _decode_lanes(data: np.ndarray, starts: np.ndarray, mcus: np.ndarray, blocks: list[tuple[int, int, int]], tables: dict[int, np.ndarray], per_mcu: int) -> np.ndarray:
    """DC levels of luminance [MCU in lane, block in MCU, lane]; mcus must not increase along the lanes."""
    window = np.ndarray((len(data) - 7,), ">u8", buffer=data, strides=(1,))
    at = starts << 3
    lanes = len(starts)
    out = np.zeros((int(mcus[0]) if lanes else 0, per_mcu, lanes), np.int32)
    predicted = np.zeros((1 + max(b[0] for b in blocks), lanes), np.int32)
    u, live = np.uint64, lanes

    def peek(p: np.ndarray) -> np.ndarray:
        return window[p >> 3].astype(u) << (p & 7).astype(u)

    for mcu in range(len(out)):
        live = int(np.searchsorted(-mcus, -mcu, "left"))
        pos, seen = at[:live], 0
        for component, dc, ac in blocks:
            bits = peek(pos)
            entry = tables[dc][(bits >> u(48)).astype(np.int64)]
            length, size = (entry >> 8).astype(np.int64), (entry & 255).astype(np.int64)
            if not length.all():
                raise ValueError("a code that no table has")
            extra = ((bits << length.astype(u)) >> u(1) >> (63 - size).astype(u)).astype(np.int32)
            half = (1 << size >> 1).astype(np.int32)
            predicted[component, :live] += np.where(extra < half, extra - 2 * half + 1, extra)
            pos = pos + length + size
            if component == 0:
                out[mcu, seen, :live] = predicted[0, :live]
                seen += 1
            todo, k = None, None  # lanes that have AC symbols left; first all of them
            while todo is None or len(todo):
                p = pos if todo is None else pos[todo]
                entry = tables[16 + ac][(peek(p) >> u(48)).astype(np.int64)]
                length, symbol = (entry >> 8).astype(np.int64), (entry & 255).astype(np.int64)
                if not length.all():
                    raise ValueError("a code that no table has")
                p = p + length + (symbol & 15)
                if todo is None:
                    pos = p
                    if not symbol.any():
                        break
                    todo, k = np.arange(live), np.ones(live, np.int64)
                else:
                    pos[todo] = p
                k = k + (symbol >> 4) + 1
                more = (k < 64) & ((symbol & 15 != 0) | (symbol == 0xF0))
                todo, k = todo[more], k[more]
        at[:live] = pos
    return out


def _decode_alone(data: bytes, mcus: int, blocks: list[tuple[int, int, int]], tables: dict[int, np.ndarray]) -> list[int]:
    """One interval, symbol by symbol: DC levels of luminance in scan order."""
    at, out, predicted = 0, [], [0] * (1 + max(b[0] for b in blocks))
    look = {k: v.tolist() for k, v in tables.items()}

    def bits(n: int) -> int:
        return int.from_bytes(data[at >> 3 : (at >> 3) + 5], "big") >> 40 - (at & 7) - n & (1 << n) - 1

    for _ in range(mcus):
        for component, dc, ac in blocks:
            entry = look[dc][bits(16)]
            if not entry:
                raise ValueError("a code that no table has")
            at += entry >> 8
            size = entry & 255
            if size:
                extra = bits(size)
                at += size
                predicted[component] += extra if extra >> size - 1 else extra - (1 << size) + 1
            if component == 0:
                out.append(predicted[0])
            k = 1
            while k < 64:
                entry = look[16 + ac][bits(16)]
                if not entry:
                    raise ValueError("a code that no table has")
                at += (entry >> 8) + (entry & 15)
                if entry & 15 == 0 and entry & 255 != 0xF0:
                    break
                k += (entry >> 4 & 15) + 1
    return out


def thumbnails(media: list[bytes]) -> list[list[tuple[int, int, np.ndarray]]]:
    """For each cell, for each of its JPEG streams: width, height and the DC-only luminance thumbnail."""
    out: list[list] = [[] for _ in media]
    alike: dict[tuple, list[tuple[int, int, Frame, np.ndarray]]] = {}
    for i, cell in enumerate(media):
        at = 0
        while at < len(cell):
            frame, at = parse(cell, at)
            key = (tuple(frame.components), tuple(frame.scan), tuple(sorted(frame.tables.items())))
            alike.setdefault(key, []).append((i, len(out[i]), frame, np.frombuffer(cell, np.uint8, frame.end - frame.begin, frame.begin)))
            out[i].append(None)
    for frames in alike.values():
        first = frames[0][2]
        tables = _tables(first)
        blocks = [b for b in first.scan for _ in range(first.components[b[0]][1] * first.components[b[0]][2] if len(first.scan) > 1 else 1)]
        per_mcu = sum(b[0] == 0 for b in blocks)
        starts, mcus, bodies, base = [], [], [], 0
        for _, _, frame, scan in frames:
            body, begin = _lane_starts(scan)
            across, down, _, _ = frame.grid()
            step = frame.restart or across * down
            starts.append(begin + base)
            left = np.full(len(begin), step, np.int64)
            left[-1] = across * down - step * (len(begin) - 1)
            mcus.append(left)
            bodies.append(body)
            base += len(body)
        counts = [len(x) for x in starts]
        begin, left = np.concatenate(starts), np.concatenate(mcus)
        data = np.concatenate([*bodies, np.full(8, 0xFF, np.uint8)])
        if len(begin) >= 16:
            order = np.argsort(-left, kind="stable")
            levels = _decode_lanes(data, begin[order], left[order], blocks, tables, per_mcu)
            back = np.empty_like(order)
            back[order] = np.arange(len(order))
            by_lane = levels.reshape(-1, len(order)).T[back]  # [lane, MCU x block]
        else:
            raw, ends = data.tobytes(), [*begin[1:].tolist(), len(data)]
            rows = [_decode_alone(raw[a:b] + b"\xff" * 8, n, blocks, tables) for a, b, n in zip(begin.tolist(), ends, left.tolist(), strict=True)]
            by_lane = np.zeros((len(rows), max(map(len, rows))), np.int32)
            for lane, row in enumerate(rows):
                by_lane[lane, : len(row)] = row
        lane = 0
        for (i, k, frame, _), n in zip(frames, counts, strict=True):
            across, down, h, v = frame.grid()
            dc = by_lane[lane : lane + n]
            full = dc.reshape(-1)[: across * down * per_mcu] if n == 1 or int(left[lane]) * per_mcu == dc.shape[1] else np.concatenate([dc[r, : left[lane + r] * per_mcu] for r in range(n)])
            image = full.reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
            q = frame.quantisers[frame.components[0][3]]
            pixels = np.clip((image * q + 4 >> 3) + 128, 0, 255).astype(np.uint8)
            hmax, vmax = max(c[1] for c in frame.components), max(c[2] for c in frame.components)
            high, wide = -(-(-(-frame.height * frame.components[0][2] // vmax)) // 8), -(-(-(-frame.width * frame.components[0][1] // hmax)) // 8)
            out[i][k] = (frame.width, frame.height, pixels[:high, :wide])
            lane += n
    return out


def difference_hash(pixels: np.ndarray) -> int:
    """64 bits: is each cell of an 8 x 9 grid of means darker than its right neighbour?"""
    y = np.arange(9) * len(pixels) // 8
    x = np.arange(10) * pixels.shape[1] // 9
    sums = np.zeros((len(pixels) + 1, pixels.shape[1] + 1), np.int64)
    np.cumsum(np.cumsum(pixels, axis=0, dtype=np.int64), axis=1, out=sums[1:, 1:])
    top, bottom = y[:-1], np.maximum(y[1:], y[:-1] + 1).clip(max=len(pixels))
    top = np.minimum(top, bottom - 1)
    left, right = x[:-1], np.maximum(x[1:], x[:-1] + 1).clip(max=pixels.shape[1])
    left = np.minimum(left, right - 1)
    area = (bottom - top)[:, None] * (right - left)[None, :]
    mean = (sums[np.ix_(bottom, right)] - sums[np.ix_(top, right)] - sums[np.ix_(bottom, left)] + sums[np.ix_(top, left)]) / area
    return int.from_bytes(np.packbits(mean[:, :-1] < mean[:, 1:]).tobytes(), "big")


DESCRIPTION = pa.schema([
    ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("streams", pa.int32()), ("feature", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
])


def describe(cell: bytes, images: list[tuple[int, int, np.ndarray]]) -> tuple:
    payload = b"".join(x.tobytes() for _, _, x in images)
    feature = ";".join(f"{w}x{h}:{difference_hash(x):016x}" for w, h, x in images)
    return (
        len(cell), hashlib.sha256(cell).hexdigest(), images[0][0] if images else None, images[0][1] if images else None, len(images), feature,
        len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]),
    )


def described(df: DataFrame, id_col: str = "doc_id", media_col: str = "media", *, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns to keep, and what the stored bytes say: see DESCRIPTION."""
    kept = [id_col, *keep]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(kept))
            _, offsets = utf8(column)
            for a, b in slices(offsets, SLICE):
                cells = [x.as_py() for x in column.slice(a, b - a)]
                images = iter(thumbnails([x for x in cells if x is not None]))
                rows = [None if x is None else describe(x, next(images)) for x in cells]
                body = [pa.array([None if r is None else r[k] for r in rows], f.type) for k, f in enumerate(DESCRIPTION)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in range(len(kept))), *body], [*kept, *DESCRIPTION.names])

    return df.select(*kept, media_col).mapInArrow(tidied(run), types + ", media_bytes bigint, media_sha256 string, width int, height int, streams int, feature string, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint")
