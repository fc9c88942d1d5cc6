"""Media columns: GIF files in binary columns, written and read without an imaging library.

Reading parses the block structure, decodes the LZW code streams, applies global and local palettes, interlacing,
transparency and the disposal rules, and gives timed frames with a colour histogram. Writing stores a payload as 8-bit
samples of frames of 64 columns with a grey palette and real LZW compression.

Code widths depend only on a code's place after the last clear code, so a stream is cut into codes by array
operations, segment by segment; the string table then needs one step for each code, not for each pixel.

Defined results: null texts count as empty (64 zero bytes); texts are stored whole, in frames of at most 256 KiB;
bytes that are no GIF, or a broken one (a code that can't stand, a code size outside 2 to 8, fewer pixels than the frame
has, a cut block, a canvas over ``MOST_PIXELS``), raise ValueError in ``read_gif`` and give null frames in ``gif_frames``; a frame reaching over the
canvas is drawn as far as it lies on it; repeated rows repeat; an empty table gives an empty table; ``text_gifs`` reads
only its two columns; ``gif_frames`` passes other columns through, but for one named like ``frames_col``, which gives
way to the result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, map_texts, table

COLUMNS, ROWS = 64, 4096
#: Pixels of a canvas that is read at most: a broken header must not ask for gigabytes.
MOST_PIXELS = 1 << 26
_K = np.arange(1 << 16)
WIDTHS = {m: np.minimum(12, np.floor(np.log2((1 << m) + 2 + np.maximum(_K - 1, 0))).astype(np.int64) + 1) for m in range(2, 9)}
_SINGLE = [bytes([i]) for i in range(256)]


def lzw_codes(data: bytes) -> list[int]:
    """The codes of data in 8-bit GIF LZW, with clear codes (256) at the start and when the table is full, and 257 last."""
    out, table, n = [256], {}, 258
    add, get = out.append, table.get
    cur = data[0]
    for b in memoryview(data)[1:]:
        key = cur << 8 | b
        code = get(key)
        if code is not None:
            cur = code
            continue
        add(cur)
        cur = b
        table[key] = n
        n += 1
        if n == 4096:
            add(256)
            table.clear()
            n = 258
    out += [cur, 257]
    return out


def pack(codes: list[int]) -> bytes:
    c = np.array(codes, np.int64)
    starts = np.flatnonzero(c == 256)
    k = np.arange(len(c)) - 1
    k -= np.repeat(np.concatenate([[0], starts[1:]]), np.diff(np.concatenate([[0], starts[1:] + 1, [len(c)]])))
    # a clear code is the last of its segment: it has the width of that place
    widths = np.where(np.arange(len(c)) == 0, 9, WIDTHS[8][np.maximum(k, 0)])
    ends = np.cumsum(widths)
    at = ends - widths
    v, byte = c << (at & 7), at >> 3
    size = int(ends[-1] + 7) >> 3
    buf = sum(np.bincount(byte + j, weights=(v >> (8 * j)) & 255, minlength=size + 3) for j in range(3))
    return buf[:size].astype(np.uint8).tobytes()


def lzw_decode(data: bytes, min_size: int, n_pixels: int) -> bytes:
    """Decode a GIF LZW stream; raises ValueError on a code that can't stand."""
    if min_size not in WIDTHS:
        raise ValueError(f"LZW code size {min_size}")
    raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.int64)
    clear, end, bits = 1 << min_size, (1 << min_size) + 1, len(data) * 8
    out, got, at = [], 0, 0
    first = [bytes([i]) for i in range(clear)] + [b"", b""]
    while got < n_pixels and at + min_size + 1 <= bits:
        table, prev, k0, cleared = first.copy(), None, 0, False
        append, emit = table.append, out.append
        while not cleared and got < n_pixels and at + min_size + 1 <= bits:
            w = WIDTHS[min_size][np.minimum(np.arange(k0, k0 + min(4096, (bits - at) // (min_size + 1) + 1)), len(_K) - 1)]
            pos = np.cumsum(np.concatenate([[at], w]))
            n = int(np.searchsorted(pos[1:], bits, side="right"))
            if not n:
                return b"".join(out)[:n_pixels]
            p, b = pos[:n], pos[:n] >> 3
            codes = ((raw[b] | raw[b + 1] << 8 | raw[b + 2] << 16) >> (p & 7)) & ((1 << w[:n]) - 1)
            stop = np.flatnonzero((codes == clear) | (codes == end))
            m = int(stop[0]) if len(stop) else n
            size = len(table)
            todo = codes[:m].tolist()
            if prev is None and todo:
                if todo[0] >= len(table):
                    raise ValueError("LZW code out of range")
                prev = table[todo.pop(0)]
                out.append(prev)
                got += len(prev)
            free, was = 4096 - len(table), len(out)
            for c in todo[:free]:  # each adds a string
                try:
                    e = table[c]
                except IndexError:
                    if c > len(table):
                        raise ValueError("LZW code out of range") from None
                    e = prev + prev[:1]
                append(prev + e[:1])
                emit(e)
                prev = e
            for c in todo[free:]:
                emit(prev := table[c])
            got += sum(map(len, out[was:]))
            if len(stop):
                at, cleared = int(pos[m + 1]), True
                if codes[m] == end:
                    return b"".join(out)[:n_pixels]
            else:
                at, k0 = int(pos[n]), k0 + n
    return b"".join(out)[:n_pixels]


def write_gif(payload: bytes, delay: int = 10) -> bytes:
    """A GIF whose pixels are payload's bytes (a positive multiple of 64), in frames of up to 4096 rows."""
    rows = len(payload) // COLUMNS
    out = [b"GIF89a", struct.pack("<HHBBB", COLUMNS, min(rows, ROWS), 0xF7, 0, 0), bytes(i for g in range(256) for i in (g, g, g))]
    for top in range(0, rows, ROWS):
        part = payload[top * COLUMNS : (top + ROWS) * COLUMNS]
        stream = pack(lzw_codes(part))
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay, 0), b"\0,", struct.pack("<HHHHB", 0, 0, COLUMNS, len(part) // COLUMNS, 0), b"\x08"]
        for i in range(0, len(stream), 255):
            s = stream[i : i + 255]
            out += [_SINGLE[len(s)], s]
        out.append(b"\0")
    return b"".join([*out, b";"])


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    got = []
    while (n := data[at]) != 0:
        got.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(got), at + 1


def histogram(rgb: np.ndarray) -> np.ndarray:
    """Pixels in each of 64 cells: two bits of red, green and blue."""
    q = rgb.reshape(-1, 3) >> 6
    return np.bincount(q[:, 0].astype(np.int64) << 4 | q[:, 1] << 2 | q[:, 2], minlength=64)


def read_gif(data: bytes) -> list[dict]:
    """The frames of a GIF: start_ms, delay_ms, disposal, the patch's place and palette indices, the whole canvas after
    the frame (RGBA) and the histogram of the patch's place on it."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    try:
        return _frames(data)
    except (IndexError, struct.error) as e:
        raise ValueError(f"broken GIF: {e}") from e


def _frames(data: bytes) -> list[dict]:
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    at, palette = 13, None
    if flags & 0x80:
        n = 2 << (flags & 7)
        palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
    if width * height > MOST_PIXELS:
        raise ValueError(f"a canvas of {width} x {height} pixels")
    canvas = np.zeros((height, width, 4), np.uint8)
    frames, disposal, delay, clear, start = [], 0, 0, None, 0
    while (kind := data[at]) != 0x3B:
        if kind == 0x21:
            label = data[at + 1]
            body, at = _blocks(data, at + 2)
            if label == 0xF9:
                f, delay, t = struct.unpack_from("<BHB", body)
                disposal, clear = (f >> 2) & 7, t if f & 1 else None
        elif kind == 0x2C:
            x, y, w, h, f = struct.unpack_from("<HHHHB", data, at + 1)
            at, local = at + 10, palette
            if f & 0x80:
                n = 2 << (f & 7)
                local = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
                at += 3 * n
            if local is None:
                raise ValueError("a frame without a palette")
            size = data[at]
            stream, at = _blocks(data, at + 1)
            pixels = lzw_decode(stream, size, w * h)
            if len(pixels) < w * h:
                raise ValueError("a frame has too few pixels")
            grid = np.frombuffer(pixels, np.uint8).reshape(h, w)
            if f & 0x40:
                order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
                flat = np.empty_like(grid)
                flat[order] = grid
                grid = flat
            before = canvas.copy() if disposal == 3 else None
            part = canvas[y : y + h, x : x + w]
            seen = grid[: part.shape[0], : part.shape[1]]
            rgb = local[np.minimum(seen, len(local) - 1)]
            if clear is None:
                part[..., :3], part[..., 3] = rgb, 255
            else:
                on = seen != clear
                part[on, :3], part[on, 3] = rgb[on], 255
            frames.append({"start_ms": start, "delay_ms": delay * 10, "disposal": disposal, "x": x, "y": y, "w": w, "h": h, "pixels": grid.tobytes(), "canvas": canvas.copy(), "histogram": histogram(part[..., :3])})
            start += delay * 10
            if disposal == 2:
                part[...] = 0
            elif disposal == 3:
                canvas = before
            disposal, delay, clear = 0, 0, None
        else:
            raise ValueError("unknown block")
    return frames


def text_gifs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: its id, ``n_bytes`` of the UTF-8 text and ``media``, a GIF of the padded bytes. Narrow."""

    def run(batches):
        for b in batches:
            raw = [(t or "").encode() for t in b.column(1).to_pylist()]
            media = [write_gif(x.ljust(max(64, -(-len(x) // 64) * 64), b"\0")) for x in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    return map_texts(df.select(id_col, text_col), run, f"id {dict(df.dtypes)[id_col]}, n_bytes bigint, media binary").withColumnRenamed("id", id_col)


_FRAME = "struct<start_ms:int,delay_ms:int,disposal:int,x:int,y:int,w:int,h:int,pixels:binary,histogram:array<bigint>>"


def gif_frames(df: DataFrame, media_col: str = "media", frames_col: str = "frames") -> DataFrame:
    """df with ``frames_col``: the timed frames of the GIF in media_col (null if it is null or none). Narrow."""
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c != frames_col or c == media_col])
    names = df.columns

    def run(batches):
        keys = ("start_ms", "delay_ms", "disposal", "x", "y", "w", "h")
        kind = pa.list_(pa.struct([*((k, pa.int32()) for k in keys), ("pixels", pa.binary()), ("histogram", pa.list_(pa.int64()))]))
        for b in batches:
            rows = []
            for m in b.column(names.index(media_col)).to_pylist():
                try:
                    rows.append(None if m is None else [{k: f[k] for k in keys} | {"pixels": f["pixels"], "histogram": f["histogram"].tolist()} for f in read_gif(m)])
                except ValueError:
                    rows.append(None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind)], [*names, frames_col])

    return map_texts(df, run, f"{columns(df)}, `{frames_col}` array<{_FRAME}>")


def op8_media_columns(spark, sf_dir):
    """The contract's digests of what is read back from the stored bytes."""
    read = gif_frames(text_gifs(table(spark, sf_dir, "documents")))
    read = read.selectExpr("doc_id", "n_bytes", "media", "aggregate(frames, cast('' as binary), (a, f) -> concat(a, f.pixels)) as payload", "transform(sequence(0, 63), i -> aggregate(frames, 0L, (a, f) -> a + f.histogram[i])) as hist")
    return read.selectExpr(
        "doc_id", "n_bytes", "cast(octet_length(payload) as bigint) as payload_bytes", "sha2(payload, 256) as payload_sha256", "crc32(substring(payload, -64, 64)) as tail_crc32",
        "cast(octet_length(media) as bigint) as media_bytes", "sha2(media, 256) as media_sha256", "concat_ws(',', transform(filter(sequence(0, 63), i -> hist[i] > 0), i -> concat_ws(':', i, hist[i]))) as feature",
    )


def expected(text: str | None) -> tuple:
    """What op8 must give besides the stored form, straight from its definition."""
    raw = (text or "").encode()
    payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
    return len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])
