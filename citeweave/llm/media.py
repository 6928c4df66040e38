"""Media columns: PNG images in binary columns, their checksum tests, and low-frequency cosine-transform hashes."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import blocks

# The signature, colour types with their samples a pixel, and row filters of the format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
NONE, SUB, UP, AVERAGE, PAETH = range(5)

WIDTH = 64


class MediaError(ValueError):
    """The bytes are no image that this reader knows, or fail a checksum."""


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def _predicted(kind: int, left: np.ndarray, up: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """What a filter expects of samples, from those on the left, above, and above on the left (int16)."""
    if kind == SUB:
        return left
    if kind == UP:
        return up
    if kind == AVERAGE:
        return (left + up) >> 1
    if kind == PAETH:
        a, b = np.abs(up - corner), np.abs(left - corner)
        c = np.abs(left + up - 2 * corner)
        return np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
    return np.zeros_like(left)


def filter_rows(rows: np.ndarray, first: np.ndarray, channels: int, kind: int | None = None) -> np.ndarray:
    """Rows of images of one width, one after another, each behind the number of its filter. first: where an image begins.

    Without a kind, each row gets the filter whose result, read as signed bytes, has the least sum of sizes (ties: the
    lower number).
    """
    here = rows.astype(np.int16)
    up = np.zeros_like(here)
    up[1:] = here[:-1]
    up[first] = 0
    left, corner = (np.pad(x, ((0, 0), (channels, 0)))[:, : x.shape[1]] for x in (here, up))
    best, cost = np.empty((len(rows), rows.shape[1] + 1), np.uint8), np.full(len(rows), np.iinfo(np.int64).max)
    for k in range(PAETH + 1) if kind is None else (kind,):
        made = (here - _predicted(k, left, up, corner)).astype(np.uint8)
        size = np.abs(made.view(np.int8).astype(np.int16)).sum(1, dtype=np.int64)
        better = size < cost
        best[better, 0], best[better, 1:], cost[better] = k, made[better], size[better]
    return best


def _file(raw: np.ndarray, width: int, channels: int, level: int) -> bytes:
    colour = {n: c for c, n in CHANNELS.items()}[channels]
    head = struct.pack(">IIBBBBB", width, len(raw), 8, colour, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + _chunk(b"IEND", b"")


def encode_png(pixels: np.ndarray, row_filter: int | None = None, level: int = 1) -> bytes:
    """8-bit image (height, width) or (height, width, channels) as PNG. row_filter: one for all rows, or the best of each."""
    image = pixels.reshape(*pixels.shape[:2], -1)
    height, width, channels = image.shape
    raw = filter_rows(image.reshape(height, -1), np.arange(1), channels, row_filter)
    return _file(raw, width, channels, level)


def chunks(png: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, data) of every chunk; raises when a checksum or length is wrong."""
    if png[:8] != SIGNATURE:
        raise MediaError("no signature")
    at = 8
    while at < len(png):
        if at + 12 > len(png):
            raise MediaError("cut chunk")
        size, kind = struct.unpack_from(">I", png, at)[0], png[at + 4 : at + 8]
        data, end = png[at + 8 : at + 8 + size], at + 8 + size
        if end + 4 > len(png):
            raise MediaError("cut chunk")
        if zlib.crc32(kind + data) != struct.unpack_from(">I", png, end)[0]:
            raise MediaError(f"checksum of {kind!r}")
        yield kind, data
        at = end + 4


def unfilter(raw: np.ndarray, channels: int, first: np.ndarray | None = None) -> np.ndarray:
    """Rows of images of one width, one after another, without their filters. first: where an image begins.

    A sample hangs on those left, above, and above on the left, so all samples of one diagonal, of all images, are
    made at once.
    """
    kinds, rows = raw[:, 0].astype(np.int64), raw[:, 1:]
    if (kinds > PAETH).any():
        raise MediaError("unknown filter")
    if not kinds.any():
        return rows.copy()
    first = np.arange(1) if first is None else first
    n, width = len(rows), rows.shape[1] // channels
    starts = np.zeros(n, np.int64)
    starts[first] = first
    depth = np.arange(n) - np.maximum.accumulate(starts)  # rows above in the same image
    by = np.argsort(depth, kind="stable")
    ends = np.searchsorted(depth[by], np.arange(int(depth.max()) + width + 1), "right")
    # Behind a column of zeros, and a row of zeros that is above all first rows.
    out = np.zeros((n + 1, width + 1, channels), np.int16)
    given = rows.reshape(n, width, channels).astype(np.int16)
    above = np.where(depth > 0, np.arange(n) - 1, n)
    for d in range(int(depth.max()) + width):
        at = by[ends[d - width] if d >= width else 0 : ends[d]]
        x = d - depth[at]
        left, up, corner = out[at, x], out[above[at], x + 1], out[above[at], x]
        kind = kinds[at]
        guess = np.zeros_like(left)
        for k in range(SUB, PAETH + 1):
            own = np.flatnonzero(kind == k)
            if len(own):
                guess[own] = _predicted(k, left[own], up[own], corner[own])
        out[at, x + 1] = (given[at, x] + guess) & 255
    return out[:n, 1:].reshape(n, -1).astype(np.uint8)


def _scanlines(png: bytes) -> tuple[np.ndarray, int, int]:
    """Filtered rows, width and channels; tests every checksum and everything that the header states."""
    head, data, ended = None, [], False
    for k, (kind, body) in enumerate(chunks(png)):
        if ended:
            raise MediaError("bytes behind the end")
        if (kind == b"IHDR") != (k == 0):
            raise MediaError("header is not the first chunk")
        if kind == b"IHDR":
            if len(body) != 13:
                raise MediaError("wrong header")
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        elif kind == b"IEND":
            ended = True
        elif not kind[0] & 32:
            raise MediaError(f"unknown critical chunk {kind!r}")
    if head is None or not ended:
        raise MediaError("no header or end")
    width, height, depth, colour, compression, filters, interlaced = head
    if depth != 8 or colour not in CHANNELS or interlaced or compression or filters or not width or not height:
        raise MediaError("only 8-bit images that are not interlaced, of the standard methods")
    size = height * (width * CHANNELS[colour] + 1)
    stream = zlib.decompressobj()
    try:
        raw = stream.decompress(b"".join(data), size + 1)  # never more than the header states
    except zlib.error as e:
        raise MediaError(str(e)) from e
    if len(raw) != size or not stream.eof or stream.unused_data:
        raise MediaError("wrong amount of data")
    return np.frombuffer(raw, np.uint8).reshape(height, -1), width, CHANNELS[colour]


def decode_many(pngs: list[bytes]) -> list[np.ndarray | str]:
    """Pixels (height, width, channels) of each 8-bit image, or what is wrong with it. Images of one form are unfiltered together."""
    out: list[np.ndarray | str] = [""] * len(pngs)
    forms: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    for k, png in enumerate(pngs):
        try:
            raw, width, channels = _scanlines(png)
            if (raw[:, 0] > PAETH).any():
                raise MediaError("unknown filter")
            forms.setdefault((width, channels), []).append((k, raw))
        except (MediaError, struct.error) as e:
            out[k] = str(e)
    for (width, channels), held in forms.items():
        heights = np.array([len(raw) for _, raw in held])
        rows = unfilter(np.concatenate([raw for _, raw in held]), channels, np.cumsum(heights) - heights)
        for (k, _), part in zip(held, np.split(rows, np.cumsum(heights)[:-1])):
            out[k] = part.reshape(len(part), width, channels)
    return out


def decode_png(png: bytes) -> np.ndarray:
    """Pixels (height, width, channels) of an 8-bit image that is not interlaced; tests every checksum."""
    pixels = decode_many([png])[0]
    if isinstance(pixels, str):
        raise MediaError(pixels)
    return pixels


GRID, LOW = 32, 8
_COSINES = np.cos(np.pi / GRID * np.outer(np.arange(LOW + 1), np.arange(GRID) + 0.5))


def _means(x: np.ndarray, n: int) -> np.ndarray:
    """Means of n bands of rows; bands repeat rows where there are fewer."""
    at = np.arange(n + 1) * len(x) // n
    total = np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, axis=0, dtype=np.float64)])
    end = np.maximum(at[1:], at[:-1] + 1)
    return (total[end] - total[at[:-1]]) / (end - at[:-1])[:, None]


def cosine_hash(pixels: np.ndarray) -> bytes:
    """64 bits: which of the 8 x 8 lowest frequencies, without the constant row and column, exceed their median."""
    grey = pixels.mean(2) if pixels.shape[2] > 1 else pixels[:, :, 0]
    small = _means(_means(grey, GRID).T, GRID).T
    low = (_COSINES @ small @ _COSINES.T)[1:, 1:]
    return np.packbits((low > np.median(low)).reshape(-1)).tobytes()


#: Pixel bytes, and images, that a worker decodes at once.
DECODED_BYTES, DECODED_ROWS = 1 << 23, 256


def payload_image(text: bytes) -> np.ndarray:
    """UTF-8 bytes, zeros up to a positive multiple of 64, as rows of 64 grey pixels."""
    size = max(WIDTH, -(-len(text) // WIDTH) * WIDTH)
    return np.frombuffer(text.ljust(size, b"\0"), np.uint8).reshape(-1, WIDTH)


def to_media(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds a binary column media: each whole text (null: empty) as a PNG, each row with the filter that suits it.

    A column media of docs is replaced, other columns stay; an empty table gives no rows. A very long text is one image.
    """
    kept = [c for c in docs.columns if c != "media"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, text=text):
            raw, at = data.tobytes(), offsets.tolist()
            images = [payload_image(raw[a:b]) for a, b in zip(at, at[1:])]
            heights = np.array(list(map(len, images)))
            filtered = np.split(filter_rows(np.concatenate(images), np.cumsum(heights) - heights, 1), np.cumsum(heights)[:-1])
            made = pa.array([_file(x, WIDTH, 1, 1) for x in filtered], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns, made], [*kept, "media"])

    schema = docs.select(*kept).schema.add("media", "binary")
    return docs.select(*kept).mapInArrow(run, schema)


def _stated_bytes(png: bytes | None) -> int:
    """Bytes of a file and of the pixels that its header states (a damaged one may state any number)."""
    if not png or len(png) < 26:
        return 0
    width, height = struct.unpack(">II", png[16:24])
    return len(png) + width * height * 4


def groups(sizes: list[int], limit: int, most: int) -> Iterator[tuple[int, int]]:
    """Runs (from, to) of at most limit bytes and most items; a larger item is a run of its own."""
    a, held = 0, 0
    for k, size in enumerate(sizes):
        if k > a and (held + size > limit or k - a == most):
            yield a, k
            a, held = k, 0
        held += size
    if sizes:
        yield a, len(sizes)


def describe_media(frame: DataFrame, keys: list[str], media: str = "media") -> DataFrame:
    """keys, then payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature (hex), phash (binary), error.

    Decodes each image and computes from its pixels. Null or damaged images give an error and no payload columns. Images
    are decoded together up to DECODED_BYTES of pixels; a larger one is decoded alone.
    """
    added = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "phash": pa.binary(), "error": pa.string()}

    def one(png: bytes | None, pixels: np.ndarray | str) -> tuple:
        if png is None:
            return (None,) * 7 + ("no image",)
        stored = (len(png), hashlib.sha256(png).hexdigest())
        if isinstance(pixels, str):
            return (None, None, None, *stored, None, None, pixels)
        payload = pixels.tobytes()
        low = cosine_hash(pixels)
        return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *stored, low.hex(), low, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images = batch.column(len(keys))
            for a, b in groups([_stated_bytes(v.as_py()) for v in images], DECODED_BYTES, DECODED_ROWS):
                part = batch.slice(a, b - a)
                found = part.column(len(keys)).to_pylist()
                cols = list(zip(*map(one, found, decode_many([v or b"" for v in found]))))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], *[pa.array(c, t) for c, t in zip(cols, added.values())]], [*keys, *added])

    schema = frame.select(*keys).schema
    for name, kind in added.items():
        schema = schema.add(name, {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}[kind])
    return frame.select(*keys, media).mapInArrow(run, schema)


def text_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the media columns of every document; narrow, no shuffle. Equal texts give equal values.

    A null text counts as empty; a very long one is one image. Rows of a repeated doc_id are described each. An empty
    table gives no rows. Only doc_id and text are read, so other columns may have any name.
    """
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "text")
    return describe_media(to_media(sized), ["doc_id", "n_bytes"])
