"""Media columns: Netpbm and BMP images, area resizing, NPY tiles, difference hashes.

``decode_image`` turns the bytes of a Netpbm (P1 to P6) or an uncompressed BMP
file into a numpy array.  ``area_resize`` averages exact areas by an integral
image, whose bilinear interpolation is exact because a pixel is constant over
its square.  ``npy_tiles`` cuts an array into NPY files.  All work is per row,
so a column of any size streams through Arrow batches without a shuffle.

Defined results: null bytes give nulls in every derived column; bytes that are
no image, or are truncated, give nulls and the reason in ``error``.  A null text
counts as an empty one; an empty text is padded like any other.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Payloads are padded to multiples of this, a whole number of stored rows.
BLOCK = 576
WIDTH = 24
PAD = 255


class ImageError(ValueError):
    """The bytes are not an image this module can read."""


def _header_fields(data: bytes, count: int) -> tuple[list[int], int]:
    """``count`` numbers after the magic, with comments, and where samples begin."""
    fields: list[int] = []
    at = 2
    while len(fields) < count:
        while at < len(data) and data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            while at < len(data) and data[at] not in b"\r\n":
                at += 1
            continue
        end = at
        while end < len(data) and 48 <= data[end] <= 57:
            end += 1
        if end == at or end - at > 9:
            raise ImageError("bad Netpbm header")
        fields.append(int(data[at:end]))
        at = end
    if not data[at : at + 1].isspace():
        raise ImageError("bad Netpbm header")
    return fields, at + 1


def _decode_netpbm(data: bytes) -> np.ndarray:
    kind = data[1] - 48
    bitmap = kind in (1, 4)
    fields, at = _header_fields(data, 2 if bitmap else 3)
    width, height, top = fields[0], fields[1], 1 if bitmap else fields[2]
    if not width or not height or not 0 < top < 65536:
        raise ImageError("bad Netpbm size")
    channels = 3 if kind in (3, 6) else 1
    total = width * height * channels
    body = data[at:]
    if kind == 4:
        stride = (width + 7) // 8
        if len(body) < stride * height:
            raise ImageError("truncated")
        rows = np.frombuffer(body, np.uint8, stride * height).reshape(height, stride)
        return (1 - np.unpackbits(rows, axis=1)[:, :width]) * np.uint8(255)
    if kind == 1:
        bits = bytes(b for b in body if b in b"01")[:total]
        if len(bits) < total:
            raise ImageError("truncated")
        return ((49 - np.frombuffer(bits, np.uint8)) * np.uint8(255)).reshape(height, width)
    if kind in (2, 3):
        words = body.split()[:total]
        if len(words) < total:
            raise ImageError("truncated")
        try:
            samples = np.array([int(w) for w in words], dtype=np.int64)
        except ValueError:
            raise ImageError("bad sample") from None
        if samples.min(initial=0) < 0 or samples.max(initial=0) > top:
            raise ImageError("bad sample")
        samples = samples.astype(np.uint8 if top < 256 else np.uint16)
    else:
        kind_of = np.dtype(np.uint8) if top < 256 else np.dtype(">u2")
        if len(body) < total * kind_of.itemsize:
            raise ImageError("truncated")
        samples = np.frombuffer(body, kind_of, total)
        if kind_of.itemsize == 2:
            samples = samples.astype(np.uint16)
    return samples.reshape((height, width, 3) if channels == 3 else (height, width))


def _decode_bmp(data: bytes) -> np.ndarray:
    if len(data) < 54:
        raise ImageError("truncated")
    offset, header = struct.unpack_from("<II", data, 10)
    if header < 40:
        raise ImageError("unsupported BMP header")
    width, height, _, depth, packing = struct.unpack_from("<iiHHI", data, 18)
    used = struct.unpack_from("<I", data, 46)[0]
    if packing not in (0, 3) or (packing == 3 and depth != 32) or depth not in (1, 4, 8, 24, 32):
        raise ImageError("unsupported BMP form")
    flip, height = height > 0, abs(height)
    if width <= 0 or not height:
        raise ImageError("bad BMP size")
    stride = (width * depth + 31) // 32 * 4
    if len(data) < offset + stride * height:
        raise ImageError("truncated")
    rows = np.frombuffer(data, np.uint8, stride * height, offset).reshape(height, stride)
    if flip:
        rows = rows[::-1]
    if depth >= 24:
        size = depth // 8
        return rows[:, : width * size].reshape(height, width, size)[:, :, 2::-1]
    if depth == 8:
        index = rows[:, :width]
    elif depth == 4:
        index = np.stack([rows >> 4, rows & 15], axis=2).reshape(height, -1)[:, :width]
    else:
        index = np.unpackbits(rows, axis=1)[:, :width]
    colours = used or 1 << depth
    if len(data) < 14 + header + 4 * colours or index.max(initial=0) >= colours:
        raise ImageError("bad BMP palette")
    palette = np.frombuffer(data, np.uint8, 4 * colours, 14 + header).reshape(-1, 4)[:, 2::-1]
    return palette[index]


def decode_image(data: bytes) -> np.ndarray:
    """``(height, width)`` or ``(height, width, 3)`` samples of a Netpbm or BMP file."""
    if data[:2] == b"BM":
        return _decode_bmp(data)
    if len(data) > 2 and data[:1] == b"P" and 49 <= data[1] <= 54:
        return _decode_netpbm(data)
    raise ImageError("neither Netpbm nor BMP")


def encode_pgm(samples: bytes, width: int = WIDTH) -> bytes:
    """A binary grey Netpbm file of whole rows of 8-bit samples."""
    if not samples or len(samples) % width:
        raise ValueError("samples must fill whole rows")
    return b"P5\n%d %d\n255\n" % (width, len(samples) // width) + samples


def encode_bmp(samples: bytes, width: int = WIDTH) -> bytes:
    """A 24-bit bottom-up BMP file of whole rows of RGB samples."""
    if not samples or len(samples) % (3 * width):
        raise ValueError("samples must fill whole rows")
    rows = np.frombuffer(samples, np.uint8).reshape(-1, width, 3)[::-1, :, ::-1]
    stride = (3 * width + 3) // 4 * 4
    body = np.zeros((rows.shape[0], stride), np.uint8)
    body[:, : 3 * width] = rows.reshape(rows.shape[0], -1)
    head = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + body.size, 0, 0, 54, 40, width, rows.shape[0], 1, 24, 0, body.size, 2835, 2835, 0, 0)
    return head + body.tobytes()


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of each target cell's exact area, as doubles."""
    planes = image[:, :, None] if image.ndim == 2 else image
    tall, wide, depth = planes.shape
    integral = np.zeros((tall + 1, wide + 1, depth))
    np.cumsum(planes, axis=0, dtype=np.float64, out=integral[1:, 1:])
    np.cumsum(integral[1:, 1:], axis=1, out=integral[1:, 1:])

    def edges(old: int, new: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.arange(new + 1) * (old / new)
        low = np.minimum(at.astype(np.int64), old - 1)
        return low, low + 1, at - low

    low, high, part = edges(tall, height)
    lines = integral[low] * (1 - part)[:, None, None] + integral[high] * part[:, None, None]
    low, high, part = edges(wide, width)
    grid = lines[:, low] * (1 - part)[None, :, None] + lines[:, high] * part[None, :, None]
    sums = grid[1:, 1:] - grid[:-1, 1:] - grid[1:, :-1] + grid[:-1, :-1]
    out = sums * (height * width / (tall * wide))
    return out[:, :, 0] if image.ndim == 2 else out


def difference_hash(image: np.ndarray) -> int:
    """64 bits: whether each of 9 x 8 area means is darker than its right neighbour."""
    grey = image if image.ndim == 2 else image @ np.array([0.299, 0.587, 0.114])
    small = np.rint(area_resize(grey, 8, 9) * 256)
    return int.from_bytes(np.packbits(small[:, :-1] < small[:, 1:]).tobytes(), "big")


def npy_tiles(image: np.ndarray, size: int) -> Iterator[tuple[int, int, bytes]]:
    """Row, column and NPY file of each tile; those at the far edges may be smaller."""
    for top in range(0, image.shape[0], size):
        for left in range(0, image.shape[1], size):
            out = io.BytesIO()
            np.save(out, np.ascontiguousarray(image[top : top + size, left : left + size]), allow_pickle=False)
            yield top // size, left // size, out.getvalue()


def image_tiles(images: DataFrame, key: str, column: str, *, height: int = 64, width: int = 64, tile: int = 32) -> DataFrame:
    """A row for each NPY tile of every image in binary ``column``, resized.

    Columns: the key, ``tile_row``, ``tile_column``, ``npy``, ``dhash`` (16 hex
    digits) and ``error``.  An image that can't be read has one row with its
    error; null bytes have one row of nulls.  Writing the result as Parquet
    stores the tiles.
    """
    kind = images.schema[key].dataType
    source = images.select(F.col(key).alias("key"), F.col(column).alias("data"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                try:
                    if data is None:
                        rows.append((None, None, None, None, None))
                    else:
                        image = decode_image(bytes(data))
                        small = np.rint(area_resize(image, height, width)).astype(image.dtype)
                        mark = f"{difference_hash(image):016x}"
                        rows = [(r, c, npy, mark, None) for r, c, npy in npy_tiles(small, tile)]
                except ImageError as why:
                    rows = [(None, None, None, None, str(why))]
                for row in rows:
                    for values, value in zip(out, (k, *row), strict=True):
                        values.append(value)
            types = [batch.schema.field(0).type, pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string()]
            names = ["key", "tile_row", "tile_column", "npy", "dhash", "error"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=names)

    schema = f"key {kind.simpleString()}, tile_row int, tile_column int, npy binary, dhash string, error string"
    return source.mapInArrow(cut, schema).withColumnRenamed("key", key)


def text_payload(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes padded with 255 to a positive multiple of the block; their own length."""
    raw = (text or "").encode()
    return raw + bytes([PAD]) * (BLOCK - len(raw) if not raw else -len(raw) % BLOCK), len(raw)


def text_media(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Store every whole text as a grey Netpbm image, read it back, and describe it.

    Columns: the key as ``doc_id``, ``n_bytes``, ``payload_bytes``,
    ``payload_sha256`` and ``tail_crc32`` of what was read back,
    ``media_bytes`` and ``media_sha256`` of the stored file, ``feature`` (the
    difference hash, then a digest of the NPY tiles of the 16 x 16 area means).
    Repeated rows give equal rows; an empty table gives an empty result.
    """
    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                payload, size = text_payload(value.as_py())
                stored = encode_pgm(payload)
                image = decode_image(stored)
                back = image.tobytes()
                small = np.rint(area_resize(image, 16, 16)).astype(np.uint8)
                tiles = hashlib.sha256(b"".join(npy for _, _, npy in npy_tiles(small, 8))).hexdigest()[:16]
                rows.append((size, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), f"{difference_hash(image):016x}:{tiles}"))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return source.mapInArrow(describe, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
