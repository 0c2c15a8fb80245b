import hashlib
import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import media as M


def test_netpbm_forms():
    assert M.decode_image(b"P1\n# c\n3 2\n101\n010").tolist() == [[0, 255, 0], [255, 0, 255]]
    assert M.decode_image(b"P4 3 2\n" + bytes([0b10100000, 0b01000000])).tolist() == [[0, 255, 0], [255, 0, 255]]
    assert M.decode_image(b"P2 2 1 255 7 250").tolist() == [[7, 250]]
    assert M.decode_image(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert M.decode_image(b"P5 2 1 65535\n" + b"\x01\x02\x03\x04").tolist() == [[258, 772]]
    assert M.decode_image(b"P6 1 1 255\n\x01\x02\x03").tolist() == [[[1, 2, 3]]]


def test_bmp_forms():
    def bmp(depth, rows, palette=b"", height=None):
        import struct

        return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 0, 0, 0, 54 + len(palette), 40, 2, height or 2, 1, depth, 0, 0, 0, 0, len(palette) // 4, 0) + palette + rows

    grey = b"\0\0\0\0\xff\xff\xff\0"
    assert M.decode_image(bmp(1, b"\x80\0\0\0\x40\0\0\0", grey)).tolist() == [[[0, 0, 0], [255, 255, 255]], [[255, 255, 255], [0, 0, 0]]]
    assert M.decode_image(bmp(4, b"\x10\0\0\0\x01\0\0\0", grey))[:, :, 0].tolist() == [[0, 255], [255, 0]]
    assert M.decode_image(bmp(8, b"\x01\0\0\0\0\x01\0\0", grey))[:, :, 0].tolist() == [[0, 255], [255, 0]]
    assert M.decode_image(bmp(8, b"\x01\0\0\0\0\x01\0\0", grey, height=-2))[:, :, 0].tolist() == [[255, 0], [0, 255]]
    assert M.decode_image(bmp(32, bytes(range(16)))).tolist() == [[[10, 9, 8], [14, 13, 12]], [[2, 1, 0], [6, 5, 4]]]


@pytest.mark.parametrize("data", [b"", b"P", b"P5", b"P5 2 2 255\nabc", b"P2 1 1 255 300", b"P7 1 1", b"BM", b"GIF89a", b"P5 0 2 255\n", b"P2 1 1 255 x"])
def test_not_an_image(data):
    with pytest.raises(M.ImageError):
        M.decode_image(data)


@given(st.binary(max_size=3000))
def test_round_trip(data):
    payload, size = M.text_payload(data.decode("latin-1"))
    assert size == len(data.decode("latin-1").encode()) and len(payload) % 576 == 0 and payload
    assert M.decode_image(M.encode_pgm(payload)).tobytes() == payload == M.decode_image(M.encode_bmp(payload)).tobytes()


@settings(deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(1, 9), st.integers(1, 9), st.integers(0, 99))
def test_area_means(tall, wide, height, width, seed):
    image = np.random.default_rng(seed).integers(0, 256, (tall, wide))
    fine = np.repeat(np.repeat(image, height, axis=0), width, axis=1)  # each cell is whole pixels here
    wanted = fine.reshape(height, tall, width, wide).mean(axis=(1, 3))
    assert np.allclose(M.area_resize(image, height, width), wanted)


def test_tiles_and_hash():
    image = np.arange(35, dtype=np.uint8).reshape(5, 7)
    out = np.zeros_like(image)
    for r, c, data in M.npy_tiles(image, 3):
        tile = np.load(io.BytesIO(data))
        out[r * 3 : r * 3 + tile.shape[0], c * 3 : c * 3 + tile.shape[1]] = tile
    assert (out == image).all()
    assert M.difference_hash(np.tile(np.arange(9), (8, 1))) == (1 << 64) - 1
    assert M.difference_hash(np.zeros((3, 3))) == 0


def test_text_media(spark):
    texts = ["", None, "é" * 300, "x" * 576, "x" * 576]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in M.text_media(rows).collect()}
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        payload = raw + b"\xff" * (576 if not raw else -len(raw) % 576)
        r = out[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r["media_bytes"] > len(payload)
    assert out[3]["feature"] == out[4]["feature"] and out[0]["feature"] == out[1]["feature"]
    assert M.text_media(rows.limit(0)).count() == 0


def test_image_tiles(spark):
    rows = spark.createDataFrame([(1, bytearray(M.encode_pgm(bytes(range(24)) * 24))), (2, bytearray(b"no")), (3, None)], "k long, data binary")
    out = M.image_tiles(rows, "k", "data", height=8, width=8, tile=4).collect()
    assert sorted((r["k"], r["error"] is None) for r in out) == [(1, True)] * 4 + [(2, False), (3, True)]
    assert np.load(io.BytesIO(bytes(next(r["npy"] for r in out if r["k"] == 1)))).shape == (4, 4)
