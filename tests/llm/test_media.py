"""Images: round trips, checksums, filters, hashes, and the query against a plain version."""

import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeweave.llm import media
from citeweave.llm.catalogue import op2_media_columns

from .common import awkward, empty


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.sampled_from([1, 2, 3, 4]), st.sampled_from([None, 0, 1, 2, 3, 4]), st.integers(0, 99))
def test_round_trip(height, width, channels, kind, seed):
    pixels = np.random.default_rng(seed).integers(0, 256, (height, width, channels)).astype(np.uint8)
    assert (media.decode_png(media.encode_png(pixels, kind)) == pixels).all()


def filtered(pixels, kinds):
    """Raw rows by the format's definition, one byte at a time."""
    height, width, channels = pixels.shape
    rows, out = pixels.reshape(height, -1).astype(int), []
    for y in range(height):
        out.append(kinds[y])
        for x in range(width * channels):
            a = rows[y, x - channels] if x >= channels else 0
            b = rows[y - 1, x] if y else 0
            c = rows[y - 1, x - channels] if y and x >= channels else 0
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            out.append((rows[y, x] - [0, a, b, (a + b) // 2, paeth][kinds[y]]) % 256)
    return np.array(out, np.uint8).reshape(height, -1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=9), st.integers(1, 7), st.sampled_from([1, 3, 4]), st.integers(0, 99))
def test_every_filter(kinds, width, channels, seed):
    pixels = np.random.default_rng(seed).integers(0, 256, (len(kinds), width, channels)).astype(np.uint8)
    assert (media.unfilter(filtered(pixels, kinds), channels).reshape(pixels.shape) == pixels).all()


def test_images_are_unfiltered_together(spark, sf_dir):
    rng = np.random.default_rng(3)
    images = [rng.integers(0, 256, (h, 5, 1)).astype(np.uint8) for h in (1, 7, 2, 7, 30)]
    kinds = [rng.integers(0, 5, len(x)).tolist() for x in images]
    raw, first = np.concatenate([filtered(x, k) for x, k in zip(images, kinds)]), np.cumsum([0, 1, 7, 2, 7])
    assert (media.unfilter(raw, 1, first) == np.concatenate(images).reshape(len(raw), -1)).all()
    found = media.decode_many([media.encode_png(x) for x in images] + [b"no image"])
    assert all((a == b).all() for a, b in zip(found, images)) and found[-1] == "no signature"
    # In the images of the query every filter that changes a row occurs, and each has the least sum of its row.
    used = set()
    for r in media.to_media(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)).collect():
        raw = media._scanlines(r["media"])[0]
        pixels = media.payload_image((r["text"] or "").encode())[:, :, None]
        cost = np.array([np.abs(filtered(pixels, [k] * len(raw))[:, 1:].view(np.int8).astype(int)).sum(1) for k in range(5)])
        assert (cost.argmin(0) == raw[:, 0]).all()
        used |= set(raw[:, 0].tolist())
    assert used >= {1, 2, 3, 4}


def test_what_the_header_states_is_tested():
    png = media.encode_png(np.arange(64, dtype=np.uint8).reshape(8, 8))
    found = list(media.chunks(png))
    make = lambda *parts: media.SIGNATURE + b"".join(media._chunk(k, d) for k, d in parts)
    head, data, end = found
    bomb = (b"IDAT", zlib.compress(bytes(10_000_000)))
    other = lambda at: (b"IHDR", bytes(b ^ (k == at) for k, b in enumerate(head[1])))
    for bad in (make(*found, data), make(head, (b"ABCD", b""), data, end), make(data, head, end), make(head, bomb, end), make(other(10), data, end), make(other(11), data, end), make(head, end), make(head, head, data, end)):
        with pytest.raises(media.MediaError):
            media.decode_png(bad)
    assert media.decode_png(make(head, (b"teXt", b"any"), data, end)).shape == (8, 8, 1)


def test_damage_is_found():
    png = bytearray(media.encode_png(np.arange(64, dtype=np.uint8).reshape(8, 8)))
    for at in range(8, len(png)):
        bad = png.copy()
        bad[at] ^= 1
        with pytest.raises((media.MediaError, struct.error)):
            media.decode_png(bytes(bad))
    for n in (0, 8, 20, len(png) - 1):
        with pytest.raises(media.MediaError):
            media.decode_png(bytes(png[:n]))


def test_hash_is_of_low_frequencies():
    # Every low frequency has some weight, as in a picture of a scene; without one its sign would be noise.
    coarse = np.random.default_rng(0).integers(30, 226, (16, 16))
    image = np.kron(coarse, np.ones((4, 4))).astype(np.uint8)[:, :, None]
    noisy = (image + np.random.default_rng(1).integers(-6, 7, image.shape)).clip(0, 255).astype(np.uint8)
    other = np.ascontiguousarray(image.transpose(1, 0, 2)[::-1])
    bits = lambda a, b: sum((p ^ q).bit_count() for p, q in zip(media.cosine_hash(a), media.cosine_hash(b)))
    assert bits(image, noisy) <= 10 < bits(image, other)

    def plain(pixels):
        g = pixels[:, :, 0].astype(float).reshape(32, 2, 32, 2).mean((1, 3))
        c = np.array([[np.cos(np.pi * u * (2 * i + 1) / 64) for i in range(32)] for u in range(9)])
        low = np.array([[sum(c[u, i] * c[v, j] * g[i, j] for i in range(32) for j in range(32)) for v in range(1, 9)] for u in range(1, 9)])
        return np.packbits((low > np.median(low)).reshape(-1)).tobytes()

    assert plain(image) == media.cosine_hash(image)


def check(rows, texts):
    for r, (d, t) in zip(rows, texts, strict=True):
        raw = (t or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert r["doc_id"] == d and r["n_bytes"] == len(raw) and r["payload_bytes"] == len(payload)
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-64:])
        png = media.encode_png(media.payload_image(raw))
        assert r["media_bytes"] == len(png) and r["media_sha256"] == hashlib.sha256(png).hexdigest()
        assert r["feature"] == media.cosine_hash(np.frombuffer(payload, np.uint8).reshape(-1, 64, 1)).hex() == bytes(r["phash"]).hex()


def by_id(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))


def test_query(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in by_id(spark.read.parquet(f"{sf_dir}/documents.parquet").collect())]
    check(by_id(op2_media_columns(spark, sf_dir).collect()), texts)


def test_images_are_decoded_up_to_a_number_of_bytes(spark, monkeypatch):
    assert list(media.groups([5, 5, 1, 30, 2, 2, 2, 2], 10, 3)) == [(0, 2), (2, 3), (3, 4), (4, 7), (7, 8)]
    assert list(media.groups([], 10, 3)) == [] and list(media.groups([99], 10, 3)) == [(0, 1)]
    docs = awkward(spark)
    whole = sorted(map(str, media.text_media(docs).collect()))
    monkeypatch.setattr(media, "DECODED_BYTES", 300)
    assert sorted(map(str, media.text_media(docs).collect())) == whole
    lying = bytearray(media.encode_png(media.payload_image(b"abc")))
    lying[16:24] = b"\xff" * 8
    frame = spark.createDataFrame([(1, lying), (2, bytearray(media.encode_png(media.payload_image(b"abc"))))], "doc_id bigint, media binary")
    assert {r["doc_id"]: r["error"] is None for r in media.describe_media(frame, ["doc_id"]).collect()} == {1: False, 2: True}


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(by_id(media.text_media(docs).collect()), [(r["doc_id"], r["text"]) for r in by_id(docs.collect())])
    assert media.text_media(empty(spark)).count() == 0
    stored = media.to_media(docs)
    assert set(stored.columns) == set(docs.columns)
    told = {r["doc_id"]: r["error"] for r in media.describe_media(spark.createDataFrame([(1, None), (2, bytearray(b"junk"))], "doc_id bigint, media binary"), ["doc_id"]).collect()}
    assert told == {1: "no image", 2: "no signature"}
