import hashlib
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import jpeg, media
from tests.llm.fixtures import DOCS, awkward_docs, prose, rows


def payloads():
    rng = np.random.default_rng(1)
    of = lambda values, n, p=None: bytes(rng.choice(values, n, p=p).astype(np.uint8))
    return [
        b"", b"a", b"hello " * 20, b"\x80" * 700, b"\xff" * 64, bytes(64), of(range(256), 5000), of([127, 128, 129, 0, 255], 20000),
        of([126, 128, 130], 3000, [0.02, 0.96, 0.02]), of([127, 128, 130], 9000, [0.02, 0.96, 0.02]), of(range(97, 123), 400_000), of([127, 128], 900_000, [0.001, 0.999]),
    ]


def test_payloads_come_back_alone_and_together():
    data = payloads()
    images = media.stored(data)
    assert [media.stored([x])[0] for x in data] == images
    told = media.tensors(images)
    assert [t["payload"] for t in told] == [media.padded(x).tobytes() for x in data]
    assert [media.tensors([x])[0] for x in images] == told
    assert len(jpeg.parse(images[10]).scans[1].data) > 1  # restart intervals


def calls(work):
    """Calls of functions, Python's and C's, that work() makes."""
    n = [0]

    def count(frame, event, arg):
        n[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        work()
    finally:
        sys.setprofile(None)
    return n[0]


def test_reading_does_not_go_code_by_code():
    """Most bytes of a payload are a code of their own; one step in Python for each took most of the query's time."""
    rng = np.random.default_rng(3)
    image = media.stored([bytes(rng.integers(97, 123, 200_000).astype(np.uint8))])
    media.tensors(image)
    assert calls(lambda: media.tensors(image)) < 200_000 / 4


def test_small_images_are_read_together():
    """What numpy is called for follows the group, not its images."""
    images = media.stored([prose(k, 20).encode() for k in range(300)])
    media.tensors(images)
    assert calls(lambda: media.tensors(images)) < 300 * 550


def test_codes_are_walked_as_one_by_one():
    rng = np.random.default_rng(4)
    one = rng.integers(1, 32, 30_000).astype(np.uint8)
    one[9_000:9_400], one[-300:] = 31, 31
    start, end = np.array([0, 5_000, 5_008, 9_000, 20_000, 29_900]), np.array([4_936, 5_000, 5_009, 19_000, 29_800, 29_999])
    want, count = [], [0]
    for at, stop in zip(start.tolist(), end.tolist()):
        while at < stop:
            want.append(at)
            at += int(one[at])
        count.append(len(want))
    at, told = jpeg._walk(one, start, end)
    assert at.tolist() == want and told.tolist() == count


def test_tensors_of_a_group_equal_those_of_each_image():
    rng = np.random.default_rng(5)
    frames = [jpeg.Frame(h, w, s, [np.full(64, q)] * 3) for h, w, q in ((16, 16, 1.0), (37, 16, 1.0), (37, 16, 2.0), (8, 51, 1.0), (9, 51, 1.0), (1, 1, 1.0)) for s in (media.SAMPLING, ((1, 1),) * 3)]
    blocks = [[rng.integers(-60, 60, (f.grid(c)[0] * f.grid(c)[1], 64)).astype(np.int16) for c in range(3)] for f in frames]
    assert all(np.array_equal(a, jpeg.rgb(f, b)) for a, f, b in zip(jpeg.rgbs(frames, blocks), frames, blocks))


def test_images_and_tensors_stay_as_they_were():
    """Images, payloads and features as the code that walked one code at a time made them."""
    data = [b"", b"a", b"\x80" * 700, b"\xff" * 64, bytes(64), bytes(range(256)) * 40, b"\x80\x7f\x81\x80\x80\x00" * 3000, "é€😀 a word".encode() * 9000, b"hello " * 20]
    images, told = media.stored(data), hashlib.sha256()
    for image, own in zip(images, media.tensors(images)):
        told.update(image + own["payload"] + own["feature"].encode() + own["data"])
    assert told.hexdigest() == "f0e2d8afaa34969816d25f83b1c3afc9e2e68686ff0cbf823aaf825131cb02ba"


def test_scans_accumulate():
    """Without its refining scans an image has all but the last bit of the refined bands."""
    data = prose(3, 400).encode()
    image = jpeg.parse(media.stored([data])[0])
    full = jpeg.coefficients([image])[0]
    image.scans = image.scans[:5]
    rough = jpeg.coefficients([image])[0]
    assert all(np.array_equal(r[:, 16:], f[:, 16:]) for r, f in zip(rough, full))
    assert np.array_equal(rough[0][:, 1:16], np.sign(full[0][:, 1:16]) * (np.abs(full[0][:, 1:16]) >> 1 << 1))
    assert all(np.array_equal(r[:, 0], f[:, 0] >> 1 << 1) for r, f in zip(rough, full)) and not np.array_equal(rough[0], full[0])


def _java(spark):
    gw = spark.sparkContext._gateway
    spark._jvm.java.lang.System.setProperty("java.awt.headless", "true")
    return gw, spark._jvm.javax.imageio.ImageIO, spark._jvm.java.io


def java_pixels(spark, data):
    _, imageio, io = _java(spark)
    image = imageio.read(io.ByteArrayInputStream(bytearray(data)))
    w, h = image.getWidth(), image.getHeight()
    if image.getRaster().getNumBands() == 1:  # getRGB would change the gamma of grey
        return np.repeat(np.array([image.getRaster().getSample(i % w, i // w, 0) for i in range(w * h)]), 3).reshape(h, w, 3)
    packed = np.array(list(image.getRGB(0, 0, w, h, None, 0, w)), np.int64)
    return np.stack([(packed >> s) & 255 for s in (16, 8, 0)], axis=-1).reshape(h, w, 3)


def java_progressive(spark, pixels):
    """A progressive image that another coder has written: its own tables, end-of-band runs and script, odd sizes."""
    gw, imageio, io = _java(spark)
    h, w = pixels.shape[:2]
    kind = 1 if pixels.ndim == 3 else 10
    image = spark._jvm.java.awt.image.BufferedImage(w, h, kind)
    rgb = pixels if pixels.ndim == 3 else np.repeat(pixels[..., None], 3, axis=2)
    flat = gw.new_array(gw.jvm.int, w * h)
    for i, v in enumerate((rgb[..., 0].astype(int) << 16 | rgb[..., 1].astype(int) << 8 | rgb[..., 2]).reshape(-1).tolist()):
        flat[i] = v
    if kind == 1:
        image.setRGB(0, 0, w, h, flat, 0, w)
    else:
        for i, v in enumerate(pixels.reshape(-1).tolist()):
            image.getRaster().setSample(i % w, i // w, 0, int(v))
    out = io.ByteArrayOutputStream()
    writer = imageio.getImageWritersByFormatName("jpeg").next()
    param = writer.getDefaultWriteParam()
    param.setProgressiveMode(1)
    sink = imageio.createImageOutputStream(out)
    writer.setOutput(sink)
    writer.write(None, spark._jvm.javax.imageio.IIOImage(image, None, None), param)
    sink.flush()
    return bytes(out.toByteArray())


def test_another_decoder_reads_our_images(spark):
    for data in (prose(1, 60).encode(), payloads()[8]):
        image = media.stored([data])[0]
        parsed = jpeg.parse(image)
        assert parsed.frame.width <= 64
        # chroma is smoothed by the other decoder, so images with luma alone are compared
        blocks = jpeg.coefficients([parsed])[0]
        grey = [blocks[0], np.zeros_like(blocks[1]), np.zeros_like(blocks[2])]
        again = jpeg.encode([media.frame_of(len(data) // 64 + 1)], [grey], [b""])[0]
        ours, theirs = media.tensors([again])[0], java_pixels(spark, again)
        mine = np.frombuffer(ours["data"], np.uint8).reshape(theirs.shape)
        assert np.abs(mine.astype(int) - theirs).max() <= 2


@pytest.mark.parametrize("shape", [(37, 51, 3), (16, 16, 3), (40, 23)])
def test_images_of_another_coder_are_read(spark, shape):
    y, x = np.mgrid[: shape[0], : shape[1]]
    grey = 128 + 60 * np.sin(x / 9) * np.cos(y / 7) + 20 * (x > 20)
    pixels = (np.stack([grey, grey * 0.9, 255 - grey], axis=-1) if len(shape) == 3 else grey).astype(np.uint8)
    data = java_progressive(spark, pixels)
    parsed = jpeg.parse(data)
    assert len(parsed.scans) > 4 and any(s.before for s in parsed.scans)
    told = media.tensors([data])[0]
    mine = np.frombuffer(told["data"], np.uint8).reshape(*shape[:2], 3).astype(int)
    theirs = java_pixels(spark, data)
    assert told["payload"] is None and np.abs(mine - theirs).mean() < (3 if len(shape) == 3 else 0.6)
    # Theirs smooths chroma; luma must agree.
    luma = lambda p: p @ [0.299, 0.587, 0.114]
    assert np.abs(luma(mine) - luma(theirs)).max() < 12


def test_transform_equals_its_formula():
    rng = np.random.default_rng(2)
    block = rng.integers(-30, 30, 64)
    square = np.zeros((8, 8))
    square.reshape(-1)[jpeg.ZIGZAG] = block
    c = lambda k: 0.5**0.5 if k == 0 else 1.0
    want = [[sum(c(u) * c(v) / 4 * square[v, u] * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) for u in range(8) for v in range(8)) for x in range(8)] for y in range(8)]
    assert np.allclose((block @ jpeg.BASIS).reshape(8, 8), want)


def test_broken_media_is_null_and_alone(spark):
    good = media.stored([b"fine", prose(1, 300).encode()])
    bad = [None, b"", b"no image", good[1][:-40], good[1][:300], good[0][:2] + good[0][9:], good[1][:200] + b"\x00" * 40 + good[1][240:]]
    told = media.tensors([good[0], *bad, good[1]])
    assert told[0]["payload"][:4] == b"fine" and told[-1]["payload"] == media.padded(prose(1, 300).encode()).tobytes() and told[1:6] == [None] * 5
    df = spark.createDataFrame([(i, None if m is None else bytearray(m)) for i, m in enumerate([good[0], *bad[:4]])], "tensor int, media binary")
    out = media.with_tensors(df, into="x")
    assert out.columns == ["tensor", "media", "x"] and sorted(r.tensor for r in out.where("x IS NULL").collect()) == [1, 2, 3, 4]


def test_query_and_awkward_rows(spark, tmp_path):
    docs = awkward_docs(spark, extra=[prose(k, 50 * k) for k in range(12)] + ["é€😀" * 40_000]).withColumns({"media": F.lit("own"), "raw": F.lit("own"), "__raw": F.lit("own")})
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for r in docs.collect():
        raw = (r.text or "").encode()
        full = raw + bytes(-len(raw) % 64 if raw else 64)
        want.setdefault((r.doc_id, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:])), []).append(1)
    out = media.op12_progressive_jpeg(spark, str(tmp_path)).collect()
    got = {}
    for r in out:
        got.setdefault((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32), []).append(1)
    assert got == want
    assert len({(r.payload_sha256, r.media_bytes, r.media_sha256, r.feature) for r in out}) == len({r.payload_sha256 for r in out})
    kept = media.with_media(docs, into="image")
    assert kept.columns == [*docs.columns, "image"] and {r.media for r in kept.collect()} == {"own"}
    assert media.with_tensors(media.with_media(docs.limit(0), into="image"), "image").count() == 0
    assert {hashlib.sha256(r.image).hexdigest() for r in kept.collect()} == {r.media_sha256 for r in out}
