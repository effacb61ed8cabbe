import base64
import struct
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepkit.functions.png import SIGNATURE, decode_png, encode_png
from prepkit.functions.resize import axis_weights, resize
from prepkit.operators.maps import add_columns
from prepkit.operators.pixels import IMAGE_MEAN, IMAGE_STD, PixelSpec, gray_to_rgb, normalise, to_pixels
from prepkit.sources import images

rng = np.random.default_rng(0)
RGB = rng.integers(0, 256, (3, 4, 3), dtype=np.uint8)
GREY = rng.integers(0, 256, (2, 2, 1), dtype=np.uint8)
RGBA = rng.integers(0, 256, (2, 2, 4), dtype=np.uint8)


def filtered_png(pixels, kinds):
    """A PNG whose lines use the given filters."""
    height, width, step = pixels.shape
    lines, above = b"", np.zeros(width * step, int)
    for row, kind in enumerate(kinds):
        line = pixels[row].reshape(-1).astype(int)
        left = np.concatenate([np.zeros(step, int), line[:-step]])
        corner = np.concatenate([np.zeros(step, int), above[:-step]])
        if kind == 4:
            p = left + above - corner
            d = np.stack([abs(p - left), abs(p - above), abs(p - corner)])
            guess = np.choose(d.argmin(axis=0), [left, above, corner])
        else:
            guess = [0 * line, left, above, (left + above) // 2][kind]
        lines += bytes([kind]) + ((line - guess) % 256).astype(np.uint8).tobytes()
        above = line

    def part(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    header = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[step], 0, 0, 0)
    return SIGNATURE + part(b"IHDR", header) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


@pytest.mark.parametrize("pixels", [RGB, GREY, RGBA])
def test_png_round_trip(pixels):
    assert np.array_equal(decode_png(encode_png(pixels)), pixels)


@pytest.mark.parametrize("step", [1, 3, 4])
def test_png_filters(step):
    pixels = rng.integers(0, 256, (10, 6, step), dtype=np.uint8)
    assert np.array_equal(decode_png(filtered_png(pixels, [0, 1, 2, 3, 4, 4, 3, 2, 1, 0])), pixels)


def test_png_filters_of_large_images_are_fast():
    pixels = np.random.default_rng(1).integers(0, 256, (224, 224, 3), dtype=np.uint8)
    content = filtered_png(pixels, [4, 3] * 112)
    start = time.process_time()
    assert np.array_equal(decode_png(content), pixels)
    assert time.process_time() - start < 0.25


def test_other_formats_are_not_taken_for_bad_images():
    with pytest.raises(RuntimeError, match="imaging library"):
        images.decode_cell(b"\xff\xd8\xff\xe0 a photo", decode_png)
    assert images.decode_cell(b"text", decode_png)[1] == "decode: not a PNG image"


def test_bad_addresses_are_reasons(spark):
    urls = ["http://localhost/a name", "data:broken", "no scheme", None]
    df = spark.createDataFrame(list(enumerate(urls)), "id int, url string")
    got = {r["id"]: r["error"] for r in images.fetch(df, "url").collect()}
    assert got == {0: "fetch: InvalidURL", 1: "fetch: ValueError", 2: "fetch: ValueError", 3: "no url"}


def test_png_damage():
    good = encode_png(RGB)
    broken = bytearray(good)
    broken[45] ^= 255
    header = b"IHDR" + good[16:28]
    short = good[:8] + struct.pack(">I", 12) + header + struct.pack(">I", zlib.crc32(header)) + good[33:]
    with pytest.raises(ValueError, match="damaged"):
        decode_png(short)
    for bad in (b"", b"text", good[:30], bytes(broken)):
        with pytest.raises(ValueError):
            decode_png(bad)


def test_resize_weights():
    for resample in ("nearest", "bilinear", "bicubic"):
        for old, new in ((8, 4), (4, 8), (5, 3), (7, 7)):
            assert np.allclose(axis_weights(old, new, resample).sum(axis=1), 1)
        assert np.allclose(axis_weights(7, 7, resample), np.eye(7))
    flat = np.full((6, 9, 3), 77, dtype=np.uint8)
    assert np.allclose(resize(flat, 4, 5, "bicubic"), 77)
    assert np.array_equal(resize(GREY, 4, 4, "nearest"), np.kron(GREY[:, :, 0], np.ones((2, 2)))[:, :, None])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("images")
    files = {"a_rgb": encode_png(RGB), "b_grey": encode_png(GREY), "c_rgba": encode_png(RGBA), "d_bad": encode_png(RGB)[:30]}
    for name, content in files.items():
        (path / f"{name}.png").write_bytes(content)
    return path, files


def expected(pixels):
    if pixels.shape[2] == 1:
        pixels = np.repeat(pixels, 3, axis=2)
    return ((pixels / 255 - IMAGE_MEAN) / IMAGE_STD).transpose(2, 0, 1).reshape(-1)


def test_folder_source(spark, folder):
    path, _ = folder
    rows = {r["origin"].rsplit("/", 1)[1][0]: r for r in images.read_image_folder(spark, f"file:{path}").collect()}
    for name, pixels in (("a", RGB), ("b", GREY), ("c", RGBA)):
        image = rows[name]["image"]
        assert (image["height"], image["width"], image["channels"]) == pixels.shape
        if name != "c":
            assert bytes(image["data"]) == pixels.tobytes()
    assert rows["d"]["image"] is None and rows["d"]["error"]
    assert images.read_image_folder(spark, f"file:{path}", drop_invalid=True).count() == 3


def test_urls_keep_every_row(spark, folder):
    path, files = folder
    urls = [f"file:{path}/{name}.png" for name in files] + [f"file:{path}/missing.png", None, "data:oops", "no url"]
    urls.append("data:image/png;base64," + base64.b64encode(files["b_grey"]).decode())
    df = spark.createDataFrame(list(enumerate(urls)), "k int, url string")
    rows = images.load_images(df, "url", partitions=3).orderBy("k").collect()
    assert [r["error"] is None for r in rows] == [True, True, True, False, False, False, False, False, True]
    assert rows[3]["error"].startswith("decode") and rows[4]["error"].startswith("fetch") and rows[5]["error"] == "no url"
    assert bytes(rows[0]["image"]["data"]) == RGB.tobytes() and bytes(rows[8]["image"]["data"]) == GREY.tobytes()


def test_unreachable_host_is_an_error_row(spark):
    df = spark.createDataFrame([(0, "http://127.0.0.1:9/none")], "k int, url string")
    row = images.fetch(df, "url", timeout_s=0.2).first()
    assert row["content"] is None and row["error"].startswith("fetch")


def test_pixels_and_rejects(spark, folder):
    _, files = folder
    cells = [files["a_rgb"], files["b_grey"], files["c_rgba"], files["d_bad"], None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "k int, content binary")
    fused = to_pixels(df, PixelSpec(), "content").orderBy("k").collect()
    staged = to_pixels(images.decode_images(df), PixelSpec()).orderBy("k").collect()
    for rows in (fused, staged):
        assert np.allclose(rows[0]["pixel_values"], expected(RGB), atol=1e-6)
        assert (rows[0]["channels"], rows[0]["height"], rows[0]["width"]) == (3, 3, 4)
        assert np.allclose(rows[1]["pixel_values"], expected(GREY), atol=1e-6)
        assert rows[2]["pixel_values"] is None and rows[2]["error"] == "pixels: 4 channels"
        assert rows[3]["error"].startswith("decode") and rows[4]["error"] == "no content"
    sized = to_pixels(df, PixelSpec(height=5, width=6), "content").where("k = 0").first()
    assert len(sized["pixel_values"]) == 3 * 5 * 6


def test_filter_does_not_decode_twice(spark, folder):
    df = spark.createDataFrame([(0, folder[1]["a_rgb"])], "k int, content binary")
    kept = to_pixels(df, PixelSpec(), "content").where("pixel_values is not null")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_column_expressions(spark):
    df = spark.createDataFrame([([10, 20],)], "px array<int>")
    row = df.select(
        gray_to_rgb(F.col("px")).alias("grey"),
        gray_to_rgb(F.col("px"), 3).alias("kept"),
        normalise(gray_to_rgb(F.col("px")), PixelSpec()).alias("norm"),
    ).first()
    assert row["grey"] == [10, 10, 10, 20, 20, 20] and row["kept"] == [10, 20]
    want = (np.array([[10] * 3, [20] * 3]) / 255 - IMAGE_MEAN) / IMAGE_STD
    assert np.allclose(row["norm"], want.reshape(-1))


def test_spec_checks():
    for bad in ({"resample": "lanczos"}, {"height": 3}):
        with pytest.raises(ValueError):
            PixelSpec(**bad)


def test_large_results_leave_in_small_batches(spark):
    df = spark.range(40, numPartitions=1).withColumn("text", F.lit("x" * 100))

    def grow(cells):
        for (text,) in cells:
            yield text * 10, len(text)

    got = add_columns(df, ["text"], "long string, n int", grow, max_bytes=2500)
    assert got.where("long <> repeat('x', 1000) or n <> 100").count() == 0
    assert [r["id"] for r in got.collect()] == list(range(40))
    assert add_columns(df.limit(0), ["text"], "long string, n int", grow).count() == 0


def test_dripping_and_endless_bodies_are_given_up(spark, monkeypatch):
    class Body:
        def __init__(self, block, wait):
            self.block, self.wait = block, wait

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read1(self, n):
            import time

            time.sleep(self.wait)
            return self.block

    def opened(address, timeout):
        return Body(b"x", 0.01) if "drip" in address else Body(b"x" * 60_000, 0)

    monkeypatch.setattr(images, "open_url", opened)
    df = spark.createDataFrame([(0, "http://a/drip"), (1, "http://b/endless")], "id int, url string")
    start = time.monotonic()
    got = {r["id"]: (r["content"], r["error"]) for r in images.fetch(df, "url", deadline_s=0.5, max_bytes=10**6).collect()}
    assert got == {0: (None, "fetch: deadline"), 1: (None, "fetch: body too large")}
    assert time.monotonic() - start < 20


@pytest.mark.parametrize("host_requests", [None, 2])
def test_a_shared_url_is_asked_once(spark, monkeypatch, tmp_path, host_requests):
    """A third of all rows share a URL; every request leaves a file behind."""
    import io

    folder = str(tmp_path)

    def opened(address, timeout):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as handle:
            handle.write(address)
        return io.BytesIO(address.encode())

    monkeypatch.setattr(images, "open_url", opened)
    monkeypatch.setattr(images, "ROWS_PER_COPY", 7)
    urls = [None if k % 10 == 9 else "http://h/hot" if k % 3 == 0 else f"http://h/{k // 2}" for k in range(120)]
    df = spark.createDataFrame(list(enumerate(urls)), "id int, url string")
    got = {r["id"]: (r["content"], r["error"]) for r in images.fetch_once(df, "url", host_requests=host_requests).collect()}
    assert got == {k: (None, "no url") if u is None else (u.encode(), None) for k, u in enumerate(urls)}
    asked = sorted(p.read_text() for p in tmp_path.iterdir())
    assert asked == sorted({u for u in urls if u})


def test_an_image_is_decoded_once_where_nothing_is_shuffled(spark, tmp_path):
    from prepkit.config import ImageClassJob
    from prepkit.plans.images import image_prepare

    df = spark.createDataFrame([(1, encode_png(RGB), "a")], "id int, image binary, label string")
    job = ImageClassJob(key_column_name="id", image_column_name="image", label_column_name="label")
    plan = image_prepare(df, job)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") + plan.count("MapInArrow") + plan.count("ArrowEvalPython") == 1
