"""Assets: content-type choice, image decode audit, executor-side fetch."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ferry.operators.assets import PLACEHOLDER_URL, audit_fetched, audit_images, choose_asset
from ferry.plans.fixtures import png_bytes
from ferry.sources.assets import fetch_urls, read_binary, read_image_sizes, with_image_sizes


def test_choose_asset(spark):
    df = spark.createDataFrame([(1, "u1", "image/png"), (2, "u2", "IMAGE/PNG"), (3, "u3", None),
                                (4, "u4", "text/html")], "id long, url string, ct string")
    got = {r.id: r.asset_url for r in choose_asset(df, "url", "ct").collect()}
    assert got == {1: "u1", 2: PLACEHOLDER_URL, 3: PLACEHOLDER_URL, 4: PLACEHOLDER_URL}


def test_image_audit(spark, tmp_dir):
    files = {"a.png": png_bytes(7, 5), "b.png": png_bytes(1, 1), "t.png": b"text",
             "e.png": b""}
    for n, data in files.items():
        with open(os.path.join(tmp_dir, n), "wb") as f:
            f.write(data)
    manifest = spark.createDataFrame([(1, "a.png"), (2, "b.png"), (3, "t.png"), (4, "e.png"),
                                      (5, "gone.png")], "id long, name string")
    sizes = with_image_sizes(manifest, F.concat(F.lit(tmp_dir + "/"), "name"))
    out = {r.id: (r.status, r.width, r.height, r.asset)
           for r in audit_images(sizes, ["id", "name"], "name").collect()}
    assert out == {1: ("ok", 7, 5, "a.png"), 2: ("ok", 1, 1, "b.png"),
                   3: ("unidentified", None, None, PLACEHOLDER_URL),
                   4: ("unidentified", None, None, PLACEHOLDER_URL),
                   5: ("missing", None, None, PLACEHOLDER_URL)}
    lengths = {r.name: r.length for r in read_binary(spark, tmp_dir).collect()}
    assert lengths["t.png"] == 4 and "e.png" not in lengths


def test_fetch_urls_on_executors(spark, tmp_dir):
    p = os.path.join(tmp_dir, "x.png")
    with open(p, "wb") as f:
        f.write(png_bytes(2, 2))
    df = spark.createDataFrame([(f"file://{p}",), (f"file://{p}",)], "u string")
    ok, = fetch_urls(df, "u").collect()
    assert ok.content_type == "image/png" and ok.content[:4] == b"\x89PNG"


def test_fetch_failures_fail_the_query(spark, tmp_dir):
    for url in (f"file://{tmp_dir}/no.png", "http://127.0.0.1:1/x.png"):
        rows = spark.createDataFrame([(url,)], "u string")
        with pytest.raises(Exception):
            fetch_urls(rows, "u", timeout=1, attempts=1).collect()


def test_storage_failures_fail_the_query(spark, tmp_dir):
    rows = spark.createDataFrame([(1, tmp_dir)], "id long, name string")  # a folder
    with pytest.raises(Exception):
        with_image_sizes(rows, F.col("name")).collect()


def test_audit_fetched_states(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None)],
                                 "id long, url string")
    fetched = spark.createDataFrame(
        [("a", 200, "image/png", 9, 3, 4), ("b", 404, "image/png", 9, 3, 4),
         ("c", 200, "text/html", 9, -1, -1), ("d", 200, "image/png", 0, -1, -1)],
        "url string, http_status int, content_type string, n_bytes long, width int, height int")
    got = {r.id: (r.status, r.width) for r in audit_fetched(rows, fetched, "url").collect()}
    assert got == {1: ("ok", 3), 2: ("ok", 3), 3: ("not_image", None),
                   4: ("unidentified", None), 5: ("missing", None)}


def _jpeg(w, h, app_segments=0):
    app1 = (b"\xff\xe1" + (60000 + 2).to_bytes(2, "big") + b"x" * 60000) * app_segments
    sof = b"\xff\xc0\x00\x11\x08" + h.to_bytes(2, "big") + w.to_bytes(2, "big") + b"\x03" + b"\x00" * 9
    return b"\xff\xd8" + app1 + b"\xff\xdb\x00\x04\x00\x00" + sof + b"\xff\xd9"


def test_header_sizes_match_decode_and_cover_formats(spark, tmp_dir):
    import struct as st
    from ferry.functions.image_header import image_size
    gif = b"GIF89a" + st.pack("<HH", 9, 4) + b"\x00" * 10
    bmp = b"BM" + b"\x00" * 16 + st.pack("<ii", 6, -3) + b"\x00" * 30
    webp = b"RIFF" + b"\x00" * 4 + b"WEBPVP8X" + b"\x00" * 8 + (10 - 1).to_bytes(3, "little") + (20 - 1).to_bytes(3, "little")
    tiff = b"II*\x00" + st.pack("<I", 8) + st.pack("<H", 2) + st.pack(
        "<HHIHH", 256, 3, 1, 33, 0) + st.pack("<HHII", 257, 4, 1, 44)
    cases = {"x.tif": (tiff, (33, 44)), "cut.tif": (tiff[:14], None), "a.png": (png_bytes(7, 5), (7, 5)), "g.gif": (gif, (9, 4)), "b.bmp": (bmp, (6, 3)),
             "w.webp": (webp, (10, 20)), "j.jpg": (_jpeg(640, 480, app_segments=3), (640, 480)),
             "t.png": (b"<html>", None), "cut.jpg": (b"\xff\xd8\xff\xe1\x00", None)}
    for n, (data, want) in cases.items():
        assert image_size(lambda off, k, d=data: d[off:off + k]) == want, n
        with open(os.path.join(tmp_dir, n), "wb") as f:
            f.write(data)
    manifest = spark.createDataFrame([(n,) for n in cases], "name string")
    sizes = with_image_sizes(manifest, F.concat(F.lit(tmp_dir + "/"), "name"))
    got = {r.name: (r._width, r._height) for r in sizes.collect()}
    assert got == {n: (w or (None, None)) for n, (_, w) in cases.items()}
    dec = {r.name: (r.width, r.height) for r in read_image_sizes(spark, tmp_dir).collect()
           if r.name.endswith(".png")}
    assert dec == {"a.png": (7, 5), "t.png": (-1, -1)}


def test_image_keys_are_paths_below_the_root(spark, tmp_dir):
    for sub, (w, h) in {"a": (3, 2), "b": (4, 5)}.items():
        os.makedirs(os.path.join(tmp_dir, sub))
        with open(os.path.join(tmp_dir, sub, "front.png"), "wb") as f:
            f.write(png_bytes(w, h))
    got = {r.name: (r.width, r.height) for r in read_image_sizes(spark, tmp_dir).collect()}
    assert got == {"a/front.png": (3, 2), "b/front.png": (4, 5)}
    assert {r.name for r in read_binary(spark, "file://" + tmp_dir).collect()} == {
        "a/front.png", "b/front.png"}


def test_io_map_keeps_order_local_and_pooled():
    from ferry.sources.assets import _io_map
    assert _io_map(lambda x: x * 2, [1, 2, 3]) == [2, 4, 6]
    urls = [f"https://h/{i}" for i in range(50)]
    assert _io_map(lambda u: u[-2:], urls) == [u[-2:] for u in urls]
