"""GeoTIFF files that the test writes itself, byte by byte."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.functions.geometry import southwards
from terrace.operators import tiles, zonal
from terrace.sources import geotiff
from tests.test_zonal import box, zones

CODE = {"u1": (8, 1), "u2": (16, 1), "i2": (16, 2), "u4": (32, 1)}


def write(path, cells, kind="u1", order="<", tile=None, strip=None, deflate=False, predictor=1, big=False, hole=None, samples=1):
    """Tags, then blocks; offsets are 4 or 8 bytes."""
    height, width = cells.shape
    bh, bw = tile or (strip or height, width)
    blocks, cast = [], np.dtype(order + kind)
    for k, (r, c) in enumerate((r, c) for r in range(0, height, bh) for c in range(0, width, bw)):
        part = cells[r : r + bh, c : c + bw]
        if tile:
            part = np.pad(part, ((0, bh - part.shape[0]), (0, bw - part.shape[1])), constant_values=77)
        part = part.astype(cast.newbyteorder("="))
        if predictor == 2:
            part = np.diff(part, axis=1, prepend=part.dtype.type(0)).astype(part.dtype)
        data = part.astype(cast).tobytes()
        blocks.append(b"" if k == hole else zlib.compress(data) if deflate else data)
    long, wide = ("Q", 16) if big else ("I", 4)
    bits, form = CODE[kind]
    scale, tie = struct.pack(order + "3d", 30, 30, 0), struct.pack(order + "6d", 0, 0, 0, -600, 5000, 0)
    keys = struct.pack(order + "8H", 1, 1, 0, 1, 3072, 0, 1, 5070)
    start = 16 if big else 8
    body, at = b"", []
    for b in blocks:
        at.append(start + len(body))
        body += b
    number = lambda *v: (wide, len(v), struct.pack(f"{order}{len(v)}{long}", *v))
    short = lambda *v: (3, len(v), struct.pack(f"{order}{len(v)}H", *v))
    tags = {256: number(width), 257: number(height), 258: short(bits), 259: short(8 if deflate else 1), 277: short(samples), 317: short(predictor), 339: short(form), 33550: (12, 3, scale), 33922: (12, 6, tie), 34735: (3, 8, keys), 42113: (2, 4, b"255\0")}
    tags |= {322: number(bw), 323: number(bh), 324: number(*at), 325: number(*map(len, blocks))} if tile else {273: number(*at), 278: number(bh), 279: number(*map(len, blocks))}
    entries, room = b"", 8 if big else 4
    for tag, (t, n, data) in sorted(tags.items()):
        if len(data) > room:
            where = struct.pack(order + long, start + len(body))
            body += data
        else:
            where = data.ljust(room, b"\0")
        entries += struct.pack(order + "HH" + long, tag, t, n) + where
    table = start + len(body)
    head = (b"II" if order == "<" else b"MM") + (struct.pack(order + "HHHQ", 43, 8, 0, table) if big else struct.pack(order + "HI", 42, table))
    path.write_bytes(head + body + struct.pack(order + ("Q" if big else "H"), len(tags)) + entries + struct.pack(order + long, 0))
    return str(path)


def raster(height, width, most=6, seed=2):
    return np.random.default_rng(seed).integers(0, most, (height, width))


def read(df, height, width):
    out = np.full((height, width), -1)
    for r in tiles.cells(df).where(f"row < {height} and col < {width}").collect():
        assert out[r["row"], r["col"]] == -1
        out[r["row"], r["col"]] = r["val"]
    return out


@pytest.mark.parametrize(
    "how",
    [dict(), dict(strip=7), dict(strip=1, order=">"), dict(tile=(64, 64)), dict(tile=(128, 128), deflate=True, predictor=2), dict(tile=(16, 48), kind="u2", order=">", predictor=2), dict(tile=(80, 80), big=True, deflate=True), dict(strip=50, kind="i2", deflate=True), dict(tile=(32, 32), kind="u4", big=True, order=">")],
)
def test_files_of_many_kinds(spark, tmp_path, how):
    cells = raster(150, 205, 200 if how.get("kind") is None else 30_000)
    path = write(tmp_path / "r.tif", cells, **how)
    assert (read(geotiff.tiles(spark, path), 150, 205) == cells).all()
    window = (70, 66, 40, 30)
    part = geotiff.tiles(spark, path, window)
    out = read(part, 150, 205)
    assert (out[70:110, 66:96] == cells[70:110, 66:96]).all() and set(np.unique(out[out >= 0])) <= set(np.unique(cells))


def test_windows_read_few_blocks(spark, tmp_path):
    cells = raster(640, 640)
    path = write(tmp_path / "r.tif", cells, tile=(64, 64))
    assert geotiff.tiles(spark, path, (64, 0, 64, 64)).select("trow").distinct().count() == 1
    assert geotiff.tiles(spark, path, (64, 0, 64, 64)).rdd.getNumPartitions() == 1 and geotiff.tiles(spark, path).rdd.getNumPartitions() == 10


def test_metadata(spark, tmp_path, monkeypatch):
    cells = raster(150, 205)
    cells[140, 200], cells[0, 0] = 9, 255
    path = write(tmp_path / "r.tif", cells, tile=(64, 64), hole=1)
    cells[:64, 64:128] = 0  # a block that was never written
    assert (read(geotiff.tiles(spark, path), 150, 205) == cells).all()
    meta = geotiff.metadata(spark, path)
    assert meta == {"width": 205, "height": 150, "count": 1, "dtype": "uint8", "crs": 5070, "bounds": (-600.0, 500.0, 5550.0, 5000.0), "nodata": 255.0, "resolution": (30.0, 30.0), "total_pixels": 30750, "memory_mb": 30750 / 2**20, "unique_values": [0, 1, 2, 3, 4, 5, 9], "sampled": False}
    monkeypatch.setattr(geotiff, "MOST_CELLS", 1000)
    monkeypatch.setattr(geotiff, "CORNER", 100)
    assert geotiff.metadata(spark, path)["unique_values"] == [0, 1, 2, 3, 4, 5]
    rows = zones(spark, (1.0, [box(0, 600, 30, 630)]), (1.0, [box(9000, 0, 9030, 30)]), (1.0, None))
    fits = geotiff.compatible(meta, rows, 4326)
    assert (fits["same_crs"], fits["zones"], fits["zones_on_raster"], fits["overlap"], fits["zone_bounds"]) == (False, 2, 1, True, (0, 0, 9030, 630))
    assert not geotiff.compatible(meta, rows.where("false"))["overlap"] and geotiff.compatible(meta, rows, 5070)["same_crs"]


def test_zonal_over_a_file(spark, tmp_path):
    cells = raster(150, 205)
    path, rng = write(tmp_path / "r.tif", cells, tile=(64, 64), deflate=True), random.Random(1)
    head = geotiff.header(path)
    shapes = [(c, r, rng.randint(1, 9), rng.randint(1, 9)) for c, r in ((rng.randint(0, 190), rng.randint(0, 130)) for _ in range(20))]
    # north is up in the zones: the cell (row, col) lies below 5000 and right of -600
    rows = zones(spark, *[(1.0, [box(-600 + 30 * c, 5000 - 30 * (r + h), -600 + 30 * (c + w), 5000 - 30 * r)]) for c, r, w, h in shapes])
    got = zonal.zonal(rows.withColumn("rings", southwards(F.col("rings"), head.north)), geotiff.tiles(spark, path), head.grid, "center").collect()
    for x in got:
        c, r, w, h = shapes[int(x["zone"])]
        part = cells[r : r + h, c : c + w]
        assert x["total_pixels"] == (part > 0).sum() and abs(x["forest_pct"] - 100 * (part == 3).sum() / max(1, (part > 0).sum())) < 1e-9


def test_what_is_not_read(spark, tmp_path):
    (tmp_path / "no.tif").write_bytes(b"no TIFF file at all")
    with pytest.raises(ValueError, match="no TIFF"):
        geotiff.header(str(tmp_path / "no.tif"))
    with pytest.raises(ValueError, match="one band"):
        geotiff.header(write(tmp_path / "r.tif", raster(10, 10), samples=3))
