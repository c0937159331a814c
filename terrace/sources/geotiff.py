"""Rasters from GeoTIFF files, as tiles: the header is read once by the driver, blocks by tasks that each take a band of them."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..config import Grid
from ..operators.tiles import SIDE, cells

SCHEMA = "trow long, tcol long, vals array<int>"
#: Cells across that one task takes, where blocks let it.
ACROSS = 4096
#: Up to so many cells, distinct values come from all of them, beyond from the upper left corner of so many cells a side.
MOST_CELLS, CORNER = 100_000_000, 1000

# TIFF tags, field types (format, bytes) and compressions.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_BYTES, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES, FORMAT, SCALE, TIEPOINT, GEO_KEYS, NO_DATA = 256, 257, 258, 259, 273, 277, 278, 279, 317, 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
TYPES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 6: ("b", 1), 7: ("s", 1), 8: ("h", 2), 9: ("i", 4), 11: ("f", 4), 12: ("d", 8), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
PLAIN, DEFLATE = 1, (8, 32946)
PROJECTED, GEOGRAPHIC = 3072, 2048


@dataclass(frozen=True)
class Header:
    """What the first image of a file says. Blocks are tiles, or strips as wide as the raster."""

    width: int
    height: int
    dtype: str
    compression: int
    predictor: int
    block_width: int
    block_height: int
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]
    cell: tuple[float, float] = (1.0, 1.0)
    west: float = 0.0
    north: float = 0.0
    nodata: float | None = None
    crs: int | None = None

    @property
    def across(self) -> int:
        return -(-self.width // self.block_width)

    @property
    def grid(self) -> Grid:
        """Cells with y running down from the northern end: zones take geometry.southwards(rings, north) to meet them."""
        if abs(self.cell[0] - self.cell[1]) > 1e-9 * self.cell[0]:
            raise ValueError("cells are not squares")
        return Grid(self.width, self.height, self.cell[0], self.west, 0.0)


def opened(path: str):
    """The file system and the path in it; plain paths are local ones."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def header(path: str) -> Header:
    """Of classic and BigTIFF files of one band, of either byte order; raises for what the reader can't take."""
    files, at = opened(path)
    with files.open_input_file(at) as file:

        def read(where: int, size: int) -> bytes:
            file.seek(where)
            return file.read(size)

        start = read(0, 16)
        order = {b"II": "<", b"MM": ">"}.get(start[:2])
        version = struct.unpack_from(order + "H", start, 2)[0] if order else 0
        if version not in (42, 43):
            raise ValueError(f"{path} is no TIFF file")
        big = version == 43
        first = struct.unpack_from(order + ("Q" if big else "I"), start, 8 if big else 4)[0]
        count_form, entry, inline = ("Q", 20, 8) if big else ("H", 12, 4)
        n = struct.unpack(order + count_form, read(first, struct.calcsize(count_form)))[0]
        table = read(first + struct.calcsize(count_form), n * entry)
        tags: dict[int, tuple] = {}
        for k in range(n):
            tag, kind = struct.unpack_from(order + "HH", table, k * entry)
            (count,) = struct.unpack_from(order + ("Q" if big else "I"), table, k * entry + 4)
            if kind not in TYPES:
                continue
            form, size = TYPES[kind]
            spot = k * entry + (12 if big else 8)
            data = table[spot : spot + inline] if size * count <= inline else read(struct.unpack_from(order + ("Q" if big else "I"), table, spot)[0], size * count)
            tags[tag] = struct.unpack_from(f"{order}{count}s", data) if form == "s" else struct.unpack_from(f"{order}{count * len(form)}{form[0]}", data)
    one = lambda tag, other=None: tags[tag][0] if tag in tags else other
    bits, kind = one(BITS, 1), one(FORMAT, 1)
    if one(SAMPLES, 1) != 1 or bits not in (8, 16, 32) or kind not in (1, 2) or one(COMPRESSION, 1) not in (PLAIN, *DEFLATE) or one(PREDICTOR, 1) not in (1, 2):
        raise ValueError(f"{path}: one band of whole numbers of 8, 16 or 32 bits, plain or deflated, is all that is read")
    tiled = TILE_AT in tags
    scale, tie, keys = tags.get(SCALE, (1.0, 1.0)), tags.get(TIEPOINT, (0.0,) * 6), tags.get(GEO_KEYS, ())
    named = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    nodata = tags[NO_DATA][0].split(b"\0")[0].strip() if NO_DATA in tags else b""
    return Header(one(WIDTH), one(HEIGHT), f"{order}{'u' if kind == 1 else 'i'}{bits // 8}", one(COMPRESSION, 1), one(PREDICTOR, 1), one(TILE_WIDTH) if tiled else one(WIDTH), one(TILE_HEIGHT) if tiled else min(one(STRIP_ROWS, one(HEIGHT)), one(HEIGHT)), tags[TILE_AT if tiled else STRIP_AT], tags[TILE_BYTES if tiled else STRIP_BYTES], (scale[0], scale[1]), tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], float(nodata) if nodata else None, named.get(PROJECTED, named.get(GEOGRAPHIC)))


def block(data: bytes, head: Header, rows: int) -> np.ndarray:
    """The cells of a block of so many rows."""
    raw = data if head.compression == PLAIN else zlib.decompress(data)
    out = np.frombuffer(raw, head.dtype, rows * head.block_width).reshape(rows, head.block_width)
    # differences to the cell on the left, which wrap around
    return np.cumsum(out, axis=1, dtype=out.dtype.newbyteorder("=")) if head.predictor == 2 else out


@dataclass
class Band(InputPartition):
    """Rows and columns that a task makes tiles of, and the blocks that hold them: (row, column, offset, bytes) each."""

    top: int
    left: int
    rows: int
    cols: int
    blocks: list[tuple[int, int, int, int]]

    def __init__(self, top: int, left: int, rows: int, cols: int, blocks: list[tuple[int, int, int, int]]):
        super().__init__(top)
        self.top, self.left, self.rows, self.cols, self.blocks = top, left, rows, cols, blocks


class Reader(DataSourceReader):
    def __init__(self, path: str, window: tuple[int, int, int, int] | None):
        self.path, self.head, self.window = path, header(path), window

    def partitions(self) -> list[Band]:
        head = self.head
        up = lambda n: -(-n // SIDE) * SIDE
        high = up(head.block_height)
        wide = up(head.block_width * max(1, ACROSS // head.block_width))
        row, col, rows, cols = self.window or (0, 0, head.height, head.width)
        out = []
        for top in range(row // high * high, min(row + rows, head.height), high):
            for left in range(col // wide * wide, min(col + cols, head.width), wide):
                down = range(top // head.block_height, -(-min(top + high, head.height) // head.block_height))
                right = range(left // head.block_width, -(-min(left + wide, head.width) // head.block_width))
                out.append(Band(top, left, min(high, head.height - top), min(wide, head.width - left), [(r * head.block_height, c * head.block_width, head.offsets[r * head.across + c], head.sizes[r * head.across + c]) for r in down for c in right]))
        # what tasks need of the header
        self.head = Header(**(head.__dict__ | {"offsets": (), "sizes": ()}))
        return out or [Band(0, 0, 0, 0, [])]

    def read(self, partition: Band) -> Iterator[pa.RecordBatch]:
        head, band = self.head, partition
        if not band.rows:
            return
        held = np.zeros((-(-band.rows // SIDE) * SIDE, -(-band.cols // SIDE) * SIDE), np.int32)
        files, at = opened(self.path)
        with files.open_input_file(at) as file:
            for row, col, offset, size in band.blocks:
                if not size:  # a block that was never written has no data
                    continue
                file.seek(offset)
                tiled = head.block_width != head.width
                found = block(file.read(size), head, head.block_height if tiled else min(head.block_height, head.height - row))
                top, left = max(row, band.top), max(col, band.left)
                bottom, right = min(row + len(found), band.top + band.rows), min(col + head.block_width, band.left + band.cols)
                held[top - band.top : bottom - band.top, left - band.left : right - band.left] = found[top - row : bottom - row, left - col : right - col]
        for r in range(0, len(held), SIDE):
            parts = held[r : r + SIDE].reshape(SIDE, -1, SIDE).swapaxes(0, 1).reshape(-1)
            n = len(parts) // SIDE**2
            vals = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * SIDE**2), pa.array(parts))
            yield pa.RecordBatch.from_arrays([pa.array([(band.top + r) // SIDE] * n, pa.int64()), pa.array(range(band.left // SIDE, band.left // SIDE + n), pa.int64()), vals], names=["trow", "tcol", "vals"])


class GeoTiff(DataSource):
    """spark.read.format("geotiff").load(path): tiles of the first band. Options row, col, rows and cols: only blocks that hold cells of this window are read."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        names = ("row", "col", "rows", "cols")
        return Reader(self.options["path"], tuple(int(self.options[n]) for n in names) if all(n in self.options for n in names) else None)


def tiles(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Tiles of a file, or of the blocks that hold a window (first row, first column, rows, columns; see tiles.window_of). A strip that is the whole raster is one task's."""
    spark.dataSource.register(GeoTiff)
    asked = spark.read.format("geotiff")
    for name, value in zip(("row", "col", "rows", "cols"), window or (), strict=False):
        asked = asked.option(name, str(value))
    return asked.load(path)


def metadata(spark: SparkSession, path: str) -> dict:
    """What the header says, and the distinct values other than the file's own no-data value: of all cells, or, of a raster of 10^8 cells or more, of its upper left corner."""
    head = header(path)
    n, whole = head.width * head.height, head.width * head.height < MOST_CELLS
    rows, cols = (head.height, head.width) if whole else (min(CORNER, head.height), min(CORNER, head.width))
    found = cells(tiles(spark, path, (0, 0, rows, cols))).where(f"row < {rows} and col < {cols}").select("val").distinct().collect()
    east, south = head.west + head.width * head.cell[0], head.north - head.height * head.cell[1]
    return {"width": head.width, "height": head.height, "count": 1, "dtype": np.dtype(head.dtype).name, "crs": head.crs, "bounds": (head.west, south, east, head.north), "nodata": head.nodata, "resolution": head.cell, "total_pixels": n, "memory_mb": n / (1 << 20), "unique_values": sorted(r["val"] for r in found if head.nodata is None or r["val"] != head.nodata), "sampled": not whole}


def compatible(meta: dict, zones: DataFrame, crs: int | None = None) -> dict:
    """Do zones fit a raster: is the reference system (an EPSG number, where one is given) the same, and how many zones' bounds meet the raster's? Neither stops a run."""
    from ..functions.geometry import with_bounds

    x0, y0, x1, y1 = meta["bounds"]
    meets = f"max_x >= {x0!r} and min_x <= {x1!r} and max_y >= {y0!r} and min_y <= {y1!r}"
    n, met, *ends = with_bounds(zones.select("rings")).selectExpr("count(min_x)", f"count_if({meets})", "min(min_x)", "min(min_y)", "max(max_x)", "max(max_y)").first()
    return {"same_crs": crs is None or meta["crs"] is None or crs == meta["crs"], "raster_bounds": meta["bounds"], "zone_bounds": None if ends[0] is None else tuple(ends), "zones": n, "zones_on_raster": met, "overlap": met > 0}
