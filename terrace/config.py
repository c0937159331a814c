"""Constants that are part of the results, and settings."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# Fixed values.
CLASSES = {1: "AGRICULTURE", 2: "DEVELOPED", 3: "FOREST", 4: "OTHER", 5: "RANGELAND_PASTURE"}
SQUARE_METRES_AN_ACRE = 4046.86
NODATA = 0
PROPORTION_TOLERANCE = 0.1
TIERS = ((0.22, 10), (1.0, 7), (5.0, 5), (10.0, 5), (50.0, 7))
TIER_ELSE = 10
SIZE_EDGES = (0.0, 0.22, 1.0, 5.0, 10.0, 50.0, 100.0)
ERROR_EDGES = (0.0, 0.5, 1.0, 2.0, 5.0)

PERCENTS = [f"{name.lower()}_pct" for name in CLASSES.values()]


@dataclass(frozen=True)
class Grid:
    """A north-up raster: width and height in cells, cell size, origin (its upper left corner; y runs down in raster space)."""

    width: int
    height: int
    cell: float = 30.0
    origin_x: float = 0.0
    origin_y: float = 0.0

    @property
    def pixel_area(self) -> float:
        return abs(self.cell) * abs(self.cell)


@dataclass(frozen=True)
class Settings:
    """Defaults, each overridden by the environment variable of its name in capitals."""

    chunk_size: int = field(default_factory=lambda: int(os.environ.get("CHUNK_SIZE", 5000)))
    min_chunk: int = field(default_factory=lambda: int(os.environ.get("MIN_CHUNK", 100)))
    chunks_a_commit: int = field(default_factory=lambda: int(os.environ.get("CHUNKS_A_COMMIT", 100)))
    max_chunk: int = field(default_factory=lambda: int(os.environ.get("MAX_CHUNK", 10000)))
    min_valid_pixels: float = field(default_factory=lambda: float(os.environ.get("MIN_VALID_PIXELS", 0.001)))
    output_format: str = field(default_factory=lambda: os.environ.get("OUTPUT_FORMAT", "parquet"))
    compression: str = field(default_factory=lambda: os.environ.get("PARQUET_COMPRESSION", "snappy"))
    sample_seed: int = field(default_factory=lambda: int(os.environ.get("SAMPLE_SEED", 42)))
