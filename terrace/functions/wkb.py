"""Rings to well-known binary and back. Encoding is a Spark expression; decoding, where lengths lie in the data, is done in Arrow batches."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .geometry import RINGS, parts

POLYGON, MULTIPOLYGON = 3, 6


def _double(value: Column) -> Column:
    """Eight bytes, big-endian, as hexadecimal digits: sign, exponent and fraction by arithmetic."""
    size = F.abs(value)
    guess = F.floor(F.log2(F.when(size == 0, 1.0).otherwise(size)))
    # log2 can be off by one next to powers of two
    exponent = guess + F.when(size >= F.pow(F.lit(2.0), guess + 1), 1).when(size < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    fraction = ((size / F.pow(F.lit(2.0), exponent) - 1) * float(1 << 52)).cast("long")
    bits = F.call_function("shiftleft", (exponent + 1023).cast("long"), F.lit(52)).bitwiseOR(fraction)
    signed = F.when(value < 0, bits.bitwiseOR(F.lit(-(1 << 63)))).otherwise(bits)
    return F.lpad(F.hex(F.when(size == 0, F.lit(0).cast("long")).otherwise(signed)), 16, "0")


def _count(n: Column) -> Column:
    return F.lpad(F.hex(n.cast("long")), 8, "0")


def encode(rings: Column) -> Column:
    """A polygon of these rings, or a multipolygon where they make several parts (big-endian; each ring closed by its first point); null stays null. Ordinary finite doubles only."""
    ring = lambda r: F.concat(_count(F.size(r) + 1), F.array_join(F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.concat(_double(p["x"]), _double(p["y"]))), ""))
    polygon = lambda rs: F.concat(F.lit(f"00{POLYGON:08X}"), _count(F.size(rs)), F.array_join(F.transform(rs, ring), ""))
    many = lambda ps: F.concat(F.lit(f"00{MULTIPOLYGON:08X}"), _count(F.size(ps)), F.array_join(F.transform(ps, polygon), ""))
    # of one ring there is one part; the others are sorted into parts first
    several = F.aggregate(F.array(parts(rings)), F.lit(None).cast("string"), lambda _, ps: F.when(F.size(ps) == 1, polygon(F.get(ps, F.lit(0)))).otherwise(many(ps)))
    return F.unhex(F.when(F.size(rings) <= 1, polygon(rings)).otherwise(several))


def parse(data: bytes | None) -> list[list[dict]] | None:
    """Rings of a polygon or multipolygon (those of all its parts, one after the other), without the closing points. Other kinds, and bytes that end too soon: None."""
    if data is None:
        return None
    at, rings = 0, []

    def read(form: str) -> tuple:
        nonlocal at
        values = struct.unpack_from(order + form, data, at)
        at += struct.calcsize(order + form)
        return values

    try:
        todo = 1
        while todo:
            todo -= 1
            order = "<" if data[at] else ">"
            at += 1
            (kind,) = read("I")
            if kind & 0x20000000:  # an id of the reference system follows
                read("I")
            wide = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000) + (0, 1, 1, 2)[(kind & 0xFFFF) // 1000 % 4]
            kind = (kind & 0xFFFF) % 1000
            (n,) = read("I")
            if kind == MULTIPOLYGON:
                todo += n
            elif kind == POLYGON:
                for _ in range(n):
                    (points,) = read("I")
                    flat = read(f"{points * wide}d")
                    ring = list(zip(flat[::wide], flat[1::wide], strict=True))
                    ring = ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring
                    rings.append([{"x": x, "y": y} for x, y in ring])
            else:
                return None
    except (struct.error, IndexError):
        return None
    return rings


def decode(df: DataFrame, geometry: str = "geometry", out: str = "rings") -> DataFrame:
    """The columns of df without geometry, and out, its rings. What is no polygon gives null."""
    rest = [f for f in df.schema.fields if f.name not in (geometry, out)]
    schema = T.StructType([*rest, T.StructField(out, T._parse_datatype_string(RINGS))])
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rings = pa.array([parse(x) for x in part.column(len(rest)).to_pylist()], kinds.field(out).type)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], rings], names=schema.names)

    return df.select(*[df[f"`{f.name}`"] for f in rest], df[f"`{geometry}`"].alias("__wkb")).mapInArrow(run, schema)
