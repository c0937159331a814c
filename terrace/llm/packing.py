"""Packing: concatenate and cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import numbered_map, slices, text_rows, with_offsets
from .tokens import Library, tool

PIECES = T.StructType([T.StructField(n, T.BinaryType() if n == "ids" else T.BooleanType() if n == "crosses" else T.LongType()) for n in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "crosses")])


def narrow(ids: bytes) -> bytes:
    """Ids as 16-bit integers where all fit, marked by a leading byte."""
    wide = np.frombuffer(ids, "<u4")
    return b"\x02" + wide.astype("<u2").tobytes() if not len(wide) or wide.max() < 1 << 16 else b"\x04" + ids


def widen(packed: bytes) -> bytes:
    return np.frombuffer(packed, "<u2", offset=1).astype("<u4").tobytes() if packed[0] == 2 else packed[1:]


def encoded(docs: DataFrame, tokenizer: str, cut: str, end_id: int) -> DataFrame:
    """doc_id, packed (ids of the whole text with end_id last, by narrow()) and n_tokens, numbered: encoded and counted by one Python worker a task."""
    end = np.uint32(end_id).tobytes()

    def one(lib: Library, text: str) -> tuple[bytes, int]:
        ids = lib.encode(text) + end
        return narrow(ids), len(ids) // 4

    fields = [("packed", T.BinaryType()), ("n_tokens", T.LongType())]
    return numbered_map(text_rows(docs), "n_tokens", "packing", one, ["text"], fields, setup=lambda: tool(Library, tokenizer, cut), drop=("text",))


def pack(docs: DataFrame, tokenizer: str, cut: str = "space", end_id: int = 1, window: int = 2048) -> DataFrame:
    """Lays all documents end to end and cuts the stream every window tokens: a row for each piece of a document.

    doc_id, start (tokens of the document before the piece), length, ids (binary), doc_tokens, sequence_id, offset (in the sequence), crosses (the document goes on in another sequence).
    First pass: tokens are written out with the count before each row of its part; the parts' totals, summed up, give every document's place. Second pass: each document is cut where windows end. Only the last sequence is short of window tokens.
    Null and empty texts are a piece of the end id alone; repeated rows are documents of their own; an empty table has no pieces; other columns are left out.
    """
    rows = with_offsets(encoded(docs, tokenizer, cut, end_id), "n_tokens", "place")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: list[list] = [[] for _ in PIECES]
                for doc, packed, n, place in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    ids, at = widen(packed), place
                    while at < place + n:
                        stop = min((at // window + 1) * window, place + n)
                        for column, value in zip(out, (doc, at - place, stop - at, ids[4 * (at - place) : 4 * (stop - place)], n, at // window, at % window, stop - at < n), strict=True):
                            column.append(value)
                        at = stop
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if f.name == "ids" else pa.bool_() if f.name == "crosses" else pa.int64()) for c, f in zip(out, PIECES, strict=True)], names=PIECES.names)

    return rows.select("doc_id", "packed", "n_tokens", "place").mapInArrow(pieces, PIECES)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "crosses")
