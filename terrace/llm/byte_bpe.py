"""Byte-level BPE encoding and decoding (two-tier lookup)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .tokens import ByteBPE, map_tool


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds ids (binary: little-endian unsigned 32-bit) and n_tokens (long) for every whole text.

    Null and empty texts: no ids. The rows, repeated ones too, stay as they are; columns of these names are replaced.
    Whole pre-tokens of the vocabulary are found through a minimal perfect hash; the others are merged byte by byte.
    """
    return map_tool(docs, (ByteBPE, ranks, pattern), lambda bpe, value: (ids := bpe.encode(value or ""), len(ids) // 4), [text], [("ids", T.BinaryType()), ("n_tokens", T.LongType())])


def decode(rows: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds decoded (binary), the bytes that ids stand for; null ids: empty."""
    return map_tool(rows, (ByteBPE, ranks, pattern), lambda bpe, value: (bpe.decode(value or b""),), [ids], [("decoded", T.BinaryType())])


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """encode() and then decode(), without the text, by one Python worker a task: texts go to Python once and do not come back."""

    def one(bpe: ByteBPE, value: str | None) -> tuple[bytes, int, bytes]:
        ids = bpe.encode(value or "")
        return ids, len(ids) // 4, bpe.decode(ids)

    return map_tool(docs, (ByteBPE, ranks, pattern), one, [text], [("ids", T.BinaryType()), ("n_tokens", T.LongType()), ("decoded", T.BinaryType())], drop=(text,))


def digests(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
