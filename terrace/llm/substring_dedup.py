"""Substring dedup by hashing units of texts: whole lines of any length, and runs of units (sentences, lines or paragraphs)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fresh, map_batches, materialize, slices

#: A unit within a line counts only together with its neighbours if it has fewer words. Whole lines count at any length.
LEAST_WORDS = 20
LINE = re.compile(r"\S[^\n]*")
SENTENCE = re.compile(r"(?=\S)[^\n]*?(?:[.!?]+(?=[ \t\n]|\Z)|[。！？]+)|\S[^\n]*")
PARAGRAPH = re.compile(r"\S(?:[^\n]+\n?)*")
#: Scripts without spaces between words (Thai to Lao, Myanmar, Khmer, kana, ideographs): two characters count as a word more.
SPACELESS = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff]")
UNITS = {"line": LINE, "sentence": SENTENCE, "paragraph": PARAGRAPH}
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
OCCURRENCES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("of", T.LongType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("again", T.BooleanType())])


def normalise(unit: str) -> str:
    """Compatibility forms, case and white space do not tell units apart."""
    if not unit.isascii():
        unit = unicodedata.normalize("NFKC", unit)
    return " ".join(unit.lower().split())


def weight(words: str) -> int:
    """Number of words of a normalised unit."""
    return words.count(" ") + 1 + (0 if words.isascii() else len(SPACELESS.findall(words)) // 2)


def lines(text: str, unit: str) -> Iterator[list[tuple[int, int, str, int]]]:
    """(start, end, normalised, words) of the units of each line, or of each paragraph."""
    for outer in UNITS["paragraph" if unit == "paragraph" else "line"].finditer(text):
        inner = UNITS[unit].finditer(text, *outer.span()) if unit == "sentence" else (outer,)
        yield [(*found.span(), words, weight(words)) for found in inner if (words := normalise(found.group()))]


def digest(parts: list[tuple[int, int, str, int]]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(p[2] for p in parts).encode())


def units(text: str, unit: str, least: int = LEAST_WORDS) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of each whole line (paragraph, where that is the unit) that has a letter or digit, and of the shortest runs of units that have `least` words or more. Each span comes once.

    A unit of so many words is a run alone. A shorter one starts a run with the units after it and ends one with the units before it. So each unit of any passage of whole units and `least` words lies in a run within that passage, whatever is around it: a passage that repeats is found whole. A paragraph is its lines, so one that repeats goes with them.
    """
    parts, spans = [], set()
    for line in lines(text, unit):
        parts += line
        if line and any(c.isalnum() for p in line for c in p[2]):
            spans.add((line[0][0], line[-1][1]))
            yield line[0][0], line[-1][1], digest(line)
    first, before, total = 0, -1, 0
    for i, (_, end, _, n) in enumerate(parts):
        total += n
        if total < least:
            continue
        # the shortest run that ends here, and those that reach `least` here for the first time
        while True:
            rest = total - parts[first][3]
            if (rest < least or first > before) and (parts[first][0], end) not in spans:
                yield parts[first][0], end, digest(parts[first : i + 1])
            if rest < least:
                break
            total = rest
            first += 1
        before = first


def occurrences(docs: DataFrame, unit: str, least: int) -> DataFrame:
    """A row for each line and run of units of each text: doc_id, of (digest of the text), digest (96 bits), start, end (code points), again (the text has had it before, and the first ended where this one starts or earlier). Not written out: two passes over the texts cost less than a table of all occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: list[list] = [[], [], [], []]
                ids: list[tuple[int, int]] = []
                for doc, of, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    had: dict[bytes, int] = {}
                    for start, end, of_unit in sorted(units(text or "", unit, least)):
                        ids.append((doc, of))
                        for column, value in zip(out, (of_unit, start, end, had.setdefault(of_unit, end) <= start), strict=True):
                            column.append(value)
                digests = np.frombuffer(b"".join(d[:12] for d in out[0]), [("a", "<i8"), ("b", "<i4")])
                yield pa.RecordBatch.from_arrays([pa.array([i[0] for i in ids], pa.int64()), pa.array([i[1] for i in ids], pa.int64()), pa.array(digests["a"].copy()), pa.array(digests["b"].copy()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.bool_())], names=OCCURRENCES.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("of"), "text").where("doc_id is not null").mapInArrow(run, OCCURRENCES)


def dedup(docs: DataFrame, unit: str = "sentence", least: int = LEAST_WORDS) -> DataFrame:
    """The rows of docs with text cleaned and removed (array of start and end in the text as it was, in code points) added, n_removed beside it.

    Of lines and runs of units with the same digest the one of the least doc_id stays, in a text the first; all others go, with the white space after them. Spans that overlap are one. Of a run that stays, a part can go that also lies in another run: each unit stays somewhere. Digests are grouped with a minimum that each task takes beforehand, so a run in a third of all texts is one row a task.
    Null and empty texts, and rows with a null doc_id, stay as they are, with nothing removed. Rows that repeat an id have equal rank: what they have in common stays in each, and each is cut by its own text. The row of a text stays even if nothing of the text does. Columns named removed and n_removed are replaced, all others stay. An empty table gives no rows. A very long text is one row of its task; its cuts, a start and an end each, are gathered in one row too.
    """
    found = occurrences(docs, unit, least)
    first = found.where("not again").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    # written, so that the join has a shuffle of its own on either side: only then does Spark split a digest that very many texts have
    first = materialize(first, "repeated")
    gone = found.join(first, ["h1", "h2"], "left").where("again or doc_id > first").select("doc_id", "of", "start", "end")
    plain = docs.drop("removed", "n_removed")
    id_, of, spans_ = fresh(docs, "__id", "__of", "__cuts")
    cuts = gone.distinct().groupBy(F.col("doc_id").alias(id_), F.col("of").alias(of)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(spans_))
    joined = plain.join(cuts, (plain["doc_id"] == F.col(id_)) & (F.xxhash64(plain["text"]) == F.col(of)), "left").drop(id_, of)

    def one(text: str | None, spans: list | None) -> tuple:
        if not spans or text is None:
            return text, [], 0
        apart: list[list[int]] = []
        for s in spans:
            if apart and s["start"] < apart[-1][1]:
                apart[-1][1] = max(apart[-1][1], s["end"])
            else:
                apart.append([s["start"], s["end"]])
        out, at, gone = [], 0, []
        for start, end in apart:
            while end < len(text) and text[end].isspace():
                end += 1
            out.append(text[at:start])
            gone.append((start, end))
            at = end
        out.append(text[at:])
        return "".join(out), [{"start": a, "end": b} for a, b in gone], len(gone)

    fields = [("text", docs.schema["text"].dataType), ("removed", T.ArrayType(SPAN)), ("n_removed", T.LongType())]
    return map_batches(joined, one, ["text", spans_], fields).drop(spans_)
