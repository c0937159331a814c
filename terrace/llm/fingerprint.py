"""Document fingerprints: bottom-k sketches of shingle hashes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, fresh

WIDTH, K = 5, 128
HASH_BITS = 48
#: Ranges of ids that adjacent() deals rows to, at most; what is gathered on the driver is one id for each.
MOST_RANGES = 4096
ROWS_A_RANGE = 4000


def with_sketch(df: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    """Adds out: the k least distinct hashes of windows of five words, ascending (array of long).

    Blanks before and after a text stand for missing words, so short texts have windows too. A null or empty text has the blank window alone.
    """
    blank = F.array_repeat(F.lit(""), WIDTH - 1)
    (held,) = fresh(df, "__w")
    df = df.withColumn(held, F.concat(blank, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), 0), blank))
    w = F.col(held)
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WIDTH)]).bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
    return df.withColumn(out, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).drop(held)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of the shingle sets: the share of the merged sketch that both have."""
    both = merge(a, b, k)
    return F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(float(1 << HASH_BITS)) / F.element_at(a, -1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    return F.least(F.lit(1.0), resemblance(a, b, k) * distinct_count(merge(a, b, k), k) / distinct_count(a, k))


def text_of(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), HASH_BITS // 4, "0")), "")


def range_of(id_: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the id, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    jumps = F.array(*[F.lit(1 << s) for s in reversed(range(steps))])
    return F.aggregate(jumps, F.lit(0), lambda low, jump: F.when((low + jump <= len(bounds)) & (F.get(table, low + jump - 1) <= id_), low + jump).otherwise(low))


def adjacent(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text, sketch, next_text and next_sketch: of the next row in descending doc_id (equal ids: in the order of their texts; null ids: last); after the last comes the first.

    Rows are dealt to ranges of ids of about equal size; each row sees the next within its range, and the last of a range gets the first row of the next range through a join with one row a range.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = rows.count()
    ranges = max(1, min(MOST_RANGES, n // ROWS_A_RANGE))
    at = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", at, 20 * ranges)).first()[0] or [])) if at and n else []
    rows = rows.withColumn("range", range_of(F.col("doc_id"), bounds))
    tops = sorted(rows.groupBy("range").agg(F.max("doc_id").alias("top")).collect(), reverse=True)
    follows = [(r["range"], tops[(i + 1) % len(tops)]["top"]) for i, r in enumerate(tops)]
    spark = docs.sparkSession
    follow = F.broadcast(spark.createDataFrame(follows, "range int, doc_id long"))
    first = rows.drop("range").join(follow, "doc_id").groupBy("range").agg(F.min("text").alias("first_text"))
    first = with_sketch(first, "first_text", "first_sketch", k)
    order = Window.partitionBy("range").orderBy(F.desc("doc_id"), "text")
    seen = with_sketch(rows, "text", "sketch", k).withColumn("next", F.lead(F.struct("text", "sketch")).over(order))
    joined = seen.join(first, "range", "left")
    return joined.select("doc_id", "text", "sketch", F.coalesce("next.text", "first_text").alias("next_text"), F.coalesce("next.sketch", "first_sketch").alias("next_sketch"))


def edits(docs: DataFrame, k: int = K) -> DataFrame:
    """The rows of adjacent() with n_chars, edited (the last half replaced by the start of the next text) and edited_sketch."""
    rows = adjacent(docs, k).withColumn("n_chars", F.length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars") - half), F.col("next_text").substr(F.lit(1), half))
    return with_sketch(rows.withColumn("edited", edited), "edited", "edited_sketch", k)


def digests(rows: DataFrame, k: int = K) -> DataFrame:
    return rows.select(
        F.when(F.col("doc_id") > -(1 << 63), F.col("doc_id")).alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        text_of(F.col("sketch")).alias("fingerprint"),
        text_of(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_count(F.col("sketch"), k).alias("n_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch"), k).alias("edited_contained"),
    )
