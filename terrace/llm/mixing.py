"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame functions only.

Documents of a source, shuffled, are one stream of words, repeated as often as the source's target asks; it is cut into blocks of equal size. Points of the golden-ratio sequence fall into the sources' shares and so make a schedule of slots; the r-th slot of a source takes its r-th block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, discard, materialize, sent

#: Fixed value: the odd number nearest to 2^32 over the golden ratio.
GOLDEN = 2654435769
#: Blocks of the schedule that one key of the join with the sources' shares covers.
GRID = 64


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0): each, with the white space after it, becomes one letter, and letters are counted."""
    return F.coalesce(F.length(F.regexp_replace(F.ltrim(text, F.lit(" \t\n\x0b\f\r")), WORD + r"[\x20\x09-\x0D]*", "w")), F.lit(0)).cast("long")


def targets(docs: DataFrame, block: int, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Of documents with source and size a row for each source, in order of code points, null last: src (its number), source_size, target, taken (the target as whole words), blocks and first (blocks of the sources before).

    Weights repeat along the sources and share the sum of all sizes. A target stops at most times its source's size, and the excess is shared by weight among the others, until none is above: sources are sorted by the level at which they stop, so one running sum finds them all. The windows hold a row for each source.
    """
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    found = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = found.withColumn("src", number).withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("src") % len(weights)).cast("long")).withColumn("cap", F.col("source_size") * most)
    by = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    rows = rows.withColumns({"under": F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "others": F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)), "whole": F.sum("source_size").over(Window.partitionBy())})
    # what this source would get of what those before leave, against where it stops
    stops = (wide("whole") - wide("under")) * wide("weight") > wide("cap") * wide("others")
    level = (F.col("whole") - F.col("under")).cast("double") / F.col("others").cast("double")
    rows = rows.withColumn("stops", stops).withColumn("level", F.max(F.when(~F.col("stops"), level)).over(Window.partitionBy()))
    rows = rows.withColumn("target", F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")))
    rows = rows.withColumn("taken", F.least(F.floor(F.col("target") + 0.5), F.col("cap"))).withColumn("blocks", F.ceil(F.col("taken") / block))
    before = F.sum("blocks").over(Window.orderBy("src")) - F.col("blocks")
    return rows.withColumn("first", before).select("src", "source", "source_size", "target", "taken", "blocks", "first")


def running(rows: DataFrame, group: str, part: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds name: the sum of value over the rows of the same group before each, by part and then order. Parts are summed first, then each part's rows; so no window holds a whole group."""
    inside = Window.partitionBy(group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(group, part).agg(F.sum(value).alias("__sum"))
    base = sums.select(group, part, (F.sum("__sum").over(Window.partitionBy(group).orderBy(part)) - F.col("__sum")).alias("__base"))
    placed = rows.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return placed.join(base, [group, part]).withColumn(name, F.col(name) + F.col("__base")).drop("__base")


def streams(sized: DataFrame, n: int, seed: int) -> DataFrame:
    """Adds start: the words of the source's shuffled stream before each document. Shuffled by digests of seed, doc_id and text, dealt into about sqrt(n) ranges of the digest, so that ranges and rows in one grow alike."""
    parts = max(1, int(n**0.5))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("print")).cast("binary"))
    keyed = sized.withColumn("key", digest).withColumn("part", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * parts / (1 << 32)))
    return running(keyed, "src", "part", ["key", "size"], F.col("size"), "start").drop("key", "part")


def schedule(sources: DataFrame) -> DataFrame:
    """slot (place in the mix), src and block: as many slots as all sources have blocks.

    Slot i looks at the golden-ratio point of i, as a whole number of 32 bits, scaled to the blocks; the source whose share holds it gets the slot, and the r-th slot of a source is for its block r. Slots beyond a source's last block fall away, and blocks for which the points left no slot (a few a source, the sequence's discrepancy) follow at the end.
    """
    spark = sources.sparkSession
    n = sources.agg(F.sum("blocks")).first()[0] or 0
    point = (F.col("slot") % (1 << 31) * GOLDEN) % (1 << 32)
    points = spark.range(n).select(F.col("id").alias("slot")).withColumn("at", F.floor(point / float(1 << 32) * n))
    shares = sources.where("blocks > 0").select("src", "first", (F.col("first") + F.col("blocks")).alias("end"), F.explode(F.sequence(F.floor(F.col("first") / GRID), F.floor((F.col("first") + F.col("blocks") - 1) / GRID))).alias("cell"))
    met = points.withColumn("cell", F.floor(F.col("at") / GRID)).join(shares, "cell").where("at >= first and at < end").select("slot", "src")
    ranked = running(met.withColumn("part", F.floor(F.col("slot") / max(1, int(n**0.5)))), "src", "part", ["slot"], F.lit(1).cast("long"), "block").drop("part")
    counts = ranked.groupBy("src").agg(F.count(F.lit(1)).alias("had"))
    short = sources.join(counts, "src", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < blocks").withColumn("missing", F.col("blocks") - F.col("had"))
    after = F.sum("missing").over(Window.orderBy("src")) - F.col("missing")
    late = short.withColumn("after", after).withColumn("block", F.explode(F.sequence("had", F.col("blocks") - 1))).select((n + F.col("after") + F.col("block") - F.col("had")).alias("slot"), "src", "block")
    kept = ranked.join(sources.select("src", "blocks"), "src").where("block < blocks").select("slot", "src", "block")
    return kept.unionByName(late)


def pieces(placed: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """What of each document lies in each block of its source's repeated stream: src, start, block, word (where in the document it begins), length. A document gives a row for each block and repetition, however long it is."""
    rows = placed.where("size > 0").join(sent(sources.select("src", "source_size", "taken")), "src")
    rows = rows.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("taken") / F.col("source_size")) - 1))).where("taken > 0")
    rows = rows.withColumn("from", F.col("turn") * F.col("source_size") + F.col("start")).withColumn("to", F.least(F.col("from") + F.col("size"), F.col("taken"))).where("from < to")
    rows = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))))
    begin = F.greatest(F.col("from"), F.col("block") * block)
    return rows.select("src", "start", "block", "doc_id", (begin - F.col("from")).alias("word"), (F.least(F.col("to"), (F.col("block") + 1) * block) - begin).alias("length"))


def plan(docs: DataFrame, block: int = 256, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 13) -> tuple[DataFrame, DataFrame, DataFrame]:
    """placed (doc_id, size, src, start), sources (see targets) and mix (slot, src, start, block, doc_id, word, length): the mix as a list of pieces of documents in the order of its slots. (src, start) names a document that has words.

    Null texts have no words; null sources are one source, the last; null and repeated ids are documents like others, and the very same row twice is two of them. A document without words is in no piece. An empty table gives no rows; other columns are not read, so none can clash. Words are never cut; a long document spreads over many blocks.
    """
    sized = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("print")), "sized")
    sources = materialize(targets(sized, block, weights, most), "sources")
    numbers = sent(sources.select(F.col("source").alias("__source"), "src"))
    known = sized.join(numbers, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "source")
    placed = materialize(streams(known, sized.count(), seed).select("doc_id", "size", "src", "start"), "placed")
    discard(sized)
    mix = pieces(placed, sources, block).join(schedule(sources), ["src", "block"])
    return placed, sources, mix.select("slot", "src", "start", "block", "doc_id", "word", "length")


def totals(placed: DataFrame, sources: DataFrame, mix: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix has of it, repeats counted) of every document."""
    taken = mix.groupBy("src", "start").agg(F.sum("length").alias("__taken"))
    rows = placed.withColumn("__key", F.when(F.col("size") > 0, F.col("start")))
    found = rows.join(taken.withColumnRenamed("start", "__key"), ["src", "__key"], "left")
    return found.join(sent(sources.select("src", "source_size", "target")), "src").select("doc_id", "size", "source_size", "target", F.coalesce("__taken", F.lit(0)).cast("long").alias("taken"))
