"""Quality rules with risk-controlled thresholds. DataFrame functions only."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, fresh

#: What each rule measures: a share from 0 to 1 of which more is worse.
RULES = ("symbols", "dup_lines", "repeats", "upper")
BINS = 200
#: Cutoffs are broadcast up to so many strata, and joined by shuffle beyond.
MOST_STRATA_SENT = 20_000


def gram_hash(a: Column, b: Column, c: Column) -> Column:
    return F.xxhash64(a, b, c)


def measure(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper (long) and base_failed, from whole texts.

    Null text: as an empty one, all zero. Columns of these names are replaced, all others stay. Repeated rows are measured alike; an empty table gives no rows. A text of any length is measured whole, within one row.
    Windows of three words are compared by hash and position, packed into one number and sorted; neighbours of equal hash are then compared word by word. Where neighbours of equal hash differ, so that equal windows may stand apart, that text's windows are sorted by their words instead.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # columns in between, under names that docs has not
    w_, l_, b_, m_, g_, a_, e_, s_ = fresh(docs, "__words", "__lines", "__bits", "__mask", "__grams", "__alike", "__exact", "__spots")
    words, grams, n = F.col(w_), F.col(g_), F.size(w_)
    at = lambda i: F.get(words, i)
    bits = F.col(b_)
    place = lambda x: x.bitwiseAND(F.col(m_)).cast("int")
    high = lambda x: F.call_function("shiftright", x, bits)
    same = lambda x, y: (at(place(x)) == at(place(y))) & (at(place(x) + 1) == at(place(y) + 1)) & (at(place(x) + 2) == at(place(y) + 2))
    packed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.call_function("shiftleft", gram_hash(at(i), at(i + 1), at(i + 2)), bits).bitwiseOR(i.cast("long")))
    # of each window and the next: 1 equal, 2 equal hashes of different words, 0 neither
    to_next = F.transform(grams, lambda x, k: F.when(high(x) == high(F.get(grams, k + 1)), F.when(same(x, F.get(grams, k + 1)), 1).otherwise(2)).otherwise(0))
    twice = F.filter(grams, lambda x, k: F.coalesce(F.get(F.col(a_), k) == 1, F.lit(False)) | F.coalesce(F.get(F.col(a_), k - 1) == 1, F.lit(False)))
    collide = F.array_contains(a_, 2)
    window = lambda i: F.struct(at(i).alias("a"), at(i + 1).alias("b"), at(i + 2).alias("c"), i.alias("at"))
    exact, equal = F.col(e_), lambda x, y: F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))
    by_words = F.filter(exact, lambda x, k: equal(x, F.get(exact, k + 1)) | equal(x, F.get(exact, k - 1)))
    spots = F.array_sort(F.when(collide, F.transform(by_words, lambda x: x["at"])).otherwise(F.transform(twice, place)))
    covered = F.aggregate(F.col(s_), F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")), lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")))["n"]
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({w_: F.regexp_extract_all(text, F.lit(WORD), 0), l_: lines})
    out = out.withColumn(b_, F.ceil(F.log2(n + 2)).cast("int")).withColumn(m_, F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    out = out.withColumn(g_, F.when(n >= 3, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn(a_, to_next)
    out = out.withColumn(e_, F.when(collide, F.array_sort(F.transform(F.sequence(F.lit(0), n - 3), window))))
    out = out.withColumn(s_, spots)
    left = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": (F.length(text) - left(r"[#*$%&|<>]+")).cast("long"),
            "n_dup_lines": (F.size(l_) - F.size(F.array_distinct(l_))).cast("long"),
            "n_repeat_words": covered.cast("long"),
            "n_lines": F.size(l_).cast("long"),
            "n_upper": (F.length(text) - left(r"\p{Lu}+")).cast("long"),
        }
    )
    out = out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return out.drop(w_, l_, b_, m_, g_, a_, e_, s_)


def shares() -> dict[str, Column]:
    part = lambda a, b: F.when(F.col(b) > 0, F.least(F.col(a) / F.col(b), F.lit(1.0))).otherwise(0.0)
    return {"symbols": part("n_symbols", "word_chars"), "dup_lines": part("n_dup_lines", "n_lines"), "repeats": part("n_repeat_words", "n_words"), "upper": part("n_upper", "word_chars")}


def bin_of(share: Column) -> Column:
    return F.floor(share * BINS).cast("int")


def log_factorial(m: Column) -> Column:
    x = m.cast("double") + 1
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(m <= 20, F.log(F.factorial(F.least(m, F.lit(20)).cast("int")).cast("double"))).otherwise((x - 0.5) * F.log(x) - x + 0.9189385332046727 + series)


def binomial_at_most(k: Column, n: Column, p: float, terms: int = 100_000) -> Column:
    """P(at most k of n), each with chance p: exact for k up to terms; beyond, terms from k down and a geometric bound from above for what is left, which errs on the safe side. 1 where k is at or over the mean."""
    top = F.exp(log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    ratio = lambda i: i.cast("double") / (n - i + 1) * ((1 - p) / p)
    steps = F.sequence(F.lit(0).cast("long"), F.least(k, F.lit(terms)))
    summed = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("all")), lambda a, j: F.struct((a["term"] * ratio(k - j)).alias("term"), (a["all"] + a["term"]).alias("all")))
    last = ratio(k - F.least(k, F.lit(terms)))
    rest = F.when(k > terms, summed["term"] / (1 - last)).otherwise(0.0)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * (summed["all"] + rest)))


#: A stratum uses so many of the rules, each with that part of its risk: the least number that rejects nearly all bad documents that any does.
PARTS = (1, 2, 4)


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.04, error: float = 0.05, enough: float = 0.98) -> DataFrame:
    """stratum and, for each rule, the largest bin that is kept: cutoffs under which, with confidence 1 - error over all strata, at most risk of a stratum's good documents are rejected.

    Holdout: the rows of measured that labels mark (quality 1: good) and the base rules keep; a document labelled more than once counts by its least label. A stratum may use its best rule with the whole risk, its two best with half of it each, or all with a quarter each; so a stratum of a few hundred labels can have a cutoff, where a quarter of the risk would not show. Each triple of stratum, rule and part has an equal share of error (Bonferroni), so the choice needs no further correction. Within a triple, cutoffs are tested from the mildest on, each only if those before it hold: a cutoff holds if a false rejection rate of its part of risk would show so few rejected good documents with a chance of at most its share of error (exact binomial). Of the cutoffs that hold, the mildest is taken that rejects at least `enough` of the bad documents that the strictest rejects.
    measured should be a written table (materialize): its columns are used many times over.
    A stratum with too few labels has no cutoff and loses no document; an empty table has no strata. All that is gathered is a count for each stratum, rule and bin.
    """
    marked = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("marked_id")).agg(F.min("quality").alias("marked"))
    held = measured.where(~F.col("base_failed")).select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("of"), F.array(*[F.struct(F.lit(r).alias("rule"), bin_of(s).alias("bin")) for r, s in shares().items()]).alias("found")).join(marked, F.col("doc_id") == F.col("marked_id"))
    counts = held.select("of", "marked", F.explode("found").alias("f")).groupBy(F.col("of").alias("stratum"), "f.rule", "f.bin").agg(F.count_if(F.col("marked") == 1).alias("good"), F.count_if(F.col("marked") == 0).alias("bad"))
    pair = Window.partitionBy("stratum", "rule")
    above = pair.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    strata = counts.agg(F.count_distinct("stratum").alias("strata"))
    steps = counts.crossJoin(F.broadcast(strata)).select("stratum", "rule", "bin", "strata", F.coalesce(F.sum("good").over(above), F.lit(0)).alias("k"), F.sum("good").over(pair).alias("n"), F.coalesce(F.sum("bad").over(above), F.lit(0)).alias("caught"))
    chance = F.array(*[F.struct(F.lit(j).alias("parts"), binomial_at_most(F.col("k"), F.col("n"), risk / j).alias("p")) for j in PARTS])
    tested = steps.select("*", F.explode(chance).alias("t")).select("*", F.col("t.parts").alias("parts"), (F.col("t.p") <= F.lit(error) / (F.col("strata") * len(RULES) * len(PARTS))).alias("holds"))
    triple = Window.partitionBy("stratum", "parts", "rule")
    held_on = F.min(F.col("holds").cast("int")).over(triple.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)) == 1
    allowed = tested.withColumn("holds", held_on).where("holds")
    mildest = allowed.withColumn("most", F.max("caught").over(triple)).where((F.col("caught") >= enough * F.col("most")) & (F.col("most") > 0))
    by_rule = mildest.groupBy("stratum", "parts", "rule").agg(F.max("bin").alias("bin"), F.first("most").alias("most"))
    best = by_rule.withColumn("place", F.row_number().over(Window.partitionBy("stratum", "parts").orderBy(F.desc("most"), "rule"))).where(F.col("place") <= F.col("parts"))
    chosen = best.groupBy("stratum", "parts").agg(*[F.max(F.when(F.col("rule") == r, F.col("bin"))).alias(f"cut_{r}") for r in RULES])
    # what the rules of each choice reject together
    over = functools.reduce(Column.__or__, [F.coalesce(F.get("found", F.lit(i))["bin"] > F.col(f"cut_{r}"), F.lit(False)) for i, r in enumerate(shares())])
    together = held.where("marked = 0").join(chosen, F.col("of") == F.col("stratum")).groupBy("stratum", "parts").agg(F.count_if(over).alias("together"))
    most = Window.partitionBy("stratum")
    fewest = together.withColumn("most", F.max("together").over(most)).where(F.col("together") >= enough * F.col("most")).groupBy("stratum").agg(F.min("parts").alias("parts"))
    return chosen.join(fewest, ["stratum", "parts"]).select("stratum", *[f"cut_{r}" for r in RULES])


def judge(measured: DataFrame, limits: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds kept (a column of that name is replaced, all others stay): false if base_failed, or if a share lies in a bin above the cutoff of the row's stratum. Strata without a cutoff (unlabelled ones, too few labels): true. An empty table gives no rows."""
    names = fresh(measured, *[f"__{c}" for c in limits.columns])
    named = limits.select(*[F.col(c).alias(n) for c, n in zip(limits.columns, names, strict=True)])
    of = dict(zip(limits.columns, names, strict=True))
    sent = F.broadcast(named) if limits.count() <= MOST_STRATA_SENT else named
    key = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    rejected = None
    for rule, share in shares().items():
        over = F.coalesce(bin_of(share) > F.col(of[f"cut_{rule}"]), F.lit(False))
        rejected = over if rejected is None else rejected | over
    return measured.join(sent, key == F.col(of["stratum"]), "left").withColumn("kept", ~F.col("base_failed") & ~rejected).drop(*names)
