"""URL filters: a temporal list join. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

#: A key of more captures than this is dealt over salts, one for each so many captures.
HOT_ROWS = 2_000
#: The number of salts of each listed key that captures have is broadcast up to so many keys, and joined by shuffle beyond.
MOST_KEYS_SENT = 100_000


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and closing dots; empty if there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.rtrim(F.lower(rest), F.lit("."))


def path_of(url: Column) -> Column:
    """The path from its first slash on, without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def tail_of(url: Column) -> Column:
    """Path and query."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)


def keys_of(url: Column) -> Column:
    """What a list may name: host, path and query; the host with each leading part of its path; the host; and its parent domains down to the top-level one.

    The leading parts of a path of n parts have n keys, so a very long URL costs its length times its depth in its own row.
    """
    host = host_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.split(path_of(url), "/")
    paths = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.array_join(F.slice(parts, F.lit(1), i), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(F.array(F.concat(host, tail_of(url))), paths, parents)))


def intervals(entries: DataFrame) -> DataFrame:
    """key, action, valid_from, valid_to (exclusive; null: still valid) from dated entries (key, action, dated).

    An entry holds until the next one of its key; of entries of one day the least action counts ("allow" before "block"). Entries without key, action or date are left out. The action "delist" ends an interval and begins none.
    """
    day = entries.where("key is not null and action is not null and dated is not null").groupBy("key", "dated").agg(F.min("action").alias("action"))
    after = F.lead("dated").over(Window.partitionBy("key").orderBy("dated"))
    return day.select("key", "action", F.col("dated").alias("valid_from"), after.alias("valid_to")).where("action <> 'delist'")


def judge(captures: DataFrame, entries: DataFrame, id_: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """A row for each capture: id, fetched, host, verdict ("block", "allow" or "none"), matched (the key that decided, null if none) and valid_from.

    Each capture is met by the entries active when it was fetched (valid_from <= fetched < valid_to); the longest key decides. Captures without a host or a date get "none". Repeated captures (same id, url and date) are one row. Other columns are left out.
    Captures are joined by key, then interval; a key of many captures is dealt over salts, and only its few list rows are repeated for them. The keys of captures and the list are written once. An empty list gives "none" everywhere, an empty table no rows.
    """
    rows = captures.select(F.col(id_).alias("id"), F.col(url).alias("url"), F.col(fetched).alias("fetched")).distinct()
    held = materialize(intervals(entries), "list")
    wide = materialize(rows.select("id", "fetched", "url", F.explode(keys_of(F.col("url"))).alias("key")), "keys")
    # Keys are counted before they meet the list, so that a key of many captures travels as one row a task; salts of a key lie below its number of salts.
    counted = wide.groupBy("key").count().join(held.select("key").distinct(), "key", "left_semi")
    many = materialize(counted.select("key", F.greatest(F.lit(1), F.ceil(F.col("count") / HOT_ROWS)).cast("int").alias("salts")), "salts")
    listed = held.join(many, "key").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    salts = F.broadcast(many) if many.count() <= MOST_KEYS_SENT else many
    dealt = wide.join(salts, "key").withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.col("salts")).cast("int")).drop("salts")
    joined = dealt.join(listed.select("key", "salt", "action", "valid_from", "valid_to"), ["key", "salt"])
    met = joined.where((F.col("valid_from") <= F.col("fetched")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))))
    best = met.groupBy("id", "url", "fetched").agg(F.max(F.struct(F.length("key").alias("n"), F.col("key"), F.col("action"), F.col("valid_from"))).alias("best"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("id", "url", "fetched")]
    out = rows.alias("r").join(best.alias("b"), same[0] & same[1] & same[2], "left")
    return out.select(F.col("r.id").alias(id_), F.col("r.fetched").alias("fetched"), host_of(F.col("r.url")).alias("host"), F.coalesce("best.action", F.lit("none")).alias("verdict"), F.col("best.key").alias("matched"), F.col("best.valid_from").alias("valid_from"))
