"""N-gram Jaccard join by a blocked sparse matrix product of documents by n-grams."""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import components, discard, materialize, sent, slices, words_of
from .tokens import Memo

#: Words are counted in so many buckets; the counts (8 bytes each) are what tasks are sent.
BUCKETS = 1 << 16
#: A tile of the product has about so many rows on either side.
BLOCK = 256
#: Products of single entries that a tile works on at once.
AT_ONCE = 1 << 20

SIGNATURE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("uid", T.LongType()), T.StructField("sketch", T.BinaryType()), T.StructField("prefix", T.ArrayType(T.LongType()))])
TILE_ROW = pa.schema([("g", pa.int64()), ("ti", pa.int32()), ("tj", pa.int32()), ("block", pa.int32()), ("uid", pa.int64()), ("component", pa.int64())])
EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


class Shingler:
    """Sets of 64-bit hashes of a text's windows of `width` words (A-Z lower-cased); a shorter text is one shingle, one without words none."""

    def __init__(self, width: int):
        self.width, self.memo = width, Memo(lambda w: xxhash.xxh3_64_digest(w)[::-1], 400_000)

    def words(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.memo.ids(words_of(text)), "<u8")

    def grams(self, words: np.ndarray) -> np.ndarray:
        """Hash of each window, in order."""
        k = min(self.width, len(words))
        if not k:
            return words
        n = len(words) - k + 1
        h = np.full(n, 0x9E3779B97F4A7C15 ^ (k if k < self.width else 0), np.uint64)
        for i in range(k):
            h = (h ^ words[i : i + n]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))

    def set(self, text: str | None) -> np.ndarray:
        return np.unique(self.grams(self.words(text)))


def word_counts(docs: DataFrame, width: int) -> np.ndarray:
    """Occurrences over all texts, by bucket of word: each task counts into a fixed table."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, n = Shingler(width), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    n += np.bincount((tool.words(text) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS) if text else 0
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=schema.names)

    rows = docs.select("text").mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(BUCKETS, np.int64)
    total[rows["bucket"].to_numpy(int)] = rows["n"].to_numpy(np.int64)
    return total


def signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, h1, h2 (digest of the set; null if it is empty), uid (a number of the row), sketch (see sketch_of()) and prefix: the rarest grams, so many that two sets whose likeness is enough have one in common.

    Rarity is estimated from the counts of a gram's words. Any order of grams that is the same for all documents gives the same links; this one keeps lists short.
    """
    weight = np.log2(word_counts(docs, width) + 1.0)
    rank = docs.sparkSession.sparkContext.broadcast((weight * 15 / max(1.0, weight.max() * width)).astype(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, weights, uid = Shingler(width), rank.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch):
                out: list[tuple] = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = tool.words(text)
                    grams = tool.grams(words)
                    distinct, first = np.unique(grams, return_index=True)
                    n = len(distinct)
                    uid += 1
                    if not n:
                        out.append((doc, 0, None, None, uid, None, []))
                        continue
                    w = weights[(words % np.uint64(BUCKETS)).astype(np.int64)]
                    k = min(width, len(words))
                    score = sum(w[i : i + len(grams)] for i in range(k))[first]
                    keys = (np.minimum(score * 17, 255).astype(np.uint64) << np.uint64(55)) | (distinct >> np.uint64(9))
                    p = n - -(-percent * n // 100) + 1
                    out.append((doc, n, *digest(distinct), uid, sketch_of(distinct), np.sort(keys)[:p].astype(np.int64)))
                kinds = [pa.int64()] * 5 + [pa.binary(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=SIGNATURE.names)

    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SIGNATURE), "signatures")


def digest(grams: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(grams.tobytes())
    return (d & (1 << 64) - 1) - (1 << 63), (d >> 64) - (1 << 63)


def sketch_of(grams: np.ndarray) -> bytes:
    """For each remainder of gram hashes, whether an odd number of grams has it: about one bit a gram. Two sets differ in as many grams at least as their sketches differ in bits."""
    bits = max(64, 1 << (len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which the sketches in the rows of a and b differ; the longer ones are folded to the length of the others."""
    k = min(a.shape[1], b.shape[1])
    a, b = (np.bitwise_xor.reduce(x.reshape(len(x), -1, k), axis=1) if x.shape[1] > k else x for x in (a, b))
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The product of two sparse incidence matrices, rows given as sorted sets of column numbers: overlap counts, left by right.

    Entries are put in column order; column block by column block, each left entry meets the right entries of its column, and the counts are added up.
    """
    over = np.zeros(len(left) * len(right), np.int64)
    if not over.size:
        return over.reshape(len(left), len(right))
    x, i = np.concatenate(left), np.repeat(np.arange(len(left)), [len(s) for s in left])
    y, j = np.concatenate(right), np.repeat(np.arange(len(right)), [len(s) for s in right])
    order = np.argsort(y, kind="stable")
    y, j = y[order], j[order]
    low, high = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
    some = high > low
    i, low, times = i[some], low[some], (high - low)[some]
    done = np.cumsum(times)
    start = 0
    while start < len(times):
        stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + AT_ONCE, "right")))
        t = times[start:stop]
        within = np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t)
        cells = np.repeat(i[start:stop], t) * len(right) + j[np.repeat(low[start:stop], t) + within]
        over += np.bincount(cells, minlength=over.size)
        start = stop
    return over.reshape(len(left), len(right))


def linked(over: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Cells of a tile whose counts reach the bound that the two sizes set."""
    return 100 * over >= percent * (left[:, None] + right[None, :] - over)


def roots(a: list[int], b: list[int], parent: dict[int, int]) -> list[tuple[int, int]]:
    """Of links a - b, as few as keep the same documents connected, given what parent joins already."""

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a, b, strict=True):
        if x != y and (p := root(x)) != (q := root(y)):
            parent[p] = q
            kept.append((x, y))
    return kept


def possible(n_a, at_a, n_b, at_b, percent: int):
    """Can two rows link that have a common gram at these places of their prefixes? Works on columns and on arrays."""
    least = np.minimum if isinstance(n_a, np.ndarray) else F.least
    reach = 1 + least(at_a, at_b) + least(n_a - at_a - 1, n_b - at_b - 1)
    # overlap >= percent * (n_a + n_b) / (100 + percent) is what the likeness asks for
    return (100 * n_a >= percent * n_b) & (100 * n_b >= percent * n_a) & ((100 + percent) * reach >= percent * (n_a + n_b))


def may_link(n_a: np.ndarray, n_b: np.ndarray, a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Of pairs of rows by size and sketch: do the sketches leave overlap enough? 2 * overlap = n_a + n_b - difference, and sketches bound the difference from below."""
    out, kinds = np.zeros(len(n_a), bool), defaultdict(list)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        kinds[len(x), len(y)].append(i)
    for (p, q), which in kinds.items():
        step = max(1, AT_ONCE // (p + q))
        for at in range(0, len(which), step):
            some = np.array(which[at : at + step])
            apart = differ(np.stack([a[i] for i in some]), np.stack([b[i] for i in some]))
            total = n_a[some] + n_b[some]
            out[some] = (100 + percent) * (total - apart) >= 2 * percent * total
    return out


def star_links(percent: int):
    """Of pairs (lead, uid, and n and sketch of both), those that sketches leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                a, b = ([np.frombuffer(x, np.uint8) for x in part.column(c).to_pylist()] for c in ("sketch_a", "sketch_b"))
                keep = may_link(*(part.column(c).to_numpy() for c in ("n_a", "n_b")), a, b, percent)
                yield part.select(["lead", "uid"]).filter(pa.array(keep))

    return run


def tiles_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(g, ti, tj) and rows of each tile, from batches in the order of these keys: a task holds one tile at a time."""
    key, rows = None, []
    for batch in batches:
        for g, ti, tj, *row in zip(*(batch.column(c).to_pylist() for c in ("g", "ti", "tj", *names)), strict=True):
            if (g, ti, tj) != key:
                if rows:
                    yield key, rows
                key, rows = (g, ti, tj), []
            rows.append(tuple(row))
    if rows:
        yield key, rows


def viable(percent: int):
    """Of the tiles of lists (rows without their sets), the rows that may link with a row of another component in their tile: what the bounds derived from sizes, places and sketches leave of the product."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (g, ti, tj), rows in tiles_of(batches, ["block", "uid", "component", "first", "n", "at", "sketch"]):
            left, right = ([r for r in rows if r[0] == t] for t in (ti, tj))
            if not left or not right:
                continue
            # the list's first row has met all others already
            c_a, f_a, n_a, at_a, c_b, f_b, n_b, at_b = (np.array([r[k] for r in side]) for side in (left, right) for k in (2, 3, 4, 5))
            may = possible(n_a[:, None], at_a[:, None], n_b[None, :], at_b[None, :], percent) & (c_a[:, None] != c_b[None, :]) & ~f_a[:, None] & ~f_b[None, :]
            i, j = np.nonzero(np.triu(may, 1) if ti == tj else may)
            sketches = [[np.frombuffer(r[6], np.uint8) for r in side] for side in (left, right)]
            keep = may_link(n_a[i], n_b[j], [sketches[0][x] for x in i], [sketches[1][x] for x in j], percent)
            chosen = {left[x] for x in i[keep]} | {right[x] for x in j[keep]}
            if chosen:
                columns = [[g] * len(chosen), [ti] * len(chosen), [tj] * len(chosen), *zip(*(r[:3] for r in sorted(chosen)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, TILE_ROW, strict=True)], schema=TILE_ROW)

    return run


def product(percent: int):
    """The tiles' rows with their sets: the overlap counts of each tile and, of the links that they give, those that join components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, ti, tj), rows in tiles_of(batches, ["block", "id", "component", "grams"]):
            left, right = ([r for r in rows if r[0] == t] for t in (ti, tj))
            if not left or not right:
                continue
            a, b = np.array([r[1] for r in left]), np.array([r[1] for r in right])
            sets = [[np.frombuffer(r[3], "<u8") for r in side] for side in (left, right)]
            i, j = np.nonzero(linked(overlaps(*sets), *(np.array([len(s) for s in side]) for side in sets), percent))
            yield edge_batch(roots(a[i].tolist(), b[j].tolist(), {r[1]: r[2] for r in rows} | {r[2]: r[2] for r in rows}))

    return run


def edge_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(2)], names=["a", "b"])


def against_first(percent: int):
    """Tiles of the product whose left side is one row: in each tile the first row (side 0) comes before the others, and meets up to BLOCK of them at once. Only the first row's set is kept from batch to batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lead_id, first = None, 0, np.zeros(0, np.uint64)
        for batch in batches:
            out: list[tuple[int, int]] = []
            for part in slices(batch, BLOCK):
                rows = zip(*(c.to_pylist() for c in part.columns), strict=True)
                for tile, group in itertools.groupby(rows, lambda r: r[:2]):
                    ids, sets = [], []
                    for _, _, side, id_, grams in group:
                        if side == 0:
                            key, lead_id, first = tile, id_, np.frombuffer(grams, "<u8")
                        else:
                            ids.append(id_)
                            sets.append(np.frombuffer(grams, "<u8"))
                    if sets and tile == key:
                        over = overlaps([first], sets)
                        near = linked(over, np.array([len(first)]), np.array([len(s) for s in sets]), percent)[0]
                        out += [(lead_id, ids[x]) for x in np.nonzero(near)[0]]
            yield edge_batch(out)

    return run


def incidence(docs: DataFrame, wanted: DataFrame, width: int, name: str) -> DataFrame:
    """uid, id and grams (the sorted set, 8 bytes each) of the wanted rows (uid, id, h1: a written table), written out. Of rows that repeat an id, h1 says whose set is meant."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("h1", T.LongType()), T.StructField("grams", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Shingler(width)
        for batch in batches:
            for part in slices(batch):
                out = [(i, digest(s)[0], s.astype("<u8").tobytes()) for i, text in zip(*(c.to_pylist() for c in part.columns), strict=True) if len(s := tool.set(text))]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=schema.names)

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    few = texts.join(sent(wanted.select("id")), "id", "left_semi")
    return materialize(few.mapInArrow(run, schema).join(wanted, ["id", "h1"]).select("uid", "id", "grams").dropDuplicates(["uid"]), name)


def link_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id that links reach) for every row of docs.

    Two rows link when their shingle sets' overlap is at least percent of their union. Equal sets are one class, found by digest, and one row of the incidence matrix. The product of that matrix with itself is computed in blocks, and only where it can hold a link: rows that have one of their rarest grams in common stand in that gram's list, and a list is a square of the product.
    First the row of each list's first class: what links to it is one component with it. Then, of the lists that still hold several components, the tiles of BLOCK by BLOCK classes whose rows are not all of that first component, each with the classes only that bounds leave which follow from sizes, from the places of the gram in both rows and from sketches of a bit a gram. Overlaps are counted column by column inside a tile; pairs below the bound are never written, and of those above it only links that join components. So a group of c near copies costs about c rows, not c squared. Every link between classes is found or follows from those found.
    Null and empty texts, and texts without words: n_shingles 0, component_id the row's own doc_id. Rows with a null id are returned with a null component and link to nothing. Rows that repeat an id are one document whose links are those of all its texts. A very long text is one row of 8 bytes a shingle; a tile holds about 2 * BLOCK rows. An empty table gives no rows. Other columns are left out, whatever their names.
    """
    found = signatures(docs, width, percent)
    some = found.where("n > 0 and doc_id is not null")
    least = F.min(F.struct("doc_id", "uid"))
    classes = materialize(some.groupBy("h1", "h2").agg(least.alias("m"), F.count(F.lit(1)).alias("rows")).select("h1", "h2", F.col("m.doc_id").alias("id"), F.col("m.uid").alias("uid"), "rows"), "classes")
    copies = materialize(some.select("uid", "h1", "h2").join(classes.where("rows > 1").select("h1", "h2", F.col("uid").alias("kept")), ["h1", "h2"]).where("uid <> kept").select("uid"), "copies")
    posts = some.join(sent(copies), "uid", "left_anti").select("uid", "n", F.posexplode("prefix").alias("at", "g"))
    lists = materialize(posts.groupBy("g").count().where("count > 1").select("g"), "lists")
    owners = classes.select("uid", "id", "h1")
    every = materialize(posts.join(lists, "g").join(owners.drop("h1"), "uid"), "listed")
    # Grams that the same classes have give the same pairs: of those, one is enough.
    member = [F.bit_xor(F.xxhash64("uid", F.lit(i))).alias(f"x{i}") for i in range(2)]
    row = F.struct("id", "uid", "n", "at")
    shared = every.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.min(row).alias("first"), *member).groupBy("c", "x0", "x1").agg(F.min(F.struct("g", "first")).alias("m")).select("m.g", "m.first", "c")
    multi = materialize(every.join(shared, "g"), "shared")
    discard(lists, copies, every)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    may = possible(F.col("first.n"), F.col("first.at"), F.col("n"), F.col("at"), percent)
    is_first = F.col("uid") == F.col("first.uid")
    met = materialize(multi.where(~is_first & may).select(F.col("first.uid").alias("lead"), "uid").distinct(), "met")
    sketch = materialize(some.join(sent(materialize(multi.select("uid").distinct(), "in-lists")), "uid", "left_semi").select("uid", "n", "sketch"), "sketches")
    side = lambda name, s: sketch.select(F.col("uid").alias(name), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    pairs = met.join(side("lead", "a"), "lead").join(side("uid", "b"), "uid")
    stars = materialize(pairs.mapInArrow(star_links(percent), "lead long, uid long"), "stars")
    wanted = materialize(stars.select("uid").union(stars.select("lead")).distinct().join(owners, "uid"), "wanted")
    grams = incidence(docs, wanted, width, "star-rows")
    sized = materialize(stars.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("salts")), "salts")
    others = stars.join(sized, "lead").select("lead", F.pmod(F.xxhash64("uid"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("side"), "uid").join(grams, "uid")
    firsts = sized.select("lead", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("lead").alias("uid")).join(grams, "uid")
    tiles = firsts.unionByName(others).select("lead", "salt", "side", "id", "grams").repartition(tasks, "lead", "salt").sortWithinPartitions("lead", "salt", "side")
    near = components(tiles.mapInArrow(against_first(percent), EDGES).union(same_id(some, classes)), "near")
    discard(met, stars, wanted, grams, sized)

    placed = materialize(multi.join(near, "id", "left").select("g", "uid", "n", "at", is_first.alias("first"), "c", F.coalesce("component", "id").alias("component")), "placed")
    # In a list, rows of its first row's component (the main ones) need no tile with each other: rest meets rest, and rest meets main.
    by = placed.groupBy("g", "component").agg(F.count(F.lit(1)).alias("rows"), F.max("first").alias("main"))
    apart = by.groupBy("g").agg(F.sum("rows").alias("all"), F.max(F.when(F.col("main"), F.col("component"))).alias("main"), F.max(F.when(F.col("main"), F.col("rows"))).alias("n_main")).where("n_main < all and all > 2")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    met = placed.join(apart, "g").withColumns({"rest_blocks": blocks(F.col("all") - F.col("n_main")), "main_blocks": blocks(F.col("n_main"))})
    is_main, some_block = F.col("component") == F.col("main"), lambda n: F.pmod(F.xxhash64("uid"), n).cast("int")
    others = F.sequence(F.lit(0), F.col("rest_blocks") + F.when(is_main, 0).otherwise(F.col("main_blocks")) - 1)
    dealt = met.withColumn("block", F.when(is_main, F.col("rest_blocks") + some_block(F.col("main_blocks"))).otherwise(some_block(F.col("rest_blocks")))).withColumn("other", F.explode(others))
    squares = dealt.select("g", F.least("block", "other").alias("ti"), F.greatest("block", "other").alias("tj"), "block", "uid", "n", "at", "component", "first")
    key = ["g", "ti", "tj"]
    looked = squares.join(sketch.drop("n"), "uid").repartition(tasks, *key).sortWithinPartitions(*key)
    left = materialize(looked.mapInArrow(viable(percent), "g long, ti int, tj int, block int, uid long, component long"), "tiles")
    wanted = materialize(left.select("uid").distinct().join(owners, "uid"), "wanted")
    grams = incidence(docs, wanted, width, "tile-rows")
    filled = left.join(grams, "uid").select(*key, "block", "id", "component", "grams").repartition(tasks, *key).sortWithinPartitions(*key)
    links = near.select(F.col("id").alias("a"), F.col("component").alias("b")).union(filled.mapInArrow(product(percent), EDGES))
    whole = components(links, "links")
    discard(multi, placed, left, wanted, grams, sketch)

    named = classes.join(whole, "id", "left").where("rows > 1 or component is not null").select("h1", "h2", F.coalesce("component", "id").alias("least"))
    out = some.select("doc_id", "n", "h1", "h2").join(named, ["h1", "h2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
    alone = found.where("not (n > 0 and doc_id is not null)").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.union(alone)


def same_id(some: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) of documents whose rows have different texts to the classes of those texts."""
    rows = some.select("doc_id", "h1", "h2")
    several = rows.groupBy("doc_id").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low < high").select("doc_id")
    return rows.join(several, "doc_id", "left_semi").join(classes, ["h1", "h2"]).select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
