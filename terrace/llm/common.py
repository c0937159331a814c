"""Pieces that several text operators share."""

from __future__ import annotations

import itertools
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

#: ASCII white space: what [^\x20\x09-\x0D]+ leaves out.
WORD = r"[^\x20\x09-\x0D]+"
#: sent() broadcasts up to so many rows of one or two numbers.
MOST_SENT = 1_000_000
#: with_offsets() broadcasts up to so many rows of 12 bytes, and joins by shuffle beyond.
MOST_PARTS_SENT = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a folder of our own on a local master; elsewhere an error, since executors would each write to their own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="terrace-")
    spark.sparkContext.setCheckpointDir(f"file://{made}")
    return shared_dir(spark)


#: Folders of the tables that materialize() returned, as long as someone holds them.
_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/terrace/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: cuts the lineage, and a lost executor costs nothing."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialize() wrote and nothing needs any longer."""
    for df in tables:
        path = _written.pop(df, None)
        if path:
            jvm = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            jvm.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm, True)


def sent(df: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """A written table of one or two numbers a row, marked for broadcast if it has so few rows; else as it is, so that a join shuffles."""
    return F.broadcast(df) if df.count() <= most else df


Batches = Iterator[pa.RecordBatch]


def mapped(df: DataFrame, per_row: Callable[..., tuple], inputs: list[str], fields: list[tuple[str, T.DataType]], setup: Callable[[], object] | None = None, drop: tuple[str, ...] = ()) -> tuple[DataFrame, Callable[[Batches], Batches], T.StructType]:
    """What map_batches() sends to Python (an input that is kept goes once), the function of its batches, and the schema that this gives."""
    new = T.StructType([T.StructField(n, t) for n, t in fields])
    names = {n.lower() for n in (*new.names, *drop)}
    keep = [f for f in df.schema.fields if f.name.lower() not in names]
    arrow = _arrow(new)
    kept = {f.name: f"__keep{i}" for i, f in enumerate(keep)}
    sent = [kept.get(n, f"__in{i}") for i, n in enumerate(inputs)]

    def run(batches: Batches) -> Batches:
        tool = (setup(),) if setup else ()
        for batch in batches:
            for part in slices(batch):
                columns = [part.column(n).to_pylist() for n in sent]
                rows = [per_row(*tool, *values) for values in zip(*columns, strict=True)]
                made = [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays([part.column(f"__keep{i}") for i in range(len(keep))] + made, names=[f.name for f in keep] + new.names)

    chosen = [df[_quote(f.name)].alias(f"__keep{i}") for i, f in enumerate(keep)] + [df[_quote(n)].alias(f"__in{i}") for i, n in enumerate(inputs) if n not in kept]
    return df.select(*chosen), run, T.StructType(keep + new.fields)


def map_batches(df: DataFrame, per_row: Callable[..., tuple], inputs: list[str], fields: list[tuple[str, T.DataType]], setup: Callable[[], object] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """The columns of df but for drop, with fields added (or replaced, where the names clash): per_row gets the inputs' values, and setup()'s result first if there is one."""
    rows, run, schema = mapped(df, per_row, inputs, fields, setup, drop)
    return rows.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in small parts, so that what is unpacked at once stays small when texts are long."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of df has."""
    taken = {c.lower() for c in df.columns}
    return [next(n for k in itertools.count() if (n := f"{name}{k or ''}").lower() not in taken) for name in names]


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _arrow(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema.fields]


def text_rows(df: DataFrame, *extra: str) -> DataFrame:
    """doc_id and text alone (null text: empty), so that other columns neither travel nor clash."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)


def numbered(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds to the rows of df, in the order its partitions have them: part, row (within the part), before (sum of value in the rows of the part before it). Written out, so that both stay as they are."""
    return _numbered(df, lambda batches: batches, df.schema, value, name)


def numbered_map(df: DataFrame, value: str, name: str, per_row: Callable[..., tuple], inputs: list[str], fields: list[tuple[str, T.DataType]], setup: Callable[[], object] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """numbered() of map_batches(), by one Python worker a task."""
    return _numbered(*mapped(df, per_row, inputs, fields, setup, drop), value, name)


def _numbered(rows: DataFrame, first: Callable[[Batches], Batches], made: T.StructType, value: str, name: str) -> DataFrame:
    schema = T.StructType(made.fields + [T.StructField("part", T.IntegerType()), T.StructField("row", T.LongType()), T.StructField("before", T.LongType())])

    def run(batches: Batches) -> Batches:
        part, row, total = TaskContext.get().partitionId(), 0, 0
        for batch in first(batches):
            before = []
            for n in batch.column(value).to_pylist():
                before.append(total)
                total += n or 0
            k = batch.num_rows
            added = [pa.array([part] * k, pa.int32()), pa.array(range(row, row + k), pa.int64()), pa.array(before, pa.int64())]
            row += k
            yield pa.RecordBatch.from_arrays(batch.columns + added, names=schema.names)

    return materialize(rows.mapInArrow(run, schema), name)


def with_offsets(rows: DataFrame, value: str, out: str) -> DataFrame:
    """Second pass after numbered(): adds the sum of value in all rows before. The totals of the parts, a row for each, are all that is summed in one place."""
    totals = rows.groupBy("part").agg(F.sum(value).alias("total"))
    base = totals.select(F.col("part").alias("__part"), (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    if totals.count() <= MOST_PARTS_SENT:
        base = F.broadcast(base)
    return rows.join(base, F.col("part") == F.col("__part")).withColumn(out, F.col("base") + F.col("before")).drop("__part", "base")


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(id, component) for the ids of edges (a, b): the smallest id that links reach. Large-star and small-star rounds; every round is a join and a minimum by key, written out, and what the round before wrote is deleted."""
    print_of = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), name)
    last = print_of(edges)
    for _ in range(most_rounds):
        if not last[0]:
            break
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        down = materialize(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*").where("a <> b").distinct()
        new = materialize(small, name)
        now = print_of(new)
        discard(edges, down)
        edges, same, last = new, now == last, now
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def words_of(text: str | None) -> list[bytes]:
    """The words [^\\x20\\x09-\\x0D]+ of a text, A-Z lower-cased."""
    return (text or "").encode().lower().split()
