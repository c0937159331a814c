"""Results in steps that survive a crash: groups of chunks are computed and committed one after another.

A folder holds the prepared zones (zones/, by group), the settings of the run (run.json), each group's rows (data/<unique name>) and one small file for each group that is done (done/<group>.json), which names its rows. That file is put in place by a rename after its rows are complete, so what a crash leaves behind is never read: rows that no file names, a file that can't be parsed, or one whose rows have gone, mean that the group is still to do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Chunks that one job computes and commits.
CHUNKS_A_GROUP = 100


class Folder:
    """A checkpoint folder on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        top = self._at("")
        self._files = top.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self._files.exists(self._at(name))

    def put(self, name: str, value: dict) -> None:
        """Writes a file under another name, then renames it: it is there whole or not at all."""
        part = self._at(f"part/{uuid.uuid4().hex}")
        out = self._files.create(part)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        self._files.mkdirs(self._at(name).getParent())
        self._files.delete(self._at(name), False)
        if not self._files.rename(part, self._at(name)):
            raise OSError(f"could not write {self.path}/{name}")

    def values(self, *names: str) -> list[dict]:
        """Contents of files, or of all files of folders; what is no JSON is left out."""
        there = [f"{self.path}/{n}" for n in names if self.exists(n)]
        found = self.spark.read.option("wholetext", True).text(there).collect() if there else []
        out = []
        for row in found:
            try:
                out.append(json.loads(row["value"]))
            except ValueError:
                continue
        return [x for x in out if isinstance(x, dict)]


def done(folder: Folder) -> dict[int, dict]:
    """What each committed group's file says, by group; only groups whose rows are complete."""
    return {x["group"]: x for x in folder.values("done") if {"group", "data", "n_parcels", "seconds", "method"} <= set(x) and folder.exists(f"{x['data']}/_SUCCESS")}


def rows(folder: Folder, schema: T.StructType) -> DataFrame:
    """The rows of all committed groups; none where nothing is committed."""
    paths = [f"{folder.path}/{x['data']}" for x in done(folder).values()]
    return folder.spark.read.schema(schema).parquet(*paths) if paths else folder.spark.createDataFrame([], schema)


def progress(folder: Folder) -> DataFrame:
    """group, n_parcels, seconds and method of each committed group, as processing_summary() takes them."""
    said = [(g, int(x["n_parcels"]), float(x["seconds"]), x["method"]) for g, x in sorted(done(folder).items())]
    return folder.spark.createDataFrame(said, "group long, n_parcels long, seconds double, method string")


def prepared(folder: Folder, zones: Callable[[], DataFrame], settings: dict, chunks_a_group: int) -> DataFrame:
    """Zones with chunk_id and group, written once by group and read back; a writing that broke off is done again. Raises where the folder belongs to a run with other settings."""
    settings = settings | {"chunks_a_group": chunks_a_group}
    before = [x for x in folder.values("run.json") if {"settings", "schema"} <= set(x)]
    if before and before[0]["settings"] != settings:
        raise ValueError(f"{folder.path} holds a run with other settings: {before[0]['settings']}")
    if not before:
        grouped = zones().withColumn("group", F.floor(F.col("chunk_id") / chunks_a_group))
        grouped.repartition("group", "chunk_id").write.mode("overwrite").partitionBy("group").parquet(f"{folder.path}/zones")
        # run.json comes last, so zones without it are not complete; an empty table leaves no file to take the schema from
        before = [{"settings": settings, "schema": grouped.schema.jsonValue()}]
        folder.put("run.json", before[0])
    return folder.spark.read.schema(T.StructType.fromJson(before[0]["schema"])).parquet(f"{folder.path}/zones")


def run(folder: Folder, zones: Callable[[], DataFrame], compute: Callable[[DataFrame], DataFrame], settings: dict, chunks_a_group: int = CHUNKS_A_GROUP) -> DataFrame:
    """Rows that compute() makes of all zones (with chunk_id): group by group, each committed before the next begins. Groups that are committed are not computed again.

    A job takes up to chunks_a_group chunks, of which all tasks of the cluster have their share; a crash loses the group it is in. The driver holds the groups' numbers, one for chunks_a_group chunks.
    """
    held = prepared(folder, zones, settings, chunks_a_group)
    todo = sorted({r["group"] for r in held.select("group").distinct().collect()} - set(done(folder)))
    for group in todo:
        part, data, began = held.where(F.col("group") == group).drop("group"), f"data/{uuid.uuid4().hex}", time.time()
        compute(part).write.parquet(f"{folder.path}/{data}")
        n = folder.spark.read.parquet(f"{folder.path}/{data}").count()
        folder.put(f"done/{group}.json", {"group": group, "data": data, "n_parcels": n, "seconds": round(time.time() - began, 6), "method": settings["method"]})
    return rows(folder, compute(held.drop("group")).schema)
