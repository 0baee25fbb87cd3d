"""Append-only streaming tables.

A streaming table is a Parquet file sink plus its checkpoint:
``<root>/<name>/g=<n>/data`` and ``.../g=<n>/_checkpoint``. The sink's commit
log makes every source row land exactly once; a rerun with the same
checkpoint processes only new input (incremental), a full refresh starts a new
generation ``g=<n+1>`` with an empty checkpoint and reloads everything.
Readers take the newest generation that has a committed sink log.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tierline.tables import filesystem

_GEN = "g="
FILE_ROWS = 1_000_000       # so that a task of a merge reads few of them (``flows.SPLIT_BYTES``)


def _generations(spark: SparkSession, root: str, name: str) -> list[int]:
    fs, p, _ = filesystem(spark, f"{root.rstrip('/')}/{name}")
    if not fs.exists(p):
        return []
    return sorted(int(st.getPath().getName()[len(_GEN):]) for st in fs.listStatus(p)
                  if st.isDirectory() and st.getPath().getName().startswith(_GEN)
                  and st.getPath().getName()[len(_GEN):].isdigit())


def table_dir(root: str, name: str, generation: int) -> str:
    return f"{root.rstrip('/')}/{name}/{_GEN}{generation:06d}"


def current_generation(spark: SparkSession, root: str, name: str) -> int | None:
    g = _generations(spark, root, name)
    return g[-1] if g else None


def data_path(spark: SparkSession, root: str, name: str) -> str | None:
    g = current_generation(spark, root, name)
    return None if g is None else table_dir(root, name, g) + "/data"


def _apply_trigger(writer, trigger):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def append_stream(df: DataFrame, root: str, name: str, trigger: str | None = "availableNow",
                  full_refresh: bool = False, partition_by=None) -> StreamingQuery:
    """Starts the flow ``df -> streaming table name``. ``trigger``:
    'availableNow' (process what is there, then stop; the triggered update),
    'once', or a processing-time interval such as '5 seconds' (continuous
    until ``stop()``)."""
    spark = df.sparkSession
    g = current_generation(spark, root, name)
    if g is None:
        g = 1
    elif full_refresh:
        g += 1
    base = table_dir(root, name, g)
    tag = hashlib.sha1(base.encode()).hexdigest()[:8]      # unique per table folder
    w = (df.writeStream.format("parquet").outputMode("append")
           .option("checkpointLocation", base + "/_checkpoint")
           .option("maxRecordsPerFile", FILE_ROWS)
           .queryName(f"{name}_flow_g{g}_{tag}"))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    return _apply_trigger(w, trigger).start(base + "/data")


def run_to_completion(q: StreamingQuery) -> StreamingQuery:
    """Waits for an availableNow/once query; raises the query's error."""
    q.awaitTermination()
    return q


def read_table(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    """Batch read of the committed rows of the current generation."""
    p = data_path(spark, root, name)
    if p is None:
        if schema is None:
            raise FileNotFoundError(f"streaming table {name} has no data under {root}")
        return spark.createDataFrame([], schema)
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(p)


def read_table_stream(spark: SparkSession, root: str, name: str, schema) -> DataFrame:
    """The table as a streaming source (``STREAM(name)``)."""
    return spark.readStream.schema(schema).parquet(data_path(spark, root, name))


def name_table(spark: SparkSession, root: str, name: str, table: str | None = None) -> str:
    """Names the current generation of a streaming table in the catalog, for
    ``stream_by_name`` and SQL; returns the name."""
    from tierline.tables import register
    register(spark, table or name, data_path(spark, root, name))
    return table or name


def stream_by_name(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table as a streaming source (``STREAM(table)``)."""
    return spark.readStream.table(table)


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                 max_files: int | None = None, options: dict | None = None) -> DataFrame:
    """Streaming read of a folder (new files are picked up incrementally). A
    single-file path is read through a one-file glob, since the file source
    lists folders."""
    fs, p, _ = filesystem(spark, path)
    if fs.exists(p) and fs.isFile(p):
        path = path[:-1] + "[" + path[-1] + "]"
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)
