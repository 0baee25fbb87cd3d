"""Versioned materialized datasets on plain Parquet.

A dataset is a folder ``<root>/<name>/v=<n>``; a version counts once Spark's
job commit wrote its ``_SUCCESS`` marker. Publishing writes a new version and
never touches the old ones, so an update that fails (for example on a FAIL
expectation) leaves the current version in place. Readers take the highest
committed version. Listing goes through the Hadoop FileSystem of the path, so
the same code runs on local disk, HDFS or an object store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PREFIX = "v="


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    fs, p, jvm = filesystem(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(_PREFIX) and name[len(_PREFIX):].isdigit():
            ok = fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
            out.append((int(name[len(_PREFIX):]), ok))
    return sorted(out)


def dataset_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def version_path(root: str, name: str, version: int) -> str:
    return f"{dataset_path(root, name)}/{_PREFIX}{version:08d}"


def latest_version(spark: SparkSession, root: str, name: str) -> int | None:
    done = [v for v, ok in _versions(spark, dataset_path(root, name)) if ok]
    return done[-1] if done else None


def publish(df: DataFrame, root: str, name: str) -> int:
    """Writes ``df`` as the next version and returns its number. On failure
    the partial folder has no ``_SUCCESS`` and is ignored by readers."""
    spark = df.sparkSession
    existing = _versions(spark, dataset_path(root, name))
    v = (existing[-1][0] + 1) if existing else 1
    df.write.mode("errorifexists").parquet(version_path(root, name, v))
    return v


def read_latest(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame | None:
    v = latest_version(spark, root, name)
    if v is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return spark.read.parquet(version_path(root, name, v))


def read_version(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    return spark.read.parquet(version_path(root, name, version))


def has_data_files(spark: SparkSession, path: str) -> bool:
    """Whether a written folder holds any data file (not only markers)."""
    fs, p, _ = filesystem(spark, path)
    if not fs.exists(p):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = filesystem(spark, path)
    return bool(fs.exists(p))


def _sql_str(s: str) -> str:
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession, table: str, path: str, comment: str | None = None,
             properties: dict | None = None) -> None:
    """Names a published version in the session catalog (``spark.read.table``
    and SQL ``FROM table`` then resolve to it), with a table comment and
    properties. Re-registering points the name at the new location, with the
    new version's columns."""
    known = spark.catalog.tableExists(table)
    if known and spark.table(table).schema != spark.read.parquet(path).schema:
        spark.sql(f"DROP TABLE {table}")            # external: files stay
        known = False
    if not known:
        ddl = f"CREATE TABLE {table} USING parquet LOCATION {_sql_str(path)}"
        if comment:
            ddl += f" COMMENT {_sql_str(comment)}"
        spark.sql(ddl)
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_sql_str(path)}")
        spark.catalog.refreshTable(table)
        if comment:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('comment' = {_sql_str(comment)})")
    if properties:
        kv = ", ".join(f"{_sql_str(k)} = {_sql_str(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({kv})")


def publish_table(df: DataFrame, root: str, name: str, comment: str | None = None,
                  properties: dict | None = None) -> int:
    """``publish`` plus catalog registration of the new version."""
    v = publish(df, root, name)
    register(df.sparkSession, name, version_path(root, name, v), comment, properties)
    return v


def preview(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """First ``n`` rows; ordered (and so repeatable) when ``order_by`` is given.
    A top-n: each partition keeps n rows before the single final merge."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def register_bucketed(spark: SparkSession, table: str, path: str, keys, buckets: int,
                      schema) -> DataFrame:
    """(Re)declares the files at ``path`` - written by ``bucketBy(buckets,
    keys)`` - as a bucketed table and returns it. Joins and aggregates on the
    keys then need no shuffle of this side."""
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {table}")            # external: files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    cols = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({cols}) "
              f"SORTED BY ({cols}) INTO {int(buckets)} BUCKETS LOCATION {_sql_str(path)}")
    return spark.table(table)


def write_bucketed(df: DataFrame, path: str, keys, buckets: int, table: str,
                   aligned: bool = False) -> None:
    """Writes ``df`` bucketed and sorted on ``keys`` (the writer needs a
    catalog entry; it is dropped again, the files stay). Rows that are not
    ``aligned`` to the buckets yet are first, else every task would write a
    file for every bucket."""
    spark = df.sparkSession
    if not aligned:
        df = df.repartition(int(buckets), *keys)
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE {table}")
    (df.write.bucketBy(int(buckets), *keys).sortBy(*keys).option("path", path)
       .mode("overwrite").saveAsTable(table))
    spark.sql(f"DROP TABLE {table}")


def _table_name(path: str, name: str) -> str:
    import hashlib
    return f"tierline_{name}_{hashlib.sha1(path.encode()).hexdigest()[:12]}"


def source_state(df: DataFrame) -> str:
    """A digest of the files behind ``df`` (names, sizes, times); another one
    each time for a DataFrame without files."""
    import hashlib
    import uuid
    spark, state = df.sparkSession, hashlib.sha1()
    files = sorted(df.inputFiles())
    for f in files:
        fs, p, _ = filesystem(spark, f)
        st = fs.getFileStatus(p)
        state.update(f"{f} {st.getLen()} {st.getModificationTime()}\n".encode())
    return state.hexdigest()[:16] if files else uuid.uuid4().hex[:16]


def bucketed_copy(df: DataFrame, root: str, name: str, keys, buckets: int | None = None) -> DataFrame:
    """A copy of ``df`` bucketed on ``keys`` below ``root``, written again
    when the files behind ``df`` changed: the way to join a large, slowly
    changing table with every micro-batch of a stream without shuffling the
    table each time."""
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    b = int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{dataset_path(root, name)}/b={b}-{source_state(df)}"
    if not exists(spark, path + "/_SUCCESS"):
        write_bucketed(df, path, keys, b, _table_name(path, name + "_w"))
    return register_bucketed(spark, _table_name(path, name), path, keys, b, df.schema)


def publish_bucketed(df: DataFrame, root: str, name: str, keys, buckets: int,
                     aligned: bool = False) -> int:
    """``publish`` with the version written bucketed on ``keys``: readers
    joining or grouping on the keys (``read_latest_bucketed``) skip the
    shuffle of this dataset. Plain readers see ordinary Parquet."""
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    existing = _versions(spark, dataset_path(root, name))
    v = (existing[-1][0] + 1) if existing else 1
    path = version_path(root, name, v)
    write_bucketed(df, path, keys, buckets, _table_name(path, name + "_w"), aligned)
    if not has_data_files(spark, path):
        df.limit(0).write.mode("overwrite").parquet(path + "/_schema")
    return v


def read_latest_bucketed(spark: SparkSession, root: str, name: str, keys,
                         buckets: int) -> DataFrame | None:
    v = latest_version(spark, root, name)
    if v is None:
        return None
    path = version_path(root, name, v)
    keys = [keys] if isinstance(keys, str) else list(keys)
    marker = path + "/_schema"
    schema = spark.read.parquet(marker if exists(spark, marker) else path).schema
    return register_bucketed(spark, _table_name(dataset_path(root, name), name), path, keys,
                             buckets, schema)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = filesystem(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def retain(spark: SparkSession, root: str, name: str, keep: int = 2) -> list[int]:
    """Deletes all but the newest ``keep`` committed versions of a published
    dataset, and uncommitted leftovers older than the newest committed one.
    Returns the deleted version numbers. Keep at least 2 while readers may
    still hold the previous version."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    vs = _versions(spark, dataset_path(root, name))
    done = [v for v, ok in vs if ok]
    if not done:
        return []
    kept = set(done[-keep:])
    newest = done[-1]
    gone = [v for v, ok in vs if v not in kept and (ok or v < newest)]
    for v in gone:
        _delete(spark, version_path(root, name, v))
    return gone
