"""Keyed merge flows: state kept as versioned, bucketed Parquet and advanced
incrementally from the new files of an append-only streaming table.

Each run of a flow:

1. finds the source's committed files that were written since the newest one
   already merged, less an hour for clocks that differ (``LATE_S``), and are not
   in the manifest, which keeps the names of that hour. Only new names reach
   the driver, and neither they nor the manifest grow with the history. A
   source whose generation changed (a full refresh) starts the state afresh
   from all of its files;
2. reads only the new files and reduces them to one row per key with a
   partial + final aggregate (a key holding a third of the rows leaves every
   map task as one row), aligned to the state's buckets. The partial aggregate
   sorts, so a task reads no more than ``SPLIT_BYTES`` (and a file), and the
   files of streaming tables hold no more than ``tables.FILE_ROWS`` rows: it
   sorts in memory, however large the delivery;
3. writes them, bucketed on the keys, as a delta on top of the state; the
   state's own files are neither read nor written, so a merge costs what its
   changes cost, however large the target. Readers combine the state with its
   deltas: all are bucketed alike and the union keeps the bucket partitioning,
   so nothing is shuffled. Every ``MAX_DELTAS`` merges the deltas are folded
   into one, or into the state once they hold half as many bytes: a row is
   rewritten a number of times that grows with the logarithm of the target. A
   state of a few KB (``WHOLE_BYTES``) is written whole;
4. commits version n+1 as ``delta_b<B>_from<k>/`` (the changes of versions k to
   n+1) or ``data_b<B>/`` (the whole state), plus ``quarantine/`` when rows were
   quarantined, ``_schema/`` when there are none, and then ``files/`` (the
   manifest). A version counts once ``files/_SUCCESS`` exists, so a crash at
   any point leaves version n current and the rerun repeats the same merge.

Subclasses say how rows reduce (``reduce``) and how reduced rows merge with
the state (``combine``); both must be associative and commutative for the runs
to equal one batch over everything. Each file is merged once, so sums need not
be idempotent.
"""

from __future__ import annotations

import hashlib
import re
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierline.operators.expectations import VIOLATIONS
from tierline.sources.testdata import PENDING
from tierline.tables import (
    exists, filesystem, has_data_files, register_bucketed, write_bucketed,
)

_DATA, _DELTA = "data_b", "delta_b"
MANIFEST = "path string, modified bigint"      # as Spark names a file; milliseconds
LATE_S = 3600               # how far a file's time may lie behind an older file's
MAX_DELTAS = 6
WHOLE_BYTES = 64 << 10      # a state this small is cheaper written again than read in parts
SPLIT_BYTES = 16 << 20      # of new files, reduced by one task: its rows are sorted in memory

_SPLITS = "spark.sql.files.maxPartitionBytes"
_lock = threading.Lock()
_within: list = []          # [merges running, what the session had before the first]


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Scans planned meanwhile are split at ``SPLIT_BYTES``, or where the
    session splits if that is less. Merges may run side by side: the first
    sets it, the last puts it back."""
    with _lock:
        if not _within:
            was = spark.conf.get(_SPLITS)
            n, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", was.strip().lower()).groups()
            if int(n) << 10 * " kmgtp".index(unit or " ") > SPLIT_BYTES:
                spark.conf.set(_SPLITS, str(SPLIT_BYTES))
            _within[:] = [0, was]
        _within[0] += 1
    try:
        yield
    finally:
        with _lock:
            _within[0] -= 1
            if not _within[0]:
                spark.conf.set(_SPLITS, _within[1])
                _within.clear()


@dataclass
class KeyedFlow:
    root: str
    target: str
    keys: list
    buckets: int | None = None          # default: the existing state's, else
                                        # spark.sql.shuffle.partitions
    bucket_by: list | None = None       # default: the keys; may be a prefix of them

    def resolve_buckets(self, spark: SparkSession) -> int:
        """The asked bucket count (the next merge moves a state that has
        another), else the state's, else the session's partitions."""
        if self.buckets:
            return int(self.buckets)
        v = self.current_version(spark)
        if v is not None:
            return self._data_dir(spark, v)[1]
        return int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _bucket_keys(self) -> list:
        return list(self.bucket_by or self.keys)

    # ---- what a flow computes (subclasses) -------------------------------------
    def prepare(self, changes: DataFrame) -> tuple[DataFrame, DataFrame, Observation | None]:
        """(rows to apply, rows to quarantine, observation counting them)."""
        return changes, changes.limit(0), None

    def reduce(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def combine(self, state: DataFrame, reduced: DataFrame) -> DataFrame:
        raise NotImplementedError

    # whether ``combine`` leaves rows in the state's buckets and takes any
    # number of reduced rows per key, so that deltas can wait to be combined
    aligned = True

    def initial(self, reduced: DataFrame) -> DataFrame:
        """The first state, from the first reduced rows."""
        return reduced

    def changes(self, spark: SparkSession, reduced: DataFrame) -> DataFrame:
        """What reduced rows change in the current state: the rows that a delta
        holds and that ``combine`` takes beside the state."""
        return reduced

    # ---- layout ------------------------------------------------------------
    def _base(self) -> str:
        return f"{self.root.rstrip('/')}/{self.target}"

    def _vdir(self, v: int) -> str:
        return f"{self._base()}/v={v:08d}"

    def _table(self, suffix: str = "") -> str:
        h = hashlib.sha1(self._base().encode()).hexdigest()[:12]
        return f"tierline_{self.target}_{h}{suffix}"

    def _list(self, spark: SparkSession, committed: bool) -> list[int]:
        fs, p, jvm = filesystem(spark, self._base())
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            n = st.getPath().getName()
            if not (n.startswith("v=") and n[2:].isdigit()):
                continue
            if committed and not fs.exists(
                    jvm.org.apache.hadoop.fs.Path(st.getPath(), "files/_SUCCESS")):
                continue
            out.append(int(n[2:]))
        return sorted(out)

    def _data_dir(self, spark: SparkSession, v: int) -> tuple[str, int, int | None]:
        """(folder, bucket count, first version of a delta or None for a whole
        state) of a version."""
        fs, p, _ = filesystem(spark, self._vdir(v))
        for st in fs.listStatus(p):
            n = st.getPath().getName()
            if n.startswith(_DATA) and n[len(_DATA):].isdigit():
                return f"{self._vdir(v)}/{n}", int(n[len(_DATA):]), None
            if n.startswith(_DELTA):
                buckets, first = n[len(_DELTA):].split("_from")
                return f"{self._vdir(v)}/{n}", int(buckets), int(first)
        raise FileNotFoundError(f"no data folder in {self._vdir(v)}")

    def _chain(self, spark: SparkSession, v: int) -> list[int]:
        """The versions that make up the state at version ``v``: the whole one,
        then the deltas on top of it. At most ``MAX_DELTAS`` + 1."""
        committed, out = self._list(spark, committed=True), []
        while True:
            out.append(v)
            first = self._data_dir(spark, v)[2]
            if first is None:
                return out[::-1]
            v = max(c for c in committed if c < first)

    def _bytes(self, spark: SparkSession, v: int) -> int:
        path = self._data_dir(spark, v)[0]
        fs, p, _ = filesystem(spark, path)
        return fs.getContentSummary(p).getLength() if has_data_files(spark, path) else 0

    def current_version(self, spark: SparkSession) -> int | None:
        c = self._list(spark, committed=True)
        return c[-1] if c else None

    # ---- declare / read ------------------------------------------------------
    def declare(self, spark: SparkSession, schema) -> int:
        """Declares the target empty (``create_streaming_table``): commits an
        empty version 0 with the given schema if no version exists yet."""
        cur = self.current_version(spark)
        if cur is not None:
            return cur
        empty = spark.createDataFrame([], schema)
        self._write_version(spark, 0, empty, empty, spark.createDataFrame([], MANIFEST))
        return 0

    def read(self, spark: SparkSession, schema=None, version: int | None = None) -> DataFrame:
        """The current state (or that of an earlier version that ``retain`` has
        not freed) as a table bucketed on the keys (joins and aggregates on the
        keys need no shuffle of it)."""
        v = self.current_version(spark) if version is None else version
        if v is None:
            if schema is None:
                raise FileNotFoundError(f"{self.target} has no committed version")
            return spark.createDataFrame([], schema)
        whole, *deltas = [self._part(spark, c) for c in self._chain(spark, v)]
        return self.combine(whole, _union(deltas)) if deltas else whole

    def changed_since(self, spark: SparkSession, version: int) -> DataFrame | None:
        """The keys that merges after ``version`` wrote (with a folded delta
        some older ones too), read from their deltas alone. None where that
        cannot be told: the state was written whole since, or ``version`` was
        freed."""
        chain = self._chain(spark, self.current_version(spark))
        try:
            before = self._chain(spark, version)
        except (FileNotFoundError, ValueError):
            return None
        if before[0] != chain[0]:
            return None
        parts = [self._part(spark, c) for c in chain if c > version]
        if not parts:
            return self._part(spark, chain[0]).select(*self.keys).limit(0)
        return _union([p.select(*self.keys) for p in parts]).distinct()

    def _part(self, spark: SparkSession, v: int) -> DataFrame:
        path, b, first = self._data_dir(spark, v)
        marker = self._vdir(v) + "/_schema"
        schema = spark.read.parquet(marker if exists(spark, marker) else path).schema
        part = register_bucketed(spark, self._table("" if first is None else f"_d{v}"), path,
                                 self._bucket_keys(), b, schema)
        if first is None:
            return part
        # A union of plain columnar scans does not put equal buckets together,
        # though it says so; this filter, true for every row, makes its input rows.
        return part.filter(F.hash(*self._bucket_keys()) >= F.lit(-(1 << 31)))

    def quarantine(self, spark: SparkSession) -> DataFrame | None:
        """All quarantined rows of the committed versions (None if none)."""
        dirs = [self._vdir(v) + "/quarantine" for v in self._list(spark, committed=True)]
        dirs = [d for d in dirs if exists(spark, d + "/_SUCCESS")]
        return spark.read.parquet(*dirs) if dirs else None

    def _manifest(self, spark: SparkSession, v: int | None) -> DataFrame:
        if v is None:
            return spark.createDataFrame([], MANIFEST)
        return spark.read.schema(MANIFEST).parquet(self._vdir(v) + "/files")

    def retain(self, spark: SparkSession, keep: int = 2) -> list[int]:
        """Frees all but the newest ``keep`` committed versions: their state
        and manifest files go, their commit marker and quarantined rows stay.
        Failed attempts older than the newest committed version are removed."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        committed = self._list(spark, committed=True)
        if not committed:
            return []
        newest = committed[-1]
        kept = set(committed[-keep:]).union(*[self._chain(spark, v) for v in committed[-keep:]])
        fs, _, jvm = filesystem(spark, self._base())
        freed = []
        for v in self._list(spark, committed=False):
            if v in kept or v > newest:
                continue
            vdir = jvm.org.apache.hadoop.fs.Path(self._vdir(v))
            if v not in committed:
                fs.delete(vdir, True)                    # a failed attempt
            else:
                for st in fs.listStatus(vdir):
                    n = st.getPath().getName()
                    if n.startswith((_DATA, _DELTA)) or n == "_schema":
                        fs.delete(st.getPath(), True)
                    elif n == "files":
                        for f in fs.listStatus(st.getPath()):
                            if f.getPath().getName() != "_SUCCESS":
                                fs.delete(f.getPath(), True)
            freed.append(v)
        return freed

    # ---- the merge -----------------------------------------------------------
    def _write_version(self, spark, v, data, invalid, manifest, obs=None, buckets=None,
                       aligned=False, first=None) -> None:
        base = self._vdir(v)
        b = buckets or self.resolve_buckets(spark)
        path = f"{base}/{_DATA}{b}" if first is None else f"{base}/{_DELTA}{b}_from{first}"
        write_bucketed(data, path, self._bucket_keys(), b, self._table(f"_w{v}"), aligned)
        if not has_data_files(spark, path):            # empty state: keep its schema
            data.limit(0).write.mode("overwrite").parquet(base + "/_schema")
        if obs is not None and (obs.get.get("invalid") or 0):
            invalid.write.mode("overwrite").parquet(base + "/quarantine")   # only then scanned
        manifest.write.mode("overwrite").parquet(base + "/files")   # commit point

    def run(self, spark: SparkSession, source_path: str) -> int | None:
        """Merges the source table's new files; returns the current version.
        A source that has committed nothing yet leaves the state as it is."""
        current = self.current_version(spark)
        if not exists(spark, source_path.rstrip("/") + "/_spark_metadata/0") and \
                not has_data_files(spark, source_path):
            return current
        src = spark.read.parquet(source_path)
        refreshed = current is not None and self._other_generation(spark, current, source_path)
        if refreshed:
            current = None
        done = self._manifest(spark, current)
        listed = self._written_since(src, done, current)
        new = listed.join(done, "path", "left_anti").collect()
        if not new and not refreshed:
            return current
        files = spark.read.schema(src.schema).parquet(*[unquote(r.path) for r in new]) if new else src.limit(0)
        changes = files.drop(VIOLATIONS)
        if PENDING in src.columns:                     # waiting rows are no changes yet
            changes = changes.filter(F.col(PENDING).isNull()).drop(PENDING)
        rows, invalid, obs = self.prepare(changes)
        b = self.resolve_buckets(spark)
        reduced = self.reduce(rows).repartition(b, *self._bucket_keys())
        existing = self._list(spark, committed=False)
        v = (existing[-1] + 1) if existing else 1
        merged, first, aligned = self._merged(spark, current, reduced, v, b)
        manifest = done.unionByName(spark.createDataFrame(new, MANIFEST))
        newest = max((r.modified for r in new), default=0)
        manifest = manifest.filter(F.col("modified").isNull()
                                   | (F.col("modified") >= newest - 1000 * LATE_S))
        with small_splits(spark):
            self._write_version(spark, v, merged, invalid, manifest.coalesce(1), obs, b, aligned, first)
        return v

    def _written_since(self, src: DataFrame, done: DataFrame, current: int | None) -> DataFrame:
        """(path, modified) of the source's committed files with rows, as of the
        manifest's newest file less ``LATE_S``. The condition is on file
        metadata, so older files are left out when the scan is planned; of the
        others only the row counts are read."""
        mark = done.agg(F.max("modified").alias("m")).first().m if current is not None else None
        if mark is not None:
            since = F.timestamp_millis(F.lit(mark - 1000 * LATE_S))
            src = src.filter(F.col("_metadata.file_modification_time") >= since)
        files = src.select(F.col("_metadata.file_path").alias("path"),
                           F.unix_millis("_metadata.file_modification_time").alias("modified"))
        return files.distinct()

    def _merged(self, spark: SparkSession, current: int | None, reduced: DataFrame, v: int,
                b: int) -> tuple[DataFrame, int | None, bool]:
        """(what version ``v`` stores, first version of the delta or None for
        the whole state, whether it is in the buckets already)."""
        if current is None:
            return self.initial(reduced), None, self.aligned
        reduced = self.changes(spark, reduced)
        same = self._data_dir(spark, current)[1] == b
        if not (self.aligned and same):
            return self.combine(self.read(spark), reduced), None, False
        whole, *deltas = self._chain(spark, current)
        size = self._bytes(spark, whole)
        if size > WHOLE_BYTES and len(deltas) < MAX_DELTAS:
            return reduced, v, True
        if size <= WHOLE_BYTES or 2 * sum(self._bytes(spark, d) for d in deltas) >= size:
            return self.combine(self.read(spark), reduced), None, True
        oldest, *later = [self._part(spark, d) for d in deltas]
        return self.combine(oldest, _union([*later, reduced])), self._data_dir(spark, deltas[0])[2], True

    def _other_generation(self, spark: SparkSession, version: int, source_path: str) -> bool:
        """Whether the version holds files of another generation of the source."""
        here = "/".join(source_path.rstrip("/").split("/")[-3:]) + "/"
        same = F.col("path").contains(here) | F.col("path").contains(quote(here, safe="/=:,+@&$!*'();~"))
        return not self._manifest(spark, version).filter(~same).isEmpty()


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
