"""Expectations on streams.

What the pipelines report is counted from stored data: ``flag`` adds the
violated expectations of every row as a bitmask, the streaming table keeps it
with the row, and ``stored_report`` counts the masks of the committed files. A
crash at any point loses no count: what is committed is counted, what is not is
run again. FAIL stops the stream before its batch is committed; a row that
violates a DROP expectation stays in the flagged table for the count, and
``passing`` leaves it out of everything behind it.

For watching a running query there are also counters per micro-batch from
``observe``, collected from its progress reports (``MetricsLog``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import functions as F

from tierline.operators.expectations import (
    VIOLATIONS, drop_bits, gate, mask_report, observation_report, violation_mask, violation_metrics,
)
from tierline.streaming.tables import read_table
from tierline.tables import exists

LOG_SCHEMA = "query string, batch bigint, metric string, value bigint"


def flag(df: DataFrame, expectations) -> DataFrame:
    """Adds every row's violations; a FAIL expectation stops the stream."""
    fails = [e for e in expectations if e.action == "fail"]
    kept = df.filter(gate(fails)) if fails else df
    return kept.withColumn(VIOLATIONS, violation_mask(expectations))


def passing(flagged: DataFrame, expectations) -> DataFrame:
    """The rows that belong to the dataset, without the mask."""
    bits = F.lit(drop_bits(expectations))
    return flagged.filter(F.col(VIOLATIONS).bitwiseAND(bits) == 0).drop(VIOLATIONS)


def stored_report(spark: SparkSession, root: str, table: str, expectations,
                  dataset: str | None = None) -> DataFrame:
    """The report over the committed rows of a flagged streaming table (its
    current generation); before the first commit all counts are 0."""
    rows = read_table(spark, root, table, f"{VIOLATIONS} bigint")
    return mask_report(rows.select(VIOLATIONS), expectations, dataset or table)


def observe_stream(df: DataFrame, expectations, name: str) -> DataFrame:
    """Counts every expectation on each micro-batch, then applies the gate."""
    if not expectations:
        return df
    return df.observe(name, *violation_metrics(expectations)).filter(gate(expectations))


class MetricsLog:
    """Observed counters per (query, batch id), collected from progress
    reports. A query keeps only its last
    ``spark.sql.streaming.numRecentProgressUpdates`` reports, so ``collect``
    (or ``wait``, which collects while it waits) must come round more often;
    if it did not, ``totals`` raises instead of missing a batch.

    With ``path`` the counters outlive the process: ``store`` appends them to
    that folder and a new log starts from it. A batch that a restarted query
    ran again is counted once, as it ran last."""

    def __init__(self, name: str, spark: SparkSession | None = None, path: str | None = None):
        self.name, self.spark, self.path = name, spark, path
        self.batches: dict = {}
        self.ran: dict = {}
        self.stored: set = set()
        if path and exists(spark, path):
            for r in spark.read.schema(LOG_SCHEMA).parquet(path).collect():
                self.batches.setdefault((r.query, r.batch), {})[r.metric] = r.value
            self.stored = set(self.batches)

    def collect(self, queries) -> None:
        for q in ([queries] if isinstance(queries, StreamingQuery) else queries):
            for p in q.recentProgress:
                row = (p.get("observedMetrics") or {}).get(self.name)
                if row is not None:
                    key = (str(p.get("id")), int(p.get("batchId")))
                    self.batches[key] = row.asDict()
                    self.ran.setdefault(key[0], set()).add(key[1])
                    self.stored.discard(key)

    def wait(self, *queries, poll_s: float = 1.0) -> None:
        """Awaits the queries, collecting all the while; raises their error."""
        for q in queries:
            while not q.awaitTermination(poll_s):
                self.collect(queries)
        self.collect(queries)

    def store(self) -> None:
        rows = [(q, b, m, int(v or 0)) for (q, b), row in self.batches.items()
                if (q, b) not in self.stored for m, v in row.items()]
        if self.path and rows:
            self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self.stored = set(self.batches)

    def totals(self) -> dict:
        """Counters summed over the batches of the newest query (a full
        refresh starts a new one)."""
        if not self.batches:
            return {}
        newest = next(reversed(self.ran)) if self.ran else next(reversed(self.batches))[0]
        seen = sorted(b for q, b in self.batches if q == newest)
        if seen != list(range(seen[-1] + 1)):
            raise RuntimeError(f"{self.name}: progress of some batches was not collected in time")
        total: dict = {}
        for (q, _), row in self.batches.items():
            for k, v in row.items() if q == newest else ():
                total[k] = total.get(k, 0) + int(v or 0)
        return total


def stream_report(spark: SparkSession, queries, name: str, expectations,
                  dataset: str) -> DataFrame:
    """The expectation report over the batches the queries still retain."""
    log = MetricsLog(name)
    log.collect(queries)
    return observation_report(spark, log.totals(), expectations, dataset)
