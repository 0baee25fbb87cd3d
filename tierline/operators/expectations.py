"""Named data-quality expectations with LOG / DROP / FAIL actions.

One pass, no extra job: ``observe`` counts every violation below the gate
(``CollectMetrics`` blocks filter pushdown, so the counts see all rows), then a
single filter expression applies FAIL before DROP:

    CASE WHEN NOT fail_1 THEN raise_error('EXPECT fail_1 ...')
         WHEN NOT fail_2 THEN raise_error(...)
         ELSE drop_1 AND drop_2 ... END

A predicate that is not TRUE (FALSE or NULL) is a violation. A row violating
several expectations is counted by each of them before any row is removed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ACTIONS = ("log", "drop", "fail")
ERROR_PREFIX = "EXPECT"

REPORT_SCHEMA = ("dataset string, expectation string, action string, input_rows bigint, "
                 "failed_rows bigint, output_rows bigint, dropped_rows bigint, "
                 "written_pct double, dropped_pct double")


def _percent(part, whole) -> Column:
    return F.round(F.when(F.col(whole) > 0, F.col(part) * 100.0 / F.col(whole)), 2)


def _with_shares(report: DataFrame) -> DataFrame:
    return (report.withColumn("written_pct", _percent("output_rows", "input_rows"))
                  .withColumn("dropped_pct", _percent("dropped_rows", "input_rows")))


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str | Column
    action: str = "log"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, got {self.action!r}")
        if not self.name or not self.name.replace("_", "").isalnum():
            raise ValueError(f"expectation name must be an identifier, got {self.name!r}")

    def holds(self) -> Column:
        p = F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate
        return F.coalesce(p, F.lit(False))


def _drop_ok(expectations) -> Column:
    ok = F.lit(True)
    for e in expectations:
        if e.action == "drop":
            ok = ok & e.holds()
    return ok


def gate(expectations) -> Column:
    """Filter condition: raises on the first failing FAIL expectation, else
    keeps the rows that pass every DROP expectation."""
    fails = [e for e in expectations if e.action == "fail"]
    cond = None
    for e in fails:
        msg = F.lit(f"{ERROR_PREFIX} {e.name}: {e.predicate}")
        raise_ = F.raise_error(msg).cast("boolean")
        cond = F.when(~e.holds(), raise_) if cond is None else cond.when(~e.holds(), raise_)
    keep = _drop_ok(expectations)
    return keep if cond is None else cond.otherwise(keep)


def violation_metrics(expectations) -> list[Column]:
    return ([F.count(F.lit(1)).alias("__rows"),
             F.count_if(~_drop_ok(expectations)).alias("__dropped")]
            + [F.count_if(~e.holds()).alias(e.name) for e in expectations])


def apply_expectations(df: DataFrame, expectations,
                       name: str | None = None) -> tuple[DataFrame, Observation]:
    """Returns the gated DataFrame and the Observation holding the counts (ready
    once an action on the returned DataFrame finished)."""
    names = [e.name for e in expectations]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate expectation names: {names}")
    obs = Observation(name or f"expect_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, *violation_metrics(expectations))
    if not expectations:
        return observed, obs                      # row count only; no gate
    return observed.filter(gate(expectations)), obs


def expectation_report(df: DataFrame, expectations, dataset: str) -> DataFrame:
    """The report as a DataFrame computed from the ungated input: one row per
    expectation with input, failed, output (written) and dropped row counts
    and shares.
    One aggregate pass (partial + final), then a 1-row unpivot."""
    agg = df.agg(*violation_metrics(expectations))
    rows = [F.struct(F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
                     F.col(e.name).alias("failed_rows")) for e in expectations]
    return _with_shares(agg.select(F.col("__rows").alias("input_rows"),
                       F.col("__dropped").alias("dropped_rows"),
                       F.explode(F.array(*rows)).alias("r"))
               .select(F.lit(dataset).alias("dataset"), "r.expectation", "r.action",
                       "input_rows", "r.failed_rows",
                       (F.col("input_rows") - F.col("dropped_rows")).alias("output_rows"),
                       "dropped_rows"))


def observation_report(spark: SparkSession, obs: Observation | dict, expectations,
                       dataset: str) -> DataFrame:
    """The same report from an Observation (or a dict of summed metrics) after
    the gated DataFrame was written. Values are a handful of counters."""
    m = obs.get if isinstance(obs, Observation) else obs
    n, dropped = int(m.get("__rows", 0) or 0), int(m.get("__dropped", 0) or 0)
    rows = [(dataset, e.name, e.action, n, int(m.get(e.name, 0) or 0), n - dropped, dropped)
            for e in expectations]
    return _with_shares(spark.createDataFrame(rows, REPORT_SCHEMA.split(", written_pct")[0]))


# the column a checked streaming table carries: bit i is set where the row
# violates expectation i
VIOLATIONS = "_violations"


def violation_mask(expectations) -> Column:
    """The violated expectations of a row as a bitmask (62 at most)."""
    if len(expectations) > 62:
        raise ValueError("at most 62 expectations on one dataset")
    mask = F.lit(0).cast("long")
    for i, e in enumerate(expectations):
        mask = mask + F.when(e.holds(), F.lit(0)).otherwise(F.lit(1 << i)).cast("long")
    return mask


def drop_bits(expectations) -> int:
    """The bits of the DROP (and FAIL) expectations: rows with one of them are
    not part of the dataset."""
    return sum(1 << i for i, e in enumerate(expectations) if e.action != "log")


def mask_report(flagged: DataFrame, expectations, dataset: str) -> DataFrame:
    """The report from rows that carry ``VIOLATIONS``: rows are counted per
    different mask (map-side first; only that column is read), then per
    expectation."""
    mask, n = F.col(VIOLATIONS), F.col("n")
    per_mask = flagged.groupBy(VIOLATIONS).agg(F.count(F.lit(1)).alias("n"))
    gone = F.when(mask.bitwiseAND(F.lit(drop_bits(expectations))) != 0, n).otherwise(0)
    sums = [F.sum(n).alias("__rows"), F.sum(gone).alias("__dropped")]
    sums += [F.sum(F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, n).otherwise(0)).alias(e.name)
             for i, e in enumerate(expectations)]
    rows = [F.struct(F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
                     F.coalesce(F.col(e.name), F.lit(0)).alias("failed_rows")) for e in expectations]
    total, dropped = (F.coalesce(F.col(c), F.lit(0)) for c in ("__rows", "__dropped"))
    return _with_shares(per_mask.agg(*sums).select(total.alias("input_rows"), dropped.alias("dropped_rows"),
                                                   F.explode(F.array(*rows)).alias("r"))
                        .select(F.lit(dataset).alias("dataset"), "r.expectation", "r.action", "input_rows",
                                "r.failed_rows", (F.col("input_rows") - F.col("dropped_rows"))
                                .alias("output_rows"), "dropped_rows"))


def failed_expectation(exc: BaseException) -> str | None:
    """Name of the FAIL expectation that aborted an update, if any."""
    text = str(exc)
    marker = f"{ERROR_PREFIX} "
    i = text.find(marker)
    if i < 0:
        return None
    return text[i + len(marker):].split(":", 1)[0].strip()
