"""Record ingest into a typed append table (the workshop's direct-ingest lab,
re-aimed): producers drop JSON lines into a landing folder; a stream parses
them against the declared schema, removes at-least-once duplicates on ``id``
and appends to ``measurements``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.expectations import Expectation

MEASUREMENTS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True, {"comment": "unique id per submission"}),
    T.StructField("city", T.StringType(), True, {"comment": "city of the reading"}),
    T.StructField("temperature", T.FloatType(), True, {"comment": "temperature in degrees C"}),
    T.StructField("comment", T.StringType(), True, {"comment": "optional free-form note"}),
])

# a record needs a city; the temperature must parse as a number
RECORD_EXPECTATIONS = [
    Expectation("city_present", "length(city) > 0", "fail"),
    Expectation("temperature_parsed", "temperature IS NOT NULL", "drop"),
]

# the same on the landed lines, none of which stops the stream
LANDING_EXPECTATIONS = [
    Expectation("line_parsed", "_corrupt_record IS NULL", "drop"),
    Expectation("city_present", "length(city) > 0", "drop"),
    Expectation("temperature_parsed", "temperature IS NOT NULL", "drop"),
]


def records_from_values(df: DataFrame, city: str = "city", temperature: str = "temperature",
                        comment: str = "comment", id_col: str | None = None) -> DataFrame:
    """Typed records from raw producer values: trimmed city, temperature parsed
    with try_cast (bad text -> null), comment defaulting to '' and an id
    (given column, else a fresh uuid per row)."""
    rid = F.col(id_col).cast("string") if id_col else F.expr("uuid()")
    return df.select(
        rid.alias("id"),
        F.trim(F.col(city).cast("string")).alias("city"),
        F.col(temperature).cast("string").try_cast("float").alias("temperature"),
        F.coalesce(F.col(comment).cast("string"), F.lit("")).alias("comment"))


def submit_records(raw: DataFrame, path: str, **columns) -> None:
    """Producer side: type the raw values, enforce the record checks (an
    empty city fails the submission, an unparsable temperature is dropped) and
    append the records as JSON lines in one job (ids are minted once, by
    that job)."""
    from tierline.operators.expectations import apply_expectations
    recs, _ = apply_expectations(records_from_values(raw, **columns), RECORD_EXPECTATIONS)
    land(recs, path)


def to_json_lines(records: DataFrame) -> DataFrame:
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))


def parse_json_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parses JSON text against MEASUREMENTS_SCHEMA (works on streams too)."""
    p = F.from_json(F.col(value), MEASUREMENTS_SCHEMA)
    return lines.select(p.alias("r")).select("r.*")


def land(records: DataFrame, path: str, files: int | None = None) -> None:
    """One producer's delivery: appends JSON lines to the landing folder."""
    out = records if files is None else records.repartition(files)
    out.write.mode("append").json(path)


def read_landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(MEASUREMENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def sorted_view(measurements: DataFrame) -> DataFrame:
    """ORDER BY city, temperature DESC (a global range-partitioned sort)."""
    return measurements.orderBy(F.col("city"), F.col("temperature").desc())


def as_double(measurements: DataFrame) -> DataFrame:
    return measurements.withColumn("temperature", F.col("temperature").cast("double"))


def id_is(value) -> str:
    """SQL condition on the record id (as text, so that it can be kept)."""
    return "id = '" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
