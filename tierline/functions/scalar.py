"""Column expressions shared by the jobs. All are built-in Spark functions, so
they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: these must equal the workshop's for equal results ---------
REASONS = [
    "velocity_check_failed",
    "stolen_card_report",
    "unusual_location",
    "device_fingerprint_mismatch",
    "suspicious_pattern",
]
ZONES = ["Zone-North", "Zone-South", "Zone-East", "Zone-West"]
FLAG_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
HOT_ABOVE_C = 28          # status 'HOT' when temperature_c > 28, else 'OK'
SENSORS = 25              # sensor_id = value % 25
ZONE_SHIFT_EVERY = 100    # the fleet moves one zone every 100 registry ticks
CONFIDENCE_BASE = 0.70    # confidence = 0.70 + (h % 3000) / 10000
FLAG_AGE_DAYS = 90        # flagged_at = as_of - (h % 90) days
# ---------------------------------------------------------------------------

_PRIME = 1000003
_MULT = 7919
SELECT_PRIME = 2147483647
SELECT_MULT = 1220703125


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_hash(key) -> Column:
    """Murmur3 ``abs(hash(key))`` as the workshop computes it; widened to
    BIGINT first so that hash = INT_MIN does not overflow under ANSI mode."""
    return F.abs(F.hash(_col(key)).cast("bigint"))


def portable_select_hash(key) -> Column:
    """A hash of an integral key in [0, 2^31 - 1) for choosing keys, independent
    of ``portable_key_hash`` (which fills the chosen keys' columns)."""
    k = F.pmod(_col(key).cast("bigint"), F.lit(SELECT_PRIME))
    return F.pmod(k * F.lit(SELECT_MULT), F.lit(SELECT_PRIME))


def portable_key_hash(key) -> Column:
    """A non-negative integer hash of an integral key that plain SQL engines
    can compute too: ((key mod p) * 7919) mod p with p = 1000003."""
    k = _col(key).cast("bigint")
    return F.pmod(F.pmod(k, F.lit(_PRIME)) * F.lit(_MULT), F.lit(_PRIME))


def fraud_reason(h: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r) for r in REASONS]),
                        (h % len(REASONS) + 1).cast("int"))


def flagged_at(h: Column, as_of: Column) -> Column:
    """ISO-8601 text of ``as_of - (h % 90) days``; ``as_of`` is a TIMESTAMP_NTZ
    (pass a fixed value for repeatable output)."""
    return F.date_format(as_of - F.make_dt_interval((h % FLAG_AGE_DAYS).cast("int")),
                         FLAG_TIME_FORMAT)


def fraud_confidence(h: Column) -> Column:
    return F.round(F.lit(CONFIDENCE_BASE) + (h % 3000) / F.lit(10000.0), 4)


def sensor_status(temperature_c) -> Column:
    return F.when(_col(temperature_c) > HOT_ABOVE_C, F.lit("HOT")).otherwise(F.lit("OK"))


def sensor_zone(value) -> Column:
    """Zone of a registry tick: ((value % 25) + floor(value / 100)) % 4, 1-based
    into ZONES."""
    v = _col(value)
    idx = ((v % SENSORS) + F.floor(v / ZONE_SHIFT_EVERY)) % len(ZONES)
    return F.element_at(F.array(*[F.lit(z) for z in ZONES]), idx.cast("int") + 1)


def owner_slug(email) -> Column:
    """Part of an e-mail before '@', '.' and '-' turned into '_', lower case."""
    return F.lower(F.translate(F.split_part(_col(email), F.lit("@"), F.lit(1)), ".-", "__"))


EXACT = "decimal(30,10)"


def exact(c) -> Column:
    """A double measure as an exact decimal (values with up to 10 decimals
    are represented exactly), so sums and averages do not depend on the
    order rows are added in. Null for NaN and infinities."""
    return F.when(~not_finite(c), _col(c)).cast(EXACT)


def not_finite(c) -> Column:
    d = _col(c).cast("double")
    return F.isnan(d) | (F.abs(d) == F.lit(float("inf")))


def round_sum(c, digits: int = 2) -> Column:
    """ROUND(SUM(c), digits) computed exactly; as the plain double sum (NaN,
    infinity) where a value is not finite."""
    exactly = F.round(F.sum(exact(c)), digits).cast("double")
    return F.when(F.max(not_finite(c)), F.sum(_col(c).cast("double"))).otherwise(exactly)


def round_avg(c, digits: int = 2) -> Column:
    """ROUND(AVG(c), digits) computed exactly: a plain double average depends
    on summation order, which varies with shuffle fetch order, and flips the
    half-up rounding when the true average lies on a boundary (6 values
    averaging 24.195). Where a value is not finite, as the double average."""
    exactly = F.round(F.avg(exact(c)), digits).cast("double")
    return F.when(F.max(not_finite(c)), F.avg(_col(c).cast("double"))).otherwise(exactly)
