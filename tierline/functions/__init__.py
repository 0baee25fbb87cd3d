from tierline.functions.scalar import (
    FLAG_TIME_FORMAT, REASONS, ZONES, exact, fraud_reason, flagged_at, fraud_confidence,
    key_hash, portable_key_hash, owner_slug, round_avg, sensor_status, sensor_zone,
)

__all__ = [
    "FLAG_TIME_FORMAT", "REASONS", "ZONES", "exact", "fraud_reason", "flagged_at",
    "fraud_confidence", "key_hash", "portable_key_hash", "owner_slug",
    "round_avg", "sensor_status", "sensor_zone",
]
