from tierline.operators.cdc import END_AT, START_AT, as_of, scd1, scd1_merge, scd2, split_invalid
from tierline.operators.expectations import (
    Expectation, apply_expectations, expectation_report, failed_expectation, gate,
    observation_report,
)
from tierline.operators.maintenance import dedupe, delete_where
from tierline.operators.sampling import stable_sample

__all__ = [
    "END_AT", "START_AT", "as_of", "scd1", "scd1_merge", "scd2", "split_invalid",
    "Expectation", "apply_expectations", "expectation_report", "failed_expectation", "gate",
    "observation_report", "dedupe", "delete_where", "stable_sample",
]
