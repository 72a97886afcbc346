"""Stage audit rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "run_id string, stage string, action string, input_path string, output_path string, rows_before bigint, "
    "rows_after bigint, rows_dropped bigint, drop_reasons map<string,bigint>, warnings array<string>, errors array<string>"
)


def audit_row(
    spark: SparkSession, *, run_id: str, stage: str, action: str, input_path: str, output_path: str, rows_before: int,
    rows_after: int, drop_reasons: Mapping[str, int] | None = None, warnings: Sequence[str] = (), errors: Sequence[str] = (),
) -> DataFrame:
    row = (run_id, stage, action, input_path, output_path, rows_before, rows_after, rows_before - rows_after,
           dict(drop_reasons or {}), list(warnings), list(errors))
    return spark.createDataFrame([row], AUDIT_SCHEMA).withColumn("logged_at", F.current_timestamp())
