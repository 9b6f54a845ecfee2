"""A log row per bulk run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

RUN_LOG = "event_type string, description string, records_affected long, created_at timestamp"


def logged_write(
    df: DataFrame, write: Callable[[DataFrame], None], log_path: str, event_type: str, description: str
) -> int:
    """Write ``df`` and append one row with the number of records to the run log.

    The rows are counted while they are written, not by a second job.
    """
    seen = Observation(f"run_{event_type}")
    write(df.observe(seen, F.count(F.lit(1)).alias("records")))
    records = int(seen.get["records"])
    row = (event_type, description, records, dt.datetime.now(dt.timezone.utc))
    df.sparkSession.createDataFrame([row], RUN_LOG).write.mode("append").parquet(log_path)
    return records
