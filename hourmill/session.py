"""Session checks shared by all operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_UTC_NAMES = {"UTC", "ETC/UTC", "GMT", "ETC/GMT", "Z", "+00:00", "+0000", "UTC+0", "UTC+00:00"}


def require_utc(where: SparkSession | DataFrame) -> SparkSession:
    """Stop unless the session zone is UTC.

    Months and days are calendar values of the session zone, while raw keys
    carry a ``Z``. In any other zone the raw and the clean layer would disagree
    about the month of a row near midnight.
    """
    spark = where if isinstance(where, SparkSession) else where.sparkSession
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in _UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone!r}")
    return spark
