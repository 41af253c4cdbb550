"""Session options that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

#: Rows and bytes of one Arrow batch: long texts make large batches otherwise.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def lower_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to ARROW_ROWS and ARROW_BYTES, for results that run when the caller reads them: such rows have no job of their own that an option
    could be bound to, and whole texts in batches of Spark's size fill an executor's memory.  Sessions with smaller batches keep them.
    """
    for name, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int(spark.conf.get(key).rstrip("bB"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def session(name: str = "lakehone", **more: str) -> SparkSession:
    """A session with these options; master and sizes are the cluster's own."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**OPTIONS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
