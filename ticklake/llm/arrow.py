"""Arrow batches of bounded size for Python stages."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS = 2500
_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's limit of rows in an Arrow batch
    to ``ROWS`` if it is higher: texts can be long, and a batch is held by
    the JVM and by the Python worker at once."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_KEY, "10000")) <= ROWS:
        conf.set(_KEY, str(ROWS))
    return df
