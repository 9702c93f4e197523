"""Streaming totals."""

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import SCHEMAS
from ..streaming import totals as X
from .registry import query


@query("stream_running_totals", """
    SELECT user_id, round(sum(value), 2) AS total, count(*) AS n_rows FROM events GROUP BY 1""")
def stream_running_totals(spark, sf):
    stream = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events*.parquet").parquet(sf)
    out = scratch_path(spark, "totals")
    running = X.running_totals(stream, "user_id", "value", out, scratch_path(spark, "totals-state"))
    running.awaitTermination()
    return X.read_totals(spark, out, "user_id").withColumn("total", F.round("total", 2))
