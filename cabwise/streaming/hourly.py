"""Incremental hourly profile with Structured Streaming.

New trip files land in a directory; the same ``hourly_profile`` logic runs
as a streaming aggregation. Its state is one (sum, count) pair per hour of
day, 24 keys whatever the input size, kept in the state store under the
checkpoint location in the shared folder, so a restarted query resumes
where it stopped. Every micro-batch publishes the complete result (24 rows at
most) from ``foreachBatch``, that is before its offsets are committed: after
a crash between the two the batch runs again and publishes the same rows.
Each publication goes to a folder named after its batch, and readers take the
latest finished one, so a half-written folder is never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.functions.timecols import hour_of_day
from cabwise.operators.trips import valid_trips
from cabwise.session import staging_path


def hourly_aggregate(trips: DataFrame) -> DataFrame:
    """Unordered hourly means (streaming-compatible form of hourly_profile)."""
    return (valid_trips(trips)
            .groupBy(hour_of_day("start_ts").alias("hour"))
            .agg(F.avg("start_lon").alias("longitude"), F.avg("start_lat").alias("latitude")))


def run_hourly_profile_stream(spark: SparkSession, source_dir: str, output_path: str,
                              checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                              schema=None) -> str:
    """Process every file present in ``source_dir`` (``availableNow``) and
    return ``output_path``; rerunning later picks up only new files.

    By default one micro-batch takes all files; ``max_files_per_trigger``
    bounds it."""
    if schema is None:
        schema = spark.read.parquet(source_dir).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def publish(result: DataFrame, batch_id: int) -> None:
        result.write.mode("overwrite").parquet(f"{output_path}/batch={batch_id:012d}")

    query = (hourly_aggregate(reader.parquet(source_dir)).writeStream
             .outputMode("complete")
             .foreachBatch(publish)
             .option("checkpointLocation", checkpoint or staging_path(spark, "hourly-stream-ckpt"))
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return output_path


def read_hourly_profile(spark: SparkSession, output_path: str) -> DataFrame:
    """The profile that the latest micro-batch has published."""
    published = spark.read.parquet(output_path)
    return (published.where(F.col("batch") == published.agg(F.max("batch")).scalar())
            .drop("batch").orderBy("hour"))
