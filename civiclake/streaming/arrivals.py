"""The clean step as a file stream.

Every contract and enrichment function is a stateless column expression, so the pipeline's own
transform runs unchanged on a stream; there is no state to keep and nothing to watermark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from civiclake.plans.pipeline import LandingToClean
from civiclake.sources.landing import READ_OPTIONS


def clean_arrivals(spark: SparkSession, pipeline: LandingToClean, landing_root: str, clean_root: str,
                   checkpoint: str, landing_schema: T.StructType, *, shards_per_batch: int = 100) -> StreamingQuery:
    """Append the clean rows of every landing shard not yet seen, then stop. The checkpoint records
    the shards done, so a restarted run neither loses nor repeats any."""
    arriving = (spark.readStream.options(**READ_OPTIONS).option("mode", "DROPMALFORMED")
                .option("recursiveFileLookup", True).option("maxFilesPerTrigger", shards_per_batch)
                .schema(landing_schema).csv(landing_root))
    return (pipeline.transform(arriving).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", clean_root)
            .trigger(availableNow=True).start())
