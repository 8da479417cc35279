"""Incremental conversion: each run picks up the vintages of which files arrived since the last one.

The stream only carries file names; its checkpoint holds which of them were seen. Rows go through
the writer that batch conversion uses, a whole vintage at a time, so a repeated run replaces
what it wrote before and both ways can share one store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.landing import convert


def convert_new_files(spark: SparkSession, landing: str, root: str, progress: str, files_per_batch: int = 64) -> StreamingQuery:
    """Start one pass over the unseen files below ``landing``; the query ends by itself.

    A vintage of which a file is new is converted anew with all its files. A malformed line fails
    the pass, and its files come again in the next one.
    """

    def take(batch: DataFrame, _: int) -> None:
        vintages = [r.vintage for r in batch.select("vintage").distinct().collect() if r.vintage]
        if vintages:
            failed = convert(spark, landing, root, overwrite=True, only=vintages).where("status = 'FAIL'").collect()
            if failed:
                raise ValueError(f"malformed lines in {sorted(r.vintage for r in failed)}")

    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .load(landing)
    )
    vintage = F.regexp_extract("path", r"(\d{4}Q[1-4])\.csv[^/]*(?:/[^/]*)?$", 1)
    return (
        names.select(vintage.alias("vintage"))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
