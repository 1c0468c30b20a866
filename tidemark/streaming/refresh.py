"""Refresh of the online table from newly arrived history files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import moment
from tidemark.operators.online import as_online
from tidemark.operators.validation import quarantined_rows, valid_rows
from tidemark.schemas import FEATURE_HISTORY, VERSION
from tidemark.sources.online_log import write_online

SOURCE = "refresh"


def refresh_online(
    spark: SparkSession, history_path: str, online_root: str, checkpoint: str, as_of: datetime,
    version: str = VERSION, max_files: int | None = None,
) -> None:
    """Take in every history file not seen by earlier runs, then stop.

    Every row is validated, and the online table gets the newest valid row of each entity: a row that
    breaks a rule leaves an older valid one in place, as it does when a batch is materialized. So the
    result is the same however files fall into batches, and a batch writes only the buckets of the
    entities it brings. `as_of` is only the time of writing; rows later than it count, since a
    file is taken in once. Rows that break a rule are kept per batch in a quarantine beside the table.
    The table knows the last batch it took in, so a batch that Spark repeats changes nothing.
    """
    arrivals = spark.readStream.schema(FEATURE_HISTORY)
    if max_files:
        arrivals = arrivals.option("maxFilesPerTrigger", max_files)

    def merge(batch: DataFrame, number: int) -> None:
        # the files of a batch are stored already, so either write reads them
        rows = batch.where(F.col("feature_version") == version)
        write_online(spark, online_root, as_online(valid_rows(rows), as_of), batch=(SOURCE, number))
        bad = quarantined_rows(rows).withColumns({"run_id": F.lit(f"{SOURCE}-{number}"), "quarantined_at": moment(as_of)})
        bad.write.mode("overwrite").parquet(f"{online_root}_quarantine/batch={number:012d}")

    query = (
        arrivals.parquet(history_path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
