"""The ingestion job as a file-source stream.

Here the stream's checkpoint remembers which files were seen, in place of the ledger
anti-join: the folder is listed by the source, and each micro-batch is landed by the same switch
of versions, so a replayed batch changes nothing. The ledger gets every file of the batch, as the
source's own log in the checkpoint names it, with or without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridlake.plans.ingest import Target, clean, create_database, raw_folder, read_raw, replace_sources, row_counts, versioned, write_raw
from gridlake.sources.files import SOURCE_COLUMN, plain_name, source_name


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """Names of the files of a micro-batch, rows or not, from the log that the file source writes
    before the batch runs."""
    log = spark.read.schema("value STRING").text(f"{checkpoint}/sources/0").where("startswith(value, '{')")
    entry = log.select(F.from_json("value", "path STRING, batchId LONG").alias("e")).where(F.col("e.batchId") == batch_id)
    name = plain_name(F.element_at(F.split("e.path", "/"), -1))
    return sorted(r[0] for r in entry.select(name).distinct().collect())


def stream_folder(
    spark: SparkSession,
    landing: str,
    folder: str,
    target: Target,
    schema: str | T.StructType,
    checkpoint: str,
    sep: str = ";",
    pattern: str = "*.csv",
    max_files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Start landing everything that is new in ``landing/folder``; ends when caught up."""
    create_database(spark, target)
    if target.table_format != "iceberg":
        versioned(spark, target, folder).repair()

    files = (
        spark.readStream.schema(schema)
        .options(sep=sep, header=True, enforceSchema=False, mode="FAILFAST")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .csv(f"{landing}/{folder}")
        .select("*", source_name().alias(SOURCE_COLUMN))
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        session, cleaned = batch.sparkSession, clean(batch)
        sources = batch_files(session, checkpoint, batch_id)
        write_raw(cleaned, target.raw_path, folder)
        counts = row_counts(session, sources, read_raw(session, target.raw_path, folder, cleaned.schema, existing(session, sources)))
        filled = [r[0] for r in counts.where("rows > 0").select(SOURCE_COLUMN).collect()]  # names only
        landed = read_raw(session, target.raw_path, folder, cleaned.schema, filled)
        replace_sources(landed if filled else None, counts, target, folder)

    def existing(session: SparkSession, sources: list[str]) -> list[str]:
        """Sources that the raw zone has a folder of: the others have no rows."""
        jvm, conf = session.sparkContext._jvm, session.sparkContext._jsc.hadoopConfiguration()
        paths = {s: jvm.org.apache.hadoop.fs.Path(raw_folder(session, target.raw_path, folder, s)) for s in sources}
        return [s for s, path in paths.items() if path.getFileSystem(conf).exists(path)]

    return (
        files.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
