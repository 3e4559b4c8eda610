"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on; anything may be overridden by the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go away with the frames that used them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Set in a session whose workers have the package.
SHIPPED = "gridlake.shipped"

# Bytes under which a materialised aggregate may be broadcast.
BROADCAST_MAX_BYTES = 32 << 20
# Row overhead that a hash table adds to the values themselves.
ROW_OVERHEAD = 48


def build_session(app_name: str = "gridlake", **conf: str) -> SparkSession:
    """Create (or reuse) a session. Keyword names use ``__`` for dots:
    ``build_session(spark__sql__shuffle__partitions="2000")``."""
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return shipped(builder.getOrCreate())


def shipped(spark: SparkSession) -> SparkSession:
    """Send the package to the workers, once for a session, so that its functions run there wherever
    the workers start. An installed package needs no sending, and sending it again does no harm."""
    if spark.conf.get(SHIPPED, None) is None:
        package = Path(__file__).resolve().parent
        # Executors fetch the archive from the driver when they start, so it stays for the session.
        archive = Path(tempfile.mkdtemp(prefix="gridlake-"), "gridlake.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        spark.conf.set(SHIPPED, "true")
    return spark


def iceberg_conf(catalog: str, uri: str, warehouse: str, s3: dict[str, str] | None = None) -> dict[str, str]:
    """Options for an Iceberg REST catalog, to be passed to ``build_session(**{...})``
    or ``spark-submit --conf``. ``s3`` takes catalog FileIO options such as
    ``endpoint``, ``region`` or ``path-style-access``. The Iceberg jars are deployed
    with the job; they are not bundled here."""
    prefix = f"spark.sql.catalog.{catalog}"
    conf = {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "rest",
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse,
    }
    if s3:
        conf[f"{prefix}.io-impl"] = "org.apache.iceberg.aws.s3.S3FileIO"
        conf |= {f"{prefix}.s3.{k}": v for k, v in s3.items()}
    return conf


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else the checkpoint folder
    of the context, else a folder below the warehouse on the default filesystem.

    A ``file:`` path is one machine's disk, so outside of local mode it is refused unless
    ``spark.checkpoint.dir`` names it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")
    path = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if path.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder; {path} is local to one machine")
    return path.rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table, wherever its filesystem is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call uses."""
    return f"{shared_folder(spark)}/gridlake/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: the length of texts, 16 for anything else."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string" if f.dataType.typeName() == "string" else "binary")), F.lit(0))
        if f.dataType.typeName() in ("string", "binary")
        else F.lit(16)
        for f in df.schema.fields
    ]
    return sum(sizes, F.lit(ROW_OVERHEAD))


def small_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Materialise an aggregate once (a job that runs when the plan is built) and mark it for
    broadcast only when its measured size is within ``max_bytes``. Beyond that it is returned
    unhinted, and the join becomes a shuffled one that adaptive execution may split on hot keys."""
    kept = cut_lineage(df)
    size = kept.agg(F.sum(row_bytes(kept))).first()[0] or 0
    return F.broadcast(kept) if size <= max_bytes else kept
