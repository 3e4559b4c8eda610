"""Catalogue build: listing pages per environment to one nested summary document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators.catalog import summary_lines

# Report key and description per environment name; root folders and descriptions.
ENVIRONMENTS = {
    "IOP": ("IOP", "Integration/Test Platform"),
    "PROD": ("Prod", "Production Platform"),
}
ACTIVE_ROOT = "TP_export"
LEGACY_ROOT = "TP_Legacy_Publications"
ROOT_DESCRIPTIONS = {ACTIVE_ROOT: "Active publications folder", LEGACY_ROOT: "Legacy publications folder"}


def build_catalogue(listing: DataFrame, path: str | None = None) -> DataFrame:
    """``listing`` has (env, root, name). Returns the lines of the summary, (environment, place,
    line), and with ``path`` also writes them there as one JSON text, in files whose order is
    that of the document. The order comes from a range sort: no task holds a whole group."""
    lines = summary_lines(listing, "env", "root", "name", ACTIVE_ROOT, LEGACY_ROOT, ENVIRONMENTS, ROOT_DESCRIPTIONS)
    if path is not None:
        ends = listing.sparkSession.createDataFrame(
            [(0, '{"environments":{'), (2, "}}")], "part int, line string"
        ).selectExpr("part", "'' AS environment", "NULL AS place", "line")
        whole = lines.select(F.lit(1).alias("part"), "environment", "place", "line")
        both = whole.unionByName(ends.withColumn("place", F.lit(None).cast(lines.schema["place"].dataType)))
        both.orderBy("part", "environment", "place").select("line").write.mode("overwrite").text(path)
    return lines
