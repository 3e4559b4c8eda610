"""Tables of sources whose versions switch by one catalogue statement.

Rows are only ever appended, each under its run and source. A version is a complete list of (source,
run): which run's rows of a source count. Lists of several versions lie beside each other, and one
view, the ledger, names the one that holds. The table that readers use is a view too: rows whose
source and run stand in the ledger. So replacing any number of sources, adding new ones and
forgetting others becomes visible at the moment the ledger view is replaced, in one statement, and
a run that dies before it has changed nothing; what it left is removed by the next run.

Columns widen without rewriting: rows of another shape go to a further table (a generation), and the
view reads each generation in the widest types. A whole number stays exact: where a column has whole
numbers that a double cannot hold, it becomes text instead.

There is one writer at a time. Readers that started before a switch have until the next run to end.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import BROADCAST_MAX_BYTES, ROW_OVERHEAD, remove_path
from gridlake.sources.files import SOURCE_COLUMN

RUN_COLUMN = "_run"

#: Whole numbers up to here are exact as a double.
EXACT_DOUBLE = 1 << 53

# Integer types by width: the wider one holds all values of the narrower.
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def quoted(name: str) -> str:
    """A name as an SQL identifier, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text as an SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def wider_type(a: str, b: str) -> str:
    """The type that holds the values of both: never one that cuts any off. ``bigint`` with a
    fraction gives ``double``; ``settled`` looks at the values and takes text where that would round."""
    if a == b:
        return a
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.index)
    numbers = {*_INTEGERS, "float", "double"}
    return "double" if a in numbers and b in numbers else "string"


def statement(spark: SparkSession, sql: str) -> DataFrame:
    """Every change of the catalogue goes through here."""
    return spark.sql(sql)


def appended(rows: DataFrame, table: str) -> None:
    """Every write of rows goes through here."""
    rows.write.insertInto(table)


class VersionedTable:
    """The table ``database.table``, with its files at ``place`` (default: below the warehouse)."""

    def __init__(self, spark: SparkSession, database: str, table: str, place: str | None = None, table_format: str = "parquet"):
        self.spark, self.database, self.table, self.table_format = spark, database, table, table_format
        self.place = place or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_bronze/{database}/{table}"
        self.view, self.ledger, self.versions = self.named(), self.named("__landed"), self.named("__versions")

    def named(self, suffix: str = "") -> str:
        return f"{quoted(self.database)}.{quoted(self.table + suffix)}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def generations(self) -> list[int]:
        """Numbers of the tables that hold rows."""
        shape = re.compile(re.escape(self.table.lower()) + r"__g(\d+)")
        names = [t.name for t in self.spark.catalog.listTables(quoted(self.database))]
        return sorted(int(m[1]) for m in map(shape.fullmatch, names) if m)

    def _ddl(self, fields: list[tuple[str, str]]) -> str:
        return ", ".join(f"{quoted(n)} {t}" for n, t in fields)

    # --- the ledger ------------------------------------------------------------------------

    def _point(self, version: str, replace: bool) -> None:
        how = "CREATE OR REPLACE VIEW" if replace else "CREATE VIEW IF NOT EXISTS"
        statement(
            self.spark,
            f"{how} {self.ledger} AS SELECT {SOURCE_COLUMN}, rows, run, generation FROM {self.versions} WHERE version = {literal(version)}",
        )

    def _prepare(self) -> None:
        statement(
            self.spark,
            f"CREATE TABLE IF NOT EXISTS {self.versions} ({SOURCE_COLUMN} STRING, rows BIGINT, run STRING, generation INT, version STRING) "
            f"USING {self.table_format} PARTITIONED BY (version) LOCATION {literal(self.place + '__versions')}",
        )
        self._point("", replace=False)

    def landed(self) -> DataFrame:
        """(source, rows, run, generation) of every source that counts."""
        return self.spark.table(self.ledger)

    # --- shapes ----------------------------------------------------------------------------

    def fields(self) -> list[tuple[str, str]]:
        if not self.exists(self.view):
            return []
        return [(n, t) for n, t in self.spark.table(self.view).dtypes if n != SOURCE_COLUMN]

    def settled(self, batch: DataFrame) -> list[tuple[str, str]]:
        """Columns and types that hold the rows at hand and the batch."""
        have = self.fields()
        types = {n.lower(): t for n, t in batch.dtypes if n != SOURCE_COLUMN}
        out = [(n, wider_type(t, types.get(n.lower(), t))) for n, t in have]
        known = {n.lower() for n, _ in have}
        old = {n.lower(): t for n, t in have}
        out += [(n, t) for n, t in batch.dtypes if n != SOURCE_COLUMN and n.lower() not in known]
        doubtful = [n for n, t in out if t == "double" and "bigint" in (old.get(n.lower()), types.get(n.lower()))]
        if doubtful:
            inexact = set()
            for side, kinds in ((batch, types), (self.spark.table(self.view), old)):
                whole = [n for n in doubtful if kinds.get(n.lower()) == "bigint"]
                if whole:
                    found = side.agg(*[F.max((F.col(quoted(n)) > EXACT_DOUBLE) | (F.col(quoted(n)) < -EXACT_DOUBLE)).alias(n) for n in whole])
                    inexact |= {n for n, large in found.first().asDict().items() if large}
            out = [(n, "string" if n in inexact else t) for n, t in out]
        return out

    def _generation(self, batch: DataFrame, fields: list[tuple[str, str]]) -> int:
        """The newest table if it can take the batch in the settled types, else a new one."""
        wanted = {n.lower(): t for n, t in fields}
        numbers = self.generations()
        if numbers:
            have = {n.lower(): t for n, t in self.spark.table(self.named(f"__g{numbers[-1]}")).dtypes}
            if all(have.get(n.lower()) == wanted[n.lower()] for n in batch.columns if n != SOURCE_COLUMN):
                return numbers[-1]
        number = numbers[-1] + 1 if numbers else 1
        statement(
            self.spark,
            f"CREATE TABLE {self.named(f'__g{number}')} ({self._ddl(fields)}, {quoted(RUN_COLUMN)} STRING, {quoted(SOURCE_COLUMN)} STRING) "
            f"USING {self.table_format} PARTITIONED BY ({quoted(RUN_COLUMN)}, {quoted(SOURCE_COLUMN)}) LOCATION {literal(f'{self.place}__g{number}')}",
        )
        return number

    def _show(self, fields: list[tuple[str, str]], listing_bytes: int) -> None:
        """Let the readers' view read all generations in these types. The list of sources is small;
        it is broadcast after its size has been looked at."""
        hint = "/*+ BROADCAST(l) */ " if listing_bytes <= BROADCAST_MAX_BYTES else ""
        parts = []
        for number in self.generations():
            name = self.named(f"__g{number}")
            have = {n.lower() for n in self.spark.table(name).columns}
            columns = [f"CAST({'d.' + quoted(n) if n.lower() in have else 'NULL'} AS {t}) AS {quoted(n)}" for n, t in fields]
            parts.append(
                f"SELECT {hint}{', '.join([*columns, 'd.' + quoted(SOURCE_COLUMN)])} FROM {name} d LEFT SEMI JOIN {self.ledger} l "
                f"ON d.{quoted(SOURCE_COLUMN)} = l.{quoted(SOURCE_COLUMN)} AND d.{quoted(RUN_COLUMN)} = l.run"
            )
        statement(self.spark, f"CREATE OR REPLACE VIEW {self.view} AS {' UNION ALL '.join(parts)}")

    # --- runs ------------------------------------------------------------------------------

    def publish(self, batch: DataFrame | None, delivered: DataFrame, run: str | None = None) -> None:
        """One version further. ``delivered`` has (source, rows) of every source of the delivery; ``batch``
        holds their rows, or is None if there are none. A source without rows keeps its entry and loses
        the rows it had. Where each source has a run of its own, ``delivered`` and ``batch`` name it."""
        run, own_runs = F.lit(run or uuid.uuid4().hex), "run" in delivered.columns
        self._prepare()
        generation = 0
        fields = self.fields()
        if batch is not None:
            row_run = F.col(RUN_COLUMN) if own_runs else run
            settled = self.settled(batch.drop(RUN_COLUMN))
            generation = self._generation(batch.drop(RUN_COLUMN), settled)
            have = {c.lower(): c for c in batch.columns}
            target = self.spark.table(self.named(f"__g{generation}"))
            columns = [
                (F.col(quoted(have[f.name.lower()])).cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in target.schema.fields if f.name not in (RUN_COLUMN, SOURCE_COLUMN)
            ]
            appended(batch.select(*columns, row_run.alias(RUN_COLUMN), SOURCE_COLUMN), self.named(f"__g{generation}"))
        version = uuid.uuid4().hex
        list_run = F.col("run") if own_runs else run.alias("run")
        new = delivered.select(SOURCE_COLUMN, F.col("rows").cast("long").alias("rows"), list_run, F.lit(generation).alias("generation"))
        old = self.landed().join(new.select(SOURCE_COLUMN), SOURCE_COLUMN, "left_anti").select(*new.columns)
        appended(old.union(new).withColumn("version", F.lit(version)), self.versions)
        if batch is not None:
            size = F.sum(F.octet_length(SOURCE_COLUMN) + ROW_OVERHEAD)
            listing = self.spark.table(self.versions).where(F.col("version") == version).agg(size).first()[0] or 0
            if settled != fields or not self.exists(self.view) or generation not in self._shown():
                self._show(settled, listing)
        self._point(version, replace=True)

    def _shown(self) -> set[int]:
        text = statement_of(self.spark, self.view)
        return {int(x) for x in re.findall(re.escape(self.table) + r"__g(\d+)`", text)}

    def repair(self) -> None:
        """Remove what no reader can see any more: rows of runs that were replaced or died, older
        versions of the list, generations that no source uses. Called at the start of a run."""
        if not self.exists(self.ledger):
            return
        now = re.search(r"version = '(\w*)'", statement_of(self.spark, self.ledger))
        current = now[1] if now else ""
        live = {(r.generation, r.run, r[SOURCE_COLUMN]) for r in self.landed().where("rows > 0").collect()}  # names only
        for number in self.generations():
            name = self.named(f"__g{number}")
            for row in statement_of_partitions(self.spark, name, [RUN_COLUMN, SOURCE_COLUMN]):
                if (number, row[0], row[1]) not in live:
                    statement(self.spark, f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({quoted(RUN_COLUMN)} = {literal(row[0])}, {quoted(SOURCE_COLUMN)} = {literal(row[1])})")
                    remove_path(self.spark, f"{self.place}__g{number}/{folder_of(self.spark, RUN_COLUMN, row[0])}/{folder_of(self.spark, SOURCE_COLUMN, row[1])}")
        for (version,) in statement_of_partitions(self.spark, self.versions, ["version"]):
            if version != current:
                statement(self.spark, f"ALTER TABLE {self.versions} DROP IF EXISTS PARTITION (version = {literal(version)})")
                remove_path(self.spark, f"{self.place}__versions/version={version}")


def statement_of(spark: SparkSession, view: str) -> str:
    """The text of a view."""
    return spark.sql(f"SHOW CREATE TABLE {view}").first()[0]


def folder_of(spark: SparkSession, column: str, value: str) -> str:
    """Spark's own name of the folder of a partition value."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{column}={escape(value)}"


def statement_of_partitions(spark: SparkSession, table: str, columns: list[str]) -> list[tuple[str, ...]]:
    """Values of the partitions of a table, from the catalogue alone."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return [tuple(unescape(part.split("=", 1)[1]) for part in name.split("/")) for name in names]
