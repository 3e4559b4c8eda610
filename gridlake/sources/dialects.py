"""Delimited files whose dialect is not known: delimiter, quote, header and decimal mark.

The first lines of every file are looked at in tasks, one file each, and scored by how alike the rows
are: after the published measure of van den Burg, Nazabal and Sutton ("Wrangling messy CSV files by
detecting row and type patterns", 2019), a dialect is the better the more rows have the same number
of cells and the more cells have a type. Files of one dialect and header are then one scan.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import product
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.sources.files import SOURCE_COLUMN, discover_files, literal_path, plain_name

DELIMITERS = (",", ";", "\t", "|")
QUOTES = ('"', "'")
#: Lines and characters of a file that are looked at.
HEAD_LINES, HEAD_CHARS = 200, 64 << 10

NUMBER = re.compile(r"[+-]?(\d+([.,]\d+)?|[.,]\d+|\d{1,3}([ .,]\d{3})+([.,]\d+)?)([eE][+-]?\d+)?%?")
DATE = re.compile(r"\d{4}-\d\d?-\d\d?([T ]\d\d?:\d\d(:\d\d(\.\d+)?)?)?(Z|[+-]\d\d:?\d\d)?|\d\d?[./]\d\d?[./]\d{4}( \d\d?:\d\d(:\d\d)?)?|\d\d?:\d\d(:\d\d)?")
WORDS = re.compile(r"[^,;\t|\"]*")
TRUTH = {"true", "false"}

SNIFFED = "path string, delimiter string, quote string, header boolean, decimal string, names array<string>"


# --- one file ---------------------------------------------------------------------------------


def cells(text: str, delimiter: str, quote: str) -> list[list[str]]:
    """Rows of cells; a quoted cell may hold delimiters, line breaks and doubled quotes."""
    if not quote:
        return [line.split(delimiter) for line in text.split("\n") if line.strip()]
    rows, row, at, size = [], [], 0, len(text)
    plain = re.compile(f"[^{re.escape(delimiter)}\n]*")
    inner = re.compile(f"((?:[^{quote}]|{quote}{quote})*){quote}?")
    while at < size:
        if text.startswith(quote, at):
            found = inner.match(text, at + 1)
            rest = plain.match(text, found.end())
            row.append(found[1].replace(quote * 2, quote) + rest[0])
            at = rest.end()
        else:
            found = plain.match(text, at)
            row.append(found[0])
            at = found.end()
        if at >= size or text[at] == "\n":
            rows.append(row)
            row = []
        elif at == size - 1:
            row.append("")
            rows.append(row)
            row = []
        at += 1
    return [r for r in rows if len(r) > 1 or r[0].strip()]


def kind(cell: str) -> str:
    """``empty``, ``number``, ``date``, ``truth``, ``words`` or, for what still holds separators, ``none``."""
    text = cell.strip()
    if not text:
        return "empty"
    if NUMBER.fullmatch(text):
        return "number"
    if DATE.fullmatch(text):
        return "date"
    if text.lower() in TRUTH:
        return "truth"
    return "words" if WORDS.fullmatch(text) else "none"


def score(rows: list[list[str]], quoted: bool) -> float:
    """Sum over row lengths of their number of rows times (length - 1) / length, over the number of
    different lengths; times the share of cells with a type. Words count half: nearly any cut
    gives words. What stood in quotes has the type words."""
    lengths = Counter(len(r) for r in rows)
    pattern = sum(n * max(k - 1, 0.001) / k for k, n in lengths.items()) / len(lengths)
    worth = {"none": 0.5 if quoted else 0.0, "words": 0.5}
    kinds = [worth.get(kind(c), 1.0) for r in rows for c in r]
    return pattern * sum(kinds) / max(len(kinds), 1)


def has_header(rows: list[list[str]]) -> bool:
    """The first row names columns: filled, different texts, none a value, and in a column of values
    or, where all columns are words, none met again below."""
    first, below = [c.strip() for c in rows[0]], rows[1:]
    if not all(first) or len(set(first)) < len(first) or any(kind(c) in ("number", "date", "truth") for c in first):
        return False
    if not below:
        return True
    columns = [[kind(r[i]) for r in below if i < len(r) and r[i].strip()] for i in range(len(first))]
    if any(c and all(k in ("number", "date", "truth") for k in c) for c in columns):
        return True
    return not any(first[i] in {r[i].strip() for r in below if i < len(r)} for i in range(len(first)))


def decimal_mark(values: list[str]) -> str:
    """The mark that numbers have in front of their fraction. ``1.234`` and ``1,234`` may be grouped
    and tell nothing; a number with both marks has the fraction behind the last."""
    votes = Counter()
    for value in values:
        marks = re.findall("[.,]", value)
        if not marks or not NUMBER.fullmatch(value):
            continue
        last, tail = marks[-1], re.split("[.,]", value)[-1]
        if len(set(marks)) == 2:
            votes[last] += 1
        elif len(marks) > 1:
            votes["," if last == "." else "."] += 1  # grouped, so the other mark is the decimal one
        elif len(tail) != 3:
            votes[last] += 1
    return "," if votes[","] > votes["."] else "."


def sniff(head: str) -> dict:
    """Dialect of a file by its first lines: delimiter, quote (empty: none), header, decimal, names."""
    head = head.removeprefix("\ufeff").replace("\r\n", "\n").replace("\r", "\n")
    best = None
    for rank, (delimiter, quote) in enumerate(product(DELIMITERS, ("", *QUOTES))):
        if quote and not re.search(f"(^|[{re.escape(delimiter)}\n]){quote}", head):
            continue  # no cell begins with it
        rows = cells(head, delimiter, quote)
        value = score(rows, bool(quote)) if rows else 0.0
        if best is None or value > best[0] + 1e-9:
            best = (value, rank, delimiter, quote, rows)
    _, _, delimiter, quote, rows = best
    header = bool(rows) and has_header(rows)
    width = max((len(r) for r in rows), default=0)
    names = [c.strip() for c in rows[0]] if header else [f"column{i}" for i in range(width)]
    numbers = [c.strip() for r in rows[1 if header else 0 :] for c in r if kind(c) == "number"]
    return {"delimiter": delimiter, "quote": quote, "header": header, "decimal": decimal_mark(numbers), "names": names}


# --- all files --------------------------------------------------------------------------------


@contextmanager
def settings(spark: SparkSession, **values: str):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _sniffed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dialect of the one file of a task. Only the first batch is taken, so the rest of the file
    is not read."""
    for batch in batches:
        lines, path = batch.column("value").to_pylist(), batch.column("path")[0].as_py()
        if batch.column("begin")[0].as_py() == 0:
            head = "\n".join(lines[:HEAD_LINES])
            if len(head) > HEAD_CHARS:
                head = head[:HEAD_CHARS].rsplit("\n", 1)[0]
            found = {"path": path, **sniff(head)}
            yield pa.RecordBatch.from_pylist([found], pa.schema([
                ("path", pa.string()), ("delimiter", pa.string()), ("quote", pa.string()), ("header", pa.bool_()),
                ("decimal", pa.string()), ("names", pa.list_(pa.string()))]))
        return


def sniff_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, delimiter, quote, header, decimal, names) of each file that has a line. One task a file,
    which stops after the first lines."""
    if not paths:
        return spark.createDataFrame([], SNIFFED)
    whole_files = {
        "spark__sql__files__maxPartitionBytes": str((1 << 62)),
        "spark__sql__files__openCostInBytes": str((1 << 62)),
        "spark__sql__execution__arrow__maxRecordsPerBatch": str(HEAD_LINES),
    }
    with settings(spark, **whole_files):
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("begin"))
        rows = lines.mapInArrow(_sniffed, SNIFFED).collect()  # one row a file
    return spark.createDataFrame(rows, SNIFFED)


def as_number(text: Column, decimal: str) -> Column:
    """Text of a number with this decimal mark as a double; NULL where it is none."""
    plain = F.replace(F.replace(text, F.lit("." if decimal == "," else ","), F.lit("")), F.lit(decimal), F.lit("."))
    group = re.escape("." if decimal == "," else ",")
    shape = rf"^\s*[+-]?(\d+|\d{{1,3}}({group}\d{{3}})+)?({re.escape(decimal)}\d+)?([eE][+-]?\d+)?\s*$"
    return F.when(text.rlike(shape), plain.try_cast("double"))


def typed(df: DataFrame, decimal: str, columns: list[str]) -> DataFrame:
    """Text columns as bigint, double, timestamp or boolean where every value is one: a single pass
    over the rows decides for all columns."""
    kinds = {
        "bigint": lambda c: F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), c.try_cast("bigint")),
        "double": lambda c: as_number(c, decimal),
        "timestamp_ntz": lambda c: F.when(c.rlike(r"^\s*\d{4}-\d"), c.try_cast("timestamp_ntz")),
        "boolean": lambda c: F.when(F.lower(c).isin(*TRUTH), c.try_cast("boolean")),
    }
    name = lambda c: F.col(f"`{c}`")
    fits = [
        F.min(F.when(name(c).isNotNull(), make(name(c)).isNotNull())).alias(f"{i}:{k}") for i, c in enumerate(columns) for k, make in kinds.items()
    ]
    found = df.agg(*fits).first().asDict() if columns else {}
    out = []
    for i, c in enumerate(columns):
        chosen = next((k for k in kinds if found[f"{i}:{k}"]), None)
        out.append((kinds[chosen](name(c)) if chosen else name(c)).alias(c))
    return df.select(*out, *[name(c) for c in df.columns if c not in columns])


def read_sniffed(spark: SparkSession, folder: str, pattern: str = "*.csv", tag_source: bool = False, recursive: bool = False) -> DataFrame:
    """All matching files of a folder, each in the dialect its first lines show, unioned by column name.

    Files of the same dialect and columns are one scan. Types are found over all rows of a scan, so a
    late text makes its column text instead of being lost. Files without a line are left out; if none
    is left the read fails. Names and dialects, one row a file, pass through the driver."""
    paths = [literal_path(r.path) for r in discover_files(spark, folder, pattern, recursive).select("path").collect()]
    groups: dict[tuple, list[str]] = {}
    for r in sniff_files(spark, paths).collect():
        groups.setdefault((r.delimiter, r.quote, r.header, r.decimal, tuple(r.names)), []).append(literal_path(unquote(r.path)))
    if not groups:
        raise ValueError(f"no lines in {pattern} below {folder}")
    frames = []
    for (delimiter, quote, header, decimal, names), files in sorted(groups.items()):
        reader = spark.read.options(sep=delimiter, quote=quote, escape=quote or "\\", header=header, mode="PERMISSIVE", multiLine=bool(quote))
        df = reader.schema(", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)).csv(files)
        if tag_source:
            df = df.select("*", plain_name(F.col("_metadata.file_name")).alias(SOURCE_COLUMN))
        frames.append(typed(df, decimal, list(names)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), widened(frames))


def widened(frames: list[DataFrame]) -> list[DataFrame]:
    """Frames whose columns of the same name have the same type: bigint and double as double, anything
    else that differs as text."""
    types: dict[str, set[str]] = {}
    for df in frames:
        for n, t in df.dtypes:
            types.setdefault(n, set()).add(t)
    wide = {n: next(iter(t)) if len(t) == 1 else "double" if t == {"bigint", "double"} else "string" for n, t in types.items()}
    return [df.select(*[F.col(f"`{n}`").cast(wide[n]).alias(n) for n in df.columns]) for df in frames]
