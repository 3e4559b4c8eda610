"""Data-quality operators over texts, records and nested documents."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.text import (
    code_shape,
    explode_lines_outside,
    is_comment,
    line_total,
    lines_outside,
    strip,
    strip_all,
)
from gridlake.operators.windows import in_ranges, match_keys
from gridlake.session import cut_lineage, small_side

# Shortest text looked at, shortest description, and the token pattern.
MIN_DUPLICATE_CHARS = 100
MIN_DESCRIPTION_CHARS = 150
OPEN_TOKEN = r"\[([^\]]+)\](?!\()"
OPEN_TOKEN_HAS = "["
IGNORED_TOKENS = ("", "x", "/")
CROSS_REFERENCE = r"(?i)^ADR-\d{3,4}$"
FENCE = "```"
SECTION_MARK = "##"


# --- exact duplicates -------------------------------------------------------------


def text_digests(df: DataFrame, key: str, text: str, min_len: int = MIN_DUPLICATE_CHARS) -> DataFrame:
    """``(digest, key, lines)`` of texts that are long enough once normalised."""
    # A shape is never longer than its text, so short texts need not be shaped at all.
    texts = df.select(key, text).where(F.length(text) >= min_len)
    shaped = F.struct(code_shape(F.col(text)).alias("shape"), line_total(F.col(text)).alias("lines"))
    # The length test sits inside the generator: as a filter it would be pushed below the
    # projection and shape every text a second time.
    long_enough = F.filter(F.array(shaped), lambda t: F.length(t["shape"]) >= min_len)
    return texts.select(key, F.inline(long_enough)).select(F.sha2("shape", 256).alias("digest"), key, "lines")


def duplicate_members(df: DataFrame, key: str, text: str, min_len: int = MIN_DUPLICATE_CHARS) -> DataFrame:
    """Every text that shares its normalised content with another one.

    One row per member, so a group of any size stays spread out: ``first_id`` is the copy
    to keep, the others are redundant. Texts are read once; only digests are kept for
    the two passes that follow."""
    digests = cut_lineage(text_digests(df, key, text, min_len))
    groups = (
        digests.groupBy("digest")
        .agg(F.count("*").alias("members"), F.min(key).alias("first_id"))
        .filter(F.col("members") > 1)
    )
    joined = match_keys(digests, groups, ["digest"])
    return joined.select("digest", key, "lines", "members", "first_id", (F.col(key) != F.col("first_id")).alias("redundant"))


def duplicate_totals(df: DataFrame, key: str, text: str, min_len: int = MIN_DUPLICATE_CHARS) -> DataFrame:
    """Number of groups, members and removable lines (all but each group's first text)."""
    groups = (
        text_digests(df, key, text, min_len)
        .groupBy("digest")
        .agg(
            F.count("*").alias("members"),
            (F.sum("lines") - F.min_by("lines", key)).alias("removable"),
        )
        .filter(F.col("members") > 1)
    )
    return groups.agg(
        F.count("*").alias("duplicate_groups"),
        F.coalesce(F.sum("members"), F.lit(0)).alias("duplicate_members"),
        F.coalesce(F.sum("removable"), F.lit(0)).alias("removable_lines"),
    )


# --- record rules -----------------------------------------------------------------


def violations(df: DataFrame, key: str, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """``(key, rule)`` for every rule a record breaks; a rule is (name, is-broken)."""
    broken = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules]))
    return df.select(key, F.explode(broken).alias("rule"))


def violation_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("rule").agg(F.count("*").alias("violations"))


def setting_rules(description: str, examples: str, default: str, default_kind: str, kind: str) -> list[tuple[str, Column]]:
    """Rules for documented settings: description, examples, default and type.

    ``default_kind`` is the type of the default value itself. Settings of kind
    ``object`` need neither examples nor a default; a missing kind reads as string."""
    effective = F.coalesce(F.col(kind), F.lit("string"))
    plain = effective != "object"
    has_kind, has_default = F.col(kind).isNotNull(), F.col(default).isNotNull()
    return [
        ("description missing", F.col(description).isNull()),
        ("description too short", F.length(strip_all(F.col(description))) < MIN_DESCRIPTION_CHARS),
        ("examples missing", plain & F.col(examples).isNull()),
        ("examples empty", plain & (F.size(examples) == 0)),
        ("default missing", plain & ~has_default),
        ("type missing", ~has_kind),
        ("type unknown", has_kind & ~effective.isin("string", "integer", "object")),
        (
            "default is not an integer",
            has_kind & has_default & (effective == "integer") & ~F.col(default_kind).isin("integer", "boolean"),
        ),
        (
            "default is not a string",
            has_kind & has_default & (effective == "string") & (F.col(default_kind) != "string"),
        ),
    ]


# --- document scans ---------------------------------------------------------------


def open_tokens(
    df: DataFrame,
    key: str,
    text: str,
    pattern: str = OPEN_TOKEN,
    token_has: str | None = None,
    fence: str = FENCE,
    ignored: Sequence[str] = IGNORED_TOKENS,
    allowed: str = CROSS_REFERENCE,
) -> DataFrame:
    """``(key, line_no, token)`` of unresolved tokens outside fenced blocks and comments.

    ``token_has`` may name a literal that every match contains; documents and lines
    without it are then dropped by a substring test before any regular expression runs.
    The default pattern brings its own."""
    if token_has is None:
        token_has = OPEN_TOKEN_HAS if pattern == OPEN_TOKEN else ""
    texts = df.select(key, text).filter(F.contains(text, F.lit(token_has)))
    lines = explode_lines_outside(texts, key, text, fence).filter(F.contains("line", F.lit(token_has)))
    hits = lines.filter(~is_comment(F.col("line"))).select(
        key, "line_no", F.explode(F.regexp_extract_all("line", F.lit(pattern), F.lit(1))).alias("token")
    )
    tokens = hits.withColumn("token", strip(F.col("token")))
    return tokens.filter(~F.lower("token").isin(*ignored) & ~F.col("token").rlike(allowed))


def missing_sections(
    df: DataFrame, key: str, text: str, required: Sequence[str], mark: str = SECTION_MARK, fence: str = FENCE
) -> DataFrame:
    """``(key, section)`` for every required heading a document lacks."""
    wanted = F.array(*[F.lit(h) for h in required])
    lines = F.filter(lines_outside(F.col(text), fence), lambda line: F.contains(line, F.lit(mark)))
    headings = F.filter(F.transform(lines, strip), lambda line: F.startswith(line, F.lit(mark)))
    # A text that holds none of the headings anywhere lacks them all: only others are cut into lines.
    held = reduce(lambda a, b: a | b, [F.contains(F.col(text), F.lit(h)) for h in required], F.lit(False))
    missing = F.when(F.col(text).isNull(), F.lit(None)).when(held, F.array_except(wanted, headings)).otherwise(F.array_distinct(wanted))
    return df.select(key, text).select(key, F.explode(missing).alias("section"))


def section_headings(df: DataFrame, key: str, text: str, mark: str = SECTION_MARK, fence: str = FENCE) -> DataFrame:
    """``(key, line_no, section)``: headings of each document, as for a template."""
    texts = df.select(key, text).filter(F.contains(text, F.lit(mark)))
    lines = explode_lines_outside(texts, key, text, fence).filter(F.contains("line", F.lit(mark)))
    headings = lines.select(key, "line_no", strip(F.col("line")).alias("section"))
    return headings.filter(F.startswith("section", F.lit(mark)))


# --- nested documents -------------------------------------------------------------


_SHAPE = re.compile(r"`((?:[^`]|``)*)`: |(\w+): |(OBJECT<)|(ARRAY<)|>")


def shape_paths(shape: str) -> list[str]:
    """Dotted key paths in the schema text of one document. What lies inside arrays has none."""
    out, above, prefix, last, arrays = [], [], "", "", 0
    for found in _SHAPE.finditer(shape):
        marked, plain, opens, array = found.groups()
        if opens or array:
            above.append((prefix, bool(array)))
            prefix, arrays = (f"{prefix}{last}." if above[1:] else ""), arrays + bool(array)
        elif found[0] == ">":
            prefix, was_array = above.pop()
            arrays -= was_array
        else:
            last = plain if marked is None else marked.replace("``", "`")
            if not arrays:
                out.append(prefix + last)
    return out


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the different shapes of a batch, each once for each side."""
    for batch in batches:
        found: dict[bool | None, set[str]] = {}
        known: dict[str, list[str]] = {}
        for side, shape in set(zip(batch.column("side").to_pylist(), batch.column("shape").to_pylist())):
            if shape is None or not shape.startswith("OBJECT<"):
                continue
            if shape not in known:
                known[shape] = shape_paths(shape)
            found.setdefault(side, set()).update(known[shape])
        rows = [(side, path) for side, paths in found.items() for path in paths]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.string())], ["side", "path"])


def _side_paths(df: DataFrame, document: str, side: Column) -> DataFrame:
    """(side, path), each once. Documents are parsed where they lie: a row gives its schema text, a
    batch the paths of its different schemas, and only paths are shuffled."""
    shapes = df.select(side.alias("side"), F.schema_of_variant(F.try_parse_json(F.col(document))).alias("shape"))
    return shapes.mapInArrow(_walked, "side boolean, path string").distinct()


def key_paths(df: DataFrame, document: str) -> DataFrame:
    """Distinct dotted key paths of a JSON column, to any depth.

    A path counts if any document has it, whatever it holds elsewhere: the paths below a key that is
    an object here and a number there stay. Texts that are not JSON, and anything inside arrays,
    have no paths."""
    return _side_paths(df, document, F.lit(True)).select("path")


def key_path_difference(df: DataFrame, document: str, left: Column) -> DataFrame:
    """(path, side): paths of only the rows where ``left`` holds (``missing``), or of only the others
    (``extra``), in one pass. Rows where it is NULL are on neither side."""
    sides = _side_paths(df.where(left.isNotNull()), document, left)
    both = sides.groupBy("path").agg(F.bool_and("side").alias("only_left"), F.bool_or("side").alias("any_left"))
    apart = both.where(F.col("only_left") | ~F.col("any_left"))
    return apart.select("path", F.when(F.col("only_left"), "missing").otherwise("extra").alias("side"))


# --- comparisons ------------------------------------------------------------------


def missing_entries(declared: DataFrame, records: DataFrame, key: str, rule: str = "entry missing") -> DataFrame:
    """``(key, rule)`` for declared keys without a record, to be added to ``violations``."""
    names = declared.select(key).where(F.col(key).isNotNull()).distinct()
    return names.join(records.select(key), key, "left_anti").withColumn("rule", F.lit(rule))


def schema_diff(left: DataFrame, right: DataFrame) -> list[tuple[str, str | None, str | None]]:
    """Columns whose type differs or that one side lacks: (column, left type, right type)."""
    a, b = (dict(df.dtypes) for df in (left, right))
    return [(c, a.get(c), b.get(c)) for c in dict.fromkeys([*a, *b]) if a.get(c) != b.get(c)]


def row_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Rows with their place (from 1) inside their key. Ranges of rows are numbered one by one, and
    equal rows are told apart by where they were read, so a key of any size stays spread."""
    rows = df.withColumns({"_group": F.struct(*keys), "_read": F.monotonically_increasing_id()})
    ranges = in_ranges(rows, "_group", [*order, "_read"])
    sizes = ranges.groupBy("_group", "_block").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = small_side(sizes.select("_group", "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")))
    inside = F.row_number().over(Window.partitionBy("_group", "_block").orderBy(*order, "_read"))
    joined = match_keys(ranges.withColumn("_nth", inside), before, ["_group", "_block"])
    return joined.withColumn(out, F.col("_nth") + F.col("_before")).drop("_group", "_block", "_read", "_nth", "_before")


def table_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: float = 0.0, pair_repeated: bool = False) -> DataFrame:
    """``(keys, column, left_value, right_value, left_rows, right_rows)`` where tables differ.

    Rows are matched by key, NULL equal to NULL. A key that one side lacks, or holds another
    number of times, gives one row whose column is NULL. Values of a key held once on both sides
    are compared column by column: numbers with a relative tolerance, NULL equal to NULL. Keys
    held several times alike are compared by how often each row occurs (without tolerance) or, with
    ``pair_repeated``, row by row: the rows of such a key are put in the order of their exact columns,
    then of their floating ones, on both sides, and those at the same place are compared with the
    tolerance. Nothing is collected; both sides are aggregated by key and joined."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    numeric = {f.name for f in left.schema.fields if f.dataType.typeName() in ("double", "float")}

    def side(df: DataFrame, name: str) -> DataFrame:
        # Order-free digest of all rows of a key; the values themselves matter only if it has one.
        digest = F.sum(F.xxhash64(*shared).cast("decimal(38,0)")) if shared else F.lit(0)
        values = [F.min(F.struct(F.lit(1), *shared)).alias("v")]
        return df.groupBy(*keys).agg(F.count("*").alias("n"), digest.alias("h"), *values).select(
            *keys, F.struct("n", "h", "v").alias(name)
        )

    renamed = side(right, "r").withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    both = side(left, "l").join(renamed, on, "full_outer")
    both = both.select(*[F.when(F.col("l").isNotNull(), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in keys], "l", "r")
    n_left, n_right = F.coalesce("l.n", F.lit(0).cast("long")), F.coalesce("r.n", F.lit(0).cast("long"))
    text = lambda c: F.col(c).cast("string")

    def entry(column: Column, a: Column, b: Column) -> Column:
        return F.struct(column.cast("string").alias("column"), a.alias("left_value"), b.alias("right_value"))

    none = F.lit(None).cast("string")
    apart = (n_left == n_right) & (n_left > 1) & (F.col("l.h") != F.col("r.h"))

    def cells(a: str, b: str, held: Column) -> list[Column]:
        out = []
        for c in shared:
            x, y = F.col(f"{a}.{c}"), F.col(f"{b}.{c}")
            near = F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.abs(y)) if c in numeric else F.lit(False)
            same = x.eqNullSafe(y) | F.coalesce(near, F.lit(False))
            out.append(F.when(held & ~same, entry(F.lit(c), text(f"{a}.{c}"), text(f"{b}.{c}"))))
        return out

    def listed(rows: DataFrame, differing: list[Column]) -> DataFrame:
        found = rows.select(*keys, n_left.alias("left_rows"), n_right.alias("right_rows"), F.inline(F.array_compact(F.array(*differing))))
        return found.select(*keys, "column", "left_value", "right_value", "left_rows", "right_rows")

    counts = F.when((n_left != n_right) | (F.lit(not pair_repeated) & apart), entry(none, none, none))
    found = listed(both, [counts, *cells("l.v", "r.v", (n_left == 1) & (n_right == 1))])
    if not pair_repeated or not shared:
        return found
    repeated = small_side(both.where(apart).select(*keys, F.struct("l.n").alias("l"), F.struct("r.n").alias("r")))
    order = [c for c in shared if c not in numeric] + [c for c in shared if c in numeric]

    def placed(df: DataFrame, name: str) -> DataFrame:
        rows = match_keys(df.select(*keys, *shared), repeated.select(*keys), list(keys), "left_semi")
        return row_positions(rows, keys, order, "_place").select(*keys, "_place", F.struct(*shared).alias(name))

    pairs = match_keys(placed(left, "a"), placed(right, "b"), [*keys, "_place"])
    pairs = match_keys(pairs, repeated, list(keys))
    return found.unionByName(listed(pairs, cells("a", "b", F.lit(True))))
