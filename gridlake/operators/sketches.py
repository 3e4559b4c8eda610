"""Aggregates that can be kept and merged without the rows: distinct counts, quantiles, exact sums."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: log2 of the nominal entries of a theta sketch: one standard error is 1 / sqrt(2**12), 1.6 %.
THETA_LOG = 12
#: Size parameter of a KLL sketch: ranks are within 0.2 % (99 % of the time), for some 50 KB a column.
KLL_K = 2000


# --- distinct counts ------------------------------------------------------------------------


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, out: str = "sketch", log: int = THETA_LOG) -> DataFrame:
    """(keys, sketch): the distinct non-NULL values of each group, to be stored. A group of any size
    gives a sketch of bounded size."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(value, log).alias(out))


def united_sketches(sketches: DataFrame, keys: Sequence[str], sketch: str = "sketch", out: str = "sketch", log: int = THETA_LOG) -> DataFrame:
    """Sketches of finer groups as those of the coarser ``keys``."""
    return sketches.groupBy(*keys).agg(F.theta_union_agg(sketch, log).alias(out))


def distinct_in(sketch: str | Column) -> Column:
    return F.theta_sketch_estimate(sketch)


def distinct_in_both(a: str | Column, b: str | Column) -> Column:
    return F.theta_sketch_estimate(F.theta_intersection(a, b))


def distinct_in_first_only(a: str | Column, b: str | Column) -> Column:
    return F.theta_sketch_estimate(F.theta_difference(a, b))


# --- column profiles ------------------------------------------------------------------------

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def quantile_sketch(column: Column, kind: T.DataType, k: int = KLL_K) -> Column:
    """A KLL sketch of a number column, to be stored or merged."""
    if isinstance(kind, _WHOLE):
        return F.kll_sketch_agg_bigint(column.cast("bigint"), k)
    return F.kll_sketch_agg_double(F.when(~F.isnan(column.cast("double")), column.cast("double")), k)


def quantile_of(sketch: Column, kind: T.DataType, share: float) -> Column:
    """The value at a rank of the sketch; NULL if it has seen none."""
    whole = isinstance(kind, _WHOLE)
    size = F.kll_sketch_get_n_bigint(sketch) if whole else F.kll_sketch_get_n_double(sketch)
    get = F.kll_sketch_get_quantile_bigint if whole else F.kll_sketch_get_quantile_double
    return F.when(size > 0, get(sketch, F.lit(float(share))))


def profile(df: DataFrame, columns: Sequence[str] | None = None, shares: Sequence[float] = (0.25, 0.5, 0.75), k: int = KLL_K) -> DataFrame:
    """(summary, columns): count, mean, stddev, min, quantiles and max of number and text columns, as text.

    Numbers and their sketches are one pass over the number columns. Texts are counted and compared as
    texts, and never cast: a mean of texts is NULL. An empty table has counts of 0 and NULLs."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    numbers = [f for f in fields if isinstance(f.dataType, T.NumericType)]
    texts = [f for f in fields if isinstance(f.dataType, T.StringType)]
    name = lambda f: F.col(f"`{f.name}`")
    labels = ["count", "mean", "stddev", "min", *[f"{share:.10g}%" for share in (100 * s for s in shares)], "max"]
    measures = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    made = []
    if numbers:
        plain = [measures[m](name(f)).alias(f"{m}:{i}") for i, f in enumerate(numbers) for m in measures]
        made.append(df.select(*map(name, numbers)).agg(*plain))
        if shares:
            sketched = df.select(*map(name, numbers)).agg(*[quantile_sketch(name(f), f.dataType, k).alias(f"q:{i}") for i, f in enumerate(numbers)])
            made.append(sketched.select(*[quantile_of(F.col(f"q:{i}"), f.dataType, s).alias(f"{lab}:{i}") for i, f in enumerate(numbers) for s, lab in zip(shares, labels[4:])]))
    if texts:
        made.append(df.select(*map(name, texts)).agg(*[measures[m](name(f)).alias(f"{m}:t{i}") for i, f in enumerate(texts) for m in ("count", "min", "max")]))
    # One row each, put side by side as scalar subqueries.
    names = [c for part in made for c in part.columns]
    wholes = [part.select(F.struct(*[F.col(f"`{c}`") for c in part.columns])).scalar().alias(f"p{i}") for i, part in enumerate(made)]
    row = df.sparkSession.range(1).select(*wholes)
    row = row.select(*[F.col(f"p{i}")[c].alias(c) for i, part in enumerate(made) for c in part.columns])
    known = set(names)
    places = {f.name: str(i) for i, f in enumerate(numbers)} | {f.name: f"t{i}" for i, f in enumerate(texts)}

    def value(label: str, f: T.StructField) -> Column:
        at = f"{label}:{places[f.name]}"
        return (F.col(f"`{at}`") if at in known else F.lit(None)).cast("string").alias(f.name)

    kept = [f for f in fields if f.name in places]
    return row.select(F.inline(F.array(*[F.struct(F.lit(label).alias("summary"), *[value(label, f) for f in kept]) for label in labels])))


# --- exact sums -----------------------------------------------------------------------------

#: A number is cut into five whole numbers of 18 bits, 18 * 4 bits below a limb of 32 bits of exponent.
LIMB_BITS, PIECE_BITS, PIECES = 32, 18, 5


def _pieces(value: Column) -> tuple[Column, list[Column]]:
    """(limb, pieces): value = 2 ** (32 * limb + 15) * sum(piece[i] / 2 ** (18 * i)), without any
    rounding: all steps scale by powers of two or take a whole part away."""
    size = F.abs(value)
    limb = F.coalesce(F.floor(F.log2(size) / LIMB_BITS).cast("int"), F.lit(0))
    half = F.pow(F.lit(2.0), limb * F.lit(-LIMB_BITS // 2))
    rest = size * half * half / F.lit(float(1 << 15))
    pieces = []
    for _ in range(PIECES):
        whole = F.floor(rest)
        pieces.append(F.when(value < 0, -whole).otherwise(whole))
        rest = (rest - whole) * F.lit(float(1 << PIECE_BITS))
    return limb, pieces


def _total(parts: list[dict]) -> Fraction:
    """The exact sum that limbs and their summed pieces stand for."""
    out = Fraction(0)
    for p in parts:
        scale = LIMB_BITS * p["limb"] + 15
        whole = sum(p[f"p{i}"] << (PIECE_BITS * (PIECES - 1 - i)) for i in range(PIECES))
        shift = scale - PIECE_BITS * (PIECES - 1)
        out += Fraction(whole << shift) if shift >= 0 else Fraction(whole, 1 << -shift)
    return out


def rounded(exact: Fraction) -> float:
    try:
        return exact.numerator / exact.denominator
    except OverflowError:
        return float("inf") if exact > 0 else float("-inf")


def exact_sums(df: DataFrame, keys: Sequence[str], value: str, out: str = "total", mean: str | None = None) -> DataFrame:
    """(keys, out[, mean]): the sum of a double column for each group, rounded once, at the end.

    Whole numbers are added, so the result does not depend on how rows lie, in what order they come
    or how large others are. NULLs are left out, a group of only NULLs has a NULL sum; NaN, and
    infinities of both signs, give NaN. A group sends a few rows per task, however large it is: one
    for each 32 bits of exponent that its values reach over."""
    x = F.col(f"`{value}`").cast("double")
    names = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], x.alias("x"))
    x = F.col("x")
    special = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").when(x.isNull(), "null").otherwise("")
    marked = rows.select(*names, special.alias("special"), F.when(special == "", x).alias("x"))
    limb, pieces = _pieces(F.col("x"))
    cut = marked.select(*names, "special", limb.alias("limb"), *[F.coalesce(p, F.lit(0)).alias(f"p{i}") for i, p in enumerate(pieces)])
    limbs = cut.groupBy(*names, "special", "limb").agg(F.count("*").alias("n"), *[F.sum(f"p{i}").alias(f"p{i}") for i in range(PIECES)])
    # At most 66 limbs and the special values for each group.
    whole = limbs.groupBy(*names).agg(F.collect_list(F.struct("special", "limb", "n", *[f"p{i}" for i in range(PIECES)])).alias("parts"))
    schema = T.StructType([*whole.schema.fields[:-1], T.StructField(out, T.DoubleType()), *([T.StructField(mean, T.DoubleType())] if mean else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, means = [], []
            for parts in batch.column("parts").to_pylist():
                seen = {p["special"] for p in parts}
                n = sum(p["n"] for p in parts if p["special"] != "null")
                exact = _total([p for p in parts if p["special"] == ""])
                if "nan" in seen or {"inf", "-inf"} <= seen:
                    sums.append(float("nan"))
                elif seen & {"inf", "-inf"}:
                    sums.append(float((seen & {"inf", "-inf"}).pop()))
                else:
                    sums.append(rounded(exact) if n else None)
                finite = sums[-1] is not None and seen <= {"", "null"}
                means.append(rounded(exact / n) if finite else sums[-1])
            columns = [*[batch.column(k) for k in names], pa.array(sums, pa.float64()), *([pa.array(means, pa.float64())] if mean else [])]
            yield pa.RecordBatch.from_arrays(columns, [*names, out, *([mean] if mean else [])])

    return whole.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keys)))
