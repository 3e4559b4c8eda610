"""Projections, filters, aggregates and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import sketches
from gridlake.operators.relational import valid_at
from gridlake.operators.sketches import profile
from gridlake.operators.windows import match_keys
from gridlake.session import scratch_path
from gridlake.suite.registry import query, table


@query("proj_select", "SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem")
def select(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(lines.l_orderkey, lines["l_quantity"], "l_extendedprice")


@query("proj_with_column", "SELECT c_custkey, c_mktsegment, upper(c_name) AS upper_name FROM customer")
def with_column(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name")
    return customers.withColumn("upper_name", F.upper("c_name")).drop("c_name")


@query("proj_expr", "SELECT count(*) > 0 AS has_rows, sum(l_linenumber)::BIGINT AS lines FROM lineitem")
def expression(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.expr("count(*)") > 0).alias("has_rows"), F.expr("sum(l_linenumber)").alias("lines")
    )


@query("flt_eq", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def equal(spark, sf):
    events = table(spark, sf, "events")
    return events.filter(events.event_type == "purchase").select("event_id", "user_id", "value")


@query("flt_cmp", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def compare(spark, sf):
    return table(spark, sf, "customer").filter("c_acctbal < 0").select("c_custkey", "c_acctbal")


@query(
    "flt_not_null",
    """SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0.0) AS discount, l_tax = 0.0 AS no_tax
       FROM lineitem WHERE nullif(l_discount, 0.0) IS NOT NULL""",
)
def not_null(spark, sf):
    discount = F.nullif(F.col("l_discount"), F.lit(0.0))
    lines = table(spark, sf, "lineitem").withColumn("discount", discount).filter(F.col("discount").isNotNull())
    no_tax = F.nullif(F.col("l_tax"), F.lit(0.0)).isNull()
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "discount", no_tax.alias("no_tax"))


@query(
    "flt_valid_at",
    """WITH spans AS (
         SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS valid_from,
                CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate + INTERVAL '1 year' AS VARCHAR) END AS valid_to
         FROM lineitem)
       SELECT l_orderkey, l_partkey, l_linenumber FROM spans
       WHERE CAST(valid_from AS TIMESTAMP) <= TIMESTAMP '1999-06-01'
         AND (valid_to IS NULL OR CAST(valid_to AS TIMESTAMP) > TIMESTAMP '1999-06-01')""",
)
def validity(spark, sf):
    ended = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate") + F.expr("INTERVAL 1 YEAR"))
    spans = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_shipdate").alias("valid_from"),
        ended.cast("string").alias("valid_to"),
    )
    return valid_at(spans, "1999-06-01 00:00:00", "valid_from", "valid_to").drop("valid_from", "valid_to")


@query(
    "distinct_exact",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY l_returnflag",
)
def distinct_exact(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("n_orders"))


@query("distinct_approx")
def distinct_approx(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", 0.01).alias("n_orders"))


@query(
    "distinct_approx_error",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, true AS close
       FROM lineitem GROUP BY l_returnflag""",
)
def distinct_approx_error(spark, sf):
    """The sketch beside the exact count: its estimate stays within five standard errors.

    Two aggregates, joined: in one, Spark would keep a sketch for every distinct value."""
    estimate = distinct_approx(spark, sf).withColumnRenamed("n_orders", "estimate")
    both = match_keys(distinct_exact(spark, sf), estimate, ["l_returnflag"])
    close = F.abs(F.col("estimate") - F.col("n_orders")) <= 0.05 * F.col("n_orders")
    return both.select("l_returnflag", "n_orders", close.alias("close"))


_VISITS_SQL = """visits AS (
  SELECT event_type AS area, CAST(ts AS DATE) AS day, event_id * 7919 % 20011 AS visitor, dayofmonth(ts) <= 15 AS early FROM events),
met AS (SELECT area, visitor, bool_or(early) AS early, bool_or(NOT early) AS late FROM visits GROUP BY area, visitor)"""


@query(
    "distinct_sketch_merge",
    f"""WITH {_VISITS_SQL}
        SELECT area, count(*) AS n_any, count(*) FILTER (early AND late) AS n_both, count(*) FILTER (early AND NOT late) AS n_early_only,
               true AS any_close, true AS both_close, true AS early_only_close FROM met GROUP BY area""",
)
def sketch_merge(spark, sf):
    """Sketches are kept per area and day. Unions, intersections and differences of the halves of
    months come from them alone; each is held against the exact count: within five standard errors of
    the union."""
    visitor = (F.col("event_id") * 7919 % 20011).alias("visitor")
    visits = table(spark, sf, "events").select(F.col("event_type").alias("area"), F.to_date("ts").alias("day"), visitor)
    path = scratch_path(spark, "sketches")
    sketches.distinct_sketches(visits, ["area", "day"], "visitor").write.parquet(path)
    kept, early = spark.read.parquet(path), F.dayofmonth("day") <= 15
    sides = [sketches.united_sketches(kept.where(w), ["area"], out=n) for w, n in ((early, "a"), (~early, "b"))]
    merged = match_keys(*sides, ["area"]).select(
        "area", sketches.distinct_in(F.theta_union("a", "b")).alias("s_any"),
        sketches.distinct_in_both("a", "b").alias("s_both"), sketches.distinct_in_first_only("a", "b").alias("s_early_only"),
    )
    met = visits.groupBy("area", "visitor").agg(F.bool_or(early).alias("early"), F.bool_or(~early).alias("late"))
    exact = met.groupBy("area").agg(
        F.count("*").alias("n_any"), F.count_if(F.col("early") & F.col("late")).alias("n_both"),
        F.count_if(F.col("early") & ~F.col("late")).alias("n_early_only"),
    )
    bound = 5 * F.col("n_any") / 2 ** (sketches.THETA_LOG / 2)
    close = [(F.abs(F.col(f"s_{c}") - F.col(f"n_{c}")) <= bound).alias(f"{c}_close") for c in ("any", "both", "early_only")]
    return match_keys(exact, merged, ["area"]).select("area", "n_any", "n_both", "n_early_only", *close)


@query(
    "agg_exact_sum",
    """WITH cells AS (
         SELECT l_returnflag, CAST(l_extendedprice AS DECIMAL(18, 2)) * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS price FROM lineitem)
       SELECT l_returnflag, CAST(round(sum(price), 2) AS DOUBLE) AS total, true AS same_in_any_order FROM cells GROUP BY l_returnflag""",
)
def exact_sum(spark, sf):
    """Prices of alternating sign beside huge amounts that cancel, dealt out in two ways."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1.0).otherwise(1.0)
    huge = F.array(F.lit(0.0), F.lit(1e17), F.lit(-1e17))
    rows = lines.select("l_returnflag", "l_orderkey", (F.col("l_extendedprice") * sign).alias("price"), F.explode(huge).alias("huge"))
    cells = rows.select("l_returnflag", "l_orderkey", F.when(F.col("huge") == 0, F.col("price")).otherwise(F.col("huge")).alias("price"))
    one = sketches.exact_sums(cells, ["l_returnflag"], "price")
    other = sketches.exact_sums(cells.repartition(7, "l_orderkey"), ["l_returnflag"], "price", out="other")
    both = match_keys(one, other, ["l_returnflag"])
    return both.select("l_returnflag", F.round("total", 2).alias("total"), (F.col("total") == F.col("other")).alias("same_in_any_order"))


@query(
    "agg_avg_all",
    """SELECT o_orderpriority, round(avg(o_orderkey), 4) AS o_orderkey, round(avg(o_custkey), 4) AS o_custkey,
              round(avg(o_totalprice), 4) AS o_totalprice
       FROM orders GROUP BY o_orderpriority""",
)
def average_of_all(spark, sf):
    means = table(spark, sf, "orders").groupBy("o_orderpriority").avg()
    numeric = ["o_orderkey", "o_custkey", "o_totalprice"]
    return means.select("o_orderpriority", *[F.round(f"avg({c})", 4).alias(c) for c in numeric])


_STATISTICS = {"count": "count({0})", "mean": "avg({0})", "stddev": "stddev_samp({0})", "min": "min({0})", "max": "max({0})"}


_LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE_TEXTS = ["l_returnflag", "l_linestatus"]


def _profile_sql() -> str:
    parts = []
    for label, sql in _STATISTICS.items():
        numbers = [f"CAST(round(CAST({sql.format(c)} AS DOUBLE), 4) AS DOUBLE) AS {c}" for c in _LINE_NUMBERS]
        usable = label in ("count", "min", "max")
        texts = [f"CAST({sql.format(c)} AS VARCHAR) AS {c}" if usable else f"CAST(NULL AS VARCHAR) AS {c}" for c in _LINE_TEXTS]
        parts.append(f"SELECT '{label}' AS summary, {', '.join(numbers + texts)} FROM lineitem")
    return " UNION ALL ".join(parts)


@query("agg_describe", _profile_sql())
def describe(spark, sf):
    """Every numeric and text column (dates are not part of this profile)."""
    found = profile(table(spark, sf, "lineitem"), [*_LINE_NUMBERS, *_LINE_TEXTS], shares=())
    numbers = [F.round(F.col(c).cast("double"), 4).alias(c) for c in _LINE_NUMBERS]
    return found.select("summary", *numbers, *_LINE_TEXTS)


@query("agg_summary")
def summary(spark, sf):
    return profile(table(spark, sf, "lineitem"))


@query(
    "agg_summary_error",
    "SELECT c.label, true AS close FROM (VALUES ('25%'), ('50%'), ('75%')) c(label), (SELECT count(*) AS n FROM lineitem) WHERE n > 0",
)
def summary_error(spark, sf):
    """Ranks of the profile's quartiles of the price: within one in a hundred of exact ones."""
    lines = table(spark, sf, "lineitem").select("l_extendedprice")
    wanted = profile(lines).where("summary like '%\\%'").select(F.col("summary").alias("label"), F.col("l_extendedprice").cast("double").alias("q"))
    marks = {r.label: r.q for r in wanted.collect()}  # three numbers
    shares = lines.agg(*[F.avg((F.col("l_extendedprice") <= q).cast("double")).alias(label) for label, q in marks.items()])
    rows = shares.select(F.inline(F.array(*[F.struct(F.lit(k).alias("label"), (F.abs(F.col(k) - float(k[:-1]) / 100) <= 0.01).alias("close")) for k in marks])))
    return rows


@query(
    "sort_multi",
    "SELECT o_orderpriority, o_orderdate, o_orderkey FROM orders ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey",
)
def sort_multi(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    return orders.orderBy("o_orderpriority", F.desc("o_orderdate"), "o_orderkey")


@query("limit_n", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 10")
def first_rows(spark, sf):
    return table(spark, sf, "events").select("event_id", "value").orderBy("event_id").limit(10)


@query("limit_last", "SELECT event_id, value FROM events ORDER BY event_id DESC LIMIT 10")
def last_rows(spark, sf):
    return table(spark, sf, "events").select("event_id", "value").orderBy(F.desc("event_id")).limit(10)


@query(
    "sql_view_count",
    "SELECT count(*) AS n FROM conversations",
)
def view_count(spark, sf):
    table(spark, sf, "conversations").createOrReplaceTempView("gridlake_turns")
    return spark.sql("SELECT count(*) AS n FROM gridlake_turns")
