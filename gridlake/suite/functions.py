"""Scalar, array, map, JSON and time functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.functions import values as v
from gridlake.functions.headers import normalise_name_column
from gridlake.suite.registry import query, table


@query(
    "fn_string",
    """WITH h AS (SELECT *, 'Price[' || c_mktsegment || '/MWh] (' || c_name || ')' AS header FROM customer)
       SELECT c_custkey, upper(c_name) AS up, lower(c_name) AS low,
              lower(replace(replace(replace(replace(replace(replace(header, '[', '_'), ']', ''), '/', '_'),
                    '(', '_'), ')', ''), ' ', '_')) AS header,
              'raw/' || c_mktsegment || '/' || replace(c_name, '#', '-') || '.parquet' AS path,
              length(c_name) AS name_length, trim('  ' || c_mktsegment || ' ') AS trimmed,
              len(string_split(c_name, '#')) AS parts
       FROM h""",
)
def strings(spark, sf):
    header = F.concat(F.lit("Price["), "c_mktsegment", F.lit("/MWh] ("), "c_name", F.lit(")"))
    file_name = F.concat(F.replace("c_name", F.lit("#"), F.lit("-")), F.lit(".parquet"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.upper("c_name").alias("up"),
        F.lower("c_name").alias("low"),
        normalise_name_column(header).alias("header"),
        F.concat_ws("/", F.lit("raw"), "c_mktsegment", file_name).alias("path"),
        F.length("c_name").cast("long").alias("name_length"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.size(F.split("c_name", "#")).cast("long").alias("parts"),
    )


@query(
    "fn_regexp_replace",
    r"""WITH c AS (SELECT doc_id, regexp_replace(text, '[ \t\n\x0b\f\r]+', ' ', 'g') AS flat FROM documents)
        SELECT doc_id, length(flat) AS flat_length, sha256(flat) AS digest FROM c""",
)
def whitespace(spark, sf):
    flat = table(spark, sf, "documents").select("doc_id", v.collapse_spaces(F.col("text")).alias("flat"))
    return flat.select("doc_id", F.length("flat").cast("long").alias("flat_length"), F.sha2("flat", 256).alias("digest"))


@query(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              round(l_extendedprice * (1.0 - l_discount) * (1.0 + l_tax), 6) AS charge,
              round(l_extendedprice / nullif(l_discount, 0.0), 4) AS per_discount,
              CAST(floor(l_extendedprice / 1000.0) * 1000 AS INTEGER) AS bin,
              l_orderkey % 7 AS remainder, l_linenumber * 15 / 60.0::DOUBLE AS hours
       FROM lineitem""",
)
def math(spark, sf):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(price * (1.0 - discount) * (1.0 + F.col("l_tax")), 6).alias("charge"),
        F.round(F.try_divide(price, discount), 4).alias("per_discount"),
        v.bin_floor(price, 1000.0).alias("bin"),
        (F.col("l_orderkey") % 7).alias("remainder"),
        v.interval_hours(F.col("l_linenumber"), 15).alias("hours"),
    )


@query(
    "fn_time_window",
    """SELECT event_id, time_bucket(INTERVAL '15 minutes', ts) AS period_start FROM events
       WHERE ts >= TIMESTAMP '2024-01-14 23:00:00' AND ts < TIMESTAMP '2024-01-16 23:00:00'""",
)
def time_window(spark, sf):
    events = table(spark, sf, "events")
    inside = events.filter(v.in_zoned_window(F.col("ts"), "2024-01-15", "2024-01-17", "Europe/Brussels"))
    return inside.select("event_id", v.interval_start(F.col("ts"), 15).alias("period_start"))


@query(
    "fn_array",
    """WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
       SELECT doc_id, len(words) AS n, list_sort(words)[1] AS first_sorted, list_sort(words)[-1] AS last_sorted,
              list_reverse(words)[1] AS last_word,
              CAST(list_sum(list_transform(words, lambda x: length(x))) AS BIGINT) AS total_length,
              CAST(list_sum(list_transform(words, lambda x, i: i * length(x))) AS BIGINT) AS weighted_length
       FROM w""",
)
def arrays(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    words = words.withColumn("ordered", F.sort_array("words"))
    lengths = F.transform("words", lambda w: F.length(w).cast("long"))
    weighted = F.transform("words", lambda w, i: (i + 1).cast("long") * F.length(w))

    def total(array):
        return F.aggregate(array, F.lit(0).cast("long"), lambda a, b: a + b)

    return words.select(
        "doc_id",
        F.size("words").cast("long").alias("n"),
        F.element_at("ordered", 1).alias("first_sorted"),
        F.element_at("ordered", -1).alias("last_sorted"),
        F.element_at(F.reverse("words"), 1).alias("last_word"),
        total(lengths).alias("total_length"),
        total(weighted).alias("weighted_length"),
    )


@query(
    "fn_enumerate",
    """SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS pos, word FROM (
         SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word,
                generate_subscripts(string_split(text, ' '), 1) AS i FROM conversations)""",
)
def enumerate_words(spark, sf):
    turns = table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "word"))


@query(
    "arr_filter_map",
    """WITH n AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda x: length(x)) AS lengths FROM documents),
            s AS (SELECT doc_id, list_transform(list_filter(lengths, lambda x: x % 2 = 0), lambda x: x * x) AS squares FROM n)
       SELECT doc_id, len(squares) AS n, CAST(coalesce(list_sum(squares), 0) AS BIGINT) AS total,
              array_to_string(squares, ',') AS squares
       FROM s""",
)
def squares(spark, sf):
    lengths = F.transform(F.split("text", " "), lambda w: F.length(w).cast("long"))
    squared = table(spark, sf, "documents").select("doc_id", v.squares_of_evens(lengths).alias("squares"))
    return squared.select(
        "doc_id",
        F.size("squares").cast("long").alias("n"),
        F.aggregate("squares", F.lit(0).cast("long"), lambda a, b: a + b).alias("total"),
        F.array_join("squares", ",").alias("squares"),
    )


_MEASURES = {"discount": "l_discount", "quantity": "l_quantity", "tax": "l_tax"}


@query(
    "map_filter",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              concat_ws(',', CASE WHEN l_discount > 0.04 THEN 'discount' END,
                             CASE WHEN l_quantity > 0.04 THEN 'quantity' END,
                             CASE WHEN l_tax > 0.04 THEN 'tax' END) AS active
       FROM lineitem""",
)
def active_entries(spark, sf):
    status = [
        part
        for name, column in _MEASURES.items()
        for part in (F.lit(name), F.when(F.col(column) > 0.04, "active").otherwise("inactive"))
    ]
    kept = F.map_keys(v.entries_with_value(F.create_map(*status), "active"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.array_join(F.sort_array(kept), ",").alias("active")
    )


@query(
    "fn_to_json",
    """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment
              || '","level":"' || CASE WHEN c_acctbal < 0 THEN 'WARNING' ELSE 'INFO' END || '"}' AS line
       FROM customer""",
)
def to_json(spark, sf):
    level = F.when(F.col("c_acctbal") < 0, "WARNING").otherwise("INFO")
    line = v.row_json(["c_custkey", "c_name", "c_mktsegment"], level=level)
    return table(spark, sf, "customer").select("c_custkey", line.alias("line"))
