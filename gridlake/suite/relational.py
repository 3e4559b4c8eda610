"""Merges, snapshots, set operations and source replacement."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import relational as r
from gridlake.operators.quality import key_path_difference, key_paths
from gridlake.suite.registry import query, table


def _daily(spark, sf):
    """Two daily aggregates keyed by (day, id): by the user of an event, and by the event's number
    within the user ids, so that either side has keys of its own."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    by_user = events.groupBy("day", F.col("user_id").alias("id")).agg(F.count("*").alias("v1"))
    by_number = events.groupBy("day", (F.col("event_id") % 1000).alias("id")).agg(F.max("value").alias("v2"))
    return by_user, by_number


@query(
    "join_full_outer",
    """WITH low AS (SELECT CAST(ts AS DATE) AS day, user_id AS id, count(*) AS v1 FROM events GROUP BY 1, 2),
            high AS (SELECT CAST(ts AS DATE) AS day, event_id % 1000 AS id, max(value) AS v2 FROM events GROUP BY 1, 2)
       SELECT coalesce(low.day, high.day) AS day, coalesce(low.id, high.id) AS id, v1, v2
       FROM low FULL OUTER JOIN high ON low.day = high.day AND low.id = high.id""",
)
def full_outer(spark, sf):
    low, high = _daily(spark, sf)
    return r.merge_outer(low, high, ["day", "id"], unique_keys=True)


@query(
    "join_full_outer_rows",
    """WITH late AS (SELECT o_custkey AS custkey, o_orderkey, o_totalprice FROM orders),
            rich AS (SELECT c_custkey AS custkey, c_name FROM customer)
       SELECT coalesce(late.custkey, rich.custkey) AS custkey, o_orderkey, o_totalprice, c_name
       FROM late FULL OUTER JOIN rich ON late.custkey = rich.custkey""",
)
def full_outer_rows(spark, sf):
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    late = orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    rich = customers.select(F.col("c_custkey").alias("custkey"), "c_name")
    return r.merge_outer(late, rich, ["custkey"])


@query(
    "latest_snapshot",
    """WITH files AS (SELECT *, event_type || '_' || strftime(ts, '%Y_%m_%d') || '.csv' AS file_name FROM events)
       SELECT event_id, event_type, file_name FROM files f
       WHERE file_name = (SELECT max(file_name) FROM files g WHERE g.event_type = f.event_type)""",
)
def snapshot(spark, sf):
    file_name = F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyy_MM_dd"), F.lit(".csv"))
    files = table(spark, sf, "events").select("event_id", "event_type", file_name.alias("file_name"))
    return r.latest_snapshot(files, "event_type", "file_name")


@query(
    "latest_file_name",
    """SELECT event_type, max(event_type || '_' || strftime(ts, '%Y_%m_%d') || '.csv') AS latest,
              arg_max(event_id, ts) AS latest_event
       FROM events GROUP BY event_type""",
)
def latest_name(spark, sf):
    file_name = F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyy_MM_dd"), F.lit(".csv"))
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", file_name.alias("file_name"))
    files = events.groupBy("event_type", "file_name").agg(
        F.max("ts").alias("ts"), F.max_by("event_id", "ts").alias("event_id")
    )
    return files.groupBy("event_type").agg(
        F.max("file_name").alias("latest"), F.max_by("event_id", "ts").alias("latest_event")
    )


@query(
    "set_diff",
    """WITH buyers AS (SELECT DISTINCT o_custkey AS key FROM orders),
            parts AS (SELECT DISTINCT l_partkey AS key FROM lineitem)
       SELECT key, 'missing' AS side FROM (SELECT * FROM buyers EXCEPT SELECT * FROM parts)
       UNION ALL SELECT key, 'extra' FROM (SELECT * FROM parts EXCEPT SELECT * FROM buyers)""",
)
def difference(spark, sf):
    buyers = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"))
    parts = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("key"))
    return r.set_difference(buyers, parts, "key")


def _nested_events(spark, sf):
    """Events as nested JSON documents, one shape per event type."""
    document = F.concat(
        F.lit('{"'), "event_type", F.lit('":'), "props", F.lit(',"user":{"id":'), F.col("user_id").cast("string"),
        F.lit(',"tier":{"'), F.concat(F.lit("t"), F.floor("value").cast("long").cast("string")), F.lit('":[{"no":1}]}}}'),
    )
    return table(spark, sf, "events").select("event_type", "value", document.alias("document"))


_NESTED_SQL = """docs AS (
  SELECT event_type, value, '{"' || event_type || '":' || props || ',"user":{"id":' || user_id || ',"tier":{"'
         || 't' || CAST(floor(value) AS BIGINT) || '":[{"no":1}]}}}' AS document
  FROM events),
paths AS (
  SELECT value < 10 AS small, unnest([event_type, event_type || '.' || json_keys(json_extract(document, '$.' || event_type))[1],
         'user', 'user.id', 'user.tier', 'user.tier.' || json_keys(json_extract(document, '$.user.tier'))[1]]) AS path
  FROM docs)"""


@query("set_keypaths", f"WITH {_NESTED_SQL} SELECT DISTINCT path FROM paths")
def paths(spark, sf):
    return key_paths(_nested_events(spark, sf), "document")


@query("set_keypaths_flat", "SELECT DISTINCT unnest(json_keys(props)) AS path FROM events")
def flat_paths(spark, sf):
    return key_paths(table(spark, sf, "events"), "props")


@query(
    "schema_symmetry",
    f"""WITH {_NESTED_SQL}, a AS (SELECT DISTINCT path FROM paths WHERE small),
         b AS (SELECT DISTINCT path FROM paths WHERE NOT small)
       SELECT path, 'missing' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
       UNION ALL SELECT path, 'extra' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def symmetry(spark, sf):
    return key_path_difference(_nested_events(spark, sf), "document", F.col("value") < 10)


@query(
    "set_keypaths_mixed",
    f"""WITH {_NESTED_SQL} SELECT DISTINCT path FROM paths WHERE NOT (path LIKE 'user%' AND small)
        UNION SELECT 'user' FROM events""",
)
def mixed_paths(spark, sf):
    """The user is an object in some documents and a number in the others."""
    plain = F.regexp_replace("document", r'"user":\{.*\}\}$', '"user":1}')
    document = F.when(F.col("value") < 10, plain).otherwise(F.col("document"))
    return key_paths(_nested_events(spark, sf).select(document.alias("document")), "document")


@query(
    "set_union",
    """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def union(spark, sf):
    customers = table(spark, sf, "customer").selectExpr("c_custkey key", "c_name name", "c_mktsegment segment")
    suppliers = table(spark, sf, "supplier").selectExpr("s_name name", "s_suppkey key")
    return r.concatenate(customers, suppliers)


# Sources: each order status is a file; the batch re-delivers two of them, partly.
def _target_and_batch(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("source"))
    batch = orders.filter(F.col("source").isin("1-URGENT", "5-LOW") & (F.col("o_totalprice") > 100000.0))
    return orders, batch.withColumn("o_totalprice", F.col("o_totalprice") + 1.0)


@query(
    "ing_replace",
    """SELECT o_orderkey, o_totalprice, o_orderpriority AS source FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
       UNION ALL
       SELECT o_orderkey, o_totalprice + 1.0, o_orderpriority FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_totalprice > 100000.0""",
)
def replace(spark, sf):
    target, batch = _target_and_batch(spark, sf)
    return r.replace_by_source(target, batch, "source")


_FOUND_SQL = """found AS (SELECT DISTINCT source || '/' || lang || '.csv' AS file FROM documents),
  landed AS (SELECT DISTINCT d.source || '/' || d.lang || '.csv' AS file
             FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 1)"""


def _found_and_landed(spark, sf):
    file = F.concat("source", F.lit("/"), "lang", F.lit(".csv")).alias("file")
    documents = table(spark, sf, "documents")
    toxic = table(spark, sf, "labels").filter("toxic = 1")
    return documents.select(file).distinct(), documents.join(toxic, "doc_id", "left_semi").select(file)


@query("ing_pending", f"WITH {_FOUND_SQL} SELECT file FROM found EXCEPT SELECT file FROM landed")
def pending(spark, sf):
    return r.pending_sources(*_found_and_landed(spark, sf), "file")


@query("ing_force", f"WITH {_FOUND_SQL} SELECT file FROM found")
def forced(spark, sf):
    return r.pending_sources(*_found_and_landed(spark, sf), "file", force=True)


@query(
    "sorted_head",
    """WITH names AS (SELECT DISTINCT url FROM pages)
       SELECT url, (SELECT count(*) FROM names) - 5 AS remaining FROM names ORDER BY url LIMIT 5""",
)
def sorted_head(spark, sf):
    return r.head_with_remainder(table(spark, sf, "pages").select("url").distinct(), "url")


@query(
    "sorted_tail",
    """WITH names AS (SELECT DISTINCT url FROM pages)
       SELECT url, (SELECT count(*) FROM names) - 5 AS remaining FROM names ORDER BY url DESC LIMIT 5""",
)
def sorted_tail(spark, sf):
    return r.head_with_remainder(table(spark, sf, "pages").select("url").distinct(), "url", descending=True)
