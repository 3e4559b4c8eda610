"""Catalogue operators over dataset names derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import catalog as c
from gridlake.plans.catalogue import build_catalogue
from gridlake.suite.registry import query, table

# A name for every term of the rules, alone and beside the terms that turn its domain, and one
# name without any.
STEMS = tuple(
    dict.fromkeys(
        [f"Some{t.capitalize()}" for r in c.RULES for t in r.terms]
        + [f"{r.terms[-1].capitalize()}With{t.capitalize()}" for r in c.RULES for t in r.unless_terms]
        + ["Export_log"]
    )
)
_STEM_LIST = ", ".join(f"'{s}'" for s in STEMS)


def _domain_sql(name: str) -> str:
    def any_of(*terms: str) -> str:
        return "(" + " OR ".join(f"contains(lower({name}), '{t}')" for t in terms) + ")"

    return f"""CASE
      WHEN {any_of('unavailability', 'outage')} THEN 'Outages'
      WHEN {any_of('load', 'forecastmargin')} THEN 'Load'
      WHEN {any_of('generation', 'fillingrate', 'hydrostorage', 'productionandgeneration')} THEN 'Generation'
      WHEN {any_of('balancing', 'imbalance', 'nettedandexchanged', 'bidavailability', 'procuredbalancing', 'mfrr', 'afrr')} THEN
        CASE WHEN {any_of('marginalprice', 'activationoptimisation')} THEN 'Operations' ELSE 'Balancing' END
      WHEN {any_of('redispatching', 'countertrading', 'algorithm', 'methodology', 'methodologies', 'annualreport',
                   'criteriaapplication', 'sogl', 'fallback', 'elasticdemand', 'frequencycontainment',
                   'permanentallocation')} THEN 'Operations'
      WHEN {any_of('auction', 'congestionmanagement', 'price', 'prices', 'dismantling')} THEN 'Market'
      WHEN {any_of('transfercapacities', 'physicalflows', 'schedule', 'schedules', 'flowbased', 'implicitallocations',
                   'nominated', 'crossbordercapacity', 'transmissionassets', 'distributionfactors',
                   'useoftransfercapacity')} THEN 'Transmission'
      WHEN {any_of('capacity')} THEN CASE WHEN {any_of('generation', 'production')} THEN 'Generation' ELSE 'Transmission' END
      ELSE 'OtherMarketInformation' END"""


def _name(key: str, suffix: str):
    stems = F.array(*map(F.lit, STEMS))
    stem = F.get(stems, (F.col(key) % len(STEMS)).cast("int"))
    return F.concat(stem, F.lit("_"), F.col(suffix).cast("string"), F.lit("_r3"))


@query(
    "classify",
    f"""WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey,
                   [{_STEM_LIST}][l_partkey % {len(STEMS)} + 1] || '_' || l_suppkey || '_r3' AS name FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, name, {_domain_sql('name')} AS domain FROM n""",
)
def classify(spark, sf):
    names = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", _name("l_partkey", "l_suppkey").alias("name")
    )
    return names.withColumn("domain", c.classify(F.col("name")))


# A listing is a set of names: part stems and brands (their product is fixed at any scale).
_LISTING_SQL = f"""listing AS (SELECT DISTINCT
    CASE WHEN p_size % 2 = 0 THEN 'IOP' ELSE 'PROD' END AS env,
    CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'TP_Legacy_Publications' ELSE 'TP_export' END AS root,
    [{_STEM_LIST}][p_partkey % {len(STEMS)} + 1] || '_' || p_brand || '_r3' AS name FROM part)"""


def _listing(spark, sf):
    return (
        table(spark, sf, "part")
        .select(
            F.when(F.col("p_size") % 2 == 0, "IOP").otherwise("PROD").alias("env"),
            F.when(F.col("p_type").isin("PROMO", "SMALL"), "TP_Legacy_Publications").otherwise("TP_export").alias("root"),
            _name("p_partkey", "p_brand").alias("name"),
        )
        .distinct()
    )


_DOMAIN_VALUES = ", ".join(f"('{d}')" for d in c.DOMAINS)


@query("catalog_counts", f"WITH {_LISTING_SQL} SELECT env, root, count(*) AS item_count FROM listing GROUP BY env, root")
def counts(spark, sf):
    return c.item_counts(_listing(spark, sf), ["env", "root"])


@query(
    "catalog_groups",
    f"""WITH {_LISTING_SQL}, active AS (SELECT env, name, {_domain_sql('name')} AS domain FROM listing WHERE root = 'TP_export'),
         skeleton AS (SELECT env, domain FROM (SELECT DISTINCT env FROM active), (VALUES {_DOMAIN_VALUES}) v(domain))
        SELECT s.env, s.domain, a.name
        FROM skeleton s LEFT JOIN active a ON a.env = s.env AND a.domain = s.domain""",
)
def groups(spark, sf):
    grouped = c.group_domains(_listing(spark, sf).filter("root = 'TP_export'"), ["env"], "name")
    return grouped.select("env", "domain", "name")


@query(
    "catalog_listing",
    f"WITH {_LISTING_SQL} SELECT env, root, {_domain_sql('name')} AS domain, name FROM listing",
)
def listing_rows(spark, sf):
    return c.domain_listing(_listing(spark, sf), ["env", "root"], "name")


@query(
    "catalog_doc",
    f"""WITH {_LISTING_SQL}, tagged AS (SELECT *, {_domain_sql('name')} AS domain FROM listing),
        lists AS (
          SELECT env, domain, '[' || string_agg('"' || name || '"', ',' ORDER BY name) || ']' AS names
          FROM tagged WHERE root = 'TP_export' GROUP BY env, domain),
        skeleton AS (
          SELECT env, domain, position FROM (SELECT DISTINCT env FROM listing),
                 (SELECT domain, row_number() OVER () AS position FROM (VALUES {_DOMAIN_VALUES}) v(domain))),
        domains AS (
          SELECT s.env, string_agg('"' || s.domain || '":' || coalesce(l.names, '[]'), ',' ORDER BY position) AS body
          FROM skeleton s LEFT JOIN lists l ON l.env = s.env AND l.domain = s.domain GROUP BY s.env),
        sizes AS (
          SELECT env, count(*) FILTER (root = 'TP_export') AS n_active,
                 count(*) FILTER (root <> 'TP_export') AS n_legacy,
                 coalesce(string_agg('"' || name || '"', ',' ORDER BY name) FILTER (root <> 'TP_export'), '') AS legacy
          FROM listing GROUP BY env)
        SELECT CASE d.env WHEN 'PROD' THEN 'Prod' ELSE d.env END AS environment,
               '{{"description":"' || CASE d.env WHEN 'PROD' THEN 'Production Platform' ELSE 'Integration/Test Platform' END
               || '","root_directories":[{{"name":"TP_export","description":"Active publications folder","item_count":'
               || n_active || ',"domains":{{' || body
               || '}}}},{{"name":"TP_Legacy_Publications","description":"Legacy publications folder","item_count":'
               || n_legacy || ',"folders":[' || legacy || ']}}]}}' AS document
        FROM domains d JOIN sizes s ON d.env = s.env""",
)
def document(spark, sf):
    """The lines, put together here only to be compared; the names are few in this table."""
    lines = build_catalogue(_listing(spark, sf))
    whole = lines.groupBy("environment").agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "")
    # Without the environment's own name before it and the comma behind.
    body = F.regexp_replace(F.regexp_replace(text, r'^"[^"]*":', ""), r",$", "")
    return whole.select("environment", body.alias("document"))
