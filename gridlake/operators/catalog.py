"""Catalogue operators: classify dataset names, count, group, and nest them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.operators.windows import match_keys
from gridlake.session import cut_lineage, small_side


@dataclass(frozen=True)
class Rule:
    """Names that contain any of ``terms`` get ``domain`` - or ``unless_domain`` when they
    also contain any of ``unless_terms``."""

    domain: str
    terms: tuple[str, ...]
    unless_domain: str | None = None
    unless_terms: tuple[str, ...] = ()


# The domains in report order, and the ordered keyword table.
DOMAINS = (
    "Load",
    "Generation",
    "Transmission",
    "Balancing",
    "Market",
    "Outages",
    "Operations",
    "OtherMarketInformation",
)
DEFAULT_DOMAIN = "OtherMarketInformation"
RULES = (
    Rule("Outages", ("unavailability", "outage")),
    Rule("Load", ("load", "forecastmargin")),
    Rule("Generation", ("generation", "fillingrate", "hydrostorage", "productionandgeneration")),
    Rule(
        "Balancing",
        ("balancing", "imbalance", "nettedandexchanged", "bidavailability", "procuredbalancing", "mfrr", "afrr"),
        unless_domain="Operations",
        unless_terms=("marginalprice", "activationoptimisation"),
    ),
    Rule(
        "Operations",
        (
            "redispatching", "countertrading", "algorithm", "methodology", "methodologies", "annualreport",
            "criteriaapplication", "sogl", "fallback", "elasticdemand", "frequencycontainment", "permanentallocation",
        ),
    ),
    Rule("Market", ("auction", "congestionmanagement", "price", "prices", "dismantling")),
    Rule(
        "Transmission",
        (
            "transfercapacities", "physicalflows", "schedule", "schedules", "flowbased", "implicitallocations",
            "nominated", "crossbordercapacity", "transmissionassets", "distributionfactors", "useoftransfercapacity",
        ),
    ),
    Rule("Transmission", ("capacity",), unless_domain="Generation", unless_terms=("generation", "production")),
)

def _mentions(name: Column, terms: tuple[str, ...]) -> Column:
    """Any-of substring test: plain byte searches, which stay inside generated code."""
    return reduce(lambda a, b: a | b, [F.contains(name, F.lit(t)) for t in terms])


def classify(name: Column, rules: tuple[Rule, ...] = RULES, default: str = DEFAULT_DOMAIN) -> Column:
    """Domain of a dataset name: the first rule that matches wins, letter case ignored."""
    lowered = F.lower(name)
    out = F.lit(default)
    for rule in reversed(rules):
        domain = F.lit(rule.domain)
        if rule.unless_terms:
            domain = F.when(_mentions(lowered, rule.unless_terms), rule.unless_domain).otherwise(domain)
        out = F.when(_mentions(lowered, rule.terms), domain).otherwise(out)
    return out


def item_counts(listing: DataFrame, keys: list[str]) -> DataFrame:
    return listing.groupBy(*keys).agg(F.count("*").alias("item_count"))


def domain_listing(listing: DataFrame, keys: list[str], name: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Row form of the grouped catalogue for listings of any size, in catalogue order."""
    position = F.array_position(F.array(*map(F.lit, DOMAINS)), F.col("domain"))
    rows = listing.select(*keys, classify(F.col(name), rules).alias("domain"), name)
    return rows.orderBy(*keys, position, name)


def _positions(column: Column, values: tuple[str, ...]) -> Column:
    """Place of a value in a list, from 1; values that are not in it come after all others."""
    place = F.array_position(F.array(*map(F.lit, values)), column)
    return F.when(place > 0, place).otherwise(len(values) + 1).cast("int")


def group_domains(listing: DataFrame, keys: list[str], name: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(keys, domain, position, name)``: the names of each domain, every domain present: one that
    holds none has one row whose name is NULL. Rows, not lists, so a group may have any size."""
    rows = listing.select(*keys, classify(F.col(name), rules).alias("domain"), F.col(name).alias(name))
    held = rows.groupBy(*keys).agg(F.collect_set("domain").alias("_held"))  # eight names at most
    missing = F.array_except(F.array(*map(F.lit, DOMAINS)), F.col("_held"))
    empty = held.select(*keys, F.explode(missing).alias("domain"), F.lit(None).cast("string").alias(name))
    both = rows.unionByName(empty)
    return both.select(*keys, "domain", _positions(F.col("domain"), DOMAINS).alias("position"), name)


def summary_lines(
    listing: DataFrame,
    env: str,
    root: str,
    name: str,
    active_root: str,
    legacy_root: str,
    env_labels: dict[str, tuple[str, str]],
    descriptions: dict[str, str],
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``(environment, place, line)``: the nested summary of all environments as lines of JSON.

    Ordered by (environment, place) the lines are one JSON document. Each name is a line, so
    nothing holds a whole group; whether a comma follows is told by the greatest name of the
    group, an aggregate. ``env_labels`` maps an environment to its report key and description;
    one without a label keeps its name. The active root is grouped into domains, any other is a
    plain sorted list; roots beyond the two named ones come after them, by name."""

    def label(i: int) -> Column:
        out = F.col(env) if i == 0 else F.lit("")
        for value, pair in env_labels.items():
            out = F.when(F.col(env) == value, pair[i]).otherwise(out)
        return out

    def described(column: Column) -> Column:
        out = F.lit("")
        for value, text in descriptions.items():
            out = F.when(column == value, text).otherwise(out)
        return out

    quoted = lambda c: F.get(F.split(F.to_json(F.array(c)), r"^\[|\]$"), 1)  # noqa: E731  a JSON string
    known = (active_root, legacy_root)
    active = F.col(root).eqNullSafe(F.lit(active_root))
    place = _positions(F.col(root), known)
    # The listing is read once: names with their domain are kept, and all else comes from one row for
    # each environment, root and domain.
    names = listing.where(F.col(env).isNotNull()).groupBy(env, root, name).agg(F.count("*").alias("_copies"))
    counted = cut_lineage(names.withColumn("domain", F.when(active, classify(F.col(name), rules)).otherwise(F.lit(""))))
    grouped = small_side(counted.groupBy(env, root, "domain").agg(F.sum("_copies").alias("_n"), F.max(name).alias("_greatest")))
    # Both named roots are there for every environment; further ones where they have names.
    roots = grouped.select(env, root, "_n").union(grouped.select(env, F.explode(F.array(*map(F.lit, known))), F.lit(0).cast("long")))
    pairs = roots.groupBy(env, root).agg(F.sum("_n").alias("n"))
    last = F.max(F.struct(place.alias("p"), F.col(root).alias("root"))).over(Window.partitionBy(env))
    pairs = pairs.withColumn("last", last)
    environments = grouped.select(env).distinct()
    top = environments.withColumn("last_env", environments.agg(F.max(label(0))).scalar())

    def row(first: Column, second: Column, third: Column, fourth: Column, text: Column) -> list[Column]:
        """Place: root position, root, part of the root, domain position, name."""
        return [label(0).alias("environment"), F.struct(first.alias("r"), second.alias("root"), third.alias("part"), fourth.alias("d"), F.lit(None).cast("string").alias("name")).alias("place"), text.alias("line")]

    none = F.lit("")
    opening = environments.select(
        *row(F.lit(0), none, F.lit(0), F.lit(0), F.concat(quoted(label(0)), F.lit(':{"description":'), quoted(label(1)), F.lit(',"root_directories":[')))
    )
    closing = top.select(
        *row(F.lit(9), none, F.lit(9), F.lit(0), F.concat(F.lit("]}"), F.when(label(0) == F.col("last_env"), "").otherwise(",")))
    )
    shown = F.coalesce(F.col(root), F.lit(""))
    head = pairs.select(
        *row(place, shown, F.lit(0), F.lit(0), F.concat(
            F.lit('{"name":'), quoted(shown), F.lit(',"description":'), quoted(described(F.col(root))), F.lit(',"item_count":'),
            F.col("n").cast("string"), F.when(active, ',"domains":{').otherwise(',"folders":['),
        ))
    )
    comma = F.when((F.col("last.p") == place) & F.col("last.root").eqNullSafe(F.col(root)), "").otherwise(",")
    tail = pairs.select(*row(place, shown, F.lit(9), F.lit(0), F.concat(F.when(active, "}}").otherwise("]}"), comma)))

    # Domains of the active root, whether or not they hold names.
    domains = environments.select(env, F.posexplode(F.array(*map(F.lit, DOMAINS))).alias("d", "domain")).withColumn(root, F.lit(active_root))
    at = place, shown
    domain_head = domains.select(*row(*at, F.lit(1), F.col("d") * 3, F.concat(quoted(F.col("domain")), F.lit(":["))))
    domain_tail = domains.select(
        *row(*at, F.lit(1), F.col("d") * 3 + 2, F.when(F.col("d") == len(DOMAINS) - 1, "]").otherwise("],"))
    )
    matched = match_keys(counted, grouped.select(env, root, "domain", "_greatest"), [env, root, "domain"])
    copies = matched.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    follows = F.when((F.col(name) == F.col("_greatest")) & (F.col("_copy") == F.col("_copies")), "").otherwise(",")
    d = F.when(active, (_positions(F.col("domain"), DOMAINS) - 1) * 3 + 1).otherwise(0)
    body = copies.select(
        label(0).alias("environment"),
        F.struct(place.alias("r"), shown.alias("root"), F.lit(1).alias("part"), d.alias("d"), F.concat(F.col(name), F.format_string("\u0000%019d", "_copy")).alias("name")).alias("place"),
        F.concat(quoted(F.col(name)), follows).alias("line"),
    )
    return reduce(DataFrame.unionByName, [opening, head, domain_head, body, domain_tail, tail, closing])
