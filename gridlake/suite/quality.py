"""Data-quality operators on the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import quality as q
from gridlake.suite.registry import query, table

_SHAPES_SQL = r"""shapes AS (
  SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, E' \t')),
                 lambda x: x <> '' AND NOT starts_with(x, '#')), chr(10)) AS shape,
         length(text) - length(replace(text, chr(10), ''))
           + CASE WHEN text <> '' AND NOT ends_with(text, chr(10)) THEN 1 ELSE 0 END AS lines
  FROM documents),
digests AS (SELECT sha256(shape) AS digest, doc_id, lines FROM shapes WHERE length(shape) >= 100),
groups AS (
  SELECT digest, count(*) AS members, min(doc_id) AS first_id, sum(lines) - arg_min(lines, doc_id) AS removable
  FROM digests GROUP BY digest HAVING count(*) > 1)"""


@query(
    "dq_duplicates",
    f"""WITH {_SHAPES_SQL}
    SELECT d.digest, doc_id, CAST(lines AS BIGINT) AS lines, members, first_id, doc_id <> first_id AS redundant
    FROM digests d JOIN groups g ON d.digest = g.digest""",
)
def duplicates(spark, sf):
    return q.duplicate_members(table(spark, sf, "documents"), "doc_id", "text")


@query(
    "dq_duplicate_totals",
    f"""WITH {_SHAPES_SQL}
    SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(members), 0) AS BIGINT) AS duplicate_members,
           CAST(coalesce(sum(removable), 0) AS BIGINT) AS removable_lines FROM groups""",
)
def duplicate_totals(spark, sf):
    return q.duplicate_totals(table(spark, sf, "documents"), "doc_id", "text")


_SETTINGS_SQL = r"""settings AS (
  SELECT doc_id, nullif(text, '') AS description,
         CASE WHEN source = 'src1' THEN NULL WHEN source = 'src2' THEN [] ELSE [source, lang] END AS examples,
         nullif(source, 'src3') AS dflt,
         CASE WHEN ends_with(source, '5') THEN 'integer' ELSE 'string' END AS kind_of_default,
         CASE lang WHEN 'en' THEN 'string' WHEN 'de' THEN 'integer' WHEN 'fr' THEN 'object'
                   ELSE nullif(source, 'src4') END AS kind
  FROM documents),
checked AS (
  SELECT *, coalesce(kind, 'string') AS k,
         length(regexp_replace(regexp_replace(description, '^[\s\x0b]+', ''), '[\s\x0b]+$', '')) AS size FROM settings),
broken AS (
  SELECT doc_id, unnest([
    CASE WHEN description IS NULL THEN 'description missing' END,
    CASE WHEN size < 150 THEN 'description too short' END,
    CASE WHEN k <> 'object' AND examples IS NULL THEN 'examples missing' END,
    CASE WHEN k <> 'object' AND len(examples) = 0 THEN 'examples empty' END,
    CASE WHEN k <> 'object' AND dflt IS NULL THEN 'default missing' END,
    CASE WHEN kind IS NULL THEN 'type missing' END,
    CASE WHEN kind IS NOT NULL AND k NOT IN ('string', 'integer', 'object') THEN 'type unknown' END,
    CASE WHEN kind = 'integer' AND dflt IS NOT NULL AND kind_of_default NOT IN ('integer', 'boolean')
         THEN 'default is not an integer' END,
    CASE WHEN kind = 'string' AND dflt IS NOT NULL AND kind_of_default <> 'string'
         THEN 'default is not a string' END]) AS rule
  FROM checked)"""


def _settings(spark, sf):
    source, lang = F.col("source"), F.col("lang")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.nullif(F.col("text"), F.lit("")).alias("description"),
        F.when(source == "src1", None).when(source == "src2", F.array().cast("array<string>"))
        .otherwise(F.array(source, lang)).alias("examples"),
        F.nullif(source, F.lit("src3")).alias("dflt"),
        F.when(F.endswith(source, F.lit("5")), "integer").otherwise("string").alias("kind_of_default"),
        F.when(lang == "en", "string").when(lang == "de", "integer").when(lang == "fr", "object")
        .otherwise(F.nullif(source, F.lit("src4"))).alias("kind"),
    )


@query("dq_rules", f"WITH {_SETTINGS_SQL} SELECT doc_id, rule FROM broken WHERE rule IS NOT NULL")
def rules(spark, sf):
    return q.violations(
        _settings(spark, sf), "doc_id", q.setting_rules("description", "examples", "dflt", "kind_of_default", "kind")
    )


@query(
    "dq_rule_counts",
    f"WITH {_SETTINGS_SQL} SELECT rule, count(*) AS violations FROM broken WHERE rule IS NOT NULL GROUP BY rule",
)
def rule_counts(spark, sf):
    return q.violation_counts(rules(spark, sf))


# Texts hold no brackets or code fences: mail addresses, or words put in brackets, act as the
# tokens, and lines that start with a common word open and close the fenced blocks.
_MAIL = r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+)"

_LINES_SQL = r"""lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
fenced AS (
  SELECT *, starts_with(trim(line, E' \t'), 'Of') AS is_fence,
         sum(CASE WHEN starts_with(trim(line, E' \t'), 'Of') THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY line_no) AS fences FROM lines),
outside AS (SELECT doc_id, line_no, line FROM fenced WHERE NOT is_fence AND fences % 2 = 0)"""


@query(
    "dq_tokens",
    f"""WITH {_LINES_SQL}, tokens AS (
      SELECT doc_id, line_no, trim(unnest(regexp_extract_all(line, '{_MAIL}', 1))) AS token FROM outside
      WHERE NOT starts_with(trim(line), '<!--') AND NOT ends_with(trim(line), '-->'))
    SELECT doc_id, line_no, token FROM tokens WHERE lower(token) NOT IN ('', 'x', '/')""",
)
def tokens(spark, sf):
    return q.open_tokens(table(spark, sf, "documents"), "doc_id", "text", pattern=_MAIL, token_has="@", fence="Of")


@query(
    "dq_headings",
    f"""WITH {_LINES_SQL} SELECT doc_id, line_no, trim(line, E' \\t') AS section FROM outside
        WHERE starts_with(trim(line, E' \\t'), 'The ')""",
)
def headings(spark, sf):
    return q.section_headings(table(spark, sf, "documents"), "doc_id", "text", mark="The ", fence="Of")


_REQUIRED = ("The and attion to thanedble the, anea. Eriner thanea.", "The.", "All rights reserved.")


@query(
    "dq_sections",
    f"""WITH {_LINES_SQL}, heads AS (SELECT DISTINCT doc_id, trim(line, E' \\t') AS section FROM outside
          WHERE starts_with(trim(line, E' \\t'), 'The')),
        required AS (SELECT * FROM (VALUES {", ".join(f"('{h}')" for h in _REQUIRED)}) v(section))
        SELECT d.doc_id, r.section FROM documents d, required r
        WHERE NOT EXISTS (SELECT 1 FROM heads h WHERE h.doc_id = d.doc_id AND h.section = r.section)""",
)
def sections(spark, sf):
    return q.missing_sections(table(spark, sf, "documents"), "doc_id", "text", _REQUIRED, mark="The", fence="Of")


# Single words in brackets: open tokens, a link, ignored marks and cross references.
_BRACKETS = {"the": "[the]", "and": "[ and ](x)", "of": "[X]", "der": "[ADR-001]", "les": "[/]", "con": "[ con ]", "la": "[la] [x]"}
_BRACKETED_SQL = "text"
for _word, _mark in _BRACKETS.items():
    _BRACKETED_SQL = f"replace({_BRACKETED_SQL}, ' {_word} ', ' {_mark} ')"


@query(
    "dq_open_tokens",
    f"""WITH lines AS (
          SELECT doc_id, unnest(string_split({_BRACKETED_SQL}, chr(10))) AS line,
                 generate_subscripts(string_split({_BRACKETED_SQL}, chr(10)), 1) AS line_no FROM documents),
        found AS (
          SELECT doc_id, line_no, unnest(regexp_extract_all(regexp_replace(line, '\\[[^\\]]+\\]\\(', '(', 'g'), '\\[([^\\]]+)\\]', 1)) AS raw
          FROM lines WHERE NOT starts_with(trim(line), '<!--') AND NOT ends_with(trim(line), '-->'))
        SELECT doc_id, line_no, trim(raw) AS token FROM found
        WHERE lower(trim(raw)) NOT IN ('', 'x', '/') AND NOT regexp_matches(trim(raw), '(?i)^ADR-[0-9]{{3,4}}$')""",
)
def bracketed(spark, sf):
    """The default pattern, with its ignore list, links and cross references."""
    text = F.col("text")
    for word, mark in _BRACKETS.items():
        text = F.replace(text, F.lit(f" {word} "), F.lit(f" {mark} "))
    return q.open_tokens(table(spark, sf, "documents").select("doc_id", text.alias("text")), "doc_id", "text")


@query(
    "dq_missing_entries",
    """SELECT doc_id, 'entry missing' AS rule FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def missing(spark, sf):
    return q.missing_entries(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


_DIFF_SQL = """changed AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 1.5 WHEN o_orderkey % 7 = 1 THEN o_totalprice * (1 + 1e-9)
         ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus
  FROM orders WHERE o_orderkey % 13 <> 0)"""


@query(
    "dq_table_diff",
    f"""WITH {_DIFF_SQL}, pairs AS (
          SELECT o.o_orderkey, o.o_totalprice AS a, c.o_totalprice AS b, o.o_orderstatus AS s, c.o_orderstatus AS t
          FROM orders o JOIN changed c ON o.o_orderkey = c.o_orderkey)
        SELECT o_orderkey, 'o_totalprice' AS "column", 1 AS left_rows, 1 AS right_rows FROM pairs WHERE abs(a - b) > 1e-6 * greatest(abs(a), abs(b))
        UNION ALL SELECT o_orderkey, 'o_orderstatus', 1, 1 FROM pairs WHERE s IS DISTINCT FROM t
        UNION ALL SELECT o_orderkey, NULL, 1, 0 FROM orders WHERE o_orderkey % 13 = 0""",
)
def difference(spark, sf):
    """Orders against a copy with changed, rounded, emptied and missing rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    key = F.col("o_orderkey")
    price = F.when(key % 7 == 0, F.col("o_totalprice") * 1.5).when(key % 7 == 1, F.col("o_totalprice") * (1 + 1e-9)).otherwise(F.col("o_totalprice"))
    changed = orders.where(key % 13 != 0).withColumns({"o_totalprice": price, "o_orderstatus": F.when(key % 11 != 0, F.col("o_orderstatus"))})
    found = q.table_diff(orders, changed, ["o_orderkey"], tolerance=1e-6)
    return found.select("o_orderkey", "column", F.col("left_rows").cast("int").alias("left_rows"), F.col("right_rows").cast("int").alias("right_rows"))


_REPEATED_SQL = """sides AS (
  SELECT o_custkey, o_orderstatus, o_totalprice AS a,
         CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 1.5 WHEN o_orderkey % 7 = 1 THEN o_totalprice * (1 + 1e-9) ELSE o_totalprice END AS b
  FROM orders)"""


@query(
    "dq_table_diff_repeated",
    f"""WITH {_REPEATED_SQL}, l AS (
          SELECT o_custkey, o_orderstatus AS s, a, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus NULLS FIRST, a) AS place FROM sides),
        r AS (
          SELECT o_custkey, o_orderstatus AS s, b, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus NULLS FIRST, b) AS place FROM sides),
        n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
        SELECT l.o_custkey, 'o_totalprice' AS "column", n AS left_rows, n AS right_rows
        FROM l JOIN r USING (o_custkey, place) JOIN n USING (o_custkey) WHERE abs(a - b) > 1e-6 * greatest(abs(a), abs(b))""",
)
def repeated_difference(spark, sf):
    """Orders by customer, whom most keys hold several times, against changed and rounded ones."""
    orders = table(spark, sf, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    changed = F.when(key % 7 == 0, price * 1.5).when(key % 7 == 1, price * (1 + 1e-9)).otherwise(price)
    left = orders.select("o_custkey", "o_orderstatus", "o_totalprice")
    right = orders.select("o_custkey", "o_orderstatus", changed.alias("o_totalprice"))
    found = q.table_diff(left, right, ["o_custkey"], tolerance=1e-6, pair_repeated=True)
    return found.select("o_custkey", "column", "left_rows", "right_rows")
