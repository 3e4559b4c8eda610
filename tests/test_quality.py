import pytest
from pyspark.sql import functions as F

from gridlake.operators import quality as q
from gridlake.operators.relational import set_difference

D150 = "d" * 150
SETTINGS = [
    ("valid", D150, ["a"], "x", "string", "string", []),
    ("short", "d" * 149, ["a"], "x", "string", "string", ["description too short"]),
    ("padded", "  " + "d" * 149 + "\n", ["a"], "x", "string", "string", ["description too short"]),
    ("bare", None, ["a"], "x", "string", "string", ["description missing"]),
    ("no examples", D150, None, "x", "string", "string", ["examples missing"]),
    ("empty examples", D150, [], "x", "string", "string", ["examples empty"]),
    ("no default", D150, ["a"], None, None, "string", ["default missing"]),
    ("no type", D150, ["a"], "5", "integer", None, ["type missing"]),
    ("unknown type", D150, ["a"], "x", "string", "float", ["type unknown"]),
    ("object", D150, None, None, None, "object", []),
    ("text for number", D150, ["a"], "x", "string", "integer", ["default is not an integer"]),
    ("flag for number", D150, ["a"], "true", "boolean", "integer", []),
    ("number for text", D150, ["a"], "5", "integer", "string", ["default is not a string"]),
    ("everything", "d", [], None, None, "odd", ["default missing", "description too short", "examples empty", "type unknown"]),
]


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame(
        [row[:6] for row in SETTINGS],
        "key string, description string, examples array<string>, dflt string, dflt_kind string, kind string",
    )
    return q.violations(df, "key", q.setting_rules("description", "examples", "dflt", "dflt_kind", "kind")).cache()


@pytest.mark.parametrize("row", SETTINGS, ids=lambda row: row[0])
def test_setting_rules(found, row):
    got = sorted(r.rule for r in found.filter(F.col("key") == row[0]).collect())
    assert got == row[6]


def test_violation_counts(found):
    counts = {r.rule: r.violations for r in q.violation_counts(found).collect()}
    assert counts["description too short"] == 3
    assert sum(counts.values()) == sum(len(r[6]) for r in SETTINGS)


def test_key_paths_and_their_difference(spark):
    left = spark.createDataFrame([('{"ports":{"a":1,"b":2}}',)], "doc string")
    right = spark.createDataFrame([('{"ports":{"a":1},"x":0}',)], "doc string")
    paths = [{r.path for r in q.key_paths(df, "doc").collect()} for df in (left, right)]
    assert paths == [{"ports", "ports.a", "ports.b"}, {"ports", "ports.a", "x"}]
    diff = set_difference(q.key_paths(left, "doc"), q.key_paths(right, "doc"), "path")
    assert {tuple(r) for r in diff.collect()} == {("ports.b", "missing"), ("x", "extra")}


def test_key_paths_of_any_depth_and_odd_documents(spark):
    deep = '{"a":' * 30 + "1" + "}" * 30
    docs = [deep, '{"l":[{"no":1}],"s":"{"}', '{"flat":1}', "not json", "[1]", None, "", ' {"sp":{"k":null}}', '{"e":{}}']
    got = {r.path for r in q.key_paths(spark.createDataFrame([(d,) for d in docs], "doc string"), "doc").collect()}
    want = {".".join(["a"] * i) for i in range(1, 31)} | {"l", "s", "flat", "sp", "sp.k", "e"}
    assert got == want


def test_key_paths_with_odd_names_and_changing_kinds(spark):
    docs = ['{"a":1,"b c":{"x":{}},"d`e":{"1":[{"z":{"q":1}}]},"é":{"k":null,"a.b":"s"},"A<B>: C":{"t":true}}',
            '{"a":{"n":{"m":[1,"x",{"p":1}]}},"select":{"1a":1,"_b":2.5}}', '{"":{"y":2}}', '{"a":[{"n":2}]}']
    df = spark.createDataFrame([(d, i < 2) for i, d in enumerate(docs)], "doc string, first boolean")
    want = {"a", "b c", "b c.x", "d`e", "d`e.1", "é", "é.k", "é.a.b", "A<B>: C", "A<B>: C.t", "a.n", "a.n.m", "select", "select.1a", "select._b"}
    assert {r.path for r in q.key_paths(df, "doc").collect()} == want | {"", ".y"}
    apart = {tuple(r) for r in q.key_path_difference(df, "doc", F.col("first")).collect()}
    assert apart == {(p, "missing") for p in want - {"a"}} | {("", "extra"), (".y", "extra")}


def test_only_paths_are_shuffled(spark):
    df = spark.createDataFrame([('{"a":{"b":1}}',)], "doc string")
    plan = q.key_paths(df, "doc")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(side" in plan and plan.count("parseJson") == 1
