"""Text expressions against straightforward Python over random texts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridlake.functions import text as t
from gridlake.operators import quality as q

PIECES = [
    "a", "bc", "#", " ", "  ", "\t", "\n", "\n\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0",
    chr(0x2028), chr(0x3000), "```", "```python", "[Open]", "[x]", "[ ]", "[ADR-001]", "[link](url)", "<!--", "-->",
    "## Head", "## Other", "é",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(800)] + ["", "\n", "```", "```\n```"]


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string").cache()


def shape(text):
    kept = (line.strip() for line in text.splitlines())
    return "\n".join(line for line in kept if line and not line.startswith("#"))


def outside(text):
    fenced, out = False, []
    for number, line in enumerate(text.splitlines(), 1):
        if line.strip().startswith("```"):
            fenced = not fenced
        elif not fenced:
            out.append((number, line))
    return out


def test_code_shape(frame, texts):
    got = {r.id: r.s for r in frame.select("id", t.code_shape(F.col("text")).alias("s")).collect()}
    assert got == {i: shape(text) for i, text in enumerate(texts)}


def test_line_total(frame, texts):
    got = {r.id: r.n for r in frame.select("id", t.line_total(F.col("text")).alias("n")).collect()}
    assert got == {i: text.count("\n") + (1 if text and not text.endswith("\n") else 0) for i, text in enumerate(texts)}


def test_lines_outside_fences(frame, texts):
    got = {(r.id, r.line_no, r.line) for r in t.explode_lines_outside(frame, "id", "text", "```").collect() if r.line}
    assert got == {(i, n, line) for i, text in enumerate(texts) for n, line in outside(text) if line}


def test_open_tokens(frame, texts):
    import re

    want = []
    for i, text in enumerate(texts):
        for number, line in outside(text):
            bare = line.strip()
            if bare.startswith("<!--") or bare.endswith("-->"):
                continue
            for token in re.findall(r"\[([^\]]+)\](?!\()", line):
                token = token.strip()
                if token and token.lower() not in ("x", "/") and not re.match(r"(?i)ADR-\d{3,4}$", token):
                    want.append((i, number, token))
    got = [tuple(r) for r in q.open_tokens(frame, "id", "text").collect()]
    assert len(want) > 100
    assert sorted(got) == sorted(want)


def test_token_prefilter_never_hides_a_custom_pattern(spark):
    df = spark.createDataFrame([(1, "ask TODO here\nTODO"), (2, "none")], "id long, text string")
    got = q.open_tokens(df, "id", "text", pattern="(TODO)")
    assert sorted(map(tuple, got.collect())) == [(1, 1, "TODO"), (1, 2, "TODO")]


def test_missing_sections(frame, texts):
    required = ["## Head", "## Other"]
    got = sorted(map(tuple, q.missing_sections(frame, "id", "text", required).collect()))
    want = []
    for i, text in enumerate(texts):
        heads = {line.strip() for _, line in outside(text)}
        want += [(i, r) for r in required if r not in heads]
    assert got == sorted(want)


def test_section_headings_of_a_template(spark):
    df = spark.createDataFrame([(1, "# T\n## A\n```\n## not\n```\n ### B \ntext")], "id long, text string")
    got = [tuple(r) for r in q.section_headings(df, "id", "text").orderBy("line_no").collect()]
    assert got == [(1, 2, "## A"), (1, 6, "### B")]


def test_duplicates_against_brute_force(frame, texts):
    groups = {}
    for i, text in enumerate(texts):
        s = shape(text)
        if len(s) >= 5:
            groups.setdefault(hashlib.sha256(s.encode()).hexdigest(), []).append(i)
    groups = {d: ids for d, ids in groups.items() if len(ids) > 1}
    lines = [text.count("\n") + (1 if text and not text.endswith("\n") else 0) for text in texts]
    got = sorted(map(tuple, q.duplicate_members(frame, "id", "text", min_len=5).collect()))
    want = sorted((d, i, lines[i], len(ids), ids[0], i != ids[0]) for d, ids in groups.items() for i in ids)
    assert groups and got == want
    totals = q.duplicate_totals(frame, "id", "text", min_len=5).first()
    removable = sum(lines[i] for ids in groups.values() for i in ids[1:])
    assert tuple(totals) == (len(groups), sum(map(len, groups.values())), removable)


def test_short_duplicates_are_ignored(spark):
    long_text = "x = 1\n" * 40
    df = spark.createDataFrame(
        [(1, long_text), (2, "# note\n\n  " + long_text), (3, "short"), (4, "short")], "id long, text string"
    )
    got = q.duplicate_members(df, "id", "text").orderBy("id").collect()
    assert [(r.id, r.first_id, r.redundant, r.lines) for r in got] == [(1, 1, False, 40), (2, 1, True, 42)]
    assert tuple(q.duplicate_totals(df, "id", "text").first()) == (1, 2, 42)


def test_no_duplicates_gives_zero_totals(spark):
    df = spark.createDataFrame([(1, "a")], "id long, text string")
    assert tuple(q.duplicate_totals(df, "id", "text").first()) == (0, 0, 0)
