"""Window operators against brute force, with one key holding most rows."""

import random

import pytest

from gridlake.operators import windows as w


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    keys = ["hot"] * 6 + ["a", "b", None]
    return [
        (i, rng.choice(keys), rng.choice([None, *range(400)]), rng.choice([None, *range(-5, 40)]))
        for i in rng.sample(range(5000), 1500)
    ]


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "id long, key string, t int, v long").cache()


def by_key(data, order):
    groups = {}
    for row in data:
        groups.setdefault(row[1], []).append(row)
    return {k: sorted(rows, key=order) for k, rows in groups.items()}


def time_order(row):
    return (row[2] is not None, row[2] or 0, row[0])


@pytest.mark.parametrize("limit", [-1, 10**9])
def test_share_of_total(frame, data, limit, monkeypatch):
    monkeypatch.setattr(w, "small_side", lambda df, _real=w.small_side: _real(df, limit))
    got = {r.id: r.share_pct for r in w.share_of_total(frame, "key", "v").collect()}
    for rows in by_key(data, time_order).values():
        total = sum(r[3] or 0 for r in rows)
        for r in rows:
            want = None if r[3] is None else 100.0 * r[3] / total
            assert got[r[0]] is None if want is None else abs(got[r[0]] - want) <= 0.00501


@pytest.mark.parametrize("limit", [-1, 10**9])
def test_running_total(frame, data, limit, monkeypatch):
    monkeypatch.setattr(w, "small_side", lambda df, _real=w.small_side: _real(df, limit))
    got = {r.id: r.running for r in w.running_total(frame, "key", ["t", "id"], "v").collect()}
    want = {}
    for rows in by_key(data, time_order).values():
        seen = None
        for r in rows:
            seen = seen if r[3] is None else (seen or 0) + r[3]
            want[r[0]] = seen
    assert got == want


def test_centred_mean(frame, data):
    got = {r.id: r.smoothed for r in w.centred_mean(frame, "key", ["t", "id"], "v").collect()}
    want = {}
    for rows in by_key(data, time_order).values():
        for i, r in enumerate(rows):
            near = [x[3] for x in rows[max(i - 1, 0) : i + 2] if x[3] is not None]
            want[r[0]] = sum(near) / len(near) if near else None
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def dense(rows):
    levels = sorted({r[3] for r in rows if r[3] is not None}, reverse=True)
    ranks = {v: i for i, v in enumerate(levels, 1)}
    ranks[None] = len(levels) + 1
    return ranks


def test_dense_rank(frame, data):
    ranked = w.with_dense_rank(frame, "key", "v")
    got = {r.id: r["rank"] for r in ranked.collect()}
    want = {}
    for rows in by_key(data, time_order).values():
        ranks = dense(rows)
        want |= {r[0]: ranks[r[3]] for r in rows}
    assert got == want


def test_dense_top_n_keeps_every_tie(frame, data):
    got = {r.id: r["rank"] for r in w.dense_top_n(frame, "key", "v", 3).collect()}
    want = {}
    for rows in by_key(data, time_order).values():
        ranks = dense(rows)
        want |= {r[0]: ranks[r[3]] for r in rows if ranks[r[3]] <= 3}
    assert got == want


def test_nothing_in_nothing_out(spark):
    empty = spark.createDataFrame([], "id long, key string, t int, v long")
    assert w.with_dense_rank(empty, "key", "v").count() == 0
    assert w.running_total(empty, "key", ["t"], "v").count() == 0
    assert w.dense_top_n(empty, "key", "v", 3).count() == 0
