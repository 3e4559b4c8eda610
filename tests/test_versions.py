"""Versions of a table switch at once: a run may die after any statement and nothing is lost."""

import uuid

import pytest
from pyspark.sql import functions as F

from gridlake.plans import ingest as g
from gridlake.plans import versions as v

FOLDER = "Prices_r3"


class Dead(Exception):
    pass


@pytest.fixture
def zone(spark, tmp_path):
    class Zone:
        landing = tmp_path / "landing"
        target = g.Target(str(tmp_path / "raw"), f"bronze_{uuid.uuid4().hex}", location=str(tmp_path / "bronze"))

        def deliver(self, name, lines, header="Zone;Price"):
            (self.landing / FOLDER).mkdir(parents=True, exist_ok=True)
            (self.landing / FOLDER / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")

        def run(self, **kw):
            return sorted(r[0] for r in g.ingest_folder(spark, str(self.landing), FOLDER, self.target, **kw).collect())

        def table(self):
            return spark.table(self.target.full_name(FOLDER))

        def prices(self):
            return sorted((r["_source_file"], str(r["price"])) for r in self.table().select("_source_file", "price").collect())

        def landed(self):
            return sorted(r[0] for r in g.ledger(spark, self.target.ledger_name(FOLDER)).collect())

        def versions(self):
            return g.versioned(spark, self.target, FOLDER)

    return Zone()


class Killer:
    """Dies before the ``n``-th change of the catalogue or of rows."""

    def __init__(self, patch, n):
        self.left, self.done = n, []
        for name in ("statement", "appended"):
            patch.setattr(v, name, self.wrap(name, getattr(v, name)))

    def wrap(self, name, call):
        def run(*args):
            self.left -= 1
            if self.left < 0:
                raise Dead(name)
            self.done.append(args[1] if name == "statement" else name)
            return call(*args)

        return run


@pytest.mark.parametrize("step", range(12))
def test_a_run_may_die_anywhere(zone, spark, monkeypatch, step):
    """A widening run that replaces one source, adds one and empties one."""
    zone.deliver("a.csv", ["n;1", "n;2"])
    zone.deliver("b.csv", ["n;3"])
    zone.run()
    before = zone.prices()
    zone.deliver("a.csv", ["n;1.5"])
    zone.deliver("b.csv", [])
    zone.deliver("c.csv", ["n;7", "n;8"])
    want = [("a.csv", "1.5"), ("c.csv", "7.0"), ("c.csv", "8.0")]
    try:
        with monkeypatch.context() as patch:
            killer = Killer(patch, step)
            zone.run(force=True)
        assert zone.prices() == want  # all statements had been made
    except Dead:
        died = [(s, str(float(p))) for s, p in zone.prices()]
        assert died == [(s, str(float(p))) for s, p in before]  # readers see the old rows, all of them
        assert zone.landed() == ["a.csv", "b.csv"]
    assert zone.run(force=True) == ["a.csv", "b.csv", "c.csv"]
    assert zone.prices() == want and zone.landed() == ["a.csv", "b.csv", "c.csv"]
    assert zone.run() == []
    switches = [s for s in killer.done if s.startswith("CREATE OR REPLACE VIEW") and "__landed`" in s.split(" AS ")[0]]
    assert len(switches) <= 1 and (not switches or killer.done[-1] == switches[0])


@pytest.mark.parametrize("step", range(6))
def test_a_first_run_may_die_anywhere(zone, monkeypatch, step):
    zone.deliver("a.csv", ["n;1", "n;2"])
    with monkeypatch.context() as patch:
        Killer(patch, step)
        try:
            zone.run()
        except Dead:
            assert zone.landed() == []
    zone.run()
    assert zone.prices() == [("a.csv", "1"), ("a.csv", "2")] and zone.landed() == ["a.csv"]


def test_what_a_dead_run_left_is_removed(zone, spark, monkeypatch):
    zone.deliver("a.csv", ["n;1"])
    zone.run()
    for _ in range(3):
        with monkeypatch.context() as patch, pytest.raises(Dead):
            Killer(patch, 2)
            zone.deliver("b.csv", ["n;2.5"])
            zone.run(force=True)
    zone.run(force=True)
    zone.versions().repair()
    table = zone.versions()
    kept = [r for n in table.generations() for r in v.statement_of_partitions(spark, table.named(f"__g{n}"), ["_run", "_source_file"])]
    assert sorted(s for _, s in kept) == ["a.csv", "b.csv"]
    assert len(v.statement_of_partitions(spark, table.versions, ["version"])) == 1
    files = [p for p in zone.table().inputFiles() if "__g" in p]
    on_disk = [p for n in table.generations() for p in __import__("pathlib").Path(f"{table.place}__g{n}").rglob("*.parquet")]
    assert len(files) == len(on_disk) == 2


def test_whole_numbers_stay_exact(zone):
    large = ["n;9007199254740993", "n;-9007199254740995"]
    zone.deliver("a.csv", large)
    zone.run()
    assert dict(zone.table().dtypes)["price"] == "bigint"
    zone.deliver("b.csv", ["n;2.5"])
    zone.run()
    assert dict(zone.table().dtypes)["price"] == "string"
    assert zone.prices() == [("a.csv", "-9007199254740995"), ("a.csv", "9007199254740993"), ("b.csv", "2.5")]


def test_whole_numbers_after_fractions_stay_exact(zone):
    zone.deliver("a.csv", ["n;2.5"])
    zone.run()
    zone.deliver("b.csv", ["n;9007199254740992"])
    zone.run()
    assert dict(zone.table().dtypes)["price"] == "double"
    zone.deliver("c.csv", ["n;9007199254740993"])
    zone.run()
    assert zone.prices() == [("a.csv", "2.5"), ("b.csv", "9.007199254740992E15"), ("c.csv", "9007199254740993")]


def test_generations_only_when_columns_change(zone):
    for i, price in enumerate(["1", "2", "2.5", "3", "4.5", "x", "6"]):
        zone.deliver(f"{i}.csv", [f"n;{price}"])
        zone.run()
    assert zone.versions().generations() == [1, 2, 3]
    assert [p for _, p in zone.prices()] == ["1", "2", "2.5", "3.0", "4.5", "x", "6"]


def test_readers_of_the_old_version_go_on(zone, spark):
    """A frame made before a switch reads what it named: its rows are still there."""
    zone.deliver("a.csv", ["n;1", "n;2"])
    zone.run()
    old = zone.table()
    old.count()
    zone.deliver("a.csv", ["n;5"])
    zone.run(force=True)
    assert {r.price for r in old.collect()} in ({1, 2}, {5})
    assert [p for _, p in zone.prices()] == ["5"]


def test_reads_prune_by_source(zone, spark):
    for i in range(6):
        zone.deliver(f"{i}.csv", [f"n;{i}"])
    zone.run()
    one = zone.table().where(F.col("_source_file") == "3.csv")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
