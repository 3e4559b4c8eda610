import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridlake.plans import ingest as g
from gridlake.sources import files as s

FOLDER = "EnergyPrices_12.1.D_r3"
HEADER = "AreaDisplayName;DateTime(UTC);Price[Currency/MWh];Currency"
A = ["DE;2026-05-15 00:00:00;10.5;EUR", "DE;2026-05-15 01:00:00;;EUR", "UA;2026-05-15 00:00:00;900;UAH"]
B = ["FR;2026-05-16 00:00:00;-3;EUR", "FR;2026-05-16 01:00:00;4;EUR"]
SCHEMA = "AreaDisplayName string, `DateTime(UTC)` timestamp, `Price[Currency/MWh]` double, Currency string"
ODD_NAME = "b'q [x] 1+1.csv"


@pytest.fixture
def zone(spark, tmp_path):
    class Zone:
        landing = tmp_path / "landing"
        target = g.Target(str(tmp_path / "raw"), f"bronze_{uuid.uuid4().hex}", location=str(tmp_path / "bronze"))

        def deliver(self, name, lines, header=HEADER):
            folder = self.landing / FOLDER
            folder.mkdir(parents=True, exist_ok=True)
            (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")

        def run(self, **kw):
            return sorted(r[0] for r in g.ingest_folder(spark, str(self.landing), FOLDER, self.target, **kw).collect())

        def table(self):
            return spark.table(self.target.full_name(FOLDER))

        def counts(self):
            return {r[0]: r[1] for r in self.table().groupBy("_source_file").count().collect()}

    return Zone()


def test_first_run_lands_clean_rows(zone):
    zone.deliver("a.csv", A)
    zone.deliver(ODD_NAME, B)
    zone.deliver("notes.txt", ["ignored"])
    assert zone.run() == sorted(["a.csv", ODD_NAME])
    table = zone.table()
    assert table.columns == ["areadisplayname", "datetime_utc", "price_currency_mwh", "currency", "_source_file"]
    assert dict(table.dtypes)["price_currency_mwh"] == "double"
    assert zone.counts() == {"a.csv": 3, ODD_NAME: 2}
    # A missing price stays NULL, not a text and not NaN.
    assert table.filter(F.col("price_currency_mwh").isNull()).count() == 1


def test_second_run_does_nothing(zone):
    zone.deliver("a.csv", A)
    zone.run()
    before = zone.table().inputFiles()
    assert zone.run() == []
    assert zone.table().inputFiles() == before


def test_new_file_is_added(zone):
    zone.deliver("a.csv", A)
    zone.run()
    zone.deliver(ODD_NAME, B)
    assert zone.run() == [ODD_NAME]
    assert zone.counts() == {"a.csv": 3, ODD_NAME: 2}


def test_changed_file_is_reloaded_only_by_force(zone, spark):
    zone.deliver("a.csv", A)
    zone.deliver("b.csv", B)
    zone.run()
    zone.deliver("a.csv", A[:1])
    assert zone.run() == []
    assert zone.counts()["a.csv"] == 3
    assert zone.run(force=True) == ["a.csv", "b.csv"]
    assert zone.counts() == {"a.csv": 1, "b.csv": 2}
    raw = spark.read.parquet(zone.target.raw_path)
    assert {r[0]: r[1] for r in raw.groupBy("_source_file").count().collect()} == {"a.csv": 1, "b.csv": 2}


def test_forced_delivery_without_rows_removes_the_old_ones(zone):
    zone.deliver(ODD_NAME, A)
    zone.deliver("b.csv", B)
    zone.run()
    zone.deliver(ODD_NAME, [])
    zone.run(force=True, schema=SCHEMA)
    assert zone.counts() == {"b.csv": 2}


def test_crash_between_raw_and_bronze_is_repaired(zone, monkeypatch):
    zone.deliver("a.csv", A)
    with monkeypatch.context() as patch:
        patch.setattr(g, "replace_sources", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            zone.run()
    assert zone.run() == ["a.csv"]
    assert zone.counts() == {"a.csv": 3}


def test_small_commits_give_the_same_table(zone):
    for i in range(5):
        zone.deliver(f"f{i}.csv", A)
    assert len(zone.run(files_per_commit=2)) == 5
    assert zone.counts() == {f"f{i}.csv": 3 for i in range(5)}


@pytest.mark.parametrize("size", [1, 10_000])
def test_fractions_after_whole_numbers_are_kept(zone, rows, size):
    zone.deliver("a.csv", ["n;1", "n;2"], header="Zone;Price")
    zone.deliver("b.csv", ["n;2.6", "n;q"], header="Zone;Price")
    zone.run(files_per_commit=size)
    assert rows(zone.table().select("price")) == [("1",), ("2",), ("2.6",), ("q",)]


def test_columns_widen_and_never_narrow(zone, rows, spark):
    steps = [(["n;1", "n;2"], "int"), (["n;3.7", "n;-4.9"], "double"), (["n;5"], "double"), (["n;odd"], "string")]
    for i, (lines, kind) in enumerate(steps):
        zone.deliver(f"{i}.csv", lines, header="Zone;Price")
        zone.run()
        assert dict(zone.table().dtypes)["price"] == kind
        if kind == "double":
            assert {r.price for r in zone.table().collect()} >= {1.0, 2.0, 3.7, -4.9}
    assert zone.table().count() == 6
    assert {k: v for k, v in zone.counts().items()} == {"0.csv": 2, "1.csv": 2, "2.csv": 1, "3.csv": 1}
    assert zone.run() == []


@pytest.mark.parametrize(
    ("a", "b", "wide"),
    [("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "int", "double"), ("date", "int", "string"), ("timestamp", "timestamp", "timestamp")],
)
def test_wider_type(a, b, wide):
    assert g.wider_type(a, b) == g.wider_type(b, a) == wide


def test_a_file_with_a_header_only_lands_once(zone):
    zone.deliver("a.csv", A)
    zone.deliver("none.csv", [])
    assert zone.run() == ["a.csv", "none.csv"]
    assert zone.run() == []
    assert zone.counts() == {"a.csv": 3}


def test_header_only_files_make_no_table(zone, spark):
    zone.deliver("none.csv", [])
    assert zone.run() == ["none.csv"] and zone.run() == []
    assert not spark.catalog.tableExists(zone.target.full_name(FOLDER))
    zone.deliver("a.csv", A)
    assert zone.run() == ["a.csv"]
    assert dict(zone.table().dtypes)["price_currency_mwh"] == "double"


def test_empty_redelivery_leaves_neither_zone(zone, spark):
    zone.deliver(ODD_NAME, A)
    zone.deliver("b.csv", B)
    zone.run()
    zone.deliver(ODD_NAME, [])
    zone.run(force=True, schema=SCHEMA)
    assert zone.counts() == {"b.csv": 2}
    raw = spark.read.parquet(zone.target.raw_path)
    assert {r[0] for r in raw.select("_source_file").distinct().collect()} == {"b.csv"}


def test_names_are_quoted(spark, tmp_path):
    folder = "Prices, 12.1 (x)&y"
    place = tmp_path / "it's"
    (place / "landing" / folder).mkdir(parents=True)
    (place / "landing" / folder / "a.csv").write_text("Zone;Price\nn;1\n", encoding="utf-8")
    target = g.Target(str(place / "raw"), f"odd_{uuid.uuid4().hex}", location=str(place / "bronze"))
    g.ingest_folder(spark, str(place / "landing"), folder, target)
    assert spark.table(target.full_name(folder)).count() == 1
    assert g.table_name(folder) == "prices__12_1__x_y"


def test_header_collision_stops_the_load(zone):
    zone.deliver("a.csv", ["1;2"], header="A B;A_B")
    with pytest.raises(ValueError, match="collide"):
        zone.run()


def test_file_with_other_columns_is_not_read_by_position(zone):
    zone.deliver("a.csv", A)
    zone.deliver("b.csv", ["EUR;FR;2026-05-16 00:00:00;4"], header="Currency;AreaDisplayName;DateTime(UTC);Price[Currency/MWh]")
    with pytest.raises(Exception, match="(?i)header"):
        zone.run(schema=SCHEMA)


def test_value_outside_the_schema_fails_unless_allowed(zone, spark, rows):
    zone.deliver("a.csv", ["DE;2026-05-15 00:00:00;ten;EUR"])
    path, schema = f"{zone.landing}/{FOLDER}", SCHEMA
    with pytest.raises(Exception, match="(?i)malformed"):
        s.read_market_csv(spark, path, schema=schema).collect()
    kept = s.read_market_csv(spark, path, schema=schema, mode="PERMISSIVE").select("Price[Currency/MWh]")
    assert rows(kept) == [(None,)]


def test_files_with_other_columns_can_be_unioned_by_name(zone, spark, rows):
    zone.deliver("a.csv", A[:1])
    zone.deliver("b.csv", ["EUR;FR;7"], header="Currency;AreaDisplayName;Extra")
    found = s.discover_files(spark, f"{zone.landing}/{FOLDER}")
    got = s.read_by_header(spark, found, tag_source=True).select("AreaDisplayName", "Currency", "Extra", "_source_file")
    assert rows(got) == [("DE", "EUR", None, "a.csv"), ("FR", "EUR", 7, "b.csv")]


def test_later_delivery_may_add_a_column(zone):
    zone.deliver("a.csv", A)
    zone.run()
    zone.deliver("b.csv", [line + ";x" for line in B], header=HEADER + ";Note")
    zone.run()
    notes = {r[0]: r[1] for r in zone.table().groupBy("_source_file").agg(F.count("note")).collect()}
    assert notes == {"a.csv": 0, "b.csv": 2}


def test_audit(zone):
    zone.deliver("a.csv", A)
    zone.run()
    row = g.audit(zone.table()).first()
    assert (row["_source_file"], row["rows"], row["price_currency_mwh_present"], row["currency_present"]) == ("a.csv", 3, 2, 3)


def test_local_files_win(zone, spark):
    zone.deliver("a.csv", A)
    here = s.discover_files(spark, f"{zone.landing}/{FOLDER}")
    remote = spark.createDataFrame([("r.csv", "x/r.csv")], here.schema)
    assert [r.file_name for r in s.prefer_local(here, remote).collect()] == ["a.csv"]
    assert [r.file_name for r in s.prefer_local(here.limit(0), remote).collect()] == ["r.csv"]


def test_only_the_latest_file_of_each_folder_is_read(spark, tmp_path, rows):
    for name, value in {"f/2026_04.csv": 4, "f/2026_05.csv": 5, "g/a [1].csv": 1, "g/a.csv": 2}.items():
        file = tmp_path / name
        file.parent.mkdir(exist_ok=True)
        file.write_text(f"v;w\n{value};x\n", encoding="utf-8")
    df = s.read_latest(spark, str(tmp_path), tag_source=True)
    assert rows(df) == [(2, "x", "a.csv"), (5, "x", "2026_05.csv")]
    assert len(df.inputFiles()) == 2


def test_table_name():
    assert g.table_name(FOLDER) == "energyprices_12_1_d_r3"


@pytest.mark.parametrize("fmt", ["csv", "parquet", "orc"])
def test_format_round_trip(spark, tmp_path, fmt, rows):
    df = spark.createDataFrame([("red", 1), ("blue", 2)], "color string, v1 long")
    options = {"header": "true"} if fmt == "csv" else {}
    back = s.write_then_read(df, str(tmp_path / fmt), fmt, **options)
    assert dict(back.dtypes)["v1"] == ("string" if fmt == "csv" else "bigint")
    assert rows(back.withColumn("v1", F.col("v1").cast("long"))) == rows(df)


def test_command_line(zone, tmp_path):
    zone.deliver("a.csv", A)
    command = [sys.executable, "-m", "gridlake", "--folder", FOLDER, "--raw", str(tmp_path / "cli-raw")]
    command += ["--warehouse", str(tmp_path / "cli-bronze")]
    root = Path(__file__).resolve().parents[1]

    def run(*more):
        return subprocess.run([*command, *more], cwd=root, capture_output=True, text=True, timeout=180)

    good = run("--landing", str(zone.landing))
    assert good.returncode == 0, good.stderr[-2000:]
    assert "1 file(s)" in good.stdout
    bad = run("--landing", str(tmp_path / "nowhere"))
    assert bad.returncode == 1
    assert "ingestion failed" in bad.stderr
