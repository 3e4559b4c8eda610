import uuid

from gridlake.plans.ingest import Target
from gridlake.streaming.landing import stream_folder

SCHEMA = "`Area Code` string, `Price[Currency/MWh]` double"


def test_stream_lands_only_new_files(spark, tmp_path):
    folder = tmp_path / "landing" / "Prices_r3"
    folder.mkdir(parents=True)
    target = Target(str(tmp_path / "raw"), f"bronze_{uuid.uuid4().hex}", location=str(tmp_path / "bronze"))

    def deliver(name, n):
        (folder / name).write_text("Area Code;Price[Currency/MWh]\n" + "DE;1.5\n" * n, encoding="utf-8")

    def run():
        query = stream_folder(
            spark, str(tmp_path / "landing"), "Prices_r3", target, SCHEMA, str(tmp_path / "checkpoint")
        )
        assert query.awaitTermination(120)
        table = spark.table(target.full_name("Prices_r3"))
        return {r[0]: r[1] for r in table.groupBy("_source_file").count().collect()}

    deliver("a 1.csv", 3)
    assert run() == {"a 1.csv": 3}
    assert run() == {"a 1.csv": 3}
    deliver("b.csv", 2)
    assert run() == {"a 1.csv": 3, "b.csv": 2}
    assert spark.table(target.full_name("Prices_r3")).columns == ["area_code", "price_currency_mwh", "_source_file"]
