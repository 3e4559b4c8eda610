"""Actions and inspection on an operator's result: Spark's own API, nothing wrapped."""

import pytest
from pyspark.sql import functions as F

from gridlake.operators.market import currency_range


@pytest.fixture(scope="module")
def result(spark):
    prices = spark.createDataFrame([("EUR", 1.0), ("EUR", 3.0), ("UAH", None)], "currency string, price double")
    return currency_range(prices, "currency", "price").orderBy("currency")


def test_show(result, capsys):
    result.show()
    result.show(1, vertical=True)
    out = capsys.readouterr().out
    assert "|     EUR|" in out and "-RECORD 0" in out
    result.printSchema()
    assert "records_count: long" in capsys.readouterr().out


def test_rows_to_the_driver(result):
    assert result.columns == ["currency", "records_count", "min_raw_price", "max_raw_price"]
    assert result.take(1) == result.collect()[:1]
    assert result.tail(1) == result.collect()[-1:]
    assert result.limit(1).toPandas().currency.tolist() == ["EUR"]


def test_eager_display(spark, result):
    spark.conf.set("spark.sql.repl.eagerEval.enabled", True)
    try:
        assert "|     UAH|" in repr(result)
    finally:
        spark.conf.unset("spark.sql.repl.eagerEval.enabled")


def test_columns_are_lazy(result):
    assert type(result.currency) is type(F.upper(result.currency)) is type(result.currency.isNull())
    assert result.withColumn("u", F.upper(result["currency"])).filter(result.currency == "EUR").first().u == "EUR"
