import pytest
from pyspark.sql import functions as F

from gridlake.functions import python_functions as p


@pytest.fixture(scope="module")
def plants(spark):
    rows = [("coast", "wind", 12, 3), ("coast", "gas", 7, 9), ("hills", "wind", 4, 1), ("hills", "hydro", 30, 5), ("plain", "sun", 9, 2)]
    return spark.createDataFrame(rows, "region string, kind string, mw long, units long").cache()


def test_series_function(plants, rows):
    assert rows(plants.select(p.plus_one("mw"))) == [(5,), (8,), (10,), (13,), (31,)]


def test_batch_function_may_drop_rows(plants):
    assert p.map_batches(plants, lambda pdf: pdf[pdf.mw > 9]).collect() == plants.filter("mw > 9").collect()


def test_group_function_and_its_native_twin(plants, rows):
    from pyspark.sql import Window

    schema = "region string, kind string, mw double, units long"
    got = plants.groupBy("region").applyInPandas(p.demean("mw"), schema)
    native = plants.withColumn("mw", F.col("mw") - F.avg("mw").over(Window.partitionBy("region")))
    assert rows(got) == rows(native)


def test_group_mean(plants, rows):
    assert rows(plants.groupBy("region").avg()) == [("coast", 9.5, 6.0), ("hills", 17.0, 3.0), ("plain", 9.0, 2.0)]


def test_sql_function(spark, plants, rows):
    p.register_sql_functions(spark)
    small = plants.withColumn("mw", F.col("mw").cast("int"))
    small.createOrReplaceTempView("plant_table")
    want = [(5,), (8,), (10,), (13,), (31,)]
    assert rows(spark.sql("SELECT add_one(mw) FROM plant_table")) == want
    assert rows(small.selectExpr("add_one(mw)")) == want
    assert spark.sql("SELECT count(*) FROM plant_table").first()[0] == 5
    assert small.select(F.expr("count(*)") > 0).first()[0] is True
