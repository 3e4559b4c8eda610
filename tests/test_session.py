import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridlake import session as s


def test_defaults_apply(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_iceberg_options():
    conf = s.iceberg_conf("lakehouse", "http://catalog:8181", "s3://bucket/", {"endpoint": "http://store", "region": "eu"})
    assert conf["spark.sql.catalog.lakehouse"].endswith("SparkCatalog")
    assert conf["spark.sql.catalog.lakehouse.type"] == "rest"
    assert conf["spark.sql.catalog.lakehouse.uri"] == "http://catalog:8181"
    assert conf["spark.sql.catalog.lakehouse.s3.endpoint"] == "http://store"
    assert "io-impl" not in " ".join(s.iceberg_conf("c", "u", "w"))


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = s.shared_folder(spark)
    assert folder
    if named:
        assert folder == named.rstrip("/")
    assert s.scratch_path(spark, "x") != s.scratch_path(spark, "x")


def test_checkpoint_cuts_the_plan(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    kept = s.cut_lineage(df)
    assert kept.collect() == df.collect()
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()


def test_broadcast_hint_depends_on_the_bytes(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    few = spark.range(10)
    assert hinted(s.small_side(few, max_bytes=10 * (s.ROW_OVERHEAD + 16)))
    assert not hinted(s.small_side(few, max_bytes=10 * (s.ROW_OVERHEAD + 16) - 1))
    wide = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("text"))
    assert not hinted(s.small_side(wide, max_bytes=3000)) and hinted(s.small_side(wide, max_bytes=3200))
    assert hinted(s.small_side(few.limit(0), max_bytes=0))


def test_a_cluster_without_a_shared_folder_is_refused():
    class Named:
        def __init__(self, **kw):
            self.__dict__ |= kw

    class Path(str):
        def __new__(cls, a, b=""):
            return str.__new__(cls, f"{a}/{b}" if b else a)

        def getFileSystem(self, _):
            return Named(makeQualified=lambda p: p)

        def toString(self):
            return str(self)

    def session(master, warehouse):
        hadoop = Named(fs=Named(Path=Path))
        jvm = Named(org=Named(apache=Named(hadoop=hadoop)))
        context = Named(getCheckpointDir=lambda: None, _jvm=jvm, _jsc=Named(hadoopConfiguration=lambda: None), master=master)
        conf = {"spark.sql.warehouse.dir": warehouse}
        return Named(conf=Named(get=lambda k, *d: conf.get(k, *d)), sparkContext=context)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        s.shared_folder(session("spark://host:7077", "file:/opt/warehouse"))
    assert s.shared_folder(session("local[2]", "file:/opt/warehouse")) == "file:/opt/warehouse/_scratch"
    assert s.shared_folder(session("yarn", "hdfs://nn/warehouse")) == "hdfs://nn/warehouse/_scratch"


def test_workers_find_the_package_from_any_folder(tmp_path):
    """A job started elsewhere, with the package on the driver's own path only."""
    root = Path(__file__).resolve().parents[1]
    job = tmp_path / "job.py"
    job.write_text(
        f"import sys\nsys.path.insert(0, {str(root)!r})\n"
        "from gridlake.session import build_session\n"
        "from gridlake.operators.quality import key_paths\n"
        "spark = build_session('elsewhere', spark__master='local[2]', spark__ui__enabled='false')\n"
        "df = spark.createDataFrame([('{\"a\":{\"b\":1}}',)], 'doc string')\n"
        "print(sorted(r.path for r in key_paths(df, 'doc').collect()))\n",
        encoding="utf-8",
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(job)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "['a', 'a.b']" in done.stdout
