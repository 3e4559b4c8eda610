import json

import pytest
from pyspark.sql import functions as F

from gridlake.operators import catalog as c
from gridlake.plans.catalogue import build_catalogue
from gridlake.sources.files import flatten_listing, parse_listing

# Names and the domains they must get.
GOLDEN = [
    ("ActualTotalLoad_6.1.A_r3", "Load"),
    ("YearAheadForecastMargin_8.1_r3", "Load"),
    ("ActualGenerationOutputPerGenerationUnit_16.1.A_r3", "Generation"),
    ("ProductionAndGenerationUnits_r3", "Generation"),
    ("InstalledGenerationCapacityPerProductionUnit_14.1.B_r3", "Generation"),
    ("UnavailabilityOfOffshoreGrid_10.1.C_r3", "Outages"),
    ("CrossBorderCapacityForDcLinksIntradayTransferLimits_11.3_r3", "Transmission"),
    ("PhysicalFlows_12.1.G_r3", "Transmission"),
    ("AggregatedBalancingEnergyBids_12.3.E_r3", "Balancing"),
    ("ImbalancePrices_17.1.G_r3", "Balancing"),
    ("EnergyPrices_12.1.D_r3", "Market"),
    ("AuctionRevenue_12.1.A_r3", "Market"),
    ("Algorithm_12.3.K_r3", "Operations"),
    ("ApprovedMethodologies_12.3.J_r3", "Operations"),
    ("RedispatchingCrossBorder_13.1.A_r3.1", "Operations"),
    ("Export_log_r3.csv", "OtherMarketInformation"),
    ("UnexpectedFolder_r3", "OtherMarketInformation"),
    ("CrossBorderMarginalPriceForAfrrCs_IF_aFRR3.16_r3", "Operations"),
    ("ElasticDemands_IFs_mFRR3.4_aFRR3.4_r3", "Balancing"),
    ("SomeCapacity_r1", "Transmission"),
    ("CapacityOfProduction_r1", "Generation"),
    ("OUTAGE", "Outages"),
    ("", "OtherMarketInformation"),
]


def test_classifier(spark):
    df = spark.createDataFrame(GOLDEN, "name string, expected string")
    wrong = df.filter(c.classify(F.col("name")) != F.col("expected")).collect()
    assert wrong == []


def test_classifier_takes_other_rules(spark):
    rules = (c.Rule("Metal", ("ring", "bolt"), "Hot", ("hot",)),)
    df = spark.createDataFrame([("hot ring",), ("Bolt",), ("rod",)], "n string")
    assert [r[0] for r in df.select(c.classify(F.col("n"), rules, "Rest")).collect()] == ["Hot", "Metal", "Rest"]


ACTIVE = ["ZoneLoad_r9", "DayAheadPrice_r9", "GridOutage_r9"]
LEGACY = ["OldFlows_r1", "ArchivedBids_r2"]


@pytest.fixture(scope="module")
def listing(spark):
    rows = [(env, "TP_export", n) for env in ("IOP", "PROD") for n in ACTIVE]
    rows += [("IOP", "TP_Legacy_Publications", n) for n in LEGACY]
    rows += [("PROD", "TP_export", "AreaLoad_r9")]
    return spark.createDataFrame(rows, "env string, root string, name string").cache()


def test_item_counts(listing, rows):
    assert rows(c.item_counts(listing, ["env", "root"])) == [
        ("IOP", "TP_Legacy_Publications", 2), ("IOP", "TP_export", 3), ("PROD", "TP_export", 4),
    ]


def test_groups_hold_every_domain(listing):
    got = c.group_domains(listing.filter("env = 'PROD'"), ["env"], "name").orderBy("position", "name").collect()
    assert list(dict.fromkeys(r.domain for r in got)) == list(c.DOMAINS)
    names = {d: [r.name for r in got if r.domain == d] for d in c.DOMAINS}
    assert names["Load"] == ["AreaLoad_r9", "ZoneLoad_r9"]
    assert names["Generation"] == [None]


def test_groups_of_any_size(spark):
    many = spark.range(300_000).select(F.lit("IOP").alias("env"), F.lit("TP_export").alias("root"), F.concat(F.lit("Load"), "id").alias("name"))
    assert c.group_domains(many, ["env"], "name").count() == 300_000 + 7
    lines = build_catalogue(many)
    assert lines.where("line like '%Load%'").count() == 300_000 + 1
    assert "collect_list" not in lines._jdf.queryExecution().executedPlan().toString()


def test_unknown_environments_and_roots_are_shown(spark, tmp_path):
    rows = [("UAT", "TP_export", "GridLoad_r9"), ("PROD", "TP_other", 'Odd "name"'), ("PROD", None, "Lost"), ("PROD", "TP_other", "Twice"), ("PROD", "TP_other", "Twice")]
    listing = spark.createDataFrame([*rows, (None, "TP_export", "x")], "env string, root string, name string")
    build_catalogue(listing, str(tmp_path / "doc"))
    text = "".join(r.value for r in spark.read.text(sorted(map(str, (tmp_path / "doc").glob("part-*")))).collect())
    got = json.loads(text)["environments"]
    assert list(got) == ["Prod", "UAT"]
    assert got["UAT"]["root_directories"][0]["domains"]["Load"] == ["GridLoad_r9"]
    roots = {r["name"]: r for r in got["Prod"]["root_directories"]}
    assert roots["TP_other"]["folders"] == ['Odd "name"', "Twice", "Twice"] and roots["TP_other"]["item_count"] == 3
    assert roots[""]["folders"] == ["Lost"]


def test_listing_rows_come_in_catalogue_order(listing):
    got = [r.domain for r in c.domain_listing(listing.filter("env = 'PROD'"), ["env", "root"], "name").collect()]
    assert got == ["Load", "Load", "Market", "Outages"]


def test_catalogue_documents(listing, spark, tmp_path):
    build_catalogue(listing, str(tmp_path / "catalogue"))
    text = "".join(r.value for r in spark.read.text(sorted(map(str, (tmp_path / "catalogue").glob("part-*")))).collect())
    got = json.loads(text)["environments"]
    assert list(got) == ["IOP", "Prod"]
    active, legacy = got["IOP"]["root_directories"]
    assert got["IOP"]["description"] == "Integration/Test Platform"
    assert (active["name"], active["item_count"]) == ("TP_export", 3)
    assert list(active["domains"]) == list(c.DOMAINS)
    assert active["domains"]["Outages"] == ["GridOutage_r9"]
    assert active["domains"]["Balancing"] == []
    assert "folders" not in active and "domains" not in legacy
    assert (legacy["item_count"], legacy["folders"]) == (2, sorted(LEGACY))
    assert got["Prod"]["description"] == "Production Platform"
    assert got["Prod"]["root_directories"][1]["folders"] == []


def test_listing_pages(spark):
    pages = [
        '{"page":1,"contentItemList":[{"name":"Outages_r3"}]}',
        '{"page":0,"contentItemList":[{"name":"ActualTotalLoad_r3"},{"name":"EnergyPrices_r3"}]}',
        '{"page":2,"contentItemList":[]}',
        '{"page":3}',
    ]
    df = spark.createDataFrame([(p,) for p in pages], "doc string")
    got = [r.name for r in flatten_listing(parse_listing(df, "doc")).collect()]
    assert got == ["ActualTotalLoad_r3", "EnergyPrices_r3", "Outages_r3"]
