from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from costlens.operators import versions as v

AT = "2024-01-0{} 00:00:00"


@pytest.fixture
def tables(spark, tmp_path):
    out = v.VersionTables(spark, str(tmp_path / "registry"))
    for i in range(1, 4):
        out.register("cost", "seasonal", {"mape": 10.0 - i}, f"/models/{i}", AT.format(i))
    return out


def test_numbers_go_up_per_name(spark, tables):
    assert tables.register("cost", "arima", {}, "/models/4", AT.format(4)) == "4"
    assert tables.register("other", "arima", {}, "/models/5", AT.format(5), tags={"a": "b"}) == "1"


def test_latest_is_numeric(spark, tables):
    for i in range(4, 12):
        tables.register("cost", "seasonal", {}, f"/models/{i}", AT.format(5))
    for version in ("9", "10", "2"):
        tables.promote("cost", version, v.PRODUCTION, AT.format(6))
    assert tables.latest("cost") == "10" and tables.path_of("cost") == "/models/10"
    assert tables.latest("cost", v.STAGING) is None
    with pytest.raises(ValueError):
        tables.path_of("cost", v.STAGING)


def test_stage_is_the_last_event(tables):
    tables.promote("cost", "1", v.STAGING, AT.format(4))
    tables.promote("cost", "1", v.PRODUCTION, AT.format(5))
    stages = {r["version"]: r["stage"] for r in tables.view().collect()}
    assert stages == {"1": "Production", "2": "None", "3": "None"}
    with pytest.raises(ValueError):
        tables.promote("cost", "99", v.STAGING, AT.format(5))


def test_rollback(tables):
    tables.promote("cost", "1", v.PRODUCTION, AT.format(4))
    tables.promote("cost", "3", v.PRODUCTION, AT.format(5))
    tables.rollback("cost", "2", AT.format(6))
    stages = {r["version"]: r["stage"] for r in tables.view().collect()}
    assert stages == {"1": "Archived", "2": "Production", "3": "Archived"}
    assert tables.latest("cost") == "2"
    with pytest.raises(ValueError):
        tables.rollback("cost", "42", AT.format(7))


def test_rollback_to_the_current_version_keeps_it(tables):
    tables.promote("cost", "3", v.PRODUCTION, AT.format(5))
    tables.rollback("cost", "3", AT.format(6))
    assert tables.latest("cost") == "3"


def test_compare(tables):
    row = tables.compare("cost", "1", "3").first()
    assert (row["version1"], row["version2"], row["stage1"]) == ("1", "3", "None")
    with pytest.raises(ValueError):
        tables.compare("cost", "1", "7")


def test_retention(spark):
    rows = [("m", str(i), stage) for stage in ("Production", "Staging", "None", "Archived") for i in range(1, 21)]
    view = spark.createDataFrame(rows, "name string, version string, stage string")
    count = lambda df: {r["stage"]: r["count"] for r in df.groupBy("stage").count().collect()}
    assert count(v.retained_versions(view)) == {"Production": 20, "Staging": 5, "None": 10, "Archived": 20}
    assert count(v.retained_versions(view, archived=2))["Archived"] == 2
    kept = v.retained_versions(view).filter("stage = 'Staging'").collect()
    assert sorted(int(r["version"]) for r in kept) == [16, 17, 18, 19, 20]


def test_retention_cuts_groups_before_the_shuffle(spark):
    number = F.col("id")
    stage = F.when(number % 2 == 0, "Staging").otherwise("None")
    view = spark.range(100).select((number % 3).cast("string").alias("name"), number.cast("string").alias("version"), stage.alias("stage"))
    plan = v.retained_versions(view)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_tags_default_to_not_available(spark):
    df = spark.createDataFrame([("Total", "2024-01-01", "7", {"mape": 9.5})], "category string, training_date string, data_version string, metrics map<string,double>")
    tags = v.version_tags(df).first()["tags"]
    assert tags["mape"] == "9.5" and tags["r2"] == "N/A" and tags["category"] == "Total"


def test_rollback_archives_every_other_production_version(spark):
    from costlens.operators import versions as v

    view = spark.createDataFrame([("m", "1", "Archived"), ("m", "2", "Production"), ("m", "3", "Production")], "name string, version string, stage string")
    events = v.rollback_events(view, "m", "1", "2024-01-05 00:00:00")
    assert {(r["version"], r["stage"]) for r in events.collect()} == {("1", "Production"), ("2", "Archived"), ("3", "Archived")}


def test_parallel_writers_get_numbers_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path / "registry")
    many = spark.createDataFrame(
        [(n, "naive", n, {"mape": 1.0}, {"k": "v"}, f"/m/{n}") for n in ("cost", "other")],
        "name string, model_type string, category string, metrics map<string,double>, tags map<string,string>, path string",
    )

    def one(i):
        tables = v.VersionTables(spark, root)
        return tables.register_all(many, AT.format(1)) if i % 3 == 0 else tables.register("cost", "seasonal", {"mape": 1.0}, f"/m/{i}", AT.format(1))

    with ThreadPoolExecutor(6) as pool:
        given = list(pool.map(one, range(9)))
    assert len(set(given)) == 9
    rows = v.VersionTables(spark, root).versions().collect()
    assert sorted(r["version"] for r in rows if r["name"] == "cost") == sorted(given)
    assert len([r for r in rows if r["name"] == "other"]) == 3


def test_names_of_any_kind_are_claimed(spark, tmp_path):
    tables = v.VersionTables(spark, str(tmp_path / "registry"))
    assert [tables.register(n, "naive", {}, "/m", AT.format(1)) for n in ("a/b c*", "a/b c*", "é?")] == ["1", "2", "1"]


def test_promoting_many_archives_the_versions_before(spark, tmp_path):
    tables = v.VersionTables(spark, str(tmp_path / "registry"))
    rows = lambda names: spark.createDataFrame(
        [(n, "naive", n, {"mape": 1.0}, {"k": "v"}, "/m") for n in names],
        "name string, model_type string, category string, metrics map<string,double>, tags map<string,string>, path string",
    )
    first = tables.register_all(rows(["a", "b"]), AT.format(1))
    tables.promote_all(first, v.PRODUCTION, AT.format(2))
    second = tables.register_all(rows(["a", "b", "c"]), AT.format(3))
    tables.promote_all(second, v.PRODUCTION, AT.format(4), rows(["a", "c"]))
    stages = {(r["name"], r["version"]): r["stage"] for r in tables.view().collect()}
    assert stages == {("a", "1"): "Archived", ("b", "1"): "Production", ("a", "2"): "Production", ("b", "2"): "None", ("c", "2"): "Production"}
    assert {(r["name"], r["version"]) for r in tables.models_in().collect()} == {("a", "2"), ("b", "1"), ("c", "2")}
    with pytest.raises(ValueError):
        tables.promote_all("99", v.STAGING, AT.format(5))
