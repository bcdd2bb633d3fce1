"""The jobs end to end, on tables exported from the test data."""

from dataclasses import fields

import pytest

from innmetrics.__main__ import main
from innmetrics.plans.pipeline import current_tables
from innmetrics.session import work_folder
from innmetrics.sources.tables import MarketTables
from innmetrics.sources.testdata import market_tables


@pytest.fixture(scope="module")
def exported(spark):
    root = work_folder(spark, "export")
    tables = market_tables(spark, "/root/testdata/sf0.001")
    for f in fields(MarketTables):
        getattr(tables, f.name).write.parquet(f"{root}/{f.name}")
    return root


def test_refresh_and_publish(spark, exported, capsys):
    out = work_folder(spark, "job")
    schema = f"job_{out.rsplit('-', 1)[-1]}"
    main(
        ["refresh", "--parquet", "--source", exported, "--output", out, "--publish", schema, "--as-of", "2024-01-20"]
    )
    printed = capsys.readouterr().out
    assert "city_funnel" in printed and printed.count("success") == 7
    assert spark.table(f"{schema}.city_funnel").count() == current_tables(spark, out)["city_funnel"].count() > 0
    clicks = current_tables(spark, out)["silver_clickstream"]
    dates = clicks.select("event_date").distinct().count()
    files = len(clicks.inputFiles())
    assert dates == files == 30


def test_generate_then_refresh_on_generated_traffic(spark, exported):
    out = work_folder(spark, "job")
    main(["generate", "--parquet", "--source", exported, "--output", f"{out}/clicks"])
    generated = spark.read.parquet(f"{out}/clicks")
    assert {r.event for r in generated.select("event").distinct().collect()} == {"view"}
    schema = f"gen_{out.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{out}/{schema}'")
    for f in fields(MarketTables):
        path = f"{out}/clicks" if f.name == "clickstream" else f"{exported}/{f.name}"
        spark.catalog.createTable(f"{schema}.{'clicks' if f.name == 'clickstream' else f.name}", path, "parquet")
    main(
        ["refresh", "--source", schema, "--clickstream", f"{schema}.clicks", "--output", f"{out}/tables"]
    )
    funnel = current_tables(spark, f"{out}/tables")["city_funnel"]
    assert funnel.where("viewers > 0 AND clickers = 0").count() > 0


def test_ingest_then_refresh(spark, exported):
    out = work_folder(spark, "job")
    main(["ingest", "--clicks", f"{exported}/clickstream", "--output", f"{out}/silver"])
    main(["refresh", "--parquet", "--source", exported, "--output", f"{out}/a", "--as-of", "2024-01-20"])
    streamed = f"{out}/silver/events"
    main(
        ["refresh", "--parquet", "--source", exported, "--output", f"{out}/b", "--as-of", "2024-01-20",
         "--streamed", streamed]
    )
    a, b = (current_tables(spark, f"{out}/{part}") for part in "ab")
    assert set(a) - set(b) == {"silver_clickstream"}
    assert all(sorted(map(str, a[name].collect())) == sorted(map(str, b[name].collect())) for name in b)


def test_views(market, spark):
    market().create_views("m_")
    assert spark.sql("SELECT count(*) AS n FROM m_city_funnel").first().n == 0
    assert spark.sql("SELECT max_date FROM m_date_boundaries").first().max_date is None
