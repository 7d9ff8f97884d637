import pytest
from pyspark.sql import functions as F

from tidemark.sources.slices import read_slices, wanted, within_hours

BASE = "base_asset string, symbol_canonical string, venue string, slice_completeness string, window_start_ms long, window_end_ms long, trade_count long, trade_volume double"


def row(asset, canonical, *more):
    return (asset, canonical, "v", "complete", 0, 1, 1, 1.0, *more)


def test_optional_columns_and_wrong_types(spark, tmp_path):
    spark.createDataFrame([row("a", "aUSDT")], BASE).write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([row("b", "bUSDT", 2.5)], BASE + ", mid_price double").write.parquet(str(tmp_path / "y"))
    spark.createDataFrame([("a", 1)], "base_asset string, venue int").write.parquet(str(tmp_path / "z"))
    got = {(r.base_asset, r.mid_price, r.spread_bps) for r in read_slices(spark, str(tmp_path / "x"), str(tmp_path / "y")).collect()}
    assert got == {("a", None, None), ("b", 2.5, None)}
    with pytest.raises(ValueError, match="venue"):
        read_slices(spark, str(tmp_path / "z"))


def test_wanted_by_either_name(spark):
    df = spark.createDataFrame([row("btc", "BTCUSDT"), row("eth", "ETHUSDT"), row("x", None), row(None, "solusdt")], BASE)
    names = spark.createDataFrame([("BTC",), ("btcusdt",), ("SOLUSDT",), (None,)], "symbol string")
    assert sorted(r.symbol_canonical for r in wanted(df, names).collect()) == ["BTCUSDT", "solusdt"]


def test_hours_prune_partitions(spark, tmp_path):
    rows = [(d * 24 + h, f"2024-01-0{d + 1}", f"{h:02}") for d in range(3) for h in range(24)]
    spark.createDataFrame(rows, "n long, dt string, hour string").write.partitionBy("dt", "hour").parquet(str(tmp_path / "p"))
    start = 1_704_067_200_000
    df = spark.read.parquet(str(tmp_path / "p")).where(within_hours("dt", "hour", start + 22 * 3_600_000, start + 49 * 3_600_000 + 5))
    assert sorted(r.n for r in df.collect()) == list(range(22, 50))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in plan and "PartitionFilters: [" in plan
