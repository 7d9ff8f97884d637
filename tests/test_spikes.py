import random

from tidemark.operators.spikes import implausible

SCHEMA = "slice_id long, symbol string, venue string, window_start_ms long, mid_price double, spread_bps double, trade_count long, trade_volume double, level string"
STEP = 900_000


def series(change=lambda k, row: row, n=96, venue="v", first=0):
    rnd = random.Random(venue)
    rows = []
    for k in range(n):
        row = [first + k, "S", venue, k * STEP, 100 + rnd.gauss(0, 1), 10 + rnd.gauss(0, 1), 5, 50 + rnd.gauss(0, 3), "x"]
        rows.append(tuple(change(k, row)))
    return rows


def found(spark, rows):
    return sorted(map(tuple, implausible(spark.createDataFrame(rows, SCHEMA)).collect()))


def at(i, value, where):
    def change(k, row):
        if k in where:
            row[i] = value(k) if callable(value) else value
        return row

    return change


def test_plain_series_has_none_and_short_spikes_are_found(spark):
    assert found(spark, series()) == []
    assert found(spark, series(at(4, 160.0, {40})) * 2) == [(40, "mid_price")]
    assert found(spark, series(at(4, 160.0, {40, 41, 42}))) == [(k, "mid_price") for k in (40, 41, 42)]


def test_lasting_changes_and_longer_runs_are_no_spikes(spark):
    rnd = random.Random(5)
    assert found(spark, series(at(4, lambda k: 300 + rnd.gauss(0, 1), set(range(50, 96))))) == []
    assert found(spark, series(at(4, lambda k: 160.0 + k / 100, {40, 41, 42, 43}))) == []


def test_impossible_readings(spark):
    assert found(spark, series(at(4, float("nan"), {3}))) == [(3, "mid_price")]
    assert found(spark, series(at(5, 10000.0, {3}))) == [(3, "spread_bps")]
    assert found(spark, series(at(6, 0, {3}))) == [(3, "trade_volume")]
    assert found(spark, series(at(7, float("inf"), {3}))) == [(3, "trade_volume")]


def test_stuck_needs_twelve_in_a_row_with_trades(spark):
    assert found(spark, series(at(4, 100.0, set(range(20, 31))))) == []
    assert found(spark, series(at(4, 100.0, set(range(20, 32))))) == [(k, "mid_price") for k in range(20, 32)]

    def quiet(k, row):
        if 20 <= k < 40:
            row[4], row[6], row[7] = 100.0, 0, 0.0
        return row

    assert found(spark, series(quiet)) == []


def test_nulls_two_sources_and_empty(spark):
    rows = series(at(4, None, set(range(10, 60)))) + series(at(4, 160.0, {40}), venue="w", first=1000)
    assert found(spark, rows) == [(1040, "mid_price")]
    assert found(spark, []) == []
