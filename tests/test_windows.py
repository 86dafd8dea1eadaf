"""Window operators: rows vs days, labels, dedupe, year safety."""

import datetime as dt

from cellcast.operators import windows as W

D = dt.date


def test_rows_vs_calendar_on_a_gap(spark):
    # days 1, 2, 5 (gap): 3-row past window vs 3-day past window at day 5
    df = spark.createDataFrame([("c", D(2024, 1, 1), 1.0), ("c", D(2024, 1, 2), 2.0), ("c", D(2024, 1, 5), 4.0)],
                               "grid_id string, date date, v double")
    spec = [(3, "v", "sum", 1, "s3")]
    rows = {r["date"]: r["s3"] for r in W.rolling_rows(df, spec).collect()}
    days = {r["date"]: r["s3"] for r in W.rolling_calendar(df, spec).collect()}
    assert rows[D(2024, 1, 5)] == 3.0  # previous two rows
    assert days[D(2024, 1, 5)] == 2.0  # calendar window [Jan 2, Jan 5) holds only Jan 2


def test_calendar_window_bounds(spark):
    df = spark.createDataFrame([("c", D(2024, 1, 1), 1.0), ("c", D(2024, 1, 2), 2.0), ("c", D(2024, 1, 4), 4.0)],
                               "grid_id string, date date, v double")
    out = {r["date"]: r["s"] for r in W.rolling_calendar(df, [(2, "v", "sum", 1, "s")]).collect()}
    assert out == {D(2024, 1, 1): None, D(2024, 1, 2): 1.0, D(2024, 1, 4): 2.0}


def test_min_count_counts_non_null_values(spark):
    df = spark.createDataFrame([("c", D(2024, 1, i), None if i == 2 else float(i)) for i in range(1, 6)],
                               "grid_id string, date date, v double")
    out = {r["date"].day: r["s"] for r in W.rolling_rows(df, [(3, "v", "sum", 3, "s")]).collect()}
    assert out[4] is None  # rows 1..3 hold only two values
    assert out[5] is None
    out2 = {r["date"].day: r["s"] for r in W.rolling_rows(df, [(3, "v", "sum", 2, "s")]).collect()}
    assert out2[4] == 4.0 and out2[5] == 7.0


def test_next_row_vs_next_day_label(spark):
    df = spark.createDataFrame([("c", D(2024, 1, 1), 0), ("c", D(2024, 1, 2), 1), ("c", D(2024, 1, 5), 1)],
                               "grid_id string, date date, fire_today int")
    w4 = {r["date"].day: r["fire_next_day"] for r in W.next_row_label(df).collect()}
    w5 = {r["date"].day: r["fire_next_day"] for r in W.next_day_label(df).collect()}
    assert w4 == {1: 1, 2: 1}
    assert w5 == {1: 1}


def test_year_safe_windows_do_not_cross_years(spark):
    df = spark.createDataFrame([("c", D(2023, 12, 31), 5.0, 5.0, 5.0, 1), ("c", D(2024, 1, 1), 1.0, 1.0, 1.0, 0),
                                ("c", D(2024, 1, 2), 1.0, 1.0, 1.0, 0)],
                               "grid_id string, date date, precipitation_total double, temperature_max double, humidity_min double, fire_today int")
    out = {r["date"]: r for r in W.year_safe_features(df).collect()}
    assert D(2023, 12, 31) not in out  # its next row is in another year
    assert out[D(2024, 1, 1)]["temperature_max_previous_3d"] is None


def test_dedupe_keep_last_and_first(spark):
    df = spark.createDataFrame([("c", 1, 1, "a"), ("c", 1, 2, "b"), ("d", 1, 1, "x")], "grid_id string, date int, src int, v string")
    last = {r["grid_id"]: r["v"] for r in W.dedupe_keep(df, ["grid_id", "date"], ["src"], "last").collect()}
    first = {r["grid_id"]: r["v"] for r in W.dedupe_keep(df, ["grid_id", "date"], ["src"], "first").collect()}
    assert last == {"c": "b", "d": "x"} and first == {"c": "a", "d": "x"}


def test_sequential_ids(spark):
    cells = spark.createDataFrame([(1, 0), (0, 1), (0, 0), (1, 1)], "ix long, iy long")
    out = {(r["ix"], r["iy"]): r["grid_id"] for r in W.sequential_ids(cells).collect()}
    assert out == {(0, 0): "CA-00001", (0, 1): "CA-00002", (1, 0): "CA-00003", (1, 1): "CA-00004"}


def test_sequential_ids_follow_large_coordinates(spark):
    from cellcast.operators.windows import sequential_ids

    cells = spark.createDataFrame([(0, 1048581), (1, 0), (0, 7), (2, 3)], "ix long, iy long")
    got = {(r.ix, r.iy): r.grid_id for r in sequential_ids(cells).collect()}
    assert got == {(0, 7): "CA-00001", (0, 1048581): "CA-00002", (1, 0): "CA-00003", (2, 3): "CA-00004"}
