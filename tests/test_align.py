import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.functions import times as t
from stationflow.operators import align, blocks, setops, windows
from tests.conftest import column, hourly

N = None
SITE = ["site"]


def pd_series(values):
    return pd.Series([np.nan if v is None else v for v in values], index=pd.date_range("2024-01-01", periods=len(values), freq="h"), dtype=float)


def same(got, want):
    got = [np.nan if v is None else v for v in got]
    np.testing.assert_allclose(got, list(want), rtol=1e-12)


GAPS = [N, N, 1, N, N, N, N, N, N, N, N, 10, N, N, N]


def test_rows_interpolation_matches_pandas(spark):
    got = column(align.interpolate_rows(hourly(spark, GAPS), SITE, "ts", "value", 6))
    same(got, pd_series(GAPS).interpolate(method="linear", limit=6))
    assert got[:2] == [N, N] and got[9:11] == [N, N] and got[12:] == [10, 10, 10]


def test_limited_time_interpolation_from_both_ends(spark):
    got = column(align.interpolate_time_limited(hourly(spark, [1, N, N, N, N, N, N, 8]), SITE, "ts", "value", 2))
    assert got == [1, 2, 3, N, N, 6, 7, 8]


def test_limited_time_interpolation_matches_pandas(spark):
    values = [N] * 15 + [3] + [N] * 30 + [9, N, 4] + [N] * 20
    got = column(align.interpolate_time_limited(hourly(spark, values), SITE, "ts", "value", 12))
    same(got, pd_series(values).interpolate(method="time", limit=12, limit_direction="both"))


def test_interior_interpolation_leaves_edges(spark):
    assert column(align.interpolate_time(hourly(spark, [N, 2, N, 4, N]), SITE, "ts", ["value"])) == [N, 2, 3, 4, N]


def test_neighbours_cross_many_blocks(spark):
    values = [5.0] + [N] * 400 + [9.0] + [N] * 30
    out = blocks.with_neighbours(hourly(spark, values), SITE, "ts", ["value"], seconds=36000)
    rows = out.orderBy("ts").collect()
    assert [r["_rn"] for r in rows] == list(range(1, len(values) + 1))
    assert rows[200]["_prev_value"]["v"] == 5.0 and rows[200]["_next_value"]["v"] == 9.0
    assert rows[200]["_next_value"]["rn"] == 402 and rows[-1]["_next_value"] is None


def test_frames_cross_blocks(spark):
    values = list(range(500))
    df = hourly(spark, values)
    out = blocks.with_trailing_frames(df, SITE, t.hour_index(F.col("ts")), [
        (24, lambda w: {"lag24": F.lag("value", 24).over(w), "roll6": F.avg("value").over(w.rowsBetween(-5, 0))})], block=64)
    rows = out.orderBy("ts").collect()
    assert len(rows) == 500
    s = pd.Series(values, dtype=float)
    same([r["lag24"] for r in rows], s.shift(24))
    same([r["roll6"] for r in rows], s.rolling(6, min_periods=1).mean())
    with pytest.raises(ValueError):
        blocks.with_trailing_frames(df, SITE, "x", [(64, None)], block=64)


def test_row_index_over_blocks_and_sites(spark):
    df = hourly(spark, range(50), "a", step=7).unionByName(hourly(spark, range(3), "b"))
    out = blocks.row_index(df, SITE, ["ts"], seconds=50_000).orderBy("site", "ts").collect()
    assert [r["row_index"] for r in out] == [*range(1, 51), 1, 2, 3]


@pytest.mark.parametrize("days", [1, 2, 5, 10])
def test_resample_matches_pandas(spark, days):
    rng = np.random.default_rng(3)
    times = pd.Timestamp("2024-01-03 07:00") + pd.to_timedelta(np.sort(rng.integers(0, 60 * 24, 80)) * 60, unit="min")
    times = times.append(times + pd.Timedelta(days=33))
    values = rng.random(len(times))
    df = spark.createDataFrame([("a", a.to_pydatetime(), float(b)) for a, b in zip(times, values)], "site STRING, ts TIMESTAMP_NTZ, value DOUBLE")
    got = align.resample_mean(df, SITE, "ts", ["value"], days * 86400).orderBy("ts").collect()
    want = pd.Series(values, index=times).resample(f"{days}D").mean()
    assert [r["ts"] for r in got] == [x.to_pydatetime() for x in want.index]
    same([r["value"] for r in got], want)


def test_round_to_three_hours_goes_to_even_slot(spark):
    df = spark.sql("SELECT 'a' AS site, x AS ts, 1D AS value FROM VALUES (TIMESTAMP_NTZ'2024-01-01 01:30:00'), (TIMESTAMP_NTZ'2024-01-01 04:30:00') t(x)")
    got = [r["ts"].hour for r in align.round_and_dedup(df, SITE, "ts").orderBy("ts").collect()]
    assert got == [0, 6]


def test_forward_fill_limit(spark):
    assert column(align.forward_fill(hourly(spark, [1, N, N, N, 2]), SITE, "ts", ["value"], 2)) == [1, 1, 1, N, 2]


def test_fill_all(spark):
    df = hourly(spark, [N, 1, N, 3, N]).unionByName(hourly(spark, [N, N], "b"))
    med = spark.createDataFrame([("a", 2.0), ("b", 7.0)], "site STRING, value_median DOUBLE")
    out = align.fill_all(df, SITE, "ts", ["value"], med)
    assert column(out.where("site = 'a'")) == [1, 1, 1, 3, 3] and column(out.where("site = 'b'")) == [7, 7]


def test_gapless_mean_and_pad(spark):
    df = hourly(spark, [1, 2, 3], step=3)
    assert column(align.hourly_mean_gapless(df, SITE, "ts", ["value"], pad_hours=2)) == [1, N, N, 2, N, N, 3, N, N]


def test_precedence_and_dedup(spark):
    old, new = hourly(spark, [1, 2]), hourly(spark, [10, 20, 30])
    assert column(setops.precedence_union([old, new], ["site", "ts"])) == [1, 2, 30]
    at = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    assert column(setops.hand_over(old, new, ["site", "ts"], "ts", at)) == [1, 2, 30]
    twice = hourly(spark, [5]).unionByName(hourly(spark, [4]))
    assert column(setops.keep_first(twice, ["site", "ts"], ["value"])) == [4]


def nowcast_reference(values):
    out = []
    for i in range(len(values)):
        win = np.array(values[max(0, i - 11):i + 1], dtype=float)
        if np.isnan(win).any():
            out.append(np.nan)
        elif win.max() == 0:
            out.append(0.0)
        else:
            w = max(0.5, 1 - (win.max() - win.min()) / win.max()) ** np.arange(len(win) - 1, -1, -1)
            out.append((w * win).sum() / w.sum())
    return out


@pytest.mark.parametrize("values", [[0] * 14, [0, 0, 5, 80, 3, 1, 2, 2, 2, 60, 1, 4, 9, 12, 30, 1], [1, N, 3] + [2] * 14])
def test_nowcast(spark, values):
    stages = windows.nowcast_stages("value", name="nowcast")
    out = blocks.with_trailing_frames(hourly(spark, values), SITE, t.hour_index(F.col("ts")), stages, block=13)
    same(column(out, "nowcast"), nowcast_reference([np.nan if v is None else v for v in values]))


def test_month_and_day_chunks(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS lo, TIMESTAMP_NTZ'2025-02-10 00:00:00' AS hi")
    got = [(str(r.chunk_start)[:10], str(r.chunk_end)[:10]) for r in align.month_chunks(df, "lo", "hi").orderBy("chunk").collect()]
    assert got == [("2024-01-01", "2024-06-30"), ("2024-07-01", "2024-12-31"), ("2025-01-01", "2025-02-10")]
    days = align.day_chunks(df, "lo", "hi", 90).orderBy("chunk_start").collect()
    assert str(days[1].chunk_start)[:10] == "2024-04-01" and str(days[-1].chunk_end)[:10] == "2025-02-10"


def test_local_time_over_clock_change(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-31 00:30:00' AS ts, 'Europe/Berlin' AS tz UNION ALL SELECT TIMESTAMP_NTZ'2024-03-31 01:30:00', 'Europe/Berlin'")
    got = [r["local_time"].hour for r in align.add_local_time(df, "ts", "tz").orderBy("ts").collect()]
    assert got == [1, 3]
