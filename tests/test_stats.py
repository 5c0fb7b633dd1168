"""Statistics against brute-force numpy versions on small fixtures."""

from __future__ import annotations

import numpy as np

from branchbook.operators import stats as st


def _decompose_np(x: np.ndarray, period: int = 12):
    """Additive decomposition by the textbook recipe (2x12 MA, linear end extrapolation)."""
    n = len(x)
    h = period // 2
    filt = np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(n, np.nan)
    for i in range(h, n - h):
        trend[i] = np.dot(filt, x[i - h:i + h + 1])
    front, back = h, n - 1 - h
    fl = min(front + period, back)
    k, c = np.polyfit(np.arange(front, fl), trend[front:fl], 1)
    trend[:front] = k * np.arange(0, front) + c
    bf = max(front, back - period)
    k, c = np.polyfit(np.arange(bf, back), trend[bf:back], 1)
    trend[back + 1:] = k * np.arange(back + 1, n) + c
    detr = x - trend
    avg = np.array([detr[i::period].mean() for i in range(period)])
    avg -= avg.mean()
    seasonal = np.tile(avg, n // period + 1)[:n]
    resid = detr - seasonal
    return avg.max() - avg.min(), resid.std(ddof=1)


def test_seasonal_decompose_matches_numpy(spark):
    rng = np.random.default_rng(11)
    rows = []
    expect = {}
    for b, n in (("A", 30), ("B", 41), ("C", 20)):
        t = np.arange(n)
        x = 1000 + 5 * t + 80 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 10, n)
        for i, v in enumerate(x):
            rows.append((b, i, float(v), i, n))
        if n >= 24:
            expect[b] = _decompose_np(x)
    df = spark.createDataFrame(rows, "filial_name string, period_idx int, x double, pos int, n bigint")
    got = {r.filial_name: (r.seasonal_amplitude, r.residual_std) for r in st.seasonal_decompose(df).collect()}
    assert set(got) == set(expect)
    for b, (amp, rs) in expect.items():
        assert abs(got[b][0] - round(amp, 2)) < 0.011 and abs(got[b][1] - round(rs, 2)) < 0.011


def test_trend_summary_statuses(spark):
    rows = [("A", i, float(10 + i), i, 3) for i in range(3)] + [("B", i, 5.0, i, 2) for i in range(2)]
    df = spark.createDataFrame(rows, "filial_name string, period_idx int, x double, pos int, n bigint")
    got = {r.filial_name: r for r in st.trend_summary(df).collect()}
    assert got["A"].status == "rolling_trend_only" and got["B"].status == "skipped"
    # n = 3 -> window 2: start = first value, end = mean of the last two
    assert got["A"].trend_start == 10.0 and got["A"].trend_end == 11.5


def test_spearman_leaves_nulls_out_pair_by_pair(spark):
    import pandas as pd

    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"a": rng.integers(0, 20, 300).astype(float), "b": rng.normal(size=300), "c": rng.integers(0, 5, 300).astype(float)})
    frame.loc[::7, "b"] = None
    frame.loc[3::11, "c"] = None
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in frame.itertuples(index=False)], "a double, b double, c double")
    for x, y, r in st.spearman_pairs(df, ["a", "b", "c"]):
        both = frame[[x, y]].dropna().rank()
        assert abs(r - both[x].corr(both[y])) < 1e-9


def test_ranks_of_all_columns_come_from_one_range_exchange(spark, monkeypatch):
    import pandas as pd

    from branchbook.operators import windows

    rng = np.random.default_rng(9)
    frame = pd.DataFrame({c: rng.integers(-4, 30, 500).astype(float) for c in "abcd"})
    calls = []
    scan = windows.scanned_slices
    monkeypatch.setattr(windows, "scanned_slices", lambda *a, **k: calls.append(1) or scan(*a, **k))
    df = spark.createDataFrame(frame)
    got = st.spearman_pairs(df, list("abcd"))
    assert len(calls) == 1 and len(got) == 6
    for x, y, r in got:
        assert abs(r - frame[x].rank().corr(frame[y].rank())) < 1e-9
