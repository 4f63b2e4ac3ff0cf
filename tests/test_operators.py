"""Operator tests against straightforward Python references."""
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.operators import (box_summary, describe_by, exact_quantiles, fold_run, guarded_fold, histogram, latest_by, quantile_bins,
                                 skipped_changes, with_global_rank)
from shelfcast.operators import fold
from shelfcast.operators.fold import blocks_of, ewm_state, stock_function


def py_fold(xs, s=0):
    for x in xs:
        if s + x >= 0:
            s += x
    return s


def test_fold_example():
    state, applied = fold_run(np.array([5, -7, 3, -8, -1]), 0)
    assert state == py_fold([5, -7, 3, -8, -1]) == 0
    assert list(applied) == [True, False, True, True, False]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-50, 50), max_size=300), st.integers(0, 40))
def test_fold_matches_loop(xs, s0):
    state, applied = fold_run(np.array(xs, dtype=np.int64), s0)
    assert state == py_fold(xs, s0)
    # replaying only the applied changes never goes negative
    s = s0
    for x, a in zip(xs, applied):
        if a:
            s += x
            assert s >= 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-12, 12), max_size=120), st.integers(0, 40), st.integers(1, 60))
def test_stock_function_equals_the_fold_for_every_entering_stock(xs, s0, most):
    f = stock_function()
    for x in xs:
        f.add(x)
    table = f.table()
    assert [int(v) for v in table] == [py_fold(xs, s) for s in range(f.drawdown)]
    assert all(py_fold(xs, s) == s + f.total for s in range(f.drawdown, f.drawdown + 5))
    stock, rows = s0, 0
    for n, total, drawdown, table in blocks_of(np.array(xs, dtype=np.int64), most):
        assert drawdown <= most or n == 1
        rows += n
        stock = stock + total if stock >= drawdown else int(table[stock]) if len(table) else stock
    assert (stock, rows) == (py_fold(xs, s0), len(xs))


@pytest.mark.parametrize("drift,parts,block,step", [(-3, 8, 65_536, 37), (0, 8, 10, 1), (4, 3, 100, 37), (-3, 16, 7, 0), (0, 1, 9, 61)])
def test_guarded_fold_distributed(spark, monkeypatch, drift, parts, block, step):
    """The fold equals a plain loop; one key holds most rows and is spread over the
    partitions, another is NULL."""
    monkeypatch.setattr(fold, "BLOCK_ROWS", block)
    rng = np.random.default_rng(7 + drift)
    t0 = pd.Timestamp("2024-01-01")
    rows = []
    for t in range(2500):
        k = 0 if rng.random() < 0.6 else int(rng.integers(1, 6))
        rows.append((None if k == 5 else k, (t0 + pd.Timedelta(minutes=step * t)).to_pydatetime(), int(rng.integers(-20, 21)) + drift, t))
    df = spark.createDataFrame(rows, "k long, timestamp timestamp, d int, i int")
    args = (["k"], ["timestamp", "i"], "d")
    got = {r["k"]: (r["current_stock"], r["skipped"], r["events"], r["last_event_at"])
           for r in guarded_fold(df, *args, num_partitions=parts).collect()}
    want, gone = {}, []
    for k in {r[0] for r in rows}:
        stock, skipped, last, n = 0, 0, None, 0
        for r in (r for r in rows if r[0] == k):
            n += 1
            if stock + r[2] >= 0:
                stock, last = stock + r[2], r[1]
            else:
                skipped += 1
                gone.append(r)
        want[k] = (stock, skipped, n, last)
    assert got == want
    assert sorted(map(tuple, skipped_changes(df, *args, num_partitions=parts).collect()), key=str) == sorted(gone, key=str)


def test_a_dominant_key_is_spread_over_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").cast("timestamp").alias("timestamp"),
                                    F.when(F.col("id") % 3 == 0, 5).otherwise(-4).alias("d"))
    first, _, _ = fold._folded(df, ["k"], ["timestamp"], "d", "timestamp", 8, None, "state")
    assert first.where("_rows is not null").select("_part").distinct().count() >= 6
    r = guarded_fold(df, ["k"], ["timestamp"], "d").first()
    assert (r["current_stock"], r["events"]) == (py_fold([5 if i % 3 == 0 else -4 for i in range(20_000)]), 20_000)


def test_guarded_fold_nulls_and_start(spark):
    """A NULL change is a change of 0, a NULL time comes first, ``init`` is the stock before."""
    rows = [("a", "2024-01-01 00:00:00", 5), ("a", "2024-01-02 00:00:00", None), ("a", "2024-01-03 00:00:00", 2),
            ("b", None, 3), ("b", "2024-01-01 00:00:00", -3), ("b", "2024-01-01 00:01:00", -1), ("c", "2024-01-01 00:00:00", -1)]
    df = spark.createDataFrame(rows, "k string, t string, d int").select("k", F.col("t").cast("timestamp").alias("timestamp"), "d")
    got = {r["k"]: (r["current_stock"], r["skipped"], r["events"]) for r in guarded_fold(df, ["k"], ["timestamp", "d"], "d").collect()}
    assert got == {"a": (7, 0, 3), "b": (0, 1, 3), "c": (0, 1, 1)}
    init = spark.createDataFrame([("c", 4), ("b", 1)], "k string, stock long")
    got = {r["k"]: (r["current_stock"], r["skipped"]) for r in guarded_fold(df, ["k"], ["timestamp", "d"], "d", init=init).collect()}
    assert got == {"a": (7, 0), "b": (0, 0), "c": (3, 0)}
    assert [r["k"] for r in skipped_changes(df, ["k"], ["timestamp", "d"], "d", init=init).collect()] == []


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("a", None)], "g string, x double")
    assert sorted((r["g"] or "", r["bin"], r["count"]) for r in histogram(df, ["g"], "x", 2).collect()) == [("", 0, 1), ("", 1, 1), ("a", 0, 1)]
    got = {r["g"]: (r["count"], r["mean"], r["std"], r["q50"]) for r in describe_by(df, ["g"], "x").collect()}
    assert got == {None: (2, 2.0, 1.41, 2.0), "a": (1, 2.0, None, 2.0)}
    box = {r["g"]: (r["min"], r["q25"], r["max"], r["outliers"]) for r in box_summary(df, ["g"], "x").collect()}
    assert box == {None: (1.0, 1.5, 3.0, 0), "a": (2.0, 2.0, 2.0, 0)}


@pytest.mark.parametrize("n", [1, 2, 4, 5, 6, 7, 13, 40])
def test_quantile_bins_equal_qcut(spark, n):
    vals = [float(v) for v in np.random.default_rng(n).integers(0, 4, n)]  # many ties
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "uid long, v double")
    got = {r["uid"]: r["q"] for r in quantile_bins(df, "v", "uid", "q").collect()}
    s = pd.Series(vals, index=range(n))
    k = min(5, n)
    ranked = pd.DataFrame({"v": vals, "uid": range(n)}).sort_values(["v", "uid"])
    ranked["r"] = np.arange(1, n + 1)
    want_bins = pd.qcut(ranked["r"], q=k, labels=list(range(1, k + 1))).astype(int) if n > 1 else pd.Series(
        [1], index=ranked.index)
    want = dict(zip(ranked["uid"], want_bins))
    assert got == want, (got, want, s)


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("v"), F.col("id"))
    r = with_global_rank(df, ["v", "id"], "rk", num_partitions=7).collect()
    assert sorted(x["rk"] for x in r) == list(range(1, 5001))
    assert all(x["rk"] == x["v"] + 1 for x in r)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(rng.normal()), i) for i, g in enumerate(rng.integers(0, 3, 999))]
    df = spark.createDataFrame(rows, "g long, v double, i long")
    got = {r["g"]: (r["q25"], r["q50"], r["q75"]) for r in exact_quantiles(df, ["g"], "v").collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v", "i"])
    for g, grp in pdf.groupby("g"):
        assert got[g] == pytest.approx(tuple(np.percentile(grp["v"], [25, 50, 75])))


def test_latest_by_ties_and_late_rows(spark):
    df = spark.createDataFrame([(1, "a", 10, 1, 5.0), (1, "a", 10, 2, 6.0), (1, "a", 9, 9, 7.0)],
                               "k long, c string, ts long, tie long, p double")
    r = latest_by(df, ["k", "c"], ["ts", "tie"]).first()
    assert (r["ts"], r["tie"], r["p"]) == (10, 2, 6.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    h = {r["bin"]: r["count"] for r in histogram(df, [], "x", 5).collect()}
    assert h == {0: 2, 1: 2, 2: 1, 4: 1}


def test_ewm_state_matches_pandas(spark):
    xs = [3.0, 0.0, 5.0, 2.0, 2.0, 9.0, 1.0]
    df = spark.createDataFrame([(xs,)], "s array<double>")
    e = df.select(ewm_state(F.col("s"), 0.4).alias("e")).first()["e"]
    want = pd.Series(xs).ewm(span=4, adjust=False).mean()
    assert e["y"] == pytest.approx(want.iloc[-1])
    assert e["p4"] == pytest.approx(want.iloc[-5])


def test_quantile_bins_leave_nulls_and_other_columns(spark):
    """NULL values rank first; columns that the ranking does not name come through."""
    df = spark.createDataFrame([("a", None, 1), ("b", 2.0, 2), ("c", 2.0, 3), ("d", 9.0, 4)], "uid string, v double, z int")
    got = {r["uid"]: (r["q"], r["z"]) for r in quantile_bins(df, "v", "uid", "q", n_bins=2, descending_labels=True).collect()}
    assert got == {"a": (2, 1), "b": (2, 2), "c": (1, 3), "d": (1, 4)}
    assert quantile_bins(df.limit(0), "v", "uid", "q").count() == 0


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_rows_at_ranks_equal_a_full_sort(spark, accuracy, monkeypatch):
    """Heavy ties, NULL values and ties, repeated rows; ranges as wide as they get with poor percentiles."""
    from shelfcast.operators import rank
    monkeypatch.setattr(rank, "ACCURACY", accuracy)
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 900)) if rng.random() > 0.02 else None, float(rng.choice([0.0, 1.5, 1.5, 1.5, rng.random()])),
             int(rng.integers(0, 3)) if rng.random() > 0.1 else None, str(rng.integers(0, 40))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "id long, a double, b int, s string").repartition(5)
    ranks = [1, 2, 150, 700, 1001, 1999, 2000]
    first = lambda t: (t[0] is not None, t[0] if t[0] is not None else 0, t[1] is not None, t[1] if t[1] is not None else 0)
    for tie, k in (("id", 0), ("s", 3)):
        got = rank.rows_at(df, ["a", "b"], tie, ranks)
        for c, col in (("a", 1), ("b", 2)):
            want = sorted(((r[col], r[k]) for r in rows), key=first)
            assert got[c] == [want[r - 1] for r in ranks], (tie, c)


def test_selection_ranks_few_rows(spark, monkeypatch):
    """All rows but the few around the cuts are only read, though one value holds a third of them."""
    from shelfcast.operators import rank
    seen = []
    monkeypatch.setattr(rank, "materialize", lambda df, name: _kept(seen, df, name))
    df = spark.range(200_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS v")
    want = sorted((1 if i % 3 == 0 else i, i) for i in range(200_000))
    got = rank.rows_at(df, ["v"], "id", [1, 40_000, 120_000])
    assert got["v"] == [want[r - 1] for r in (1, 40_000, 120_000)]
    assert seen and max(n for _, n in seen) < 2_000


def _kept(seen, df, name):
    from shelfcast.session import materialize
    out = materialize(df, name)
    seen.append((name, out.count()))
    return out


@pytest.mark.parametrize("hours", [1, 2, 4, 5, 6, 60])
def test_ewm_levels_equal_pandas_over_the_zero_filled_series(spark, hours):
    from shelfcast.operators import ewm_levels
    rng = np.random.default_rng(hours)
    rows = [(h * 3, c, int(rng.integers(1, 9))) for h in range(hours) for c in ("a", "b", None) if c == "a" or rng.random() < 0.5]
    df = spark.createDataFrame([*rows, (None, "a", 100), (0, "z", None)], "h int, c string, x int")
    got = {r["c"]: r for r in ewm_levels(df, ["c"], "h", "x", 0.4).collect()}
    assert set(got) == {c for _, c, _ in rows}
    for c, r in got.items():
        series = pd.Series([sum(x for h, k, x in rows if k == c and h == t * 3) for t in range(hours)], dtype=float)
        want = list(series.ewm(alpha=0.4, adjust=False).mean())[::-1] + [None] * 4
        assert (r["n"], r["last"]) == (hours, (hours - 1) * 3)
        assert [r["y"], r["p1"], r["p2"], r["p3"], r["p4"]] == [None if w is None else pytest.approx(w, abs=1e-12) for w in want[:5]]


def test_guarded_fold_shuffles_the_columns_alone(spark, monkeypatch):
    from shelfcast.operators import fold
    plans, write = [], fold.materialize

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)
    monkeypatch.setattr(fold, "materialize", seen)
    rows = [(None if i % 7 == 0 else i % 5, f"w{i % 2}", i, None if i % 11 == 0 else (-1) ** i * (i % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "p int, w string, timestamp int, x int")
    got = {(r["p"], r["w"]): (r["current_stock"], r["events"]) for r in
           fold.guarded_fold(df, ["p", "w"], ["timestamp", "x"], "x", num_partitions=4).collect()}
    want = {}
    for p, w, _, x in rows:
        stock, n = want.get((p, w), (0, 0))
        want[p, w] = (stock + (x or 0) if stock + (x or 0) >= 0 else stock, n + 1)
    assert got == want
    below = plans[0][plans[0].index("rangepartitioning"):]
    assert "to_json" not in below and "_key" not in below
