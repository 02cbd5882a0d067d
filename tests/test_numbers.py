"""Skew-safe numbering, quantiles, tests and trajectories against brute force, with tiny blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from socigrain.operators import rolling, rollups as R, skew, stats as ST, tags as TG, trajectory as TR


def test_number_rows_equals_one_window(spark):
    df = spark.range(500).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    got = skew.number_rows(df, ["k"], ["t"], F.floor(F.col("t") / 7), "rn").toPandas().sort_values(["k", "t"])
    assert (got["rn"].values == got.groupby("k").cumcount().values + 1).all()


def test_lookup_join_rejects_unsplittable(spark):
    with pytest.raises(ValueError):
        skew.lookup_join(spark.range(1), spark.range(1), "id", "right")


def test_hot_keys_are_found(spark):
    df = spark.range(100).select(F.when(F.col("id") < 70, 1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in skew.hot_keys(df, ["k"], 20).collect()] == [(1, 4)]


@pytest.mark.parametrize("values", [[1.0], [2.0, 9.0], list(np.random.RandomState(1).lognormal(0, 4, 999)), [3.0] * 50 + [1e9, -5.0]])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([("g", float(v)) for v in values], "k string, v double")
    probs = [0.0, 0.1, 0.3, 0.5, 0.9, 1.0]
    got = {r["p"]: r["q"] for r in ST.exact_quantiles(df, ["k"], "v", probs, bins=8, rounds=2).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_t_test(spark):
    df = spark.createDataFrame([("m", True, x) for x in (5.1, 4.9, 6.2, 5.8)] + [("m", False, x) for x in (7.9, 6.8, 7.2)], "m string, g boolean, v double")
    r = ST.two_sample_t(df, "m", F.col("g"), "v").first()
    pooled = (3 * np.var([5.1, 4.9, 6.2, 5.8], ddof=1) + 2 * np.var([7.9, 6.8, 7.2], ddof=1)) / 5
    assert r["t_statistic"] == pytest.approx((5.5 - 7.3) / np.sqrt(pooled * (1 / 4 + 1 / 3)))
    # density of Student's t with 5 degrees of freedom, integrated numerically
    x = np.linspace(0, -r["t_statistic"], 20_001)
    density = 8 / (3 * np.pi * np.sqrt(5)) * (1 + x * x / 5) ** -3
    assert r["p_value"] == pytest.approx(1 - 2 * np.trapezoid(density, x), abs=1e-7)
    known = spark.createDataFrame([(1.0, 1.0), (2.0, 10.0), (0.0, 5.0)], "t double, d double").select(ST.student_t_p_value("t", "d").alias("p")).toPandas()["p"]
    assert known.tolist() == pytest.approx([0.5, 0.0733880, 1.0], abs=1e-6)


def test_user_sketches_roll_up(spark):
    df = spark.range(60_000).select(
        F.format_string("d%02d", F.col("id") % 28).alias("day_name"), F.when(F.col("id") % 3 == 0, "hot").otherwise("other").alias("tag"),
        F.when(F.col("id") % 1000 != 7, F.col("id") * 31 % 20_011).alias("user_id"))
    few = spark.createDataFrame([("d01", "few", 5), ("d01", "few", 5), ("d09", "few", 5), ("d27", "few", None)], df.schema)
    df = df.unionByName(few)
    days = TG.user_sketches(df)
    week = F.expr("substr(day_name, 2, 2) div 7").alias("week")
    weeks = TG.roll_up_users(days.select(week, "tag", "tag_cnt", "users"), ["week", "tag"])
    total = TG.roll_up_users(weeks, ["tag"])
    for got, exact, keys in ((days, df, ["day_name", "tag"]), (weeks, df.withColumn("week", week), ["week", "tag"]), (total, df, ["tag"])):
        counts = exact.groupBy(*keys).agg(F.count_distinct("user_id").alias("n"), F.count(F.lit(1)).alias("uses"))
        rows = TG.estimated_users(got).join(counts, keys, "full").collect()
        assert all(abs(r["user_cnt"] - r["n"]) <= 5 * TG.sketch_error() * r["n"] and r["tag_cnt"] == r["uses"] for r in rows)
    few = {r["tag"]: r["user_cnt"] for r in TG.estimated_users(total).collect()}
    assert few["few"] == 1
    assert TG.roll_up_users(TG.user_sketches(df.limit(0)), ["tag"]).count() == 0


def test_histogram_closes_last_bin(spark):
    h = ST.histogram(spark.range(0, 101), "id").orderBy("bin").toPandas()
    assert h["n"].tolist() == [10] * 9 + [11]


@pytest.fixture(scope="module")
def walk():
    rng = np.random.RandomState(3)
    parts = []
    for e, n in (("a", 57), ("b", 23), ("c", 3)):
        parts.append(pd.DataFrame({"entity": e, "frame": np.arange(n), "pos_x": rng.rand(n).cumsum(), "pos_y": rng.rand(n)}))
    return pd.concat(parts, ignore_index=True)


def test_rolling_over_block_edges(spark, walk):
    df = spark.createDataFrame(walk)
    got = TR.path_values(df, 4, block=5).toPandas().sort_values(["entity", "frame"]).reset_index(drop=True)
    desc = TR.rolling_descriptor(df, "pos_x", 4, block=5).toPandas().sort_values(["entity", "frame"]).reset_index(drop=True)
    want = []
    for _, g in walk.groupby("entity"):
        g = g.copy()
        g["step"] = np.hypot(g.pos_x.diff(), g.pos_y.diff())
        g["rpl"] = g["step"].rolling(4).sum()
        g["spl"] = np.hypot(g.pos_x.diff(4), g.pos_y.diff(4))
        g["str_index"] = g["spl"] / g["rpl"]
        g["p25"] = g.pos_x.rolling(4).quantile(0.25)
        g["sd"] = g.pos_x.rolling(4).std()
        want.append(g)
    want = pd.concat(want).reset_index(drop=True)
    for c in ("step", "spl", "rpl", "str_index"):
        np.testing.assert_allclose(got[c], want[c].fillna(0), atol=1e-9)
    np.testing.assert_allclose(desc["pos_x_p25"], want["p25"], atol=1e-9)
    np.testing.assert_allclose(desc["pos_x_std"], want["sd"], atol=1e-9)


@pytest.mark.parametrize("window", [1, 2, 7, 300, 5000])
def test_rolling_statistics(window):
    rng = np.random.RandomState(window)
    x = np.round(rng.lognormal(0, 2, 4000), 1)  # ties
    x[rng.rand(4000) < 0.0005] = np.nan
    x[1000] = 1e12
    s = pd.Series(x)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    for p, got in zip(probs, rolling.rolling_quantiles(x, window, probs)):
        np.testing.assert_allclose(got, s.rolling(window).quantile(p), rtol=1e-12)
    mean, std = rolling.rolling_moments(x, window)
    frames = np.lib.stride_tricks.sliding_window_view(x, window) if window <= len(x) else np.empty((0, window))
    np.testing.assert_allclose(mean[window - 1:], frames.mean(axis=1), rtol=1e-9)
    if window > 1:
        np.testing.assert_allclose(std[window - 1:], frames.std(axis=1, ddof=1), rtol=1e-6, atol=1e-6)
    assert np.isnan(mean[:window - 1]).all() and (window > 1 or np.isnan(std).all())


def test_window_over_many_blocks(spark, walk, monkeypatch):
    df = spark.createDataFrame(walk.assign(note=[["x"]] * len(walk)))
    for block, short in ((3, 0), (8, 0), (None, 0), (8, 32)):
        monkeypatch.setattr(TR, "SHORT", short)
        got = TR.rolling_descriptor(df, "pos_x", 20, block=block).toPandas().sort_values(["entity", "frame"])
        want = walk.groupby("entity")["pos_x"].rolling(20).quantile(0.9)
        np.testing.assert_allclose(got["pos_x_p90"], want.values)
        assert len(got) == len(walk) and got["note"].str.len().eq(1).all()
        diff = TR.differences(df, ["pos_x"], 20, block=block).toPandas().sort_values(["entity", "frame"])
        np.testing.assert_allclose(diff["pos_x_diff"], walk.groupby("entity")["pos_x"].diff(20))
    wide = TR.path_values(df, 30, block=4).toPandas().sort_values(["entity", "frame"])
    x, y = (walk.groupby("entity")[c].diff(30) for c in ("pos_x", "pos_y"))
    np.testing.assert_allclose(wide["spl"], np.hypot(x, y).fillna(0))
    for short in (0, 32):
        monkeypatch.setattr(TR, "SHORT", short)
        for hole in (None, float("nan")):
            holes = df.withColumn("pos_x", F.when(F.col("frame") != 30, F.col("pos_x")).otherwise(F.lit(hole)))
            got = TR.rolling_descriptor(holes, "pos_x", 5).filter("entity = 'a'").orderBy("frame").toPandas()
            for c in ("mean", "median", "std", "max"):
                assert got.index[got[f"pos_x_{c}"].isna()].tolist() == [0, 1, 2, 3, 30, 31, 32, 33, 34]
        assert TR.rolling_descriptor(df.limit(0), "pos_x", 5).count() == 0


def test_forward_fill_crosses_blocks(spark, walk):
    holes = walk.assign(pos_x=walk.pos_x.where((walk.frame < 2) | (walk.frame > 40)))
    df = spark.createDataFrame(holes).withColumn("pos_x", F.nanvl("pos_x", F.lit(None)))
    got = TR.forward_fill(df, ["pos_x"], block=5).toPandas().sort_values(["entity", "frame"])
    np.testing.assert_allclose(got["pos_x"], holes.groupby("entity")["pos_x"].ffill())


def test_contacts_against_all_pairs(spark):
    rng = np.random.RandomState(5)
    rows = [(e, f, float(rng.randint(-6, 6)), float(rng.randint(-6, 6))) for e in range(6) for f in range(40)]
    df = spark.createDataFrame(rows, "entity long, frame long, pos_x double, pos_y double")
    at = {(e, f): (x, y) for e, f, x, y in rows}
    want = set()
    for a in range(6):
        for b in range(a + 1, 6):
            near = [f for f in range(40) if np.hypot(at[a, f][0] - at[b, f][0], at[a, f][1] - at[b, f][1]) <= 5.0]
            start = None
            for f in near + [None]:
                if start is None:
                    start = prev = f
                elif f is None or f != prev + 1:
                    if prev - start + 1 >= 2:
                        want.add((a, b, start, prev, prev - start + 1))
                    start = f
                prev = f
    near = TR.near_pairs(df, 5.0)
    for block in (3, 100):
        got = {tuple(r) for r in TR.contact_runs(near, 2, block=block).select("entity_a", "entity_b", "start", "end", "frames").collect()}
        assert got == want


@pytest.mark.parametrize("name", ["int", "string"])
def test_crowded_contacts_stay_in_their_cells(spark, name):
    rng = np.random.RandomState(3)
    walk = lambda: np.cumsum(rng.randint(-2, 3, 60))
    rows = [(e, f - 8, float(x), float(y)) for e in range(14) for f, (x, y) in enumerate(zip(walk(), walk())) if rng.rand() < 0.95]
    rows += [(None, 3, 0.0, 0.0), (2, None, 0.0, 0.0), (3, 70, None, 0.0)]
    df = spark.createDataFrame(rows, "entity long, frame long, pos_x double, pos_y double")
    df = df.withColumn("entity", F.concat(F.lit("e"), "entity")) if name == "string" else df
    plain = TR.contact_runs(TR.near_pairs(df, 5.0), 2)
    crowded = TR.contacts(df, 4.0, 2, neighbours=0, block=16)
    assert crowded.exceptAll(plain.select(*crowded.columns)).isEmpty() and crowded.count() == plain.count() > 100
    want = {tuple(r) for r in TR.contact_edges(plain, 24.0).collect()}
    assert {tuple(r) for r in TR.edges_of_totals(TR.contact_totals(df, 4.0, 2, neighbours=0, block=16), 24.0).collect()} == want
    assert {tuple(r) for r in TR.edges_of_totals(TR.contact_totals(df, 4.0, 2, neighbours=1000, block=16), 24.0).collect()} == want
    # frames of one block: nothing that belongs to a pair is moved
    first = df.filter("frame BETWEEN 0 AND 15")
    runs, plain = TR.contacts(first, 4.0, 2, neighbours=0, block=16), TR.contact_runs(TR.near_pairs(first, 5.0), 2)
    assert runs.exceptAll(plain.select(*runs.columns)).isEmpty() and runs.count() == plain.count() > 0
    assert "hashpartitioning(entity_a" not in runs._jdf.queryExecution().toString()


def test_contact_edge_formulas(spark):
    runs = spark.createDataFrame([(1, 2, 0, 11, 12), (1, 2, 20, 31, 12)], "entity_a long, entity_b long, start long, end long, frames long")
    e = TR.contact_edges(runs, 24.0).first()
    assert (e["count"], e["duration"]) == (2, 1.0) and e["frequency"] == pytest.approx(4.0)
    multi = spark.createDataFrame([(2, 1, 12), (1, 2, 12), (1, 3, 0)], "src long, dst long, duration long")
    assert [tuple(r)[:4] for r in TR.collapse_multi_edges(multi, 24.0).collect()] == [(1, 2, 2, 1.0)]


def test_chunks_of_a_list_join_up(spark):
    df = spark.range(40).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.array(F.col("id"), F.col("id")).alias("xs"))
    rows = R.concat_lists(df, ["k"], "xs", ["t"], F.floor(F.col("t") / 3), chunk=7).orderBy("chunk").collect()
    assert sum((r["items"] for r in rows), []) == [i for i in range(40) for _ in range(2)]
    assert max(len(r["items"]) for r in rows) == 7


def test_busiest_fortnight(spark):
    day = 86_400
    stamps = [0, 1, 13 * day, 14 * day, 14 * day + 1, 27 * day, 60 * day]
    df = spark.createDataFrame([(1, s) for s in stamps], "user_id long, s long").withColumn("created_at", F.timestamp_seconds("s"))
    want = max(sum(1 for x in stamps if t - 14 * day < x <= t) for t in stamps)
    assert R.busiest_fortnight(df).first()["max_posts"] == want
