"""State that micro-batches keep up, against the batch rollups, with folds, reruns and restarts."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from socigrain.operators import posts as P, rollups as R
from socigrain.streaming import incremental as INC, rollups as SR
from socigrain.streaming.folded import FoldedTable


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "socigrain" / "state")


def test_folds_and_reruns(spark, root):
    table = FoldedTable(spark, root, "k string, n bigint, first bigint", {"n": "sum", "first": "min"}, fold_every=3)
    want = {}
    for batch in range(11):
        rows = [(f"k{batch % 4}", batch + 1, batch), ("hot", 1, -batch)]
        partial = spark.createDataFrame(rows, "k string, n long, first long")
        if batch in (2, 5, 7):  # a run that died after its write, on a fold and between folds
            table.write(batch, spark.createDataFrame([("lost", 1, 1)], partial.schema))
        table.write(batch, partial)
        for k, n, first in rows:
            have = want.get(k, (0, first))
            want[k] = (have[0] + n, min(have[1], first))
        assert {r["k"]: (r["n"], r["first"]) for r in table.read(batch).collect()} == want
    assert [r["n"] for r in table.read(10, spark.createDataFrame([("hot",)], "k string")).collect()] == [11]
    kept = sorted(f for f in os.listdir(root))
    assert len(kept) <= 2 + 2 * 3 and "part=0" not in kept and "folded=2" not in kept
    assert table.read(-1).count() == 0


def posts_of(spark, n=60):
    """Posts every 7 hours; some react to earlier, to later and to unknown posts, a third to post 1."""
    rows = []
    for i in range(1, n + 1):
        kind = ("none", "repost", "quote", "reply")[i % 4]
        ref = 1 if i % 3 == 0 else (i * 7) % (n + 5)
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i)
        own = {f"{k}_of_id" if k != "reply" else "reply_to_id": ref if kind == k else None for k in ("repost", "quote", "reply")}
        rows.append((i, i % 5, at, kind == "none", kind == "repost", kind == "reply", kind == "quote", i,
                     i * 2 if kind == "repost" else None, i * 3 if kind == "quote" else None, own["repost_of_id"], own["quote_of_id"],
                     own["reply_to_id"], i * 11 if kind == "repost" else None, i * 13 if kind == "quote" and i % 8 != 2 else None))
    flags = ", ".join(f"{c} boolean" for c in ("is_original", "is_repost", "is_reply", "is_quote"))
    longs = ", ".join(f"{c} long" for c in ("original_favourite_cnt", "repost_favourite_cnt", "quote_favourite_cnt", "repost_of_id",
                                             "quote_of_id", "reply_to_id", "repost_delay_sec", "quote_delay_sec"))
    df = spark.createDataFrame(rows, f"id long, user_id long, created_at timestamp, {flags}, {longs}")
    return df.withColumn("week_name", F.date_format(F.date_trunc("week", "created_at"), "yyyy-MM-dd"))


def same(got, want, key):
    got, want = (d.select(*sorted(d.columns)).toPandas().sort_values(key).reset_index(drop=True) for d in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def week_rollup(posts):
    view = P.attach_inbound(posts).withColumn("total_in_cnt", F.expr("in_repost_cnt + in_reply_cnt + in_quote_cnt"))
    return R.week_rollup(view)


def test_week_stream_equals_batch(spark, root):
    posts = posts_of(spark)
    stream = SR.WeekStream(spark, root, fold_every=2)
    for batch, upto in enumerate((13, 14, 40, 40, 60)):  # the fourth batch is empty
        rows = posts.filter(F.col("id").between((0, 14, 15, 41, 41)[batch], upto))
        stream.accept(rows, batch)
        if batch == 2:
            stream.accept(rows, batch)
        if batch != 1:
            same(stream.current(batch), week_rollup(posts.filter(F.col("id") <= upto)), "week_name")


def test_inbound_stream_restarts(spark, root, tmp_path):
    posts, landing = posts_of(spark).select(*SR.NEEDED), str(tmp_path / "landing")
    last = []
    for low, high in ((1, 30), (20, 45), (46, 60), (50, 60)):  # overlapping: posts that arrive again
        posts.filter(F.col("id").between(low, high)).coalesce(1).write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(posts.schema).parquet(landing)
        stream = SR.InboundStream(spark, root, fold_every=2)
        last.append(stream.run(INC.new_posts(arriving, "60 days")))
        same(stream.current(last[-1]), P.inbound_reactions(posts.filter(F.col("id") <= high)), "id")
    # nothing new: the state stays readable
    assert SR.InboundStream(spark, root, fold_every=2).run(INC.new_posts(arriving, "60 days")) >= last[-1]


def test_marks_survive_a_restart(spark, root, tmp_path):
    landing, schema = str(tmp_path / "landing"), "id bigint, user_id bigint, created_at timestamp"
    for ids in ([5, 9], [7, 12], [3, 20]):  # 7 and 3 are below the mark when they arrive
        rows = [(i, 1, dt.datetime(2024, 1, 1, i)) for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        table = INC.MarkedTable(spark, root, fold_every=2)
        last = table.run(INC.arriving_parquet(spark, landing, schema))
    assert sorted(r["id"] for r in table.posts().collect()) == [5, 9, 12, 20]
    assert [tuple(r) for r in table.marks(last).collect()] == [(1, 20)]
