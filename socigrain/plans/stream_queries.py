"""Streaming forms of the incremental load and the tag rollup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import incremental as INC, rollups as SR
from . import adapter as ad
from .adapter import EV, FLAT, with_ctes as sql
from .registry import SQL, query
from .rollup_queries import DELAYS, rounded



def _halves():
    """The two halves of the month, by time of creation."""
    middle = F.lit("2024-01-16").cast("timestamp")
    return F.col("created_at") < middle, F.col("created_at") >= middle


def _landed(spark, sf, path):
    """The activity landed as two files, split at the middle of the month."""
    act = ad.activity(spark, sf).select("id", "user_id", "created_at", "fav")
    for half in _halves():
        act.filter(half).write.mode("append").parquet(path)
    return "id bigint, user_id bigint, created_at timestamp, fav bigint"


@query("I02_incremental_stream", sql(EV, select="SELECT id, user_id, fav FROM ev"))
def _(spark, sf):
    path = scratch_path(spark, "landing")
    schema = _landed(spark, sf, path)
    table = INC.MarkedTable(spark, scratch_path(spark, "marked"))
    table.run(INC.new_posts(INC.arriving_parquet(spark, path, schema), "40 days"))
    return table.posts().select("id", "user_id", "fav")


@query("I02_stream_marks", sql(EV, select="SELECT user_id, max(id) AS max_id FROM ev GROUP BY 1"))
def _(spark, sf):
    path = scratch_path(spark, "landing")
    schema = _landed(spark, sf, path)
    table = INC.MarkedTable(spark, scratch_path(spark, "marked"))
    last = table.run(INC.new_posts(INC.arriving_parquet(spark, path, schema), "40 days"))
    return table.marks(last)


@query("I02_tag_day_stream", sql(FLAT, select="""
  SELECT day_name, tag, count(*) AS tag_cnt, CAST(sum(original_favourite_cnt) AS BIGINT) AS favourite_cnt
  FROM (SELECT unnest(all_tags) AS tag, * FROM flat) GROUP BY 1, 2"""))
def _(spark, sf):
    path, out = scratch_path(spark, "landing"), scratch_path(spark, "tag-days")
    ad.flat(spark, sf).select("created_at", "all_tags", "original_favourite_cnt").write.parquet(path)
    stream = INC.arriving_parquet(spark, path, "created_at timestamp, all_tags array<string>, original_favourite_cnt bigint")

    def keep(rows, batch):
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query_ = (
        INC.tag_day_stream(stream).writeStream.outputMode("update").foreachBatch(keep)
        .option("checkpointLocation", f"{out}-progress").trigger(availableNow=True).start()
    )
    query_.awaitTermination()
    rows = spark.read.parquet(out)
    # a batch writes the groups it changed; the last one written counts
    last = rows.groupBy("day_name", "tag").agg(F.max_by(F.struct("tag_cnt", "favourite_cnt"), "batch").alias("v"))
    return last.select("day_name", "tag", "v.*")


def _kept_up(spark, sf, kind):
    """A streamed rollup over all posts: half of the month arrives, is taken in, then the rest."""
    path, root = scratch_path(spark, "landing"), scratch_path(spark, "rollup")
    flat = ad.flat(spark, sf).select(*SR.NEEDED)
    for half in _halves():
        flat.filter(half).write.mode("append").parquet(path)
        arriving = spark.readStream.schema(flat.schema).parquet(path)
        table = kind(spark, root)  # a new object each time: all state is in the folder
        last = table.run(INC.new_posts(arriving, "40 days"))
    return table.current(last)


@query("I02_inbound_stream", SQL["A03_inbound_reactions"])
def _(spark, sf):
    return rounded(_kept_up(spark, sf, SR.InboundStream), "in_repost_delay_sec", "in_quote_delay_sec")


@query("I02_week_stream", SQL["A08_week_rollup"])
def _(spark, sf):
    w = _kept_up(spark, sf, SR.WeekStream).withColumn("first_post", F.date_format("first_post", "yyyy-MM-dd HH:mm:ss"))
    return rounded(w, *DELAYS, digits=3)
