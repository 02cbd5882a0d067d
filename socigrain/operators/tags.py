"""Tag rollups, popularity and spam-damped shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import correlation, scale_by_max
from ..session import cut
from .rollups import aliased, reaction_measures
from .skew import with_group_totals


def explode_tags(posts: DataFrame, tags: str = "all_tags") -> DataFrame:
    return posts.withColumn("tag", F.explode(tags))


def tag_user_day_rollup(tagged: DataFrame) -> DataFrame:
    """``tagged``: exploded posts joined to accounts (followers_count, friends_count, screen_name)."""
    measures = reaction_measures() | {
        "total_in_cnt": F.sum("total_in_cnt"),
        "followers_cnt": F.avg("followers_count"),
        "friends_cnt": F.avg("friends_count"),
        "in_repost_delay_sec": F.avg("in_repost_delay_sec"),
        "in_quote_delay_sec": F.avg("in_quote_delay_sec"),
    }
    return tagged.groupBy("year", "month", "week", "day", "tag", "screen_name").agg(*aliased(measures))


_MEANS = ("followers_cnt", "friends_cnt", "in_repost_delay_sec", "in_quote_delay_sec")


def tag_rollup(tag_user_days: DataFrame) -> DataFrame:
    """Sums of sums and means of means over the (day, tag, user) rollup."""
    keys = {"year", "month", "week", "day", "tag", "screen_name"}
    return tag_user_days.groupBy("tag").agg(
        *[
            (F.avg(c) if c in _MEANS else F.sum(c)).alias(c)
            for c in tag_user_days.columns
            if c not in keys
        ]
    )


def tag_day_rollup(tagged: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    measures = {
        "tag_cnt": F.count(F.lit(1)),
        "user_cnt": distinct,
        "favourite_cnt": F.sum("original_favourite_cnt"),
        "total_in_cnt": F.sum("total_in_cnt"),
    }
    shared = reaction_measures()
    for c in ("original_cnt", "out_repost_cnt", "out_reply_cnt", "out_quote_cnt", "in_repost_cnt",
              "in_reply_cnt", "in_quote_cnt", "in_repost_favourite_cnt", "in_quote_favourite_cnt"):
        measures[c] = shared[c]
    measures["in_repost_delay_sec"] = F.avg("in_repost_delay_sec")
    measures["in_quote_delay_sec"] = F.avg("in_quote_delay_sec")
    return tagged.groupBy("day_name", "tag").agg(*aliased(measures))


#: log2 of the registers of a distinct-user sketch: 2^12 give a relative standard error of some 1.6 %.
SKETCH_BITS = 12


def user_sketches(tagged: DataFrame, keys: Sequence[str] = ("day_name", "tag"), bits: int = SKETCH_BITS) -> DataFrame:
    """Per key the uses and a mergeable sketch of the users; a few KB a row however many users there are.

    Stored by day they answer for any longer period without the users: see ``roll_up_users``.  Null users
    don't count.  The relative standard error is ``sketch_error(bits)``; few users are counted exactly.
    """
    return tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("tag_cnt"), F.hll_sketch_agg("user_id", bits).alias("users"))


def roll_up_users(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sketches of longer periods or of several tags, by merging; can be rolled up again."""
    return sketches.groupBy(*keys).agg(F.sum("tag_cnt").alias("tag_cnt"), F.hll_union_agg("users").alias("users"))


def estimated_users(sketches: DataFrame) -> DataFrame:
    return sketches.withColumn("user_cnt", F.hll_sketch_estimate("users")).drop("users")


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """Relative standard error of a merged sketch."""
    return 1.04 / 2 ** (bits / 2)


def tag_totals(tag_days: DataFrame) -> DataFrame:
    """Per tag over all days; ``user_days`` adds daily distinct users up."""
    return tag_days.groupBy("tag").agg(
        F.sum("tag_cnt").alias("tag_cnt"),
        F.sum("favourite_cnt").alias("favourite_cnt"),
        F.sum("user_cnt").alias("user_days"),
    )


def tag_popularity(tag_days: DataFrame) -> DataFrame:
    """alpha: user days per use; beta: share of all uses; gamma: favourites; each also by its maximum.

    The per-tag table is stored first: its sum and maxima are scalar subqueries over it, and
    without that each of them would run the rollup again.
    """
    totals = cut(tag_totals(tag_days), "tag-totals")
    all_uses = totals.select(F.sum("tag_cnt")).scalar()
    measured = totals.withColumns(
        {
            "alpha": F.col("user_days") / F.col("tag_cnt"),
            "beta": F.col("tag_cnt") / all_uses,
            "gamma": F.col("favourite_cnt"),
        }
    )
    return scaled_by_max(measured, ["alpha", "beta", "gamma"])


def scaled_by_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``<c>_n`` = c * (1 / max c)."""
    return df.withColumns(
        {f"{c}_n": scale_by_max(F.col(c), df.select(F.max(c)).scalar()) for c in cols}
    )


def tag_composition(tagged: DataFrame, by: Sequence[str] = ("tag",)) -> DataFrame:
    r = tagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_cnt"),
        F.count_if("is_repost").alias("repost_cnt"),
        F.count_if("is_reply").alias("reply_cnt"),
    )
    return r.withColumn("pure_original_cnt", F.col("total_cnt") - (F.col("repost_cnt") + F.col("reply_cnt")))


MONTH_KEYS = ("tag", "year", "month")


def tag_user_share(tagged: DataFrame) -> DataFrame:
    """Per (tag, month, user): counts, the literal share and the share of the tag's month.

    ``user_pct`` divides by originals + reposts of the same group and so is always 1;
    ``tag_pct`` divides by the tag's total of the month.
    """
    r = tagged.groupBy(*MONTH_KEYS, "screen_name").agg(
        F.sum("original_favourite_cnt").alias("favourite_cnt"),
        F.count_if("is_original").alias("original_cnt"),
        F.count_if("is_repost").alias("repost_cnt"),
        F.count_if("is_reply").alias("reply_cnt"),
        F.count(F.lit(1)).alias("user_tag_cnt"),
    )
    r = r.withColumn("total_tag_cnt", F.col("original_cnt") + F.col("repost_cnt"))
    r = r.withColumn("user_pct", F.try_divide("user_tag_cnt", "total_tag_cnt"))
    r = with_group_totals(
        r, MONTH_KEYS, month_tag_cnt=F.sum("user_tag_cnt"), avg_user_pct=F.avg("user_pct"), users=F.count(F.lit(1))
    )
    # the mean share of n users of one total is 1 / n
    return r.withColumns(
        {"tag_pct": F.col("user_tag_cnt") / F.col("month_tag_cnt"), "avg_tag_pct": F.lit(1.0) / F.col("users")}
    ).drop("users")


def spam_damping(shares: DataFrame, pct: str = "tag_pct", limit: float = 0.5) -> DataFrame:
    """A user with more than ``limit`` of a tag counts once; shares are then computed again.

    ``pct='user_pct'`` is the literal form, in which every group is damped.
    """
    heavy = F.col(pct) > limit
    damped = shares.select(
        *MONTH_KEYS, "screen_name", "favourite_cnt", "original_cnt",
        F.when(heavy, F.lit(1)).otherwise(F.col("user_tag_cnt")).alias("user_tag_cnt"),
        F.when(heavy & (F.col("repost_cnt") > 0), F.lit(1)).otherwise(F.col("repost_cnt")).alias("repost_cnt"),
        F.when(heavy & (F.col("reply_cnt") > 0), F.lit(1)).otherwise(F.col("reply_cnt")).alias("reply_cnt"),
    )
    damped = damped.withColumn("total_tag_cnt", F.col("original_cnt") + F.col("reply_cnt"))
    damped = damped.withColumn("user_pct", F.try_divide("user_tag_cnt", "total_tag_cnt"))
    return with_group_totals(
        damped, MONTH_KEYS, month_tag_cnt=F.sum("user_tag_cnt"), avg_user_pct=F.avg("user_pct")
    ).withColumn("tag_pct", F.try_divide("user_tag_cnt", "month_tag_cnt"))


def user_share_of_tag(tagged: DataFrame) -> DataFrame:
    uses = tagged.groupBy("tag", "screen_name").agg(F.count(F.lit(1)).alias("user_tag_cnt"))
    shares = with_group_totals(uses, ["tag"], total_tag_cnt=F.sum("user_tag_cnt"), users=F.count(F.lit(1)))
    return shares.withColumns(
        {"user_pct": F.col("user_tag_cnt") / F.col("total_tag_cnt"), "avg_user_pct": F.lit(1.0) / F.col("users")}
    ).drop("users")


def repost_original_correlation(tagged: DataFrame) -> DataFrame:
    """Pearson correlation over tags of uses in reposts and uses in originals."""
    per_tag = tagged.groupBy("tag").agg(
        F.count_if("is_repost").cast("double").alias("reposts"),
        F.count_if("is_original").cast("double").alias("originals"),
    )
    return per_tag.agg(correlation(F.col("reposts"), F.col("originals")).alias("r"), F.count(F.lit(1)).alias("tags"))
