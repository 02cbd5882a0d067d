"""Post table: flattening, flags, calendar fields and inbound reactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import arrays as A, dates as D
from ..sources.schemas import CLEAN_POST, conformed


def flatten_post(raw: DataFrame) -> DataFrame:
    """Nested post -> flat fields.  A repost shows the text of the reposted post, once."""
    own_tags = A.pluck(F.col("entities.hashtags"), "text")
    own_names = A.pluck(F.col("entities.user_mentions"), "screen_name")
    is_repost = F.col("retweeted_status").isNotNull()
    is_quote = F.coalesce(F.col("is_quote_status"), F.lit(False))
    none = A.empty_strings()

    def by_origin(entity: str, field: str, own: Column) -> list[Column]:
        return [
            F.when(~is_repost, own).otherwise(none),
            F.when(is_repost, A.pluck(F.col(f"retweeted_status.entities.{entity}"), field)).otherwise(none),
            F.when(is_quote, A.pluck(F.col(f"quoted_status.entities.{entity}"), field)).otherwise(none),
        ]

    tags = by_origin("hashtags", "text", own_tags)
    names = by_origin("user_mentions", "screen_name", own_names)
    return raw.select(
        "id",
        F.col("user.id").alias("user_id"),
        F.col("user.id_str").alias("user_id_str"),
        F.col("user.screen_name").alias("screen_name"),
        F.coalesce("retweeted_status.full_text", "full_text").alias("full_text"),
        D.parse_post_time(F.col("created_at")).alias("created_at"),
        "lang",
        "possibly_sensitive",
        own_tags.alias("tags"),
        own_names.alias("mentions"),
        A.pluck(F.col("entities.user_mentions"), "id").cast("array<bigint>").alias("mention_ids"),
        *[c.alias(f"{o}_tags") for o, c in zip(("original", "repost", "quote"), tags)],
        *[c.alias(f"{o}_mentions") for o, c in zip(("original", "repost", "quote"), names)],
        F.coalesce("favorite_count", F.lit(0)).alias("original_favourite_cnt"),
        F.col("retweeted_status.id").alias("repost_of_id"),
        F.col("retweeted_status.user.id").alias("repost_of_user_id"),
        F.col("retweeted_status.user.screen_name").alias("repost_of_screen_name"),
        D.parse_post_time(F.col("retweeted_status.created_at")).alias("repost_created_at"),
        F.col("retweeted_status.favorite_count").alias("repost_favourite_cnt"),
        F.col("is_quote_status").alias("is_quote"),
        F.col("quoted_status.id").alias("quote_of_id"),
        F.col("quoted_status.user.id").alias("quote_of_user_id"),
        F.col("quoted_status.user.screen_name").alias("quote_of_screen_name"),
        D.parse_post_time(F.col("quoted_status.created_at")).alias("quote_created_at"),
        F.col("quoted_status.favorite_count").alias("quote_favourite_cnt"),
        F.col("in_reply_to_status_id").alias("reply_to_id"),
        F.col("in_reply_to_user_id").alias("reply_to_user_id"),
        F.col("in_reply_to_screen_name").alias("reply_to_screen_name"),
    )


def reaction_flags(posts: DataFrame) -> DataFrame:
    """``is_original`` means "not a repost", so replies and quotes are originals too."""
    return posts.withColumns(
        {
            "is_repost": F.col("repost_of_id").isNotNull(),
            "is_reply": F.col("reply_to_id").isNotNull(),
            "is_quote": F.coalesce("is_quote", F.lit(False)),
            "is_original": F.col("repost_of_id").isNull(),
        }
    )


def reaction_delays(posts: DataFrame) -> DataFrame:
    return posts.withColumns(
        {
            "repost_delay_sec": D.seconds_between(F.col("created_at"), F.col("repost_created_at")),
            "quote_delay_sec": D.seconds_between(F.col("created_at"), F.col("quote_created_at")),
        }
    )


def in_date_window(posts: DataFrame, min_date=None, max_date=None, ts: str = "created_at") -> DataFrame:
    """Inclusive window; either bound may be absent."""
    if min_date is not None:
        posts = posts.filter(F.col(ts) >= F.lit(min_date).cast("timestamp"))
    if max_date is not None:
        posts = posts.filter(F.col(ts) <= F.lit(max_date).cast("timestamp"))
    return posts


def strictly_between(posts: DataFrame, start=None, end=None, ts: str = "created_at") -> DataFrame:
    """Exclusive window, applied only when both bounds are given."""
    if start is None or end is None:
        return posts
    c = F.col(ts)
    return posts.filter((c > F.lit(start).cast("timestamp")) & (c < F.lit(end).cast("timestamp")))


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Deterministic de-duplication; Spark limits each group before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def reaction_refs(posts: DataFrame) -> DataFrame:
    """(kind, id, delay): the posts that each post reacts to."""
    return posts.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(kind).alias("kind"), F.col(ref).alias("id"), delay.alias("delay"))
                    for kind, ref, delay in (
                        ("repost", "repost_of_id", F.col("repost_delay_sec")),
                        ("quote", "quote_of_id", F.col("quote_delay_sec")),
                        ("reply", "reply_to_id", F.lit(None).cast("bigint")),
                    )
                ]
            )
        ).alias("r")
    ).select("r.*").filter(F.col("id").isNotNull())


def inbound_reactions(posts: DataFrame) -> DataFrame:
    """Per referenced post: reposts, quotes, replies and mean delays, in one aggregation."""

    def of(kind: str) -> Column:
        return F.col("kind") == kind

    return reaction_refs(posts).groupBy("id").agg(
        F.count_if(of("repost")).alias("in_repost_cnt"),
        F.avg(F.when(of("repost"), F.col("delay"))).alias("in_repost_delay_sec"),
        F.count_if(of("quote")).alias("in_quote_cnt"),
        F.avg(F.when(of("quote"), F.col("delay"))).alias("in_quote_delay_sec"),
        F.count_if(of("reply")).alias("in_reply_cnt"),
    )


def attach_inbound(posts: DataFrame, reacting: DataFrame | None = None, null_delays: bool = False) -> DataFrame:
    """Add inbound measures, 0 when nobody reacted.

    Counts come from ``reacting`` (the whole table by default; pass one batch to count only that
    batch).  ``null_delays`` keeps the mean delay null instead of 0 when nobody reacted.
    """
    inbound = inbound_reactions(posts if reacting is None else reacting)
    joined = posts.join(inbound, "id", "left")
    zero = ["in_repost_cnt", "in_quote_cnt", "in_reply_cnt"]
    if not null_delays:
        zero += ["in_repost_delay_sec", "in_quote_delay_sec"]
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})


def all_tags() -> Column:
    return A.concat_arrays(F.col("original_tags"), F.col("repost_tags"), F.col("quote_tags"))


def conform(posts: DataFrame, folder_name: str | Column, schema: str = CLEAN_POST) -> DataFrame:
    """Exactly the schema's columns, cast; null text becomes ''."""
    run = F.lit(folder_name) if isinstance(folder_name, str) else folder_name
    full = posts.withColumns({"full_text": F.coalesce("full_text", F.lit("")), "folder_name": run})
    return full.select(*conformed(schema))


def flat_posts(raw: DataFrame, min_date=None, max_date=None, dedup: bool = True) -> DataFrame:
    """Flat posts with flags, delays and calendar, without inbound measures."""
    posts = in_date_window(flatten_post(raw), min_date, max_date)
    if dedup:
        posts = first_per_key(posts, ["id"], ["created_at", "user_id"])
    posts = reaction_delays(reaction_flags(posts))
    return posts.withColumns(D.calendar_columns(F.col("created_at")))


def clean_posts(raw: DataFrame, folder_name: str | Column, min_date=None, max_date=None, dedup: bool = True) -> DataFrame:
    """Raw nested posts -> clean post table."""
    return conform(attach_inbound(flat_posts(raw, min_date, max_date, dedup)), folder_name)


def posts_view(posts: DataFrame) -> DataFrame:
    """Clean posts plus the derived columns the reports group by."""
    return posts.withColumns(
        {
            "all_tags": all_tags(),
            "original_mentions_cnt": A.array_len(F.col("original_mentions")),
            "repost_mentions_cnt": A.array_len(F.col("repost_mentions")),
            "quote_mentions_cnt": A.array_len(F.col("quote_mentions")),
            "total_in_cnt": F.col("in_repost_cnt") + F.col("in_reply_cnt") + F.col("in_quote_cnt"),
        }
    )
