"""Account, week, month and table-level rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .skew import lookup_join, number_rows



def _flag_sum(name: str) -> Column:
    return F.count_if(F.col(name))


def reaction_measures() -> dict[str, Column]:
    """Measures shared by the account, tag and week rollups."""
    return {
        "total_out_cnt": F.count(F.lit(1)),
        "original_cnt": _flag_sum("is_original"),
        "out_repost_cnt": _flag_sum("is_repost"),
        "out_reply_cnt": _flag_sum("is_reply"),
        "out_quote_cnt": _flag_sum("is_quote"),
        "in_repost_cnt": F.sum("in_repost_cnt"),
        "in_reply_cnt": F.sum("in_reply_cnt"),
        "in_quote_cnt": F.sum("in_quote_cnt"),
        "in_original_favourite_cnt": F.sum("original_favourite_cnt"),
        "in_repost_favourite_cnt": F.coalesce(F.sum("repost_favourite_cnt"), F.lit(0)),
        "in_quote_favourite_cnt": F.coalesce(F.sum("quote_favourite_cnt"), F.lit(0)),
    }


def aliased(measures: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in measures.items()]


def account_rollup(posts: DataFrame) -> DataFrame:
    """Scalar measures per user; a user's tags, mentions and words are in ``account_bags``."""
    measures = reaction_measures() | {
        "original_mentions_cnt": F.sum("original_mentions_cnt"),
        "repost_mentions_cnt": F.sum("repost_mentions_cnt"),
        "quote_mentions_cnt": F.sum("quote_mentions_cnt"),
        "out_repost_delay_sec": F.avg("repost_delay_sec"),
        "out_quote_delay_sec": F.avg("quote_delay_sec"),
        "in_repost_delay_sec": F.avg("in_repost_delay_sec"),
        "in_quote_delay_sec": F.avg("in_quote_delay_sec"),
    }
    return posts.groupBy("user_id").agg(*aliased(measures))


LIST_COLUMNS = (
    "tags", "original_tags", "repost_tags", "quote_tags",
    "mentions", "original_mentions", "repost_mentions", "quote_mentions", "lemmas",
)


def account_bags(posts: DataFrame, lists: Sequence[str] = LIST_COLUMNS, key: str = "user_id") -> DataFrame:
    """(user, list, item, n): the concatenated lists of a user as counted items.

    The list itself can outgrow a row for a very active user; the bag cannot.
    """
    present = [c for c in lists if c in posts.columns]
    long = posts.select(
        key,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("list"), F.col(c).alias("items")) for c in present])
        ).alias("l"),
    ).select(key, "l.list", F.explode("l.items").alias("item"))
    return long.groupBy(key, "list", "item").agg(F.count(F.lit(1)).alias("n"))


def concat_lists(
    df: DataFrame,
    keys: Sequence[str],
    items: str,
    order: Sequence[str],
    bucket: Column,
    chunk: int = 10_000,
) -> DataFrame:
    """Concatenate arrays per key in ``order``, as numbered chunks of at most ``chunk`` items.

    Chunks 0, 1, ... of a key, put one after the other, are the whole list; no row or task ever
    holds more than one chunk of it.
    """
    rows = df.select(*keys, *order, bucket.alias("_b"), F.posexplode(items).alias("_i", "item"))
    numbered = number_rows(rows, keys, [*order, "_i"], F.col("_b"), "_pos", 0)
    return (
        numbered.withColumn("chunk", F.floor(F.col("_pos") / chunk))
        .groupBy(*keys, "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "item"))).alias("_l"))
        .select(*keys, "chunk", F.transform("_l", lambda x: x["item"]).alias("items"))
    )


def account_view(accounts: DataFrame, rollup: DataFrame) -> DataFrame:
    """Accounts with their rollup: counts of silent accounts are 0, means stay null."""
    counts = [c for c in rollup.columns if c.endswith("_cnt")]
    joined = accounts.drop("created_at").join(rollup, "user_id", "left")
    joined = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})
    return joined.withColumn(
        "total_in_cnt", F.col("in_repost_cnt") + F.col("in_reply_cnt") + F.col("in_quote_cnt")
    )


def posts_with_accounts(posts: DataFrame, accounts: DataFrame, suffix: str = "_user") -> DataFrame:
    """Inner join on user_id; account columns that clash with post columns get the suffix."""
    clash = {c: c + suffix for c in accounts.columns if c in posts.columns and c != "user_id"}
    return lookup_join(posts, accounts.withColumnsRenamed(clash), "user_id", "inner")


def active_accounts(posts: DataFrame, accounts: DataFrame, name: str = "total_posts") -> DataFrame:
    """Accounts with at least one post, with their number of posts."""
    per_user = posts.groupBy("user_id").agg(F.count(F.lit(1)).alias(name))
    return per_user.join(accounts, "user_id", "inner")


def validated_one_to_many(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join that fails the job if ``key`` is not unique on the left."""
    counted = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    checked = counted.select(
        key, F.assert_true(F.col("_n") == 1, F.lit(f"{key} is not unique on the left side")).alias("_ok")
    ).filter(F.col("_ok").isNull())
    return left.join(checked.drop("_ok"), key, "inner").join(right, key, how)


def resolve_names(edges: DataFrame, accounts: DataFrame, src: str = "user_id", dst_name: str = "mention") -> DataFrame:
    """(user id, mentioned screen name) with both accounts' fields as ``_source`` / ``_target``."""
    a = accounts.select("user_id", "screen_name", "followers_count")
    source = a.select(F.col("user_id").alias(src), F.col("screen_name").alias("screen_name_source"),
                      F.col("followers_count").alias("followers_source"))
    target = a.select(F.col("screen_name").alias(dst_name), F.col("user_id").alias("user_id_target"),
                      F.col("followers_count").alias("followers_target"))
    return lookup_join(lookup_join(edges, source, src, "inner"), target, dst_name, "left")


def name_or_id(df: DataFrame, accounts: DataFrame, id_col: str, out: str) -> DataFrame:
    """Look an id's screen name up; an unknown account keeps its id as text."""
    names = accounts.select(F.col("user_id").alias(id_col), F.col("screen_name").alias("_name"))
    joined = lookup_join(df, names, id_col, "left")
    return joined.withColumn(out, F.coalesce("_name", F.col(id_col).cast("string"))).drop("_name")


def week_rollup(posts: DataFrame) -> DataFrame:
    measures = reaction_measures() | {
        "total_in_cnt": F.sum("total_in_cnt"),
        "user_cnt": F.count_distinct("user_id"),
        "out_repost_delay_sec": F.avg("repost_delay_sec"),
        "out_quote_delay_sec": F.avg("quote_delay_sec"),
        "in_repost_delay_sec": F.avg("in_repost_delay_sec"),
        "in_quote_delay_sec": F.avg("in_quote_delay_sec"),
        "first_post": F.min("created_at"),
    }
    return posts.groupBy("week_name").agg(*aliased(measures))


def month_user_rollup(posts: DataFrame) -> DataFrame:
    """Here an original is neither a repost nor a reply."""
    r = posts.groupBy("month_name", "screen_name").agg(
        F.count(F.lit(1)).alias("total_out_cnt"),
        _flag_sum("is_repost").alias("out_repost_cnt"),
        _flag_sum("is_reply").alias("out_reply_cnt"),
        _flag_sum("is_quote").alias("out_quote_cnt"),
    )
    return r.withColumn(
        "pure_original_cnt", F.col("total_out_cnt") - (F.col("out_repost_cnt") + F.col("out_reply_cnt"))
    )


def favourites_rollup(posts: DataFrame) -> DataFrame:
    """(month, user, sensitive) base of the favourites reports, in one pass."""
    return posts.groupBy("month_name", "screen_name", "possibly_sensitive").agg(
        F.count(F.lit(1)).alias("posts"), F.sum("original_favourite_cnt").alias("favourites")
    )


def favourites_levels(base: DataFrame) -> DataFrame:
    """The coarser favourites rollups of one base as one grouping-sets query."""
    level = (
        F.when(F.grouping("screen_name") == 1, "month_sensitive")
        .when(F.grouping("month_name") == 1, "user")
        .otherwise("month_user")
    )
    return base.groupingSets(
        [["month_name", "possibly_sensitive"], ["screen_name"], ["month_name", "screen_name"]],
        "month_name", "screen_name", "possibly_sensitive",
    ).agg(
        level.alias("level"), F.sum("posts").alias("posts"), F.sum("favourites").alias("favourites")
    )


def favourites_by_tag(posts: DataFrame, by: Sequence[str] = ("tag",)) -> DataFrame:
    """Each tag occurrence of a (month, user, sensitive) group gets the group's whole favourite sum."""
    group = ["month_name", "screen_name", "possibly_sensitive"]
    base = favourites_rollup(posts)
    uses = posts.select(*group, F.explode("all_tags").alias("tag")).groupBy(*group, "tag").agg(
        F.count(F.lit(1)).alias("uses")
    )
    joined = uses.join(base, group, "inner")
    return joined.groupBy(*by).agg(
        F.sum("uses").alias("uses"), F.sum(F.col("uses") * F.col("favourites")).alias("favourites")
    )


def value_counts(df: DataFrame, *cols: str, name: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *cols)


def table_kpis(posts: DataFrame) -> DataFrame:
    """(metric, value) in one aggregation."""
    row = posts.agg(
        F.count_distinct("user_id").cast("double").alias("users"),
        F.count(F.lit(1)).cast("double").alias("posts"),
        F.try_divide(F.lit(100.0) * _flag_sum("is_original"), F.count(F.lit(1))).alias("original_pct"),
        F.try_divide(F.lit(100.0) * _flag_sum("is_repost"), F.count(F.lit(1))).alias("repost_pct"),
        F.sum("in_repost_cnt").cast("double").alias("in_reposts"),
        F.sum("in_reply_cnt").cast("double").alias("in_replies"),
        F.sum("in_quote_cnt").cast("double").alias("in_quotes"),
        F.sum("original_favourite_cnt").cast("double").alias("favourites"),
        F.unix_timestamp(F.min("created_at")).cast("double").alias("first_post_epoch"),
        F.unix_timestamp(F.max("created_at")).cast("double").alias("last_post_epoch"),
    )
    return row.unpivot([], row.columns, "metric", "value")


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence, measure: Column | None = None) -> DataFrame:
    """Wide table with listed column values, so no extra job has to find them; absent cells are 0."""
    measure = F.count(F.lit(1)) if measure is None else measure
    wide = df.groupBy(row).pivot(column, list(values)).agg(measure)
    return wide.na.fill(0)


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """Whole-table top k; Spark takes k per partition first."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, groups: Sequence[str], order: Sequence, k: int, rank: str = "rank") -> DataFrame:
    """First k rows per group; Spark limits each group before the shuffle, so a hot group is cheap."""
    w = W.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def fastest_reactors(view: DataFrame, count: str, delay: str, k: int = 12, negate: bool = False) -> DataFrame:
    """Top k by inbound count, then by mean delay, with the log2 of the delay (null for 0)."""
    leaders = view.filter(F.col(delay).isNotNull()).orderBy(F.desc(count), "user_id").limit(k)
    log = F.log2(F.nullif(F.col(delay), F.lit(0.0)))
    return leaders.withColumn("log2_delay", -log if negate else log).orderBy(F.asc(delay), "user_id")


def dominant_pair_filter(pairs: DataFrame, share: float = 0.8) -> DataFrame:
    """Drop (src, dst) pairs that make up more than ``share`` of everything the source has."""
    counted = pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_n"))
    totals = counted.groupBy("src").agg(F.sum("_n").alias("_total"))
    fans = lookup_join(counted, totals, "src", "inner").filter(F.col("_n") > share * F.col("_total"))
    return lookup_join(pairs, fans.select("src", "dst"), ["src", "dst"], "left_anti")


def busiest_fortnight(posts: DataFrame, days: int = 14) -> DataFrame:
    """Per user the most posts in any ``days`` days ending at a post.

    Posts are first counted per second; each span of ``days`` gets a copy of the one before it,
    so a window task holds two spans of seconds, never the whole history of a busy user.
    """
    span = days * 86_400
    per_sec = posts.groupBy("user_id", F.unix_timestamp("created_at").alias("sec")).agg(
        F.count(F.lit(1)).alias("n")
    )
    block = F.floor(F.col("sec") / span)
    haloed = per_sec.withColumn("block", F.explode(F.array(block, block + 1)))
    w = W.partitionBy("user_id", "block").orderBy("sec").rangeBetween(-span + 1, 0)
    counted = haloed.withColumn("in_span", F.sum("n").over(w)).filter(F.col("block") == block)
    return counted.groupBy("user_id").agg(F.max("in_span").alias("max_posts"))
