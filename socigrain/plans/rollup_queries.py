"""Joins, rollups, ordered functions and top-k over the social tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import percent
from ..operators import baseline as B, edges as ED, posts as P, rollups as R, stats as ST, tags as TG, text as TX
from ..operators.skew import lookup_join, with_group_totals
from ..session import cut
from . import adapter as ad
from .adapter import ACCOUNTS, EV, FLAT, PAIRS, POSTS, with_ctes as sql
from .registry import query

TAGGED = "tagged AS (SELECT unnest(all_tags) AS tag, * FROM posts)"
TAGGED_FLAT = "tagged AS (SELECT unnest(all_tags) AS tag, * FROM flat)"


def tagged(spark, sf):
    return TG.explode_tags(ad.posts(spark, sf))


def tagged_flat(spark, sf):
    return TG.explode_tags(ad.flat(spark, sf))


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def big(*names):
    """SQL sums as BIGINT."""
    return ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)


# ------------------------------------------------------------------ J: joins
@query("J01_posts_with_accounts", sql(POSTS, ACCOUNTS, select="""
  SELECT p.id, p.user_id, p.screen_name, a.screen_name AS screen_name_user, a.followers_count, a.clean_location
  FROM posts p JOIN accounts a ON a.user_id = p.user_id"""))
def _(spark, sf):
    j = R.posts_with_accounts(ad.posts(spark, sf), ad.accounts(spark, sf).drop("created_at"))
    return j.select("id", "user_id", "screen_name", "screen_name_user", "followers_count", "clean_location")


@query("J02_active_accounts", sql(EV, ACCOUNTS, select="SELECT a.user_id, a.screen_name, count(*) AS total_posts FROM ev JOIN accounts a ON a.user_id = ev.user_id GROUP BY 1, 2"))
def _(spark, sf):
    return R.active_accounts(ad.activity(spark, sf), ad.accounts(spark, sf)).select("user_id", "screen_name", "total_posts")


@query("J03_attach_inbound", sql(POSTS, select="""
  SELECT id, in_repost_cnt, in_quote_cnt, in_reply_cnt, round(in_repost_delay_sec, 6) AS in_repost_delay_sec,
         round(in_quote_delay_sec, 6) AS in_quote_delay_sec FROM posts"""))
def _(spark, sf):
    p = ad.posts(spark, sf).select("id", "in_repost_cnt", "in_quote_cnt", "in_reply_cnt", "in_repost_delay_sec", "in_quote_delay_sec")
    return rounded(p, "in_repost_delay_sec", "in_quote_delay_sec")


@query("J03_attach_inbound_null_delays", sql(POSTS, select="SELECT f.id, round(i.in_repost_delay_sec, 6) AS in_repost_delay_sec FROM flat f LEFT JOIN inb i ON i.ref = f.id"))
def _(spark, sf):
    f = ad.flat(spark, sf)
    return rounded(P.attach_inbound(f, null_delays=True).select("id", "in_repost_delay_sec"), "in_repost_delay_sec")


@query("J04_repost_edge_join", sql(FLAT, ACCOUNTS, select="""
  SELECT f.id AS repost_id, f.repost_of_user_id AS src, f.user_id AS dst, s.screen_name AS src_name, d.screen_name AS dst_name
  FROM flat f JOIN accounts d ON d.user_id = f.user_id JOIN accounts s ON s.user_id = f.repost_of_user_id
  WHERE f.is_repost AND f.repost_of_user_id <> f.user_id"""))
def _(spark, sf):
    return ED.repost_edges(ad.accounts(spark, sf), ad.flat(spark, sf)).select("repost_id", "src", "dst", "src_name", "dst_name")


@query("J05_resolve_mention_names", sql(FLAT, ACCOUNTS, select="""
  SELECT f.id, f.user_id, m.mention, s.screen_name AS screen_name_source, t.user_id AS user_id_target, t.followers_count AS followers_target
  FROM (SELECT id, user_id, unnest(original_mentions) AS mention FROM flat) m JOIN flat f ON f.id = m.id
  JOIN accounts s ON s.user_id = f.user_id LEFT JOIN accounts t ON t.screen_name = m.mention"""))
def _(spark, sf):
    m = ad.flat(spark, sf).select("id", "user_id", F.explode("original_mentions").alias("mention"))
    return R.resolve_names(m, ad.accounts(spark, sf)).select(
        "id", "user_id", "mention", "screen_name_source", "user_id_target", "followers_target")


@query("J06_name_or_id", sql(FLAT, ACCOUNTS, select="""
  SELECT f.id, CASE WHEN is_reply THEN 'reply' ELSE 'repost' END AS kind, coalesce(a.screen_name, CAST(f.target AS VARCHAR)) AS target_name
  FROM (SELECT id, is_reply, CASE WHEN is_reply THEN reply_to_user_id ELSE repost_of_user_id END AS target FROM flat WHERE is_reply OR is_repost) f
  LEFT JOIN accounts a ON a.user_id = f.target AND NOT a.protected"""))
def _(spark, sf):
    """Accounts that replies and reposts go to; a protected account's name is unknown."""
    flat = ad.flat(spark, sf).filter("is_reply OR is_repost")
    target = F.when(F.col("is_reply"), F.col("reply_to_user_id")).otherwise(F.col("repost_of_user_id"))
    aimed = flat.select("id", F.when(F.col("is_reply"), "reply").otherwise("repost").alias("kind"), target.alias("target"))
    return R.name_or_id(aimed, ad.accounts(spark, sf).filter("NOT protected"), "target", "target_name").select("id", "kind", "target_name")


@query("J07_validated_one_to_many", "SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey")
def _(spark, sf):
    c = ad.table(spark, sf, "customer").select("c_custkey")
    o = ad.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return R.validated_one_to_many(c, o, "c_custkey", "inner")


@query("J08_text_enrichment", sql(FLAT, select="SELECT id, CASE WHEN lang = 'en' THEN array_to_string(words_, ' ') ELSE '' END AS lemmas FROM (SELECT id, lang, all_tags AS words_ FROM flat)"))
def _(spark, sf):
    f = ad.flat(spark, sf)
    lemmas = f.filter("lang = 'en'").select("id", F.col("all_tags").alias("lemmas"))
    return TX.enrich_with(f.select("id"), lemmas).select("id", F.array_join("lemmas", " ").alias("lemmas"))


@query("J09_top_k_with_profile", sql(EV, ACCOUNTS, select="""
  SELECT t.user_id, n, a.name, a.description FROM (SELECT user_id, count(*) AS n FROM ev GROUP BY 1 ORDER BY n DESC, user_id LIMIT 20) t
  JOIN accounts a ON a.user_id = t.user_id"""))
def _(spark, sf):
    ranked = R.top_k(R.value_counts(ad.activity(spark, sf), "user_id"), 20, F.desc("n"), "user_id")
    return ad.accounts(spark, sf).select("user_id", "name", "description").join(F.broadcast(ranked), "user_id", "inner")


@query("J10_aligned_assignment", sql(EV, ACCOUNTS, select="""
  SELECT a.user_id, coalesce(n, 0) AS posts FROM accounts a LEFT JOIN (SELECT user_id, count(*) AS n FROM ev GROUP BY 1) e ON e.user_id = a.user_id"""))
def _(spark, sf):
    n = ad.activity(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return ad.accounts(spark, sf).join(n, "user_id", "left").select("user_id", F.coalesce("n", F.lit(0)).alias("posts"))


@query("J11_set_difference", sql(EV, ACCOUNTS, select="SELECT user_id FROM accounts WHERE user_id NOT IN (SELECT user_id FROM ev) AND user_id NOT IN (SELECT user_id FROM accounts WHERE protected)"))
def _(spark, sf):
    a = ad.accounts(spark, sf)
    return B.without_ids(a.select("user_id"), ad.activity(spark, sf).select("user_id"), a.filter("protected").select("user_id"))


# ------------------------------------------------------------------ A: aggregations
ROLL = ["total_out_cnt", "original_cnt", "out_repost_cnt", "out_reply_cnt", "out_quote_cnt"]
ROLL_SQL = """count(*) AS total_out_cnt, count(*) FILTER (is_original) AS original_cnt, count(*) FILTER (is_repost) AS out_repost_cnt,
  count(*) FILTER (is_reply) AS out_reply_cnt, count(*) FILTER (is_quote) AS out_quote_cnt,
  CAST(sum(in_repost_cnt) AS BIGINT) AS in_repost_cnt, CAST(sum(in_reply_cnt) AS BIGINT) AS in_reply_cnt,
  CAST(sum(in_quote_cnt) AS BIGINT) AS in_quote_cnt, CAST(sum(original_favourite_cnt) AS BIGINT) AS in_original_favourite_cnt,
  CAST(coalesce(sum(repost_favourite_cnt), 0) AS BIGINT) AS in_repost_favourite_cnt,
  CAST(coalesce(sum(quote_favourite_cnt), 0) AS BIGINT) AS in_quote_favourite_cnt"""
ACC_SQL = ROLL_SQL + """, CAST(sum(original_mentions_cnt) AS BIGINT) AS original_mentions_cnt,
  CAST(sum(repost_mentions_cnt) AS BIGINT) AS repost_mentions_cnt, CAST(sum(quote_mentions_cnt) AS BIGINT) AS quote_mentions_cnt,
  round(avg(repost_delay_sec), 4) AS out_repost_delay_sec, round(avg(quote_delay_sec), 4) AS out_quote_delay_sec,
  round(avg(in_repost_delay_sec), 4) AS in_repost_delay_sec, round(avg(in_quote_delay_sec), 4) AS in_quote_delay_sec"""
DELAYS = ["out_repost_delay_sec", "out_quote_delay_sec", "in_repost_delay_sec", "in_quote_delay_sec"]


@query("A01_account_rollup", sql(POSTS, select=f"SELECT user_id, {ACC_SQL} FROM posts GROUP BY user_id"))
def _(spark, sf):
    return rounded(R.account_rollup(ad.posts(spark, sf)), *DELAYS, digits=4)


@query("A01_account_bags", sql(POSTS, select="""
  SELECT user_id, list, item, count(*) AS n FROM (
    SELECT user_id, 'tags' AS list, unnest(tags) AS item FROM posts UNION ALL SELECT user_id, 'original_tags', unnest(original_tags) FROM posts
    UNION ALL SELECT user_id, 'repost_tags', unnest(repost_tags) FROM posts UNION ALL SELECT user_id, 'quote_tags', unnest(quote_tags) FROM posts
    UNION ALL SELECT user_id, 'mentions', unnest(mentions) FROM posts UNION ALL SELECT user_id, 'original_mentions', unnest(original_mentions) FROM posts
    UNION ALL SELECT user_id, 'repost_mentions', unnest(repost_mentions) FROM posts UNION ALL SELECT user_id, 'quote_mentions', unnest(quote_mentions) FROM posts)
  GROUP BY 1, 2, 3"""))
def _(spark, sf):
    return R.account_bags(ad.flat(spark, sf))


@query("A02_account_view", sql(POSTS, ACCOUNTS, select=f"""
  , r AS (SELECT user_id, {ACC_SQL} FROM posts GROUP BY user_id)
  SELECT a.user_id, a.screen_name, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ROLL + ['in_repost_cnt', 'in_reply_cnt', 'in_quote_cnt'])},
         coalesce(in_repost_cnt + in_reply_cnt + in_quote_cnt, 0) AS total_in_cnt, out_repost_delay_sec, in_repost_delay_sec
  FROM accounts a LEFT JOIN r ON r.user_id = a.user_id"""))
def _(spark, sf):
    v = R.account_view(ad.accounts(spark, sf), R.account_rollup(ad.posts(spark, sf)))
    return rounded(v.select("user_id", "screen_name", *ROLL, "in_repost_cnt", "in_reply_cnt", "in_quote_cnt", "total_in_cnt",
                            "out_repost_delay_sec", "in_repost_delay_sec"), "out_repost_delay_sec", "in_repost_delay_sec", digits=4)


@query("A03_inbound_reactions", sql(POSTS, select="""
  SELECT ref AS id, in_repost_cnt, round(in_repost_delay_sec, 6) AS in_repost_delay_sec, in_quote_cnt,
         round(in_quote_delay_sec, 6) AS in_quote_delay_sec, in_reply_cnt FROM inb"""))
def _(spark, sf):
    return rounded(P.inbound_reactions(ad.flat(spark, sf)), "in_repost_delay_sec", "in_quote_delay_sec")


TAG_MEANS = ["followers_cnt", "friends_cnt", "in_repost_delay_sec", "in_quote_delay_sec"]
TUD = f"""tud AS (SELECT year, month, week, day, tag, t.screen_name, {ROLL_SQL}, CAST(sum(total_in_cnt) AS BIGINT) AS total_in_cnt,
  avg(a.followers_count) AS followers_cnt, avg(a.friends_count) AS friends_cnt,
  avg(in_repost_delay_sec) AS in_repost_delay_sec, avg(in_quote_delay_sec) AS in_quote_delay_sec
  FROM tagged t JOIN accounts a ON a.user_id = t.user_id GROUP BY ALL)"""


def _tud(spark, sf):
    a = ad.accounts(spark, sf).select("user_id", "followers_count", "friends_count")
    return TG.tag_user_day_rollup(lookup_join(tagged(spark, sf), a, "user_id", "inner"))


@query("A04_tag_user_day_rollup", sql(POSTS, ACCOUNTS, TAGGED, TUD, select="SELECT * REPLACE (" + ", ".join(f"round({c}, 4) AS {c}" for c in TAG_MEANS) + ") FROM tud"))
def _(spark, sf):
    return rounded(_tud(spark, sf), *TAG_MEANS, digits=4)


SUMS = ROLL + ["in_repost_cnt", "in_reply_cnt", "in_quote_cnt", "in_original_favourite_cnt", "in_repost_favourite_cnt", "in_quote_favourite_cnt", "total_in_cnt"]


@query("A05_tag_rollup", sql(POSTS, ACCOUNTS, TAGGED, TUD, select=f"SELECT tag, {big(*SUMS)}, " + ", ".join(f"round(avg({c}), 4) AS {c}" for c in TAG_MEANS) + " FROM tud GROUP BY tag"))
def _(spark, sf):
    return rounded(TG.tag_rollup(_tud(spark, sf)), *TAG_MEANS, digits=4)


TAG_DAY = """tag_day AS (SELECT day_name, tag, count(*) AS tag_cnt, count(DISTINCT user_id) AS user_cnt,
  CAST(sum(original_favourite_cnt) AS BIGINT) AS favourite_cnt, CAST(sum(total_in_cnt) AS BIGINT) AS total_in_cnt,
  count(*) FILTER (is_original) AS original_cnt, count(*) FILTER (is_repost) AS out_repost_cnt, count(*) FILTER (is_reply) AS out_reply_cnt,
  count(*) FILTER (is_quote) AS out_quote_cnt, CAST(sum(in_repost_cnt) AS BIGINT) AS in_repost_cnt,
  CAST(sum(in_reply_cnt) AS BIGINT) AS in_reply_cnt, CAST(sum(in_quote_cnt) AS BIGINT) AS in_quote_cnt,
  CAST(coalesce(sum(repost_favourite_cnt), 0) AS BIGINT) AS in_repost_favourite_cnt,
  CAST(coalesce(sum(quote_favourite_cnt), 0) AS BIGINT) AS in_quote_favourite_cnt,
  round(avg(in_repost_delay_sec), 4) AS in_repost_delay_sec, round(avg(in_quote_delay_sec), 4) AS in_quote_delay_sec
  FROM tagged GROUP BY day_name, tag)"""


@query("A06_tag_day_rollup", sql(POSTS, TAGGED, TAG_DAY, select="SELECT * FROM tag_day"))
def _(spark, sf):
    return rounded(TG.tag_day_rollup(tagged(spark, sf)), "in_repost_delay_sec", "in_quote_delay_sec", digits=4)


LEVELS = {"week": "week_name", "month": "month_name", "total": "'all'"}


@query("A06_rolled_up_users", sql(FLAT, TAGGED_FLAT, select=" UNION ALL ".join(
    f"SELECT '{level}' AS level, {period} AS period, tag, count(*) AS tag_cnt, count(DISTINCT user_id) AS user_cnt, true AS within_error FROM tagged GROUP BY ALL"
    for level, period in LEVELS.items())))
def _(spark, sf):
    """Users per tag and period from the sketches of days, held against the exact counts at five standard errors."""
    t = tagged_flat(spark, sf).select("day_name", "week_name", "month_name", "tag", "user_id")
    days = cut(TG.user_sketches(t, ["day_name", "week_name", "month_name", "tag"]), "sketches")
    exact, rolled = [], []
    for level, period in LEVELS.items():
        keys = [F.lit(level).alias("level"), F.expr(period).alias("period"), "tag"]
        rolled.append(TG.estimated_users(TG.roll_up_users(days, keys)).withColumnRenamed("user_cnt", "estimate"))
        exact.append(t.groupBy(*keys).agg(F.count_distinct("user_id").alias("user_cnt")))
    joined = reduce(DataFrame.unionByName, rolled).join(reduce(DataFrame.unionByName, exact), ["level", "period", "tag"], "full")
    off = F.abs(F.col("estimate") - F.col("user_cnt"))
    return joined.withColumn("within_error", off <= F.col("user_cnt") * (5 * TG.sketch_error())).drop("estimate")


POPULARITY = """pop0 AS (SELECT tag, CAST(sum(tag_cnt) AS BIGINT) AS tag_cnt, CAST(sum(favourite_cnt) AS BIGINT) AS favourite_cnt,
  CAST(sum(user_cnt) AS BIGINT) AS user_days FROM tag_day GROUP BY tag),
pop AS (SELECT *, user_days / tag_cnt AS alpha, tag_cnt / (SELECT sum(tag_cnt) FROM pop0) AS beta, favourite_cnt AS gamma FROM pop0)"""


@query("A07_tag_popularity", sql(POSTS, TAGGED, TAG_DAY, POPULARITY, select="""
  SELECT tag, tag_cnt, favourite_cnt, user_days, round(alpha, 6) AS alpha, round(beta, 6) AS beta, gamma,
         round(alpha * (1 / (SELECT max(alpha) FROM pop)), 6) AS alpha_n, round(beta * (1 / (SELECT max(beta) FROM pop)), 6) AS beta_n,
         round(gamma * (1 / (SELECT max(gamma) FROM pop)), 6) AS gamma_n FROM pop"""))
def _(spark, sf):
    return rounded(TG.tag_popularity(TG.tag_day_rollup(tagged(spark, sf))), "alpha", "beta", "alpha_n", "beta_n", "gamma_n")


@query("A08_week_rollup", sql(POSTS, select=f"""
  SELECT week_name, {ROLL_SQL}, CAST(sum(total_in_cnt) AS BIGINT) AS total_in_cnt, count(DISTINCT user_id) AS user_cnt,
         round(avg(repost_delay_sec), 3) AS out_repost_delay_sec, round(avg(quote_delay_sec), 3) AS out_quote_delay_sec,
         round(avg(in_repost_delay_sec), 3) AS in_repost_delay_sec, round(avg(in_quote_delay_sec), 3) AS in_quote_delay_sec,
         strftime(min(created_at), '%Y-%m-%d %H:%M:%S') AS first_post FROM posts GROUP BY week_name"""))
def _(spark, sf):
    w = R.week_rollup(ad.posts(spark, sf)).withColumn("first_post", F.date_format("first_post", "yyyy-MM-dd HH:mm:ss"))
    return rounded(w, *DELAYS, digits=3)


@query("A09_month_user_rollup", sql(FLAT, select="""
  SELECT month_name, screen_name, count(*) AS total_out_cnt, count(*) FILTER (is_repost) AS out_repost_cnt, count(*) FILTER (is_reply) AS out_reply_cnt,
         count(*) FILTER (is_quote) AS out_quote_cnt, count(*) FILTER (NOT is_repost AND NOT is_reply) AS pure_original_cnt
  FROM flat GROUP BY 1, 2"""))
def _(spark, sf):
    return R.month_user_rollup(ad.flat(spark, sf))


FAV = "fav AS (SELECT month_name, screen_name, possibly_sensitive, count(*) AS posts, CAST(sum(original_favourite_cnt) AS BIGINT) AS favourites FROM flat GROUP BY 1, 2, 3)"


@query("A10_favourites_rollup", sql(FLAT, FAV, select="SELECT * FROM fav"))
def _(spark, sf):
    return R.favourites_rollup(ad.flat(spark, sf))


@query("A10_favourites_levels", sql(FLAT, FAV, select=f"""
  SELECT 'month_sensitive' AS level, month_name, NULL AS screen_name, possibly_sensitive, {big('posts', 'favourites')} FROM fav GROUP BY month_name, possibly_sensitive
  UNION ALL SELECT 'user', NULL, screen_name, NULL, {big('posts', 'favourites')} FROM fav GROUP BY screen_name
  UNION ALL SELECT 'month_user', month_name, screen_name, NULL, {big('posts', 'favourites')} FROM fav GROUP BY month_name, screen_name"""))
def _(spark, sf):
    return R.favourites_levels(R.favourites_rollup(ad.flat(spark, sf)))


@query("A10_favourites_by_tag", sql(FLAT, FAV, TAGGED_FLAT, select="""
  SELECT month_name, tag, CAST(sum(uses) AS BIGINT) AS uses, CAST(sum(uses * favourites) AS BIGINT) AS favourites FROM (
    SELECT t.month_name, t.screen_name, t.possibly_sensitive, tag, count(*) AS uses FROM tagged t GROUP BY 1, 2, 3, 4) u
  JOIN fav USING (month_name, screen_name, possibly_sensitive) GROUP BY 1, 2"""))
def _(spark, sf):
    return R.favourites_by_tag(ad.flat(spark, sf), ["month_name", "tag"])


@query("A11_tag_composition", sql(FLAT, TAGGED_FLAT, select="""
  SELECT year, month, tag, count(*) AS total_cnt, count(*) FILTER (is_repost) AS repost_cnt, count(*) FILTER (is_reply) AS reply_cnt,
         count(*) - count(*) FILTER (is_repost) - count(*) FILTER (is_reply) AS pure_original_cnt FROM tagged GROUP BY 1, 2, 3"""))
def _(spark, sf):
    return TG.tag_composition(tagged_flat(spark, sf), ["year", "month", "tag"])


SHARE = """share AS (SELECT *, user_tag_cnt / total_tag_cnt AS user_pct, user_tag_cnt / sum(user_tag_cnt) OVER m AS tag_pct,
  CAST(sum(user_tag_cnt) OVER m AS BIGINT) AS month_tag_cnt, 1 / count(*) OVER m AS avg_tag_pct, avg(user_tag_cnt / total_tag_cnt) OVER m AS avg_user_pct
  FROM (SELECT tag, year, month, screen_name, CAST(sum(original_favourite_cnt) AS BIGINT) AS favourite_cnt, count(*) FILTER (is_original) AS original_cnt,
          count(*) FILTER (is_repost) AS repost_cnt, count(*) FILTER (is_reply) AS reply_cnt, count(*) AS user_tag_cnt, count(*) AS total_tag_cnt
        FROM tagged GROUP BY 1, 2, 3, 4) WINDOW m AS (PARTITION BY tag, year, month))"""


@query("A12_tag_user_share", sql(FLAT, TAGGED_FLAT, SHARE, select="SELECT * REPLACE (round(user_pct, 6) AS user_pct, round(tag_pct, 6) AS tag_pct, round(avg_tag_pct, 6) AS avg_tag_pct, round(avg_user_pct, 6) AS avg_user_pct) FROM share"))
def _(spark, sf):
    return rounded(TG.tag_user_share(tagged_flat(spark, sf)), "user_pct", "tag_pct", "avg_tag_pct", "avg_user_pct")


def _damped_sql(pct, limit):
    return sql(FLAT, TAGGED_FLAT, SHARE, select=f"""
  , d AS (SELECT tag, year, month, screen_name, favourite_cnt, original_cnt, CASE WHEN {pct} > {limit} THEN 1 ELSE user_tag_cnt END AS user_tag_cnt,
            CASE WHEN {pct} > {limit} AND repost_cnt > 0 THEN 1 ELSE repost_cnt END AS repost_cnt,
            CASE WHEN {pct} > {limit} AND reply_cnt > 0 THEN 1 ELSE reply_cnt END AS reply_cnt FROM share),
  e AS (SELECT *, original_cnt + reply_cnt AS total_tag_cnt, user_tag_cnt / nullif(original_cnt + reply_cnt, 0) AS user_pct FROM d)
  SELECT * REPLACE (round(user_pct, 6) AS user_pct), CAST(sum(user_tag_cnt) OVER m AS BIGINT) AS month_tag_cnt,
         round(avg(user_pct) OVER m, 6) AS avg_user_pct, round(user_tag_cnt / sum(user_tag_cnt) OVER m, 6) AS tag_pct
  FROM e WINDOW m AS (PARTITION BY tag, year, month)""")


@query("A13_spam_damping", _damped_sql("tag_pct", 0.01))
def _(spark, sf):
    return rounded(TG.spam_damping(TG.tag_user_share(tagged_flat(spark, sf)), "tag_pct", 0.01), "user_pct", "avg_user_pct", "tag_pct")


@query("A13_spam_damping_literal", _damped_sql("user_pct", 0.5))
def _(spark, sf):
    return rounded(TG.spam_damping(TG.tag_user_share(tagged_flat(spark, sf)), "user_pct"), "user_pct", "avg_user_pct", "tag_pct")


@query("A14_user_share_of_tag", sql(FLAT, TAGGED_FLAT, select="""
  SELECT tag, screen_name, user_tag_cnt, CAST(sum(user_tag_cnt) OVER t AS BIGINT) AS total_tag_cnt,
         round(user_tag_cnt / sum(user_tag_cnt) OVER t, 6) AS user_pct, round(1 / count(*) OVER t, 6) AS avg_user_pct
  FROM (SELECT tag, screen_name, count(*) AS user_tag_cnt FROM tagged GROUP BY 1, 2) WINDOW t AS (PARTITION BY tag)"""))
def _(spark, sf):
    return rounded(TG.user_share_of_tag(tagged_flat(spark, sf)), "user_pct", "avg_user_pct")


@query("A15_value_counts", sql(EV, PAIRS, select="SELECT src, kind, count(*) AS n FROM pairs GROUP BY 1, 2"))
def _(spark, sf):
    return R.value_counts(ad.reaction_pairs(spark, sf), "src", "kind")


@query("A16_table_kpis", sql(POSTS, select="""
  , k AS (SELECT CAST(count(DISTINCT user_id) AS DOUBLE) AS users, CAST(count(*) AS DOUBLE) AS posts, round(100.0::DOUBLE * count(*) FILTER (is_original) / count(*), 6) AS original_pct,
     round(100.0::DOUBLE * count(*) FILTER (is_repost) / count(*), 6) AS repost_pct, CAST(sum(in_repost_cnt) AS DOUBLE) AS in_reposts, CAST(sum(in_reply_cnt) AS DOUBLE) AS in_replies,
     CAST(sum(in_quote_cnt) AS DOUBLE) AS in_quotes, CAST(sum(original_favourite_cnt) AS DOUBLE) AS favourites,
     CAST(epoch(min(created_at)) AS DOUBLE) AS first_post_epoch, CAST(epoch(max(created_at)) AS DOUBLE) AS last_post_epoch FROM posts)
  SELECT metric, value FROM k UNPIVOT (value FOR metric IN (COLUMNS(*)))"""))
def _(spark, sf):
    return rounded(R.table_kpis(ad.posts(spark, sf)), "value")


DESCRIBED = {"lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]}


@query("A17_describe", "SELECT measure, count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min, max(v) AS max, "
       "round(quantile_cont(v, 0.3), 6) AS p30, round(quantile_cont(v, 0.6), 6) AS p60, round(quantile_cont(v, 0.9), 6) AS p90 FROM ("
       + " UNION ALL ".join(f"SELECT '{c}' AS measure, {c} AS v FROM lineitem" for c in DESCRIBED["lineitem"]) + ") GROUP BY measure")
def _(spark, sf):
    d = ST.describe(ad.table(spark, sf, "lineitem"), DESCRIBED["lineitem"])
    return rounded(rounded(d, "mean", "std", digits=4), "p30", "p60", "p90")


@query("A18_descriptor", """
  SELECT user_id, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
         round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS median,
         round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY user_id""")
def _(spark, sf):
    d = ST.descriptor(ad.table(spark, sf, "events"), "value", ["user_id"])
    return rounded(d, "mean", "std", "p10", "p25", "median", "p75", "p90")


@query("A19_pivot", sql(FLAT, TAGGED_FLAT, select="""
  SELECT day_name, count(*) FILTER (tag = 'red') AS red, count(*) FILTER (tag = 'blue') AS blue, count(*) FILTER (tag = 'bolt') AS bolt FROM tagged GROUP BY day_name"""))
def _(spark, sf):
    return R.pivot_counts(tagged_flat(spark, sf), "day_name", "tag", ["red", "blue", "bolt"])


@query("A20_unstack", sql(FLAT, select="SELECT week_name, count(*) FILTER (NOT is_repost) AS original, count(*) FILTER (is_repost) AS repost FROM flat GROUP BY week_name"))
def _(spark, sf):
    f = ad.flat(spark, sf).withColumn("kind", F.when(F.col("is_repost"), "repost").otherwise("original"))
    return R.pivot_counts(f, "week_name", "kind", ["original", "repost"])


@query("A21_concat_lists", sql(FLAT, select="""
  , items AS (SELECT user_id, unnest(tags) AS item, unnest(range(0, len(tags))) AS i, created_at, id FROM flat),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at, id, i) - 1 AS pos FROM items)
  SELECT user_id, pos // 50 AS chunk, string_agg(item, ' ' ORDER BY pos) AS items FROM numbered GROUP BY 1, 2"""))
def _(spark, sf):
    c = R.concat_lists(ad.flat(spark, sf), ["user_id"], "tags", ["created_at", "id"], F.date_trunc("hour", "created_at"), chunk=50)
    return c.select("user_id", F.col("chunk").cast("bigint").alias("chunk"), F.array_join("items", " ").alias("items"))


@query("A22_histogram", """
  , b AS (SELECT 1) SELECT 1""".replace("  , b AS (SELECT 1) SELECT 1", """
  WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
  c AS (SELECT least(CAST(floor((l_extendedprice - lo) * 10 / (hi - lo)) AS INTEGER), 9) AS bin, count(*) AS n FROM lineitem, r GROUP BY 1)
  SELECT CAST(g AS INTEGER) AS bin, round(lo + g * (hi - lo) / 10, 4) AS bin_lo, round(lo + (g + 1) * (hi - lo) / 10, 4) AS bin_hi, coalesce(n, 0) AS n
  FROM range(0, 10) t(g), r LEFT JOIN c ON c.bin = g"""))
def _(spark, sf):
    return rounded(ST.histogram(ad.table(spark, sf, "lineitem"), "l_extendedprice"), "bin_lo", "bin_hi", digits=4)


CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("A23_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in CORR for b in CORR))
def _(spark, sf):
    return rounded(ST.correlation_matrix(ad.table(spark, sf, "lineitem"), CORR), "r")


@query("A24_group_median_mean_sem", " UNION ALL ".join(
    f"SELECT l_returnflag, '{m}' AS measure, round(avg({m}), 4) AS mean, round(stddev_samp({m}) / sqrt(count({m})), 6) AS sem, round(median({m}), 6) AS median FROM lineitem GROUP BY 1"
    for m in ("l_quantity", "l_extendedprice")))
def _(spark, sf):
    g = ST.group_median_mean_sem(ad.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], ["l_returnflag"])
    return rounded(rounded(g, "mean", digits=4), "sem", "median")


@query("A25_two_sample_t", """
  SELECT lang, n1, n2, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)), 6) AS t_statistic
  FROM (SELECT lang, count(*) FILTER (quality = 1) AS n1, count(*) FILTER (quality = 0) AS n2, avg(n_chars) FILTER (quality = 1) AS m1,
          avg(n_chars) FILTER (quality = 0) AS m2, var_samp(n_chars) FILTER (quality = 1) AS v1, var_samp(n_chars) FILTER (quality = 0) AS v2
        FROM documents JOIN labels USING (doc_id) GROUP BY lang)""")
def _(spark, sf):
    d = ad.table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(ad.table(spark, sf, "labels"), "doc_id")
    t = ST.two_sample_t(d, "lang", F.col("quality") == 1, "n_chars")
    return rounded(t.drop("p_value"), "t_statistic")


@query("A25_two_sample_p")
def _(spark, sf):
    d = ad.table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(ad.table(spark, sf, "labels"), "doc_id")
    return ST.two_sample_t(d, "lang", F.col("quality") == 1, "n_chars")


@query("A26_min_max_normalise", """
  SELECT o_orderkey, round((o_totalprice - (SELECT min(o_totalprice) FROM orders)) / ((SELECT max(o_totalprice) FROM orders) - (SELECT min(o_totalprice) FROM orders)), 6) AS o_totalprice FROM orders""")
def _(spark, sf):
    o = ad.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(ST.min_max_normalise(o, ["o_totalprice"]), "o_totalprice")


@query("A27_word_counts", sql(FLAT, select="SELECT user_id, word, count(*) AS n FROM (SELECT user_id, unnest(string_split(full_text, ' ')) AS word FROM flat) GROUP BY 1, 2"))
def _(spark, sf):
    docs = ad.flat(spark, sf).select("user_id", F.split("full_text", " ").alias("words"))
    return TX.word_counts(docs, "user_id", "words")


@query("A28_weighted_pairs", sql(EV, PAIRS, select="SELECT src, dst, count(*) AS count FROM pairs GROUP BY 1, 2"))
def _(spark, sf):
    return ED.weighted_pairs(ad.reaction_pairs(spark, sf))


@query("A29_tag_weights", sql(FLAT, TAGGED_FLAT, select="SELECT month_name, tag, count(*) AS weight FROM tagged GROUP BY 1, 2"))
def _(spark, sf):
    return R.value_counts(tagged_flat(spark, sf), "month_name", "tag", name="weight")


@query("A30_population_minima", "SELECT min(value) AS min_x, CAST(min(CAST(json_extract(props, '$.k') AS BIGINT)) AS DOUBLE) AS min_y FROM events")
def _(spark, sf):
    from ..operators.trajectory import population_minima
    return population_minima(ad.activity(spark, sf).select(F.col("value").alias("pos_x"), F.col("k").cast("double").alias("pos_y")))


@query("A31_repost_original_correlation", sql(FLAT, TAGGED_FLAT, select="""
  SELECT round(corr(r, o), 6) AS r, count(*) AS tags FROM (SELECT tag, count(*) FILTER (is_repost) AS r, count(*) FILTER (is_original) AS o FROM tagged GROUP BY tag)"""))
def _(spark, sf):
    return rounded(TG.repost_original_correlation(tagged_flat(spark, sf)), "r")


@query("A32_most_mentioned_per_month", sql(FLAT, select="""
  SELECT month_name, mention, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY month_name ORDER BY n DESC, mention) AS rank FROM (
    SELECT month_name, mention, count(*) AS n FROM (SELECT month_name, unnest(original_mentions) AS mention FROM flat) GROUP BY 1, 2)) WHERE rank <= 10"""))
def _(spark, sf):
    m = ad.flat(spark, sf).select("month_name", F.explode("original_mentions").alias("mention"))
    return R.top_k_per_group(m.groupBy("month_name", "mention").agg(F.count(F.lit(1)).alias("n")), ["month_name"], [F.desc("n"), "mention"], 10)


# ------------------------------------------------------------------ W07-W10, O: ordered
@query("W07_top_k_per_group", sql(POSTS, select="""
  SELECT week_name, id, total_in_cnt, rank FROM (SELECT *, row_number() OVER (PARTITION BY week_name ORDER BY total_in_cnt DESC, id) AS rank FROM posts) WHERE rank <= 10"""))
def _(spark, sf):
    return R.top_k_per_group(ad.posts(spark, sf).select("week_name", "id", "total_in_cnt"), ["week_name"], [F.desc("total_in_cnt"), "id"], 10)


@query("W08_share_of_group", """
  SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER p, 9) AS share, round(avg(o_totalprice) OVER p, 2) AS group_mean FROM orders WINDOW p AS (PARTITION BY o_orderpriority)""")
def _(spark, sf):
    o = ad.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    g = with_group_totals(o, ["o_orderpriority"], total=F.sum("o_totalprice"), mean=F.avg("o_totalprice"))
    return g.select("o_orderkey", F.round(F.col("o_totalprice") / F.col("total"), 9).alias("share"), F.round("mean", 2).alias("group_mean"))


@query("W09_global_max_scaling", sql(FLAT, TAGGED_FLAT, select="""
  , c AS (SELECT tag, count(*) AS uses FROM tagged GROUP BY tag)
  SELECT tag, uses, round(uses * (1 / (SELECT max(uses) FROM c)), 6) AS uses_n FROM c"""))
def _(spark, sf):
    c = tagged_flat(spark, sf).groupBy("tag").agg(F.count(F.lit(1)).alias("uses"))
    return rounded(TG.scaled_by_max(c, ["uses"]), "uses_n")


@query("W10_busiest_fortnight", sql(EV, select="""
  SELECT user_id, max(n) AS max_posts FROM (SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY created_at RANGE BETWEEN INTERVAL 1209599 SECONDS PRECEDING AND CURRENT ROW) AS n FROM ev) GROUP BY user_id"""))
def _(spark, sf):
    return R.busiest_fortnight(ad.activity(spark, sf))


@query("O01_sort_values", sql(ACCOUNTS, select="SELECT user_id, followers_count, friends_count FROM accounts ORDER BY followers_count DESC, friends_count, user_id"))
def _(spark, sf):
    return ad.accounts(spark, sf).select("user_id", "followers_count", "friends_count").orderBy(F.desc("followers_count"), "friends_count", "user_id")


@query("O02_top_k", sql(POSTS, select="SELECT id, total_in_cnt FROM posts ORDER BY total_in_cnt DESC, id LIMIT 75"))
def _(spark, sf):
    return R.top_k(ad.posts(spark, sf).select("id", "total_in_cnt"), 75, F.desc("total_in_cnt"), "id")


@query("O03_fastest_reactors", sql(POSTS, select="""
  , r AS (SELECT user_id, CAST(sum(in_repost_cnt) AS BIGINT) AS in_repost_cnt, avg(in_repost_delay_sec) AS d FROM posts GROUP BY 1)
  SELECT user_id, in_repost_cnt, round(d, 4) AS in_repost_delay_sec, round(-log2(nullif(d, 0)), 6) AS log2_delay
  FROM (SELECT * FROM r WHERE d IS NOT NULL ORDER BY in_repost_cnt DESC, user_id LIMIT 12)"""))
def _(spark, sf):
    v = R.account_rollup(ad.posts(spark, sf)).select("user_id", "in_repost_cnt", "in_repost_delay_sec")
    f = R.fastest_reactors(v, "in_repost_cnt", "in_repost_delay_sec", 12, negate=True)
    return rounded(rounded(f, "in_repost_delay_sec", digits=4), "log2_delay")


@query("O04_natural_sort", """
  SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS place FROM supplier""")
def _(spark, sf):
    from ..functions.text import natural_sort_key
    from ..operators.skew import number_rows
    s = ad.table(spark, sf, "supplier").withColumn("label", F.concat(F.lit("fly "), F.col("s_suppkey").cast("string")))
    s = s.withColumn("key", natural_sort_key(F.col("label")))
    return number_rows(s, [], ["key"], F.substring("key", 1, 20), "place").select("s_suppkey", "place")


@query("O05_sample", sql(FLAT, select="SELECT id, user_id, week_name FROM flat ORDER BY md5(CAST(id AS VARCHAR) || ':7'), id LIMIT 7"))
def _(spark, sf):
    seeded = F.md5(F.concat(F.col("id").cast("string"), F.lit(":7")))  # the same rows however they are dealt out
    return ad.flat(spark, sf).select("id", "user_id", "week_name").orderBy(seeded, "id").limit(7)
