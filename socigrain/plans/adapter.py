"""Reference-shaped social tables derived from the driver's parquet tables.

``events`` become posts, ``customer`` accounts, ``part.p_name`` tags; everything is integer
arithmetic over whole tables so that an SQL engine can state the same derivation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..operators import posts as P
from ..operators.skew import lookup_join, number_rows
from ..session import balanced

RUN_DAY = "2024-02-01"
LANGS = ["en", "hr", "sl", "und", "de"]
LOCAL_PLACES = ["zagreb", "split", "osijek", "zg", "rijeka", "zadar", "nation_3"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return balanced(table(spark, sf, "documents").select("doc_id", "lang", "text"))


def activity(spark: SparkSession, sf: str) -> DataFrame:
    """One row per event: id, author, time, favourites, k, kind of reaction, parent id."""
    ev = balanced(table(spark, sf, "events").select("event_id", "user_id", "ts", "value", "props", "event_type")).select(
        F.col("event_id").alias("id"),
        "user_id",
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("created_at"),
        F.floor("value").cast("bigint").alias("fav"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        "event_type",
        "ts",
        "value",
    )
    kind = (
        F.when(F.col("event_type") == "view", "repost")
        .when(F.col("event_type") == "click", "reply")
        .when(F.col("event_type") == "error", "quote")
    )
    parent = F.when(
        F.col("event_type").isin("view", "click", "error") & (F.col("id") > 0),
        F.expr("(id * (k + 1)) div 101"),
    )
    return ev.withColumns({"parent_id": parent}).withColumn(
        "kind", F.when(F.col("parent_id").isNotNull(), kind)
    )


def _user_name(c: Column) -> Column:
    return F.concat(F.lit("user_"), c.cast("string"))


def raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Nested posts as they land from harvesting, one row per event."""
    act = activity(spark, sf).drop("ts", "value")
    words = table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), F.split("p_name", " ").alias("words")
    )
    act = lookup_join(act, words, "k", "left").withColumn(
        "words", F.coalesce("words", F.array().cast("array<string>"))
    )
    act = act.withColumn(
        "text",
        F.concat(
            F.array_join(F.transform("words", lambda w: F.concat(F.lit("#"), w)), " "),
            F.lit(" "), F.col("event_type"),
            F.lit(" https://t.co/"), F.col("id").cast("string"),
            F.lit(" @user_"), F.col("k").cast("string"),
        ),
    )
    when = F.date_format("created_at", "EEE MMM dd HH:mm:ss Z yyyy")
    k_mention = F.when(
        F.col("k") % 3 == 0,
        F.array(F.struct(F.col("k").alias("id"), _user_name(F.col("k")).alias("screen_name"))),
    ).otherwise(F.array().cast("array<struct<id:bigint,screen_name:string>>"))
    hashtags = F.transform("words", lambda w: F.struct(w.alias("text")))
    parents = act.select(
        F.col("id").alias("parent_id"),
        F.struct(
            "id",
            when.alias("created_at"),
            F.col("text").alias("full_text"),
            F.col("fav").alias("favorite_count"),
            F.struct(F.col("user_id").alias("id"), _user_name(F.col("user_id")).alias("screen_name")).alias("user"),
            F.struct(hashtags.alias("hashtags"), k_mention.alias("user_mentions")).alias("entities"),
        ).alias("parent"),
    )
    # posts without a parent meet nothing: joined as well, all of them would share the one task of the null key
    alone = act.filter(F.col("parent_id").isNull()).withColumn("parent", F.lit(None).cast(parents.schema["parent"].dataType))
    reacting = lookup_join(act.filter(F.col("parent_id").isNotNull()), parents, "parent_id", "left").unionByName(alone)
    kind = F.col("kind")
    parent_mention = F.when(
        kind.isNotNull(),
        F.array(F.struct(F.col("parent.user.id").alias("id"), F.col("parent.user.screen_name").alias("screen_name"))),
    ).otherwise(F.array().cast("array<struct<id:bigint,screen_name:string>>"))
    return reacting.select(
        "id",
        F.col("id").cast("string").alias("id_str"),
        when.alias("created_at"),
        F.col("text").alias("full_text"),
        F.element_at(F.array(*[F.lit(x) for x in LANGS]), (F.col("k") % 5 + 1).cast("int")).alias("lang"),
        F.col("fav").alias("favorite_count"),
        (F.col("k") % 7 == 0).alias("possibly_sensitive"),
        F.coalesce(kind == "quote", F.lit(False)).alias("is_quote_status"),
        F.struct(
            F.col("user_id").alias("id"),
            F.col("user_id").cast("string").alias("id_str"),
            _user_name(F.col("user_id")).alias("screen_name"),
        ).alias("user"),
        F.struct(
            hashtags.alias("hashtags"), F.concat(parent_mention, k_mention).alias("user_mentions")
        ).alias("entities"),
        F.when(kind == "repost", F.col("parent")).alias("retweeted_status"),
        F.when(kind == "quote", F.col("parent")).alias("quoted_status"),
        F.when(kind == "reply", F.col("parent_id")).alias("in_reply_to_status_id"),
        F.when(kind == "reply", F.col("parent.user.id")).alias("in_reply_to_user_id"),
        F.when(kind == "reply", F.col("parent.user.screen_name")).alias("in_reply_to_screen_name"),
    )


def flat(spark: SparkSession, sf: str) -> DataFrame:
    """Flat posts with flags, delays, calendar and tags; event ids are unique, so no de-duplication."""
    return P.flat_posts(raw_posts(spark, sf), dedup=False).withColumn("all_tags", P.all_tags())


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """Clean posts view: flat posts plus inbound reactions."""
    clean = P.attach_inbound(P.flat_posts(raw_posts(spark, sf), dedup=False))
    return P.posts_view(clean).withColumn("folder_name", F.lit(RUN_DAY))


def raw_accounts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key = F.col("c_custkey")
    place = (
        F.when(key % 8 == 0, "Zagreb")
        .when(key % 8 == 1, " zg ")
        .when(key % 8 == 2, "Split,  Croatia")
        .when(key % 8 == 3, F.col("n_name"))
        .when(key % 8 == 4, "")
        .when(key % 8 == 5, "Republika Hrvatska")
        .when(key % 8 == 7, "novi osijek")
    )
    joined = lookup_join(c, n, "c_nationkey", "left")
    return joined.select(
        key.alias("id"),
        F.lit(None).cast("bigint").alias("user_id"),
        key.cast("string").alias("id_str"),
        F.lit(None).cast("string").alias("user_id_str"),
        F.col("c_name").alias("name"),
        _user_name(key).alias("screen_name"),
        place.alias("location"),
        F.concat(F.lit("segment "), F.col("c_mktsegment")).alias("description"),
        (key % 11 == 0).alias("protected"),
        (key % 13 == 0).alias("verified"),
        F.greatest(F.floor("c_acctbal"), F.lit(0)).cast("bigint").alias("followers_count"),
        (key % 500).alias("friends_count"),
        F.col("c_nationkey").cast("bigint").alias("listed_count"),
        (key * 3 % 1000).alias("favourites_count"),
        (key * 7 % 300).alias("statuses_count"),
        F.lit("Mon Jan 03 10:00:00 +0000 2022").alias("created_at"),
    )


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.accounts import clean_accounts

    return clean_accounts(raw_accounts(spark, sf), LOCAL_PLACES)


def account_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every account as cleaned on two days; the later day has one follower more."""
    days = F.explode(F.array(F.lit("2024-01-25"), F.lit(RUN_DAY)))
    return accounts(spark, sf).withColumn("folder_name", days).withColumn(
        "followers_count", F.col("followers_count") + (F.col("folder_name") == RUN_DAY).cast("bigint")
    )


#: Friends in one list row; a user with more has several rows.
LIST_ROWS = 1000


def follow_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Users somebody reacted to, as friend lists of at most LIST_ROWS friends a row."""
    pairs = reaction_pairs(spark, sf).select(
        F.col("dst").alias("user_id"), F.col("src").alias("friend")
    ).distinct()
    numbered = number_rows(pairs, ["user_id"], ["friend"], F.floor(F.col("friend") / LIST_ROWS), "place", 0)
    return numbered.groupBy("user_id", F.floor(F.col("place") / LIST_ROWS).alias("slice")).agg(
        F.sort_array(F.collect_list("friend")).alias("friends")
    ).drop("slice")


def strip_sql(column: str) -> str:
    """SQL for the removal of links and mentions."""
    return f"regexp_replace(regexp_replace({column}, '{T.URL_PATTERN}', '', 'g'), '{T.MENTION_PATTERN}', '', 'g')"


def reaction_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(src = author of the parent, dst = reacting user, kind) without the nested posts."""
    act = activity(spark, sf)
    kids = act.filter(F.col("parent_id").isNotNull()).select("id", "user_id", "kind", "parent_id")
    authors = act.select(F.col("id").alias("parent_id"), F.col("user_id").alias("src"))
    return lookup_join(kids, authors, "parent_id", "inner").select(
        "src", F.col("user_id").alias("dst"), "kind", "id"
    )


def trajectories(spark: SparkSession, sf: str) -> DataFrame:
    """(entity, frame, pos_x, pos_y): a user's events in time order."""
    act = activity(spark, sf).select(
        F.col("user_id").alias("entity"), "ts", "id", F.col("value").alias("pos_x"),
        F.col("k").cast("double").alias("pos_y"),
    )
    numbered = number_rows(act, ["entity"], ["ts", "id"], F.date_trunc("minute", F.col("ts")), "frame", 0)
    return numbered.select("entity", F.col("frame").cast("bigint").alias("frame"), "pos_x", "pos_y")


# ---------------------------------------------------------------- the same derivations as SQL
EV = """
ev AS (
  SELECT event_id AS id, user_id, date_trunc('second', ts) AS created_at, ts, value,
         CAST(floor(value) AS BIGINT) AS fav, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type
  FROM events),
act0 AS (
  SELECT *, CASE WHEN event_type IN ('view','click','error') AND id > 0 THEN (id * (k + 1)) // 101 END AS parent_id
  FROM ev),
act AS (
  SELECT *, CASE WHEN parent_id IS NULL THEN NULL WHEN event_type = 'view' THEN 'repost'
                 WHEN event_type = 'click' THEN 'reply' ELSE 'quote' END AS kind FROM act0)"""

FLAT = EV + """,
worded AS (
  SELECT act.*, CASE WHEN p_name IS NULL THEN CAST([] AS VARCHAR[]) ELSE string_split(p_name, ' ') END AS words
  FROM act LEFT JOIN part ON p_partkey = k),
texted AS (
  SELECT *, array_to_string(list_transform(words, lambda w: '#' || w), ' ') || ' ' || event_type
            || ' https://t.co/' || id || ' @user_' || k AS text,
         CASE WHEN k % 3 = 0 THEN ['user_' || k] ELSE CAST([] AS VARCHAR[]) END AS k_names
  FROM worded),
flat0 AS (
  SELECT c.id, c.user_id, 'user_' || c.user_id AS screen_name, c.k,
         CASE WHEN c.kind = 'repost' THEN p.text ELSE c.text END AS full_text,
         c.created_at, ['en','hr','sl','und','de'][(c.k % 5) + 1] AS lang, c.k % 7 = 0 AS possibly_sensitive,
         c.words AS tags,
         CASE WHEN c.kind IS NULL THEN c.k_names ELSE list_concat(['user_' || p.user_id], c.k_names) END AS mentions,
         CASE WHEN c.kind IS DISTINCT FROM 'repost' THEN c.words ELSE CAST([] AS VARCHAR[]) END AS original_tags,
         CASE WHEN c.kind = 'repost' THEN p.words ELSE CAST([] AS VARCHAR[]) END AS repost_tags,
         CASE WHEN c.kind = 'quote' THEN p.words ELSE CAST([] AS VARCHAR[]) END AS quote_tags,
         CASE WHEN c.kind = 'repost' THEN CAST([] AS VARCHAR[])
              WHEN c.kind IS NULL THEN c.k_names ELSE list_concat(['user_' || p.user_id], c.k_names) END AS original_mentions,
         CASE WHEN c.kind = 'repost' THEN p.k_names ELSE CAST([] AS VARCHAR[]) END AS repost_mentions,
         CASE WHEN c.kind = 'quote' THEN p.k_names ELSE CAST([] AS VARCHAR[]) END AS quote_mentions,
         c.fav AS original_favourite_cnt,
         CASE WHEN c.kind = 'repost' THEN c.parent_id END AS repost_of_id,
         CASE WHEN c.kind = 'repost' THEN p.user_id END AS repost_of_user_id,
         CASE WHEN c.kind = 'repost' THEN p.fav END AS repost_favourite_cnt,
         CASE WHEN c.kind = 'repost' THEN CAST(epoch(c.created_at) - epoch(p.created_at) AS BIGINT) END AS repost_delay_sec,
         CASE WHEN c.kind = 'quote' THEN c.parent_id END AS quote_of_id,
         CASE WHEN c.kind = 'quote' THEN p.user_id END AS quote_of_user_id,
         CASE WHEN c.kind = 'quote' THEN p.fav END AS quote_favourite_cnt,
         CASE WHEN c.kind = 'quote' THEN CAST(epoch(c.created_at) - epoch(p.created_at) AS BIGINT) END AS quote_delay_sec,
         CASE WHEN c.kind = 'reply' THEN c.parent_id END AS reply_to_id,
         CASE WHEN c.kind = 'reply' THEN p.user_id END AS reply_to_user_id,
         coalesce(c.kind = 'repost', false) AS is_repost, coalesce(c.kind = 'reply', false) AS is_reply,
         coalesce(c.kind = 'quote', false) AS is_quote, coalesce(c.kind <> 'repost', true) AS is_original
  FROM texted c LEFT JOIN texted p ON p.id = c.parent_id),
flat AS (
  SELECT *, list_concat(list_concat(original_tags, repost_tags), quote_tags) AS all_tags,
         year(created_at) AS year, quarter(created_at) AS quarter,
         year(created_at) || 'Q' || quarter(created_at) AS quarter_name, month(created_at) AS month,
         strftime(created_at, '%Y-%m') AS month_name, weekofyear(created_at) AS week,
         strftime(created_at, '%Y-%W') AS week_name, day(created_at) AS day,
         strftime(created_at, '%Y-%m-%d') AS day_name, hour(created_at) AS hour,
         minute(created_at) AS minute, CAST(second(created_at) AS BIGINT) AS second
  FROM flat0)"""

POSTS = FLAT + """,
inb AS (
  SELECT ref, count(*) FILTER (kind = 'repost') AS in_repost_cnt,
         avg(d) FILTER (kind = 'repost') AS in_repost_delay_sec,
         count(*) FILTER (kind = 'quote') AS in_quote_cnt, avg(d) FILTER (kind = 'quote') AS in_quote_delay_sec,
         count(*) FILTER (kind = 'reply') AS in_reply_cnt
  FROM (SELECT repost_of_id AS ref, 'repost' AS kind, repost_delay_sec AS d FROM flat WHERE is_repost
        UNION ALL SELECT quote_of_id, 'quote', quote_delay_sec FROM flat WHERE is_quote
        UNION ALL SELECT reply_to_id, 'reply', NULL FROM flat WHERE is_reply) GROUP BY ref),
posts AS (
  SELECT f.*, coalesce(in_repost_cnt, 0) AS in_repost_cnt, coalesce(in_quote_cnt, 0) AS in_quote_cnt,
         coalesce(in_reply_cnt, 0) AS in_reply_cnt, coalesce(in_repost_delay_sec, 0) AS in_repost_delay_sec,
         coalesce(in_quote_delay_sec, 0) AS in_quote_delay_sec,
         len(original_mentions) AS original_mentions_cnt, len(repost_mentions) AS repost_mentions_cnt,
         len(quote_mentions) AS quote_mentions_cnt,
         coalesce(in_repost_cnt, 0) + coalesce(in_reply_cnt, 0) + coalesce(in_quote_cnt, 0) AS total_in_cnt
  FROM flat f LEFT JOIN inb ON inb.ref = f.id)"""

ACCOUNTS = """
accounts0 AS (
  SELECT c_custkey AS user_id, CAST(c_custkey AS VARCHAR) AS user_id_str, c_name AS name,
         'user_' || c_custkey AS screen_name,
         trim(regexp_replace(coalesce(CASE c_custkey % 8 WHEN 0 THEN 'Zagreb' WHEN 1 THEN ' zg '
           WHEN 2 THEN 'Split,  Croatia' WHEN 3 THEN n_name WHEN 4 THEN '' WHEN 5 THEN 'Republika Hrvatska'
           WHEN 7 THEN 'novi osijek' END, ''), '\\s+', ' ', 'g')) AS location,
         'segment ' || c_mktsegment AS description, c_custkey % 11 = 0 AS protected, c_custkey % 13 = 0 AS verified,
         greatest(CAST(floor(c_acctbal) AS BIGINT), 0) AS followers_count, c_custkey % 500 AS friends_count,
         CAST(c_nationkey AS BIGINT) AS listed_count, c_custkey * 3 % 1000 AS favourites_count,
         c_custkey * 7 % 300 AS statuses_count
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey),
accounts1 AS (
  SELECT *, lower(location) IN ('zagreb','split','osijek','zg','rijeka','zadar','nation_3')
            OR contains(lower(location), 'croa') OR contains(lower(location), 'hrvat') AS is_local FROM accounts0),
accounts AS (
  SELECT *, CASE WHEN NOT is_local THEN NULL
                 WHEN contains(lower(location), 'hrvatska') OR contains(lower(location), 'croatia') THEN 'Hrvatska'
                 WHEN lower(location) = 'zg' THEN 'Zagreb'
                 ELSE upper(location[1]) || lower(location[2:]) END AS clean_location FROM accounts1)"""

PAIRS = """
pairs AS (SELECT p.user_id AS src, c.user_id AS dst, c.kind, c.id
          FROM act c JOIN act p ON p.id = c.parent_id)"""

TRAJ = """
traj AS (SELECT user_id AS entity, row_number() OVER (PARTITION BY user_id ORDER BY ts, id) - 1 AS frame,
                value AS pos_x, CAST(k AS DOUBLE) AS pos_y FROM act)"""


def with_ctes(*ctes: str, select: str) -> str:
    """CTE chain plus final select; a select starting with a comma adds further CTEs."""
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()
