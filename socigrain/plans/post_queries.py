"""Scans and sinks, flattening, filters and scalar functions over the post and account tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A, dates as D, numbers as N, text as T
from ..operators import accounts as AC, baseline as B, posts as P, rollups as R, trajectory as TR
from ..operators.skew import lookup_join
from ..session import scratch_path
from ..sources import readers, writers
from . import adapter as ad
from .adapter import ACCOUNTS, EV, FLAT, PAIRS, POSTS, TRAJ, with_ctes as sql
from .registry import query

# Topic keywords (include / exclude), matched as substrings of the lower-cased text.
TOPICS = {
    "is_covid": (
        [
            "alemka", "markotic", "markotić", "beros", "beroš", "capak", "hzjz",
            "antigensk", "antimaskeri", "antivakseri",
            "cijep", "cijepiv", "cijeplj", "cijepljen", "cjep", "cjepiv", "cjepljen",
            "booster doza", "prva doza", "druga doza", "treca doza", "treća doza",
            "astra zeneca", "biontech", "curevac", "inovio", "janssen", "johnson",
            "novavax", "moderna", "pfizer", "vaxart",
            "sojevi koronavirusa", "brazilski", "britanski", "ceski soj", "delta",
            "indijski", "juznoafricki", "južnoafrički", "lambda",
            "njujorski", "njujorški", "omikorn", "omikron", "novi soj", "češki soj",
            "coron", "corona", "covid", "covid-19", "covid 19", "koron", "korona", "kovid",
            "ncov", "mutira", "mutaci", "n95", "sars-cov-2", "sarscov2", "sputnik",
            "inkubacij", "ljekov", "obolje", "novozaražen", "nuspoj", "patoge", "regeneron",
            "medicin", "infekc", "dezinf", "bolnic", "dijagnost", "doktor", "epidem",
            "respir", "respirator", "simpto", "rt pcr", "terapij", "virus",
            "slusaj struku", "slušaj struku", "propusnic", "ostani doma", "ostanimo doma", "zaraž",
            "festivala slobod", "pcr", "samoizola", "samoizolacij", "zaraz",
            "distanc", "izolac", "karant", "lockd", "mask", "festival slobod",
            "ostanimo odgovorni", "pandem", "pandemij", "stozer", "stožer",
        ],
        [],
    ),
    "ukraine_war": (
        [
            " rat ", " boj ", "war", "ukra", "zelens", "putin", "russ", "rusk", "missil", "rossiya",
            "kijev", "kiev", "kyiv", "poljska", "poland", " nato", "#nato", "civil",
            "vojni", "militar", "militair", "napad", "attack", "borba",
            "украина", "киев", "одесса", "харьков", "днепр", "odessa", "debski", "crime",
        ],
        ["reward", "warpigstoken", "warrior nun", " rate ", " rates ", "warn", "warcraft"],
    ),
}

FLAT_COLUMNS = [
    "id", "user_id", "screen_name", "full_text", "lang", "possibly_sensitive", "original_favourite_cnt",
    "repost_of_id", "repost_of_user_id", "repost_favourite_cnt", "quote_of_id", "quote_of_user_id",
    "quote_favourite_cnt", "reply_to_id", "reply_to_user_id",
]
FLAT_ARRAYS = ["tags", "mentions", "original_tags", "repost_tags", "quote_tags", "original_mentions", "repost_mentions", "quote_mentions"]


def joined_arrays(cols):
    return [F.array_join(c, " ").alias(c) for c in cols]


def arrays_sql(cols):
    return ", ".join(f"array_to_string({c}, ' ') AS {c}" for c in cols)


# ------------------------------------------------------------------ P: projections
P01_SQL = sql(FLAT, select=f"SELECT {', '.join(FLAT_COLUMNS)}, {arrays_sql(FLAT_ARRAYS)}, "
                           "CAST(epoch(created_at) AS BIGINT) AS created_epoch FROM flat")


@query("P01_flatten_post", P01_SQL)
def _(spark, sf):
    f = P.flatten_post(ad.raw_posts(spark, sf))
    return f.select(*FLAT_COLUMNS, *joined_arrays(FLAT_ARRAYS), F.unix_timestamp("created_at").alias("created_epoch"))


ACCOUNT_COLS = ["user_id", "user_id_str", "name", "screen_name", "location", "description", "protected", "verified",
                "followers_count", "friends_count", "listed_count", "favourites_count", "statuses_count"]


@query("P02_flatten_account", sql(ACCOUNTS, select="""
  SELECT user_id, user_id_str, name, screen_name, description, protected, verified, followers_count,
         friends_count, listed_count, favourites_count, statuses_count FROM accounts0"""))
def _(spark, sf):
    cols = [c for c in ACCOUNT_COLS if c != "location"]
    return AC.flatten_account(ad.raw_accounts(spark, sf)).select(*cols)


@query("P03_pluck", sql(FLAT, select="SELECT id, array_to_string(tags, ',') AS tags, array_to_string(mentions, ',') AS names FROM flat"))
def _(spark, sf):
    r = ad.raw_posts(spark, sf)
    return r.select(
        "id", F.array_join(A.pluck(F.col("entities.hashtags"), "text"), ",").alias("tags"),
        F.array_join(A.pluck(F.col("entities.user_mentions"), "screen_name"), ",").alias("names"),
    )


@query("P04_by_origin", sql(FLAT, select=f"SELECT id, {arrays_sql(FLAT_ARRAYS[2:])} FROM flat"))
def _(spark, sf):
    return ad.flat(spark, sf).select("id", *joined_arrays(FLAT_ARRAYS[2:]))


@query("P05_text_of_post", sql(FLAT, select="SELECT id, full_text FROM flat"))
def _(spark, sf):
    return ad.flat(spark, sf).select("id", "full_text")


CONFORMED = ["id", "folder_name", "user_id", "lang", "week", "week_name", "in_repost_cnt", "in_quote_cnt", "in_reply_cnt",
             "is_original", "is_repost", "is_quote", "is_reply", "repost_delay_sec", "quote_delay_sec"]


@query("P06_conform", sql(POSTS, select=f"SELECT {', '.join(c if c != 'folder_name' else chr(39) + ad.RUN_DAY + chr(39) + ' AS folder_name' for c in CONFORMED)}, "
                          "round(in_repost_delay_sec, 6) AS in_repost_delay_sec FROM posts"))
def _(spark, sf):
    clean = P.conform(ad.posts(spark, sf), ad.RUN_DAY)
    return clean.select(*CONFORMED, F.round("in_repost_delay_sec", 6).alias("in_repost_delay_sec"))


@query("P07_all_tags", sql(FLAT, select="SELECT id, array_to_string(all_tags, ' ') AS all_tags FROM flat"))
def _(spark, sf):
    return ad.flat(spark, sf).select("id", F.array_join("all_tags", " ").alias("all_tags"))


@query("P08_array_len", sql(FLAT, select="SELECT id, len(original_mentions) AS o, len(repost_mentions) AS r, len(quote_mentions) AS q FROM flat"))
def _(spark, sf):
    return ad.flat(spark, sf).select(
        "id", *[A.array_len(F.col(f"{c}_mentions")).cast("bigint").alias(c[0]) for c in ("original", "repost", "quote")])


_WEEKS = [f"2024-0{i}" for i in range(1, 6)]


@query("P09_transpose", sql(POSTS, select="SELECT measure, " + ", ".join(
    f"CAST(sum(v) FILTER (week_name = '{w}') AS BIGINT) AS w{w[-2:]}" for w in _WEEKS) + """
  FROM (SELECT week_name, 'favourites' AS measure, original_favourite_cnt AS v FROM posts
        UNION ALL SELECT week_name, 'in_quotes', in_quote_cnt FROM posts
        UNION ALL SELECT week_name, 'in_replies', in_reply_cnt FROM posts
        UNION ALL SELECT week_name, 'in_reposts', in_repost_cnt FROM posts) GROUP BY measure"""))
def _(spark, sf):
    weekly = ad.posts(spark, sf).groupBy("week_name").agg(
        F.sum("in_repost_cnt").alias("in_reposts"), F.sum("in_reply_cnt").alias("in_replies"),
        F.sum("in_quote_cnt").alias("in_quotes"), F.sum("original_favourite_cnt").alias("favourites"))
    long = weekly.unpivot("week_name", ["in_reposts", "in_replies", "in_quotes", "favourites"], "measure", "v")
    return long.groupBy("measure").pivot("week_name", _WEEKS).agg(F.sum("v")).withColumnsRenamed(
        {w: f"w{w[-2:]}" for w in _WEEKS})


@query("P10_relabel_groups", """
  SELECT name, grp || '_' || row_number() OVER (PARTITION BY grp ORDER BY name) AS label
  FROM (SELECT c_name AS name, CASE WHEN c_nationkey % 2 = 0 THEN 'CTRL' ELSE 'COC' END AS grp FROM customer)""")
def _(spark, sf):
    c = ad.table(spark, sf, "customer").select(
        F.concat(F.when(F.col("c_nationkey") % 2 == 0, "CTRL").otherwise("COC"), F.lit(" "), F.col("c_name")).alias("name"))
    return TR.relabel_groups(c).select(F.substring_index("name", " ", -1).alias("name"), "label")


@query("P11_round_half_even", """
  SELECT o_orderkey, round_even(o_totalprice / 8, 1) AS rounded FROM orders""")
def _(spark, sf):
    return ad.table(spark, sf, "orders").select("o_orderkey", F.bround(F.col("o_totalprice") / 8, 1).alias("rounded"))


# ------------------------------------------------------------------ F: filters
@query("F01_date_window_inclusive", sql(FLAT, select="SELECT id FROM flat WHERE created_at BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'"))
def _(spark, sf):
    return P.in_date_window(ad.flat(spark, sf), "2024-01-05 00:00:00", "2024-01-20 12:00:00").select("id")


@query("F02_date_window_exclusive", sql(FLAT, select="SELECT id FROM flat WHERE created_at > TIMESTAMP '2024-01-05 00:00:00' AND created_at < TIMESTAMP '2024-01-06 00:00:00'"))
def _(spark, sf):
    return P.strictly_between(ad.flat(spark, sf), "2024-01-05 00:00:00", "2024-01-06 00:00:00").select("id")


@query("F03_month_slice", sql(FLAT, select="SELECT count(*) AS posts, count(DISTINCT user_id) AS users FROM flat WHERE created_at BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31 23:59:59'"))
def _(spark, sf):
    return P.in_date_window(ad.flat(spark, sf), "2024-01-01 00:00:00", "2024-01-31 23:59:59").agg(
        F.count(F.lit(1)).alias("posts"), F.count_distinct("user_id").alias("users"))


@query("F04_account_quality", sql(ACCOUNTS, select="""
  SELECT user_id, followers_count FROM accounts
  WHERE NOT protected AND is_local AND statuses_count > 10 AND friends_count > 10 AND followers_count > 10"""))
def _(spark, sf):
    return AC.quality_filter(ad.accounts(spark, sf)).select("user_id", "followers_count")


@query("F04_account_quality_debug", sql(ACCOUNTS, select="SELECT user_id FROM accounts WHERE NOT protected AND is_local AND followers_count < 5000"))
def _(spark, sf):
    return AC.quality_filter(ad.accounts(spark, sf), "debug").select("user_id")


@query("F05_is_local", sql(ACCOUNTS, select="SELECT user_id, is_local FROM accounts"))
def _(spark, sf):
    places = spark.createDataFrame([(p.upper(),) for p in ad.LOCAL_PLACES], "place string")
    return AC.clean_accounts(ad.raw_accounts(spark, sf), places).select("user_id", "is_local")


def _like_any(col, terms):
    return " OR ".join(f"contains({col}, '{t}')" for t in terms) or "false"


@query("F06_topic_flag", "SELECT doc_id, " + ", ".join(
    f"(({_like_any('lower(text)', inc)}) AND NOT ({_like_any('lower(text)', exc)})) AS {name}" for name, (inc, exc) in TOPICS.items()
) + " FROM documents")
def _(spark, sf):
    docs = ad.table(spark, sf, "documents")
    return docs.select("doc_id", *[T.topic_flag(F.col("text"), inc, exc).alias(n) for n, (inc, exc) in TOPICS.items()])


@query("F07_semi_membership", sql(FLAT, ACCOUNTS, select="SELECT id FROM flat WHERE user_id IN (SELECT user_id FROM accounts WHERE is_local)"))
def _(spark, sf):
    local = ad.accounts(spark, sf).filter("is_local").select("user_id")
    return lookup_join(ad.flat(spark, sf), local, "user_id", "left_semi").select("id")


@query("F08_drop_self_loops", sql(EV, PAIRS, select="SELECT id, src, dst FROM pairs WHERE src <> dst"))
def _(spark, sf):
    from ..operators.edges import drop_self_loops
    return drop_self_loops(ad.reaction_pairs(spark, sf)).select("id", "src", "dst")


@query("F09_language_keep_list", sql(FLAT, select="SELECT id, lang FROM flat WHERE lang IN ('en','hr','sl','sr','bs')"))
def _(spark, sf):
    from ..operators.text import KEPT_LANGS
    return ad.flat(spark, sf).filter(F.col("lang").isin(*KEPT_LANGS)).select("id", "lang")


@query("F10_non_empty", sql(FLAT, select="SELECT id, array_to_string(list_filter(all_tags, lambda t: t <> ''), ' ') AS t FROM flat WHERE repost_of_id IS NOT NULL AND len(all_tags) > 0"))
def _(spark, sf):
    f = ad.flat(spark, sf).dropna(subset=["repost_of_id"]).filter(F.size("all_tags") > 0)
    return f.select("id", F.array_join(A.non_empty_items(F.col("all_tags")), " ").alias("t"))


@query("F11_follower_band", sql(ACCOUNTS, select="""
  SELECT user_id, band FROM (
    SELECT user_id, CASE
      WHEN f > 0 AND f < 6000 AND f % 2000 <> 0 THEN (f // 2000 * 2000) || '-' || (f // 2000 * 2000 + 2000)
      WHEN f > 6000 AND 6000 + (f - 6000) // 6000 * 6000 < 35000 AND (f - 6000) % 6000 <> 0
        THEN (6000 + (f - 6000) // 6000 * 6000) || '-' || (12000 + (f - 6000) // 6000 * 6000) END AS band
    FROM (SELECT user_id, followers_count AS f FROM accounts)) WHERE band IS NOT NULL"""))
def _(spark, sf):
    band = AC.follower_band(F.col("followers_count"), ((0, 6000, 2000), (6000, 35000, 6000)))
    return ad.accounts(spark, sf).select("user_id", band.alias("band")).filter("band is not null")


@query("F12_threshold", sql(POSTS, select="SELECT id, in_repost_cnt FROM posts WHERE in_repost_cnt > 1"))
def _(spark, sf):
    return ad.posts(spark, sf).filter("in_repost_cnt > 1").select("id", "in_repost_cnt")


@query("F13_dominant_pair_filter", sql(EV, PAIRS, select="""
  SELECT src, dst, id FROM (SELECT *, count(*) OVER (PARTITION BY src, dst) AS n, count(*) OVER (PARTITION BY src) AS t FROM pairs)
  WHERE NOT n > 0.1 * t"""))
def _(spark, sf):
    return R.dominant_pair_filter(ad.reaction_pairs(spark, sf), 0.1).select("src", "dst", "id")


@query("F14_min_degree_filter", sql(EV, PAIRS, select="""
  , d AS (SELECT v, count(*) AS n FROM (SELECT src AS v FROM pairs UNION ALL SELECT dst FROM pairs) GROUP BY v)
  SELECT id, src, dst FROM pairs WHERE src IN (SELECT v FROM d WHERE n >= 75) AND dst IN (SELECT v FROM d WHERE n >= 75)"""))
def _(spark, sf):
    from ..operators.edges import min_degree_filter
    return min_degree_filter(ad.reaction_pairs(spark, sf), 75).select("id", "src", "dst")


@query("F15_clean_posts_repeated", sql(POSTS, select="SELECT id, user_id, full_text, in_repost_cnt, in_reply_cnt, in_quote_cnt, day_name FROM posts"))
def _(spark, sf):
    """Every post landed twice: the clean table has it once, and counts reactions to it once."""
    raw = ad.raw_posts(spark, sf)
    clean = P.clean_posts(raw.unionByName(raw), "2024-02-01")
    return clean.select("id", "user_id", "full_text", "in_repost_cnt", "in_reply_cnt", "in_quote_cnt", "day_name")


@query("F15_dedup_keep_first", sql(ACCOUNTS, select="SELECT user_id, followers_count + 1 AS followers_count, '2024-02-01' AS folder_name FROM accounts"))
def _(spark, sf):
    return AC.latest_per_account(ad.account_days(spark, sf)).select("user_id", "followers_count", "folder_name")


# ------------------------------------------------------------------ X: scalar functions
CAL = ["year", "quarter", "quarter_name", "month", "month_name", "week", "week_name", "day", "day_name", "hour", "minute", "second"]


@query("X01_parse_post_time", sql(EV, select="SELECT id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS parsed FROM ev"))
def _(spark, sf):
    text = F.date_format("created_at", "EEE MMM dd HH:mm:ss Z yyyy")
    return ad.activity(spark, sf).select("id", F.date_format(D.parse_post_time(text), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("X02_date_parts", sql(FLAT, select="SELECT id, year, quarter, month, day, hour, minute, second FROM flat"))
def _(spark, sf):
    return ad.flat(spark, sf).select("id", "year", "quarter", "month", "day", "hour", "minute", "second")


@query("X03_iso_week", "SELECT o_orderkey, weekofyear(o_orderdate) AS week FROM orders")
def _(spark, sf):
    return ad.table(spark, sf, "orders").select("o_orderkey", F.weekofyear("o_orderdate").alias("week"))


@query("X04_week_label", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%W') AS week_name FROM orders")
def _(spark, sf):
    return ad.table(spark, sf, "orders").select("o_orderkey", D.monday_week_label(F.col("o_orderdate")).alias("week_name"))


@query("X05_labels", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, year(l_shipdate) || 'Q' || quarter(l_shipdate) AS q, strftime(l_shipdate, '%Y-%m') AS m, strftime(l_shipdate, '%Y-%m-%d') AS d FROM lineitem")
def _(spark, sf):
    ts = F.col("l_shipdate")
    return ad.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", D.quarter_label(ts).alias("q"),
        F.date_format(ts, "yyyy-MM").alias("m"), F.date_format(ts, "yyyy-MM-dd").alias("d"))


@query("X06_reaction_delay", sql(FLAT, select="SELECT id, repost_delay_sec, quote_delay_sec FROM flat WHERE is_repost OR is_quote"))
def _(spark, sf):
    return ad.flat(spark, sf).filter("is_repost or is_quote").select("id", "repost_delay_sec", "quote_delay_sec")


@query("X07_flags", sql(FLAT, select="SELECT id, is_repost, is_reply, is_quote, is_original FROM flat"))
def _(spark, sf):
    return ad.flat(spark, sf).select("id", "is_repost", "is_reply", "is_quote", "is_original")


@query("X08_squeeze_spaces", "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS h FROM documents")
def _(spark, sf):
    return ad.table(spark, sf, "documents").select("doc_id", F.md5(T.squeeze_spaces(F.col("text"))).alias("h"))


@query("X09_clean_location", sql(ACCOUNTS, select="SELECT user_id, location, clean_location FROM accounts"))
def _(spark, sf):
    return ad.accounts(spark, sf).select("user_id", "location", "clean_location")


@query("X10_strip_noise", sql(FLAT, select=f"SELECT id, {ad.strip_sql('full_text')} AS stripped FROM flat"))
def _(spark, sf):
    return ad.flat(spark, sf).select("id", T.strip_noise(F.col("full_text")).alias("stripped"))


@query("X11_lower_contains", "SELECT p_partkey, lower(p_type) AS t, contains(lower(p_type), 'eco') AS eco, lower(p_brand) IN ('brand#1','brand#2') AS b FROM part")
def _(spark, sf):
    return ad.table(spark, sf, "part").select(
        "p_partkey", F.lower("p_type").alias("t"), F.lower("p_type").contains("eco").alias("eco"),
        F.lower("p_brand").isin("brand#1", "brand#2").alias("b"))


@query("X12_math", """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(sqrt(abs(l_quantity - 25)), 6) AS s, round(log2(l_quantity), 6) AS lg,
         round(power(l_discount, 2), 6) AS sq, CAST(ceil(l_tax * 100) AS BIGINT) AS c, l_partkey % 7 AS m, least(l_quantity, 10) AS lo FROM lineitem""")
def _(spark, sf):
    q = F.col("l_quantity")
    return ad.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.sqrt(F.abs(q - 25)), 6).alias("s"),
        F.round(N.log2_or_null(q), 6).alias("lg"), F.round(F.pow("l_discount", F.lit(2)), 6).alias("sq"),
        F.ceil(F.col("l_tax") * 100).alias("c"), (F.col("l_partkey") % 7).alias("m"), F.least(q, F.lit(10.0)).alias("lo"))


@query("X13_euclid", sql(EV, TRAJ, select="SELECT entity, frame, round(sqrt(pos_x * pos_x + pos_y * pos_y), 6) AS d FROM traj"))
def _(spark, sf):
    return ad.trajectories(spark, sf).select("entity", "frame", F.round(N.euclid(F.col("pos_x"), F.col("pos_y")), 6).alias("d"))


@query("X14_arrays", sql(FLAT, select="""
  SELECT id, len(all_tags) AS n, list_contains(all_tags, 'red') AS red,
         array_to_string(list_filter(all_tags, lambda t: t <> 'red'), ' ') AS others, array_to_string(all_tags[1:2], ' ') AS head FROM flat"""))
def _(spark, sf):
    t = F.col("all_tags")
    return ad.flat(spark, sf).select(
        "id", F.size(t).alias("n"), F.array_contains(t, "red").alias("red"),
        F.array_join(F.filter(t, lambda x: x != "red"), " ").alias("others"), F.array_join(F.slice(t, 1, 2), " ").alias("head"))


@query("X15_tag_pairs", sql(FLAT, select="""
  SELECT id, all_tags[i] AS src, all_tags[i + 1] AS dst, count(*) AS n
  FROM (SELECT id, all_tags, unnest(range(1, len(all_tags), 2)) AS i FROM flat) GROUP BY 1, 2, 3"""))
def _(spark, sf):
    f = ad.flat(spark, sf).select("id", F.explode(A.paired_items(F.col("all_tags"))).alias("p"))
    return f.groupBy("id", "p.src", "p.dst").agg(F.count(F.lit(1)).alias("n"))


@query("X16_list_revive", sql(FLAT, select="SELECT id, array_to_string(all_tags, ' ') AS t, len(all_tags) AS n FROM flat"))
def _(spark, sf):
    literal = F.concat(F.lit("["), F.array_join(F.transform("all_tags", lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", "), F.lit("]"))
    f = ad.flat(spark, sf).select("id", A.revive_list(literal).alias("l"))
    return f.select("id", F.array_join("l", " ").alias("t"), F.size("l").alias("n"))


@query("X17_string_build", sql(EV, PAIRS, select="SELECT id, src || '->' || dst AS pair FROM pairs"))
def _(spark, sf):
    return ad.reaction_pairs(spark, sf).select("id", F.concat_ws("->", F.col("src").cast("string"), F.col("dst").cast("string")).alias("pair"))


@query("X18_coalesce", sql(FLAT, select="SELECT id, coalesce(repost_of_id, quote_of_id, reply_to_id, id) AS root, coalesce(repost_favourite_cnt, 0) AS f FROM flat"))
def _(spark, sf):
    return ad.flat(spark, sf).na.fill({"repost_favourite_cnt": 0}).select(
        "id", F.coalesce("repost_of_id", "quote_of_id", "reply_to_id", "id").alias("root"), F.col("repost_favourite_cnt").alias("f"))


@query("X19_percent", sql(POSTS, select="SELECT id, round(100.0 * in_repost_cnt / nullif(total_in_cnt, 0), 6) AS pct FROM posts").replace("100.0 * in_repost_cnt", "CAST(100 * in_repost_cnt AS DOUBLE)"))
def _(spark, sf):
    return ad.posts(spark, sf).select("id", F.round(N.percent(F.col("in_repost_cnt"), F.col("total_in_cnt")), 6).alias("pct"))


@query("X20_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    parsed = F.from_json("props", "struct<k:bigint>")
    return ad.table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


# ------------------------------------------------------------------ S: scans and sinks
@query("S01_scan_posts_json", P01_SQL)
def _(spark, sf):
    path = scratch_path(spark, "posts-json")
    ad.raw_posts(spark, sf).withColumn("day", F.substring("created_at", 5, 6)).write.partitionBy("day").json(path)
    f = P.flatten_post(readers.scan_posts_json(spark, path, multiline=False))
    return f.select(*FLAT_COLUMNS, *joined_arrays(FLAT_ARRAYS), F.unix_timestamp("created_at").alias("created_epoch"))


@query("S02_scan_accounts_json", sql(ACCOUNTS, select="SELECT user_id, screen_name, location, is_local, followers_count FROM accounts"))
def _(spark, sf):
    path = scratch_path(spark, "accounts-json")
    ad.raw_accounts(spark, sf).write.json(path)
    a = AC.clean_accounts(readers.scan_accounts_json(spark, path, multiline=False), ad.LOCAL_PLACES)
    return a.select("user_id", "screen_name", "location", "is_local", "followers_count")


@query("S03_scan_follow_lists", sql(EV, PAIRS, select="""
  SELECT count(*) AS nodes, count(*) FILTER (u IN (SELECT dst FROM pairs)) AS found, count(*) FILTER (u NOT IN (SELECT dst FROM pairs)) AS not_found
  FROM (SELECT c_custkey AS u FROM customer)"""))
def _(spark, sf):
    path = scratch_path(spark, "follows")
    lists = ad.follow_lists(spark, sf)
    one = F.struct(F.size("friends").alias("friends_count"), F.lit(0).alias("followers_count"), "friends",
                   F.array().cast("array<bigint>").alias("followers"))
    lists.select(F.pmod("user_id", F.lit(8)).alias("part"), F.to_json(F.create_map(F.col("user_id").cast("string"), one)).alias("value")
                 ).write.partitionBy("part").text(path)
    nodes = ad.accounts(spark, sf).select("user_id")
    return readers.follow_coverage(nodes, readers.scan_follow_lists(spark, path, lines=True))


@query("S04_scan_dated_csv", sql(POSTS, select="SELECT id, user_id, full_text, in_repost_cnt, day_name, array_to_string(tags, ' ') AS tags FROM posts"))
def _(spark, sf):
    path = scratch_path(spark, "posts-csv")
    cols = ["id", "user_id", "full_text", "in_repost_cnt", "tags", "day_name"]
    p = ad.posts(spark, sf).select(*cols).withColumn("tags", F.to_json("tags")).withColumn("folder_name", F.col("day_name"))
    p.write.partitionBy("folder_name").options(header=True, quoteAll=True, escape='"').csv(path)
    schema = ("id bigint, user_id bigint, full_text string, in_repost_cnt bigint, tags string, day_name string")
    back = readers.scan_dated_csv(spark, path, schema, {"tags": "string"})
    return back.select(*[c for c in cols if c != "tags"], F.array_join("tags", " ").alias("tags"))


@query("S05_read_ids", "SELECT c_custkey AS user_id FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "ids")
    ad.table(spark, sf, "customer").select(F.to_json(F.array("c_custkey")).alias("value")).write.text(path)
    listed = readers.read_ids(spark, path, lines=True)
    return listed.unionByName(readers.read_ids(spark, path + "-absent"))


@query("S06_append_and_upsert", sql(EV, select="SELECT user_id, max(id) AS max_id FROM ev GROUP BY user_id"))
def _(spark, sf):
    path = scratch_path(spark, "marks")
    act = ad.activity(spark, sf)
    early = act.filter(F.col("created_at") < F.lit("2024-01-16").cast("timestamp")).groupBy("user_id").agg(F.max("id").alias("max_id"))
    late = act.filter(F.col("created_at") >= F.lit("2024-01-16").cast("timestamp")).groupBy("user_id").agg(F.max("id").alias("max_id"))
    writers.write_table(early, path)
    return B.upsert_latest(spark.read.parquet(path), late, ["user_id"])


@query("S07_write_clean_csv", sql(FLAT, select="SELECT id, full_text, array_to_string(all_tags, ' ') AS all_tags FROM flat"))
def _(spark, sf):
    path = scratch_path(spark, "clean-csv")
    writers.write_clean_csv(ad.flat(spark, sf).select("id", "full_text", "all_tags"), path)
    back = readers.scan_dated_csv(spark, path, ("id bigint, full_text string, all_tags string"), {"all_tags": "string"})
    return back.select("id", "full_text", F.array_join("all_tags", " ").alias("all_tags"))


@query("S08_write_edges", sql(EV, PAIRS, select="SELECT src, dst, id FROM pairs"))
def _(spark, sf):
    path = scratch_path(spark, "edges")
    writers.write_edges(ad.reaction_pairs(spark, sf).select("src", "dst", "id"), path)
    return spark.read.schema("src bigint, dst bigint, id bigint").option("header", True).csv(path)


@query("S09_write_edges_by_tag", sql(FLAT, select="""
  SELECT tag, 'user_' || repost_of_user_id AS src, screen_name AS dst, count(*) AS n
  FROM (SELECT unnest(all_tags) AS tag, * FROM flat WHERE is_repost) WHERE tag IN ('red', 'bolt') GROUP BY 1, 2, 3"""))
def _(spark, sf):
    from ..operators.edges import tag_repost_edges
    path = scratch_path(spark, "tag-edges")
    writers.write_edges_by_tag(tag_repost_edges(ad.flat(spark, sf)), path, ["red", "bolt"])
    back = spark.read.option("header", True).schema("src string, dst string, tag string").csv(f"{path}/by_tag")
    return back.groupBy("tag", "src", "dst").agg(F.count(F.lit(1)).alias("n"))


@query("S10_archive_snapshot", "SELECT c_custkey AS user_id, 'clean_accounts' AS reason, '2024-02-01' AS run_date FROM customer")
def _(spark, sf):
    root = scratch_path(spark, "baseline")
    ids = ad.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    writers.archive_snapshot(ids, root, "clean_accounts", ad.RUN_DAY)
    return spark.read.parquet(f"{root}/history").select("user_id", "reason", F.col("run_date").cast("string").alias("run_date"))


@query("S11_run_metrics", sql(EV, PAIRS, select="""
  SELECT '2024-02-01' AS run_date, 'edges' AS step, metric, value FROM (
    SELECT 'edges' AS metric, CAST(count(*) AS DOUBLE) AS value FROM pairs
    UNION ALL SELECT 'sources', CAST(count(DISTINCT src) AS DOUBLE) FROM pairs)"""))
def _(spark, sf):
    path = scratch_path(spark, "run-log")
    writers.append_run_metrics(ad.reaction_pairs(spark, sf), path, "edges", ad.RUN_DAY,
                               edges=F.count(F.lit(1)), sources=F.count_distinct("src"))
    return spark.read.parquet(path)
