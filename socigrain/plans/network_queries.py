"""Id bookkeeping, incremental loads, edges and trajectories."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import accounts as AC, baseline as B, edges as ED, tags as TG, trajectory as TR
from . import adapter as ad
from .adapter import ACCOUNTS, EV, FLAT, PAIRS, TRAJ, with_ctes as sql
from .registry import query
from .rollup_queries import rounded, tagged_flat

# ------------------------------------------------------------------ U, I: ids
BASE = """baseline AS (SELECT user_id FROM accounts WHERE NOT protected AND is_local AND statuses_count > 10 AND friends_count > 10 AND followers_count > 10),
processed AS (SELECT user_id FROM accounts WHERE verified)"""


def _baseline(spark, sf):
    return AC.quality_filter(ad.accounts(spark, sf)).select("user_id")


def _processed(spark, sf):
    return ad.accounts(spark, sf).filter("verified").select("user_id")


@query("U01_concat", """SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier""")
def _(spark, sf):
    c = ad.table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"),
                                               F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = ad.table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


@query("U02_difference", sql(EV, select="SELECT c_custkey AS user_id FROM customer EXCEPT SELECT user_id FROM ev"))
def _(spark, sf):
    return B.without_ids(ad.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id")), ad.activity(spark, sf).select("user_id"))


@query("U03_union_of_friends", sql(EV, PAIRS, select="SELECT DISTINCT src AS user_id FROM pairs"))
def _(spark, sf):
    return B.union_of_friends(ad.follow_lists(spark, sf))


@query("U04_candidates_from_follows", sql(EV, PAIRS, ACCOUNTS, BASE, select="""
  SELECT DISTINCT src AS user_id FROM pairs WHERE dst IN (SELECT user_id FROM baseline)
    AND src NOT IN (SELECT user_id FROM baseline) AND src NOT IN (SELECT user_id FROM processed)"""))
def _(spark, sf):
    return B.candidates_from_follows(ad.follow_lists(spark, sf), _baseline(spark, sf), _processed(spark, sf))


@query("U05_candidates_from_mentions", sql(FLAT, ACCOUNTS, BASE, select="""
  SELECT DISTINCT CAST(m[6:] AS BIGINT) AS user_id FROM (SELECT unnest(mentions) AS m FROM flat)
  WHERE CAST(m[6:] AS BIGINT) NOT IN (SELECT user_id FROM baseline) AND CAST(m[6:] AS BIGINT) NOT IN (SELECT user_id FROM processed)"""))
def _(spark, sf):
    return B.candidates_from_mentions(ad.flat(spark, sf), _baseline(spark, sf), _processed(spark, sf))


@query("U06_candidates_from_reposts", sql(FLAT, ACCOUNTS, BASE, select="""
  SELECT DISTINCT repost_of_user_id AS user_id FROM flat WHERE is_repost
    AND repost_of_user_id NOT IN (SELECT user_id FROM baseline) AND repost_of_user_id NOT IN (SELECT user_id FROM processed)"""))
def _(spark, sf):
    return B.candidates_from_reposts(ad.flat(spark, sf), _baseline(spark, sf), _processed(spark, sf))


@query("U07_pending_ids", sql(ACCOUNTS, BASE, select="""
  SELECT user_id FROM baseline WHERE user_id NOT IN (SELECT user_id FROM accounts WHERE location = '') AND user_id NOT IN (SELECT user_id FROM processed)"""))
def _(spark, sf):
    missing = ad.accounts(spark, sf).filter("location = ''").select("user_id")
    return B.pending_ids(_baseline(spark, sf), missing, _processed(spark, sf))


@query("U08_update_filtered_baseline", sql(ACCOUNTS, select="""
  SELECT user_id, followers_count + 1 AS followers_count FROM accounts
  WHERE NOT protected AND is_local AND statuses_count > 10 AND friends_count > 10 AND followers_count + 1 > 10"""))
def _(spark, sf):
    from ..session import scratch_path
    from ..sources import writers
    root = scratch_path(spark, "filtered-baseline")
    new = B.filtered_baseline(ad.account_days(spark, sf))
    writers.archive_snapshot(_baseline(spark, sf), root, "clean_accounts", ad.RUN_DAY)
    watched, seen = writers.with_metrics(new, "filtered_baseline", local_accounts=F.count(F.lit(1)))
    writers.write_table(watched, f"{root}/current")
    writers.write_table(spark.createDataFrame([(seen.get["local_accounts"],)], "local_accounts bigint"), f"{root}/log")
    return spark.read.parquet(f"{root}/current")


@query("U10_bipartite_nodes", sql(FLAT, select="""
  , e AS (SELECT screen_name AS src, unnest(all_tags) AS dst FROM flat WHERE is_original)
  SELECT src AS id, 'user' AS node_type FROM e UNION SELECT dst, 'tag' FROM e WHERE dst NOT IN (SELECT src FROM e)"""))
def _(spark, sf):
    return B.bipartite_nodes(ED.user_tag_edges(ad.flat(spark, sf)))


CUT = "2024-01-16"


@query("I01_incremental_batch", sql(EV, select=f"""
  , marks AS (SELECT user_id, max(id) AS max_id FROM ev WHERE created_at < TIMESTAMP '{CUT}' GROUP BY 1)
  SELECT ev.id, ev.user_id FROM ev LEFT JOIN marks m ON m.user_id = ev.user_id WHERE m.max_id IS NULL OR ev.id > m.max_id"""))
def _(spark, sf):
    act = ad.activity(spark, sf)
    early = act.filter(F.col("created_at") < F.lit(CUT).cast("timestamp"))
    marks = early.groupBy("user_id").agg(F.max("id").alias("max_id"))
    return B.newer_than_marks(act, marks).select("id", "user_id")


@query("I01_advance_marks", sql(EV, select="SELECT user_id, max(id) AS max_id FROM ev GROUP BY 1"))
def _(spark, sf):
    act = ad.activity(spark, sf)
    early = act.filter(F.col("created_at") < F.lit(CUT).cast("timestamp"))
    marks = early.groupBy("user_id").agg(F.max("id").alias("max_id"))
    return B.advance_marks(marks, B.newer_than_marks(act, marks))


# ------------------------------------------------------------------ E: nodes and edges
NODES = "nodes AS (SELECT a.*, n AS total_posts FROM accounts a JOIN (SELECT user_id, count(*) AS n FROM ev GROUP BY 1) e ON e.user_id = a.user_id)"
LOCAL_NODES = "local_nodes AS (SELECT * FROM nodes WHERE is_local)"


def _nodes(spark, sf):
    return ED.nodes(ad.activity(spark, sf), ad.accounts(spark, sf))


def _local_nodes(spark, sf):
    return _nodes(spark, sf).filter("is_local")


@query("E01_nodes", sql(EV, ACCOUNTS, NODES, select="SELECT user_id, total_posts, CAST(followers_count AS DOUBLE) AS out_d, CAST(friends_count AS DOUBLE) AS in_d, is_local FROM nodes"))
def _(spark, sf):
    return _nodes(spark, sf).select("user_id", "total_posts", "out_d", "in_d", "is_local")


@query("E02_follow_edges", sql(EV, PAIRS, ACCOUNTS, NODES, LOCAL_NODES, select="""
  SELECT DISTINCT src, dst FROM pairs WHERE src IN (SELECT user_id FROM local_nodes) AND dst IN (SELECT user_id FROM local_nodes)"""))
def _(spark, sf):
    return ED.follow_edges(_local_nodes(spark, sf).select("user_id"), ad.follow_lists(spark, sf))


@query("E03_mention_edges", sql(FLAT, ACCOUNTS, NODES, LOCAL_NODES, select="""
  SELECT src, dst, count(*) AS n FROM (SELECT user_id AS src, CAST(m[6:] AS BIGINT) AS dst FROM (SELECT user_id, unnest(mentions) AS m FROM flat))
  WHERE src <> dst AND src IN (SELECT user_id FROM local_nodes) AND dst IN (SELECT user_id FROM local_nodes) GROUP BY 1, 2"""))
def _(spark, sf):
    return ED.weighted_pairs(ED.mention_edges(_local_nodes(spark, sf).select("user_id"), ad.flat(spark, sf))).withColumnRenamed("count", "n")


@query("E04_repost_edges", sql(FLAT, ACCOUNTS, NODES, LOCAL_NODES, select="""
  SELECT repost_of_user_id AS src, f.user_id AS dst, f.id AS repost_id, repost_of_id AS post_id, repost_delay_sec AS delay_sec, lang, full_text,
         'user_' || repost_of_user_id AS src_name, 'user_' || f.user_id AS dst_name
  FROM flat f WHERE is_repost AND repost_of_user_id <> f.user_id
    AND repost_of_user_id IN (SELECT user_id FROM local_nodes) AND f.user_id IN (SELECT user_id FROM local_nodes)"""))
def _(spark, sf):
    return ED.repost_edges(_local_nodes(spark, sf), ad.flat(spark, sf)).drop("reposted_at", "posted_at")


@query("E05_edge_coverage", sql(EV, PAIRS, ACCOUNTS, NODES, select="""
  SELECT (SELECT count(DISTINCT user_id) FROM nodes) AS nodes, count(DISTINCT src) AS nodes_with_edges, count(*) AS edges FROM pairs WHERE src <> dst"""))
def _(spark, sf):
    return ED.edge_coverage(_nodes(spark, sf).select("user_id"), ED.drop_self_loops(ad.reaction_pairs(spark, sf)))


TAG_EDGES = "tag_edges AS (SELECT unnest(all_tags) AS tag, 'user_' || repost_of_user_id AS src, screen_name AS dst FROM flat WHERE is_repost)"


@query("E06_tag_repost_edges", sql(FLAT, TAG_EDGES, select="SELECT tag, src, dst, count(*) AS n FROM tag_edges GROUP BY 1, 2, 3"))
def _(spark, sf):
    return ED.weighted_pairs(ED.tag_repost_edges(ad.flat(spark, sf)), ["tag", "src", "dst"]).withColumnRenamed("count", "n")


TOP = "top AS (SELECT tag FROM (SELECT unnest(all_tags) AS tag FROM flat) GROUP BY tag ORDER BY count(*) DESC, tag LIMIT 5)"


def _top_tags(spark, sf, k=5):
    return tagged_flat(spark, sf).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag").limit(k).select("tag")


@query("E07_user_tag_edges", sql(FLAT, TOP, select="""
  SELECT src, dst, count(*) AS n FROM (SELECT screen_name AS src, unnest(all_tags) AS dst FROM flat WHERE is_original)
  WHERE src IN (SELECT screen_name FROM flat WHERE is_repost AND len(all_tags) > 0) AND dst IN (SELECT tag FROM top) GROUP BY 1, 2"""))
def _(spark, sf):
    return ED.weighted_pairs(ED.user_tag_edges(ad.flat(spark, sf), _top_tags(spark, sf))).withColumnRenamed("count", "n")


@query("E08_tag_pair_edges", sql(FLAT, TOP, select="""
  SELECT all_tags[i] AS src, all_tags[i + 1] AS dst, count(*) AS n FROM (SELECT all_tags, unnest(range(1, len(all_tags), 2)) AS i FROM flat)
  WHERE all_tags[i] IN (SELECT tag FROM top) GROUP BY 1, 2"""))
def _(spark, sf):
    return ED.weighted_pairs(ED.tag_pair_edges(ad.flat(spark, sf), _top_tags(spark, sf))).withColumnRenamed("count", "n")


@query("E09_simple_graph", sql(EV, PAIRS, select="SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM pairs"))
def _(spark, sf):
    return ED.simple_graph(ad.reaction_pairs(spark, sf), directed=False)


# contacts: within 20 + 1 of each other for at least 1 frame, 2 frames a second
NEAR = """near AS (SELECT a.entity AS ea, b.entity AS eb, a.frame, sqrt((a.pos_x - b.pos_x) * (a.pos_x - b.pos_x) + (a.pos_y - b.pos_y) * (a.pos_y - b.pos_y)) AS dist
  FROM traj a JOIN traj b ON a.frame = b.frame AND a.entity < b.entity
  WHERE sqrt((a.pos_x - b.pos_x) * (a.pos_x - b.pos_x) + (a.pos_y - b.pos_y) * (a.pos_y - b.pos_y)) <= 21),
runs AS (SELECT ea, eb, min(frame) AS s, max(frame) AS e, count(*) AS frames FROM (
  SELECT *, frame - row_number() OVER (PARTITION BY ea, eb ORDER BY frame) AS island FROM near) GROUP BY ea, eb, island HAVING count(*) >= 2)"""


def _runs(spark, sf):
    return TR.contacts(ad.trajectories(spark, sf), 20.0, 2)


EDGE_SQL = """SELECT src, dst, count, round(duration, 6) AS duration, round(count / duration / 0.5, 6) AS frequency,
  round(1 / 599.5 * (duration / count - 0.5), 6) AS averaging FROM (SELECT ea AS src, eb AS dst, count(*) AS count, sum(frames) / 24.0::DOUBLE AS duration FROM runs GROUP BY 1, 2)"""


@query("E10_contact_edges", sql(EV, TRAJ, NEAR, select=EDGE_SQL))
def _(spark, sf):
    return rounded(TR.edges_of_totals(TR.contact_totals(ad.trajectories(spark, sf), 20.0, 2), 24.0), "duration", "frequency", "averaging")


@query("E11_contact_multi_edges", sql(EV, TRAJ, NEAR, select="SELECT ea AS src, eb AS dst, frames AS duration FROM runs"))
def _(spark, sf):
    return TR.contact_multi_edges(_runs(spark, sf))


@query("E12_contact_intervals", sql(EV, TRAJ, NEAR, select='SELECT ea AS src, eb AS dst, s AS "start", e AS "end" FROM runs'))
def _(spark, sf):
    return TR.contact_intervals(_runs(spark, sf))


@query("E13_collapse_multi_edges", sql(EV, TRAJ, NEAR, select=EDGE_SQL))
def _(spark, sf):
    return rounded(TR.collapsed_contacts(TR.contact_totals(ad.trajectories(spark, sf), 20.0, 2), 24.0), "duration", "frequency", "averaging")


# ------------------------------------------------------------------ W01-W06, R: trajectories
@query("W01_differences", sql(EV, TRAJ, select="""
  SELECT entity, frame, round(pos_x - lag(pos_x, 3) OVER w, 6) AS pos_x_diff, round(pos_y - lag(pos_y, 3) OVER w, 6) AS pos_y_diff
  FROM traj WINDOW w AS (PARTITION BY entity ORDER BY frame)"""))
def _(spark, sf):
    d = TR.differences(ad.trajectories(spark, sf), ["pos_x", "pos_y"], 3)
    return rounded(d.drop("pos_x", "pos_y"), "pos_x_diff", "pos_y_diff")


@query("W02_path_values", sql(EV, TRAJ, select="""
  , s AS (SELECT *, pos_x - lag(pos_x) OVER w AS dx, pos_y - lag(pos_y) OVER w AS dy, pos_x - lag(pos_x, 5) OVER w AS wx, pos_y - lag(pos_y, 5) OVER w AS wy
    FROM traj WINDOW w AS (PARTITION BY entity ORDER BY frame)),
  t AS (SELECT *, sqrt(dx * dx + dy * dy) AS step, sqrt(wx * wx + wy * wy) AS spl FROM s),
  u AS (SELECT *, CASE WHEN count(step) OVER r = 5 THEN sum(step) OVER r END AS rpl FROM t WINDOW r AS (PARTITION BY entity ORDER BY frame ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
  SELECT entity, frame, round(coalesce(step, 0), 5) AS step, round(coalesce(spl, 0), 5) AS spl, round(coalesce(rpl, 0), 5) AS rpl,
         round(coalesce(spl / nullif(rpl, 0), 0), 6) AS str_index, round(coalesce(abs(wx), 0), 5) AS abs_change_x, round(coalesce(abs(wy), 0), 5) AS abs_change_y FROM u"""))
def _(spark, sf):
    p = TR.path_values(ad.trajectories(spark, sf), 5).drop("pos_x", "pos_y")
    return rounded(rounded(p, "step", "spl", "rpl", "abs_change_x", "abs_change_y", digits=5), "str_index")


def _rolling_sql(window):
    """Measures of full windows; every window function shares one frame."""
    shown = ", ".join(
        f"CASE WHEN n = {window} THEN round({e}, 5) END AS pos_x_{c}" for c, e in (
            ("min", "mn"), ("max", "mx"), ("mean", "av"), ("std", "sd"), ("median", "q[3]"), ("p10", "q[1]"), ("p25", "q[2]"), ("p75", "q[4]"), ("p90", "q[5]")))
    return sql(EV, TRAJ, select=f"""SELECT entity, frame, {shown}
  FROM (SELECT entity, frame, count(pos_x) OVER w AS n, min(pos_x) OVER w AS mn, max(pos_x) OVER w AS mx, avg(pos_x) OVER w AS av, stddev_samp(pos_x) OVER w AS sd,
          quantile_cont(pos_x, [0.1, 0.25, 0.5, 0.75, 0.9]) OVER w AS q FROM traj WINDOW w AS (PARTITION BY entity ORDER BY frame ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW))""")


def _rolling(spark, sf, window):
    d = TR.rolling_descriptor(ad.trajectories(spark, sf), "pos_x", window)
    return rounded(d.drop("pos_x", "pos_y"), *[c for c in d.columns if c.startswith("pos_x_")], digits=5)


@query("W03_rolling_descriptor", _rolling_sql(7))
def _(spark, sf):
    return _rolling(spark, sf, 7)


@query("W03_rolling_wide", _rolling_sql(60))
def _(spark, sf):
    return _rolling(spark, sf, 60)


@query("W04_forward_fill", sql(EV, TRAJ, select="""
  , g AS (SELECT entity, frame, CASE WHEN pos_y >= 30 THEN pos_x END AS pos_x, pos_y FROM traj),
  h AS (SELECT entity, frame, last_value(pos_x IGNORE NULLS) OVER (PARTITION BY entity ORDER BY frame ROWS UNBOUNDED PRECEDING) AS pos_x, pos_y FROM g)
  SELECT entity, frame, round(pos_x - (SELECT min(pos_x) FROM h), 6) AS pos_x, round(pos_y - (SELECT min(pos_y) FROM h), 6) AS pos_y FROM h"""))
def _(spark, sf):
    gaps = ad.trajectories(spark, sf).withColumn("pos_x", F.when(F.col("pos_y") >= 30, F.col("pos_x")))
    filled = TR.shift_to_origin(TR.forward_fill(gaps, ["pos_x"]))
    return rounded(filled.select("entity", "frame", "pos_x", "pos_y"), "pos_x", "pos_y")


@query("W05_acceleration", sql(EV, TRAJ, select="""
  SELECT entity, frame, round(acceleration, 6) AS acceleration FROM (
    SELECT entity, frame, lead(pos_x) OVER (PARTITION BY entity ORDER BY frame) - pos_x AS acceleration FROM traj) WHERE acceleration IS NOT NULL"""))
def _(spark, sf):
    v = ad.trajectories(spark, sf).withColumnRenamed("pos_x", "velocity")
    return rounded(TR.acceleration(v), "acceleration")


@query("W06_contact_runs", sql(EV, TRAJ, NEAR, select='SELECT ea AS entity_a, eb AS entity_b, s AS "start", e AS "end", frames FROM runs'))
def _(spark, sf):
    return _runs(spark, sf)


PAIR_DIST = """SELECT p.a AS entity_a, p.b AS entity_b, x.frame, round(sqrt((x.pos_x - y.pos_x) * (x.pos_x - y.pos_x) + (x.pos_y - y.pos_y) * (x.pos_y - y.pos_y)), 6) AS dist
  FROM (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM pairs WHERE src <> dst) p
  JOIN traj x ON x.entity = p.a JOIN traj y ON y.entity = p.b AND y.frame = x.frame"""


@query("J12_pairwise_frame_join", sql(EV, PAIRS, TRAJ, select=f"SELECT entity_a, entity_b, count(*) AS frames, round(min(dist), 6) AS nearest FROM ({PAIR_DIST}) GROUP BY 1, 2"))
def _(spark, sf):
    d = R04(spark, sf)
    return d.groupBy("entity_a", "entity_b").agg(F.count(F.lit(1)).alias("frames"), F.round(F.min("dist"), 6).alias("nearest"))


@query("R04_pair_distances", sql(EV, PAIRS, TRAJ, select=PAIR_DIST))
def R04(spark, sf):
    e = ED.simple_graph(ED.drop_self_loops(ad.reaction_pairs(spark, sf)), directed=False)
    pairs = e.select(F.col("src").alias("entity_a"), F.col("dst").alias("entity_b"))
    return rounded(TR.pair_distances(ad.trajectories(spark, sf), pairs), "dist")


@query("R01_load_population", sql(EV, TRAJ, select="SELECT CAST(entity AS VARCHAR) AS entity, frame, round_even(pos_x, 0) AS pos_x, round_even(pos_y, 0) AS pos_y FROM traj"))
def _(spark, sf):
    from ..session import scratch_path
    from ..sources.readers import load_population
    from ..sources.writers import write_population
    path = scratch_path(spark, "population")
    t = ad.trajectories(spark, sf).select(F.col("entity"), F.col("frame"), F.col("pos_x").alias("pos x"), F.col("pos_y").alias("pos y"))
    write_population(t, path)
    return load_population(spark, path)


@query("R02_check_columns", "SELECT true AS ok, false AS ok_if_swapped")
def _(spark, sf):
    from ..session import cut, scratch_path
    from ..sources.readers import compare_headers, file_headers
    from ..sources.writers import write_population
    path = scratch_path(spark, "population")
    write_population(ad.trajectories(spark, sf).select("frame", "pos_x", "pos_y", "entity"), path)
    # file names repeat in the folders, so the two checks meet as one row each
    headers = cut(file_headers(spark, path), "headers")
    right, swapped = compare_headers(headers, ["frame", "pos_x", "pos_y", "entity"]), compare_headers(headers, ["frame", "pos_y", "pos_x", "entity"])
    return right.agg(F.bool_and("ok").alias("ok")).crossJoin(swapped.agg(F.bool_or("ok").alias("ok_if_swapped")))


@query("R03_coordinates_union", sql(EV, TRAJ, select="SELECT pos_x, pos_y FROM traj WHERE pos_x IS NOT NULL AND pos_y IS NOT NULL"))
def _(spark, sf):
    return TR.coordinates_union(ad.trajectories(spark, sf))


@query("R05_group_values", """
  SELECT CASE WHEN c_mktsegment LIKE 'B%' THEN 'COC' ELSE 'CTRL' END AS "group", c_custkey, c_acctbal AS value FROM customer""")
def _(spark, sf):
    c = ad.table(spark, sf, "customer").select(
        F.concat(F.when(F.col("c_mktsegment").startswith("B"), "COC").otherwise("CTRL"), F.lit("_"), F.col("c_mktsegment")).alias("population"),
        "c_custkey", F.col("c_acctbal").alias("value"))
    return TR.group_values(c).drop("population")
