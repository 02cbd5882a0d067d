"""Graph measures over the reaction graph, the tag graphs and the reply chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import edges as ED, trajectory as TR
from ..operators.graph import cells, community as CM, components as CP, core as C, paths as PA, rank as RK, report as RP, triangles as TRI
from . import adapter as ad
from .adapter import ACCOUNTS, EV, FLAT, PAIRS, TRAJ, with_ctes as sql
from .registry import query
from .rollup_queries import rounded, tagged_flat


# ------------------------------------------------------------------ the graphs
def users(spark, sf, directed=False):
    """Who reacted to whom, parallel edges collapsed to their number, no self loops."""
    p = ED.weighted_pairs(ad.reaction_pairs(spark, sf))
    return C.network(p, directed=directed, weight="count", keep_loops=False)


def plain(net):
    return C.Network(net.vertices, net.edges.withColumn("weight", F.lit(1.0)), net.directed)


def tag_graphs(spark, sf):
    """One directed repost graph per tag."""
    return C.network(ED.tag_repost_edges(ad.flat(spark, sf)), directed=True, graph_id="tag", keep_loops=False)


def chains(spark, sf):
    """Conversation turns linked to the turn before: many components."""
    t = ad.table(spark, sf, "conversations").select("conv_id", "turn")
    node = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    e = t.filter("turn > 0").select(node(F.col("turn")).alias("src"), node(F.col("turn") - 1).alias("dst"))
    return C.network(e, t.select(node(F.col("turn")).alias("id")), directed=False)


def nation_labels(spark, sf, net):
    c = ad.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("community"))
    return net.vertices.join(c, "id", "inner")


UE = """ue AS (SELECT 'all' AS g, least(src, dst) AS a, greatest(src, dst) AS b, CAST(count(*) AS DOUBLE) AS w FROM pairs WHERE src <> dst GROUP BY 2, 3),
ar AS (SELECT g, a AS s, b AS t, w FROM ue UNION ALL SELECT g, b, a, w FROM ue),
vx AS (SELECT DISTINCT g, s AS v FROM ar), nn AS (SELECT g, count(*) AS n FROM vx GROUP BY g)"""
DE = """ar AS (SELECT 'all' AS g, src AS s, dst AS t, CAST(count(*) AS DOUBLE) AS w FROM pairs WHERE src <> dst GROUP BY 2, 3),
vx AS (SELECT g, s AS v FROM ar UNION SELECT g, t FROM ar), nn AS (SELECT g, count(*) AS n FROM vx GROUP BY g)"""
TE = """ar AS (SELECT DISTINCT tag AS g, src AS s, dst AS t, 1.0::DOUBLE AS w FROM (
  SELECT unnest(all_tags) AS tag, 'user_' || repost_of_user_id AS src, screen_name AS dst FROM flat WHERE is_repost) WHERE src <> dst),
vx AS (SELECT g, s AS v FROM ar UNION SELECT g, t FROM ar), nn AS (SELECT g, count(*) AS n FROM vx GROUP BY g)"""
CH = """ue AS (SELECT 'all' AS g, conv_id || ':' || (turn - 1) AS a, conv_id || ':' || turn AS b, 1.0::DOUBLE AS w FROM conversations WHERE turn > 0),
ar AS (SELECT g, a AS s, b AS t, w FROM ue UNION ALL SELECT g, b, a, w FROM ue),
vx AS (SELECT 'all' AS g, conv_id || ':' || turn AS v FROM conversations), nn AS (SELECT g, count(*) AS n FROM vx GROUP BY g)"""


def users_sql(select, *more):
    return sql(EV, PAIRS, UE, *more, select=select)


def directed_sql(select, *more):
    return sql(EV, PAIRS, DE, *more, select=select)


def tags_sql(select, *more):
    return sql(FLAT, TE, *more, select=select)


def levels_sql(depth):
    """Breadth-first levels from every vertex with path counts: tables l0..l<depth>, hops."""
    parts = ["l0 AS (SELECT g, v AS s, v, 0 AS d, 1.0::DOUBLE AS sig FROM vx)", "h0 AS (SELECT g, s, v FROM l0)"]
    for k in range(1, depth + 1):
        parts.append(f"l{k} AS (SELECT l.g, l.s, e.t AS v, {k} AS d, sum(l.sig) AS sig FROM l{k - 1} l JOIN ar e ON e.g = l.g AND e.s = l.v "
                     f"ANTI JOIN h{k - 1} h ON h.g = l.g AND h.s = l.s AND h.v = e.t GROUP BY 1, 2, 3)")
        parts.append(f"h{k} AS (SELECT * FROM h{k - 1} UNION ALL SELECT g, s, v FROM l{k})")
    parts.append("hops AS (" + " UNION ALL ".join(f"SELECT * FROM l{k}" for k in range(depth + 1)) + ")")
    return ",\n".join(parts)


def dependencies_sql(depth):
    parts = [f"d{depth} AS (SELECT g, s, v, sig, 0.0::DOUBLE AS dl FROM l{depth})"]
    for k in range(depth - 1, -1, -1):
        parts.append(f"d{k} AS (SELECT l.g, l.s, l.v, l.sig, coalesce(sum(l.sig / n.sig * (1 + n.dl)), 0) AS dl FROM l{k} l "
                     f"LEFT JOIN (SELECT e.g, e.s AS u, n0.s AS src, n0.sig, n0.dl FROM ar e JOIN d{k + 1} n0 ON n0.g = e.g AND n0.v = e.t) n "
                     f"ON n.g = l.g AND n.src = l.s AND n.u = l.v GROUP BY 1, 2, 3, 4)")
    parts.append("bt AS (SELECT x.g, x.v, coalesce(sum(y.dl), 0) AS b FROM vx x LEFT JOIN (" + " UNION ALL ".join(
        f"SELECT g, s, v, dl FROM d{k}" for k in range(1, depth + 1)) + ") y ON y.g = x.g AND y.v = x.v GROUP BY 1, 2)")
    return ",\n".join(parts)


CLOSE = "hm AS (SELECT g, v, count(*) FILTER (d > 0) AS r, CAST(sum(d) AS BIGINT) AS sd, sum(CASE WHEN d > 0 THEN 1.0::DOUBLE / d ELSE 0 END) AS inv, max(d) AS ecc FROM hops GROUP BY 1, 2)"


# ------------------------------------------------------------------ G01-G05: sizes and degrees
@query("G01_graph_sizes", tags_sql("""
  SELECT g AS graph_id, n AS nodes, m AS edges, round(m / n, 6) AS edges_per_node, round(m / (n * (n - 1)), 6) AS density
  FROM nn JOIN (SELECT g, count(*) AS m FROM ar GROUP BY g) USING (g)"""))
def _(spark, sf):
    return rounded(C.graph_sizes(tag_graphs(spark, sf)), "edges_per_node", "density")


DEG = "dg AS (SELECT v.g, v.v, coalesce(o, 0) AS o, coalesce(i, 0) AS i, coalesce(o, 0) + coalesce(i, 0) AS d FROM vx v LEFT JOIN (SELECT g, s AS v, count(*) AS o FROM ar GROUP BY 1, 2) x ON x.g = v.g AND x.v = v.v LEFT JOIN (SELECT g, t AS v, count(*) AS i FROM ar GROUP BY 1, 2) y ON y.g = v.g AND y.v = v.v)"


@query("G02_degrees", tags_sql("SELECT g AS graph_id, v AS id, d AS degree, i AS in_degree, o AS out_degree FROM dg", DEG))
def _(spark, sf):
    return C.degrees(tag_graphs(spark, sf))


@query("G02_average_degrees", tags_sql("""
  SELECT g AS graph_id, round(avg(d) FILTER (d > 0), 6) AS avg_degree, round(avg(i) FILTER (i > 0), 6) AS avg_in_degree,
         round(avg(o) FILTER (o > 0), 6) AS avg_out_degree FROM dg GROUP BY g""", DEG))
def _(spark, sf):
    return rounded(C.average_degrees(tag_graphs(spark, sf), positive_only=True), "avg_degree", "avg_in_degree", "avg_out_degree")


@query("G03_degree_centrality", directed_sql("""
  SELECT g AS graph_id, v AS id, round(d / (n - 1), 6) AS degree_centrality, round(i / (n - 1), 6) AS in_degree_centrality, round(o / (n - 1), 6) AS out_degree_centrality
  FROM dg JOIN nn USING (g)""", DEG))
def _(spark, sf):
    return rounded(C.degree_centrality(users(spark, sf, True)), "degree_centrality", "in_degree_centrality", "out_degree_centrality")


@query("G04_strengths", users_sql("SELECT g AS graph_id, s AS id, sum(w) AS strength FROM ar GROUP BY 1, 2"))
def _(spark, sf):
    return C.strengths(users(spark, sf))


@query("G04_average_strength", users_sql("SELECT 'all' AS graph_id, round(avg(x), 6) AS avg_strength FROM (SELECT s, sum(w) AS x FROM ar GROUP BY s)"))
def _(spark, sf):
    return rounded(C.average_strength(users(spark, sf)), "avg_strength")


@query("G05_density", users_sql("SELECT 'all' AS graph_id, n AS nodes, (SELECT count(*) FROM ue) AS edges, round(2.0::DOUBLE * (SELECT count(*) FROM ue) / (n * (n - 1)), 6) AS density FROM nn"))
def _(spark, sf):
    return rounded(C.graph_sizes(users(spark, sf)).drop("edges_per_node"), "density")


# ------------------------------------------------------------------ G06-G09, G16: components and paths
COMP = "cc AS (SELECT conv_id || ':' || turn AS v, min(conv_id || ':' || turn) OVER (PARTITION BY conv_id) AS c FROM conversations)"


@query("G06_connected_components", sql(COMP, select="SELECT 'all' AS graph_id, v AS id, c AS component FROM cc"))
def _(spark, sf):
    return CP.connected_components(chains(spark, sf).checkpointed())


@query("G06_component_summary", sql(COMP, select="SELECT 'all' AS graph_id, count(*) AS components, max(n) AS largest FROM (SELECT c, count(*) AS n FROM cc GROUP BY c)"))
def _(spark, sf):
    return CP.component_summary(CP.connected_components(chains(spark, sf).checkpointed()))


def reach_sql(rounds):
    """Smallest vertex reachable along undirected arcs: table lab."""
    parts = ["un AS (SELECT g, s, t FROM ar UNION SELECT g, t, s FROM ar)", "m0 AS (SELECT g, v, v AS c FROM vx)"]
    for k in range(1, rounds + 1):
        parts.append(f"m{k} AS (SELECT m.g, m.v, least(m.c, coalesce(min(q.c), m.c)) AS c FROM m{k - 1} m LEFT JOIN un ON un.g = m.g AND un.t = m.v "
                     f"LEFT JOIN m{k - 1} q ON q.g = un.g AND q.v = un.s GROUP BY m.g, m.v, m.c)")
    parts.append(f"lab AS (SELECT * FROM m{rounds})")
    return ",\n".join(parts)


@query("G06_giant_subgraph", tags_sql("""
  , sz AS (SELECT g, c, count(*) AS n, row_number() OVER (PARTITION BY g ORDER BY count(*) DESC, c) AS i FROM lab GROUP BY 1, 2)
  SELECT ar.g AS graph_id, ar.s AS src, ar.t AS dst FROM ar JOIN lab ON lab.g = ar.g AND lab.v = ar.s JOIN sz ON sz.g = lab.g AND sz.c = lab.c AND sz.i = 1""", reach_sql(20)))
def _(spark, sf):
    return CP.giant_subgraph(tag_graphs(spark, sf).checkpointed()).edges.select("graph_id", "src", "dst")


SUMMARY = """
  , gi AS (SELECT * FROM hm WHERE r = (SELECT max(r) FROM hm))
  SELECT 'all' AS graph_id, round(CAST(sum(sd) AS DOUBLE) / (count(*) * (count(*) - 1)), 6) AS avg_path, max(ecc) AS diameter FROM gi"""


@query("G07_path_summary", users_sql(SUMMARY, levels_sql(6), CLOSE))
def _(spark, sf):
    net = users(spark, sf).checkpointed()
    return rounded(PA.path_summary(net, PA.hop_measures(net)).select("graph_id", "avg_path", "diameter"), "avg_path")


@query("G07_path_estimate", users_sql(SUMMARY.replace("max(ecc) AS diameter", "true AS close_to_it"), levels_sql(6), CLOSE))
def _(spark, sf):
    """The exact mean path, and whether the estimate without all sources is within 5 % of it."""
    net = users(spark, sf).checkpointed()
    exact = PA.path_summary(net, PA.hop_measures(net)).select("graph_id", "avg_path")
    near = PA.path_summary(net, PA.hop_estimates(net, 13)).select("graph_id", F.col("avg_path").alias("estimate"))
    close = F.abs(F.col("estimate") / F.col("avg_path") - 1) < 0.05
    return rounded(exact.join(near, "graph_id").select("graph_id", "avg_path", close.alias("close_to_it")), "avg_path")


@query("G07_hop_measures", sql(CH, levels_sql(14), CLOSE, select="SELECT g AS graph_id, v AS id, r AS reach, sd AS sum_dist, round(inv, 6) AS sum_inv, ecc FROM hm"))
def _(spark, sf):
    return rounded(PA.hop_measures(chains(spark, sf).checkpointed()), "sum_inv")


@query("G07_hop_measures_directed", tags_sql("SELECT g AS graph_id, v AS id, r AS reach, sd AS sum_dist, round(inv, 6) AS sum_inv, ecc FROM hm", levels_sql(24), CLOSE))
def _(spark, sf):
    return rounded(PA.hop_measures(tag_graphs(spark, sf).checkpointed()), "sum_inv")


@query("G08_global_efficiency", users_sql("SELECT g AS graph_id, round(sum(inv) / (any_value(n) * (any_value(n) - 1)), 6) AS global_efficiency FROM hm JOIN nn USING (g) GROUP BY g", levels_sql(6), CLOSE))
def _(spark, sf):
    net = users(spark, sf).checkpointed()
    return rounded(PA.path_summary(net, PA.hop_measures(net)).select("graph_id", "global_efficiency"), "global_efficiency")


@query("G09_global_reaching", users_sql("SELECT g AS graph_id, round(sum((SELECT max(inv) FROM hm) - inv) / (any_value(n) - 1) / (any_value(n) - 1), 6) AS global_reaching FROM hm JOIN nn USING (g) GROUP BY g", levels_sql(6), CLOSE))
def _(spark, sf):
    net = users(spark, sf).checkpointed()
    return rounded(PA.path_summary(net, PA.hop_measures(net)).select("graph_id", "global_reaching"), "global_reaching")


@query("G16_closeness", directed_sql("SELECT g AS graph_id, v AS id, round(coalesce(r / nullif(sd, 0) * (r / (n - 1)), 0), 6) AS closeness FROM hm JOIN nn USING (g)", levels_sql(8), CLOSE))
def _(spark, sf):
    net = users(spark, sf, True).checkpointed()
    return rounded(PA.closeness(PA.hop_measures(net), net), "closeness")


# ------------------------------------------------------------------ G10-G13: clustering
TRIS = """nb AS (SELECT DISTINCT g, least(s, t) AS a, greatest(s, t) AS b FROM ar),
sym AS (SELECT g, a AS s, b AS t FROM nb UNION ALL SELECT g, b, a FROM nb),
k AS (SELECT g, s AS v, count(*) AS k FROM sym GROUP BY 1, 2),
tri AS (SELECT x.g, x.a, x.b, y.b AS c FROM nb x JOIN nb y ON y.g = x.g AND y.a = x.b JOIN nb z ON z.g = x.g AND z.a = x.a AND z.b = y.b),
tc AS (SELECT g, v, count(*) AS t FROM (SELECT g, a AS v FROM tri UNION ALL SELECT g, b FROM tri UNION ALL SELECT g, c FROM tri) GROUP BY 1, 2)"""


@query("G10_clustering", users_sql("SELECT k.g AS graph_id, k.v AS id, round(CASE WHEN k < 2 THEN 0.0 ELSE 2.0 * coalesce(t, 0) / (k * (k - 1)) END, 6)::DOUBLE AS clustering FROM k LEFT JOIN tc ON tc.g = k.g AND tc.v = k.v", TRIS))
def _(spark, sf):
    return rounded(TRI.clustering(users(spark, sf).checkpointed()), "clustering")


@query("G10_triangle_counts_by_tag", tags_sql("SELECT k.g AS graph_id, k.v AS id, k AS degree, coalesce(t, 0) AS triangles FROM k LEFT JOIN tc ON tc.g = k.g AND tc.v = k.v", TRIS))
def _(spark, sf):
    return TRI.triangle_counts(tag_graphs(spark, sf).checkpointed())


@query("G10_triangles_by_cells", users_sql("SELECT k.g AS graph_id, k.v AS id, k AS degree, coalesce(t, 0) AS triangles FROM k LEFT JOIN tc ON tc.g = k.g AND tc.v = k.v", TRIS))
def _(spark, sf):
    net = users(spark, sf).checkpointed()
    return TRI.triangle_counts(net, cells.triangles_by_cells(net))


@query("G11_weighted_clustering", users_sql("""
  , wt AS (SELECT x.a, x.b, y.b AS c, cbrt(x.w * y.w * z.w) / (SELECT max(w) FROM ue) AS gm FROM ue x JOIN ue y ON y.a = x.b JOIN ue z ON z.a = x.a AND z.b = y.b),
  ws AS (SELECT v, sum(gm) AS s FROM (SELECT a AS v, gm FROM wt UNION ALL SELECT b, gm FROM wt UNION ALL SELECT c, gm FROM wt) GROUP BY v)
  SELECT k.g AS graph_id, k.v AS id, round(coalesce(2.0::DOUBLE * s / nullif(k * (k - 1), 0), 0), 6) AS clustering FROM k LEFT JOIN ws ON ws.v = k.v""", TRIS))
def _(spark, sf):
    return rounded(TRI.weighted_clustering(users(spark, sf).checkpointed()), "clustering")


@query("G12_directed_clustering", tags_sql("""
  , sm AS (SELECT g, least(s, t) AS a, greatest(s, t) AS b, count(*) AS m FROM ar GROUP BY 1, 2, 3),
  wt AS (SELECT x.g, x.a, x.b, y.b AS c, 2 * x.m * y.m * z.m AS p FROM sm x JOIN sm y ON y.g = x.g AND y.a = x.b JOIN sm z ON z.g = x.g AND z.a = x.a AND z.b = y.b),
  ws AS (SELECT g, v, sum(p) AS t FROM (SELECT g, a AS v, p FROM wt UNION ALL SELECT g, b, p FROM wt UNION ALL SELECT g, c, p FROM wt) GROUP BY 1, 2),
  dd AS (SELECT g, v, sum(m) AS d, count(*) FILTER (m = 2) AS r FROM (SELECT g, a AS v, m FROM sm UNION ALL SELECT g, b, m FROM sm) GROUP BY 1, 2)
  SELECT dd.g AS graph_id, dd.v AS id, round(CASE WHEN t IS NULL THEN 0.0::DOUBLE ELSE t / (2.0::DOUBLE * (d * (d - 1) - 2 * r)) END, 6) AS clustering FROM dd LEFT JOIN ws ON ws.g = dd.g AND ws.v = dd.v"""))
def _(spark, sf):
    return rounded(TRI.directed_clustering(tag_graphs(spark, sf).checkpointed()), "clustering")


@query("G13_transitivity", tags_sql("SELECT k.g AS graph_id, round(coalesce(CAST(sum(2 * coalesce(t, 0)) AS DOUBLE) / nullif(sum(k * (k - 1)), 0), 0), 6) AS transitivity FROM k LEFT JOIN tc ON tc.g = k.g AND tc.v = k.v GROUP BY 1", TRIS))
def _(spark, sf):
    return rounded(TRI.transitivity(tag_graphs(spark, sf).checkpointed()), "transitivity")


# ------------------------------------------------------------------ G14-G17, G26: path-count measures
@query("G14_betweenness", users_sql("SELECT g AS graph_id, v AS id, round(b / ((n - 1) * (n - 2)), 6) AS betweenness FROM bt JOIN nn USING (g)", levels_sql(6), dependencies_sql(6)))
def _(spark, sf):
    return rounded(PA.betweenness(users(spark, sf).checkpointed()), "betweenness")


@query("G14_betweenness_directed", directed_sql("SELECT g AS graph_id, v AS id, round(b / ((n - 1) * (n - 2)), 6) AS betweenness FROM bt JOIN nn USING (g)", levels_sql(8), dependencies_sql(8)))
def _(spark, sf):
    return rounded(PA.betweenness(users(spark, sf, True).checkpointed()), "betweenness")


def relaxations_sql(rounds):
    """Weighted distances between all vertices after a number of relaxation rounds: table wd."""
    parts = ["r0 AS (SELECT g, v AS s, v, 0.0::DOUBLE AS d FROM vx)"]
    for k in range(1, rounds + 1):
        parts.append(f"r{k} AS (SELECT g, s, v, min(d) AS d FROM (SELECT * FROM r{k - 1} UNION ALL "
                     f"SELECT r.g, r.s, e.t, r.d + e.w FROM r{k - 1} r JOIN ar e ON e.g = r.g AND e.s = r.v) GROUP BY 1, 2, 3)")
    parts.append(f"wd AS (SELECT * FROM r{rounds})")
    return ",\n".join(parts)


def tight_sql(rounds):
    """Weighted betweenness from the distances wd: shortest-path arcs, counts and dependencies carried hop by hop: table wb."""
    parts = ["dag AS (SELECT x.s, e.s AS u, e.t AS v FROM ar e JOIN wd x ON x.g = e.g AND x.v = e.s JOIN wd y ON y.g = e.g AND y.s = x.s AND y.v = e.t WHERE x.d + e.w = y.d)",
             "c0 AS (SELECT v AS s, v, 1.0::DOUBLE AS n FROM vx)"]
    for k in range(1, rounds + 1):
        parts.append(f"c{k} AS (SELECT c.s, dag.v, sum(c.n) AS n FROM c{k - 1} c JOIN dag ON dag.s = c.s AND dag.u = c.v GROUP BY 1, 2)")
    parts.append("sg AS (SELECT s, v, sum(n) AS n FROM (" + " UNION ALL ".join(f"SELECT * FROM c{k}" for k in range(rounds + 1)) + ") GROUP BY 1, 2)")
    parts.append("p0 AS (SELECT s, v, 1 / n AS x FROM sg)")
    for k in range(1, rounds + 1):
        parts.append(f"p{k} AS (SELECT p.s, dag.u AS v, sum(p.x) AS x FROM p{k - 1} p JOIN dag ON dag.s = p.s AND dag.v = p.v GROUP BY 1, 2)")
    parts.append("pg AS (SELECT s, v, sum(x) AS x FROM (" + " UNION ALL ".join(f"SELECT * FROM p{k}" for k in range(rounds + 1)) + ") GROUP BY 1, 2)")
    parts.append("wb AS (SELECT v, sum(n * x - 1) AS b FROM sg JOIN pg USING (s, v) WHERE s <> v GROUP BY v)")
    return ",\n".join(parts)


@query("G15_weighted_betweenness", users_sql("SELECT g AS graph_id, vx.v AS id, round(coalesce(b, 0) / ((n - 1) * (n - 2)), 6) AS betweenness FROM vx JOIN nn USING (g) LEFT JOIN wb ON wb.v = vx.v",
                                             relaxations_sql(10), tight_sql(10)))
def _(spark, sf):
    return rounded(PA.betweenness(users(spark, sf).checkpointed(), weighted=True), "betweenness")


@query("G17_weighted_closeness", users_sql("""
  SELECT g AS graph_id, v AS id, round(r / sd * (r / (n - 1)), 6) AS closeness
  FROM (SELECT g, v, count(*) FILTER (s <> v) AS r, sum(d) AS sd FROM wd GROUP BY 1, 2) JOIN nn USING (g)""", relaxations_sql(10)))
def _(spark, sf):
    return rounded(PA.weighted_closeness(users(spark, sf).checkpointed()), "closeness")


@query("G26_mean_path_nodes", directed_sql("SELECT g AS graph_id, s AS id, CAST(ceil(sum(sig * (d + 1)) / sum(sig)) AS BIGINT) AS path_nodes FROM hops GROUP BY 1, 2", levels_sql(8)))
def _(spark, sf):
    return PA.mean_path_nodes(users(spark, sf, True).checkpointed())


# ------------------------------------------------------------------ G18-G23, G28: degree statistics and communities
@query("G18_degree_heterogeneity", tags_sql("SELECT g AS graph_id, round(round_even(stddev_pop(d), 0) / avg(d), 6) AS degree_heterogeneity FROM dg GROUP BY g", DEG))
def _(spark, sf):
    return rounded(C.degree_heterogeneity(tag_graphs(spark, sf)), "degree_heterogeneity")


@query("G19_degree_assortativity", users_sql("""
  , dd AS (SELECT s AS v, count(*) AS d FROM ar GROUP BY s)
  SELECT 'all' AS graph_id, round(corr(x.d, y.d), 6) AS degree_assortativity FROM ar JOIN dd x ON x.v = ar.s JOIN dd y ON y.v = ar.t"""))
def _(spark, sf):
    return rounded(C.degree_assortativity(users(spark, sf).checkpointed()), "degree_assortativity")


LAB = """lb AS (SELECT c_custkey AS v, c_nationkey AS c FROM customer WHERE c_custkey IN (SELECT v FROM vx)),
le AS (SELECT ue.*, x.c AS ca, y.c AS cb FROM ue JOIN lb x ON x.v = ue.a JOIN lb y ON y.v = ue.b),
md AS (SELECT c, sum(i) AS i, sum(s) AS s, sum(d) AS d FROM (
  SELECT ca AS c, w AS s, CASE WHEN ca = cb THEN w ELSE 0 END AS i, 1 AS d FROM le UNION ALL SELECT cb, w, 0, 1 FROM le) GROUP BY c)"""
MODULARITY = "(SELECT sum(i / m - power(s / (2 * m), 2)) FROM md, (SELECT sum(w) AS m FROM ue))"


@query("G21_modularity", users_sql(f"SELECT 'all' AS graph_id, round({MODULARITY}, 6) AS modularity", LAB))
def _(spark, sf):
    net = users(spark, sf)
    return rounded(CM.modularity(net, nation_labels(spark, sf, net)), "modularity")


@query("G22_modularity_bounds", users_sql(f"""
  , q AS (SELECT {MODULARITY} AS q, round((SELECT sum(d / t - (d / t) * (d / t)) FROM md, (SELECT sum(d) AS t FROM md)), 4) AS q_max)
  SELECT 'all' AS graph_id, round(q, 6) AS modularity, q_max, round(q / q_max, 3) AS relative FROM q""", LAB))
def _(spark, sf):
    net = users(spark, sf)
    return rounded(CM.modularity_bounds(net, nation_labels(spark, sf, net)), "modularity")


@query("G23_average_within_degree", users_sql("SELECT 'all' AS graph_id, round(2.0::DOUBLE * (SELECT count(*) FROM le WHERE ca = cb) / (SELECT n FROM nn), 6) AS avg_within_degree", LAB))
def _(spark, sf):
    net = users(spark, sf)
    return rounded(CM.average_within_degree(net, nation_labels(spark, sf, net)), "avg_within_degree")


@query("G20_communities")
def _(spark, sf):
    return CM.communities(users(spark, sf).checkpointed())


@query("G27_girvan_newman", """
  WITH n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1),
  -- a chain of n loses its middle edge first, the earlier one on a tie; then the longer part, the earlier one on a tie, loses its own
  a AS (SELECT conv_id, n, CASE WHEN n < 2 THEN n ELSE (n - 2) // 2 + 1 END AS a FROM n),
  c AS (SELECT conv_id, n, a, CASE WHEN n - a > a THEN a + (n - a - 2) // 2 + 1 WHEN a > 1 THEN (a - 2) // 2 + 1 ELSE a END AS c FROM a)
  SELECT conv_id AS graph_id, turn AS id, CAST((CASE WHEN turn >= a THEN 1 ELSE 0 END) + (CASE WHEN c <> a AND turn >= c THEN 1 ELSE 0 END) AS BIGINT) AS community
  FROM conversations JOIN c USING (conv_id)""")
def _(spark, sf):
    """Every conversation's reply chain split twice, all of them in the same two rounds."""
    t = ad.table(spark, sf, "conversations").select(F.col("conv_id").alias("graph_id"), "turn")
    e = t.filter("turn > 0").select("graph_id", F.col("turn").alias("src"), (F.col("turn") - 1).alias("dst"))
    net = C.network(e, t.select("graph_id", F.col("turn").alias("id")), directed=False, graph_id="graph_id")
    return CM.numbered_communities(CM.girvan_newman(net), "split_2", net.vertices)


@query("G28_community_flag_sizes", users_sql("""
  , j AS (SELECT c, is_local FROM lb JOIN accounts a ON a.user_id = lb.v),
  top AS (SELECT c, count(*) AS total FROM j GROUP BY c ORDER BY total DESC, c LIMIT 10)
  SELECT 'all' AS graph_id, c AS community, is_local, count(*) AS size, total FROM j JOIN top USING (c) GROUP BY c, is_local, total""", LAB, ACCOUNTS))
def _(spark, sf):
    flags = ad.accounts(spark, sf).select(F.col("user_id").alias("id"), "is_local")
    return CM.community_flag_sizes(nation_labels(spark, sf, users(spark, sf)), flags, "is_local")


# ------------------------------------------------------------------ G24, G25: rank
def pagerank_sql(rounds, alpha=0.85):
    parts = ["ow AS (SELECT g, s, sum(w) AS o FROM ar GROUP BY 1, 2)",
             "p0 AS (SELECT vx.g, vx.v, n, o, 1.0::DOUBLE / n AS r FROM vx JOIN nn USING (g) LEFT JOIN ow ON ow.g = vx.g AND ow.s = vx.v)"]
    for k in range(1, rounds + 1):
        parts.append(f"p{k} AS (SELECT p.g, p.v, p.n, p.o, {alpha} * (coalesce(i.x, 0) + coalesce(l.x, 0) / p.n) + {1 - alpha:.2f}::DOUBLE / p.n AS r FROM p{k - 1} p "
                     f"LEFT JOIN (SELECT e.g, e.t, sum(q.r / q.o * e.w) AS x FROM ar e JOIN p{k - 1} q ON q.g = e.g AND q.v = e.s GROUP BY 1, 2) i ON i.g = p.g AND i.t = p.v "
                     f"LEFT JOIN (SELECT g, sum(r) AS x FROM p{k - 1} WHERE o IS NULL GROUP BY g) l ON l.g = p.g)")
    return ",\n".join(parts)


@query("G24_pagerank", directed_sql("SELECT g AS graph_id, v AS id, round(r, 6) AS rank FROM p28", pagerank_sql(28)))
def _(spark, sf):
    return rounded(RK.pagerank(users(spark, sf, True).checkpointed(), tol=1e-12), "rank")


@query("G24_pagerank_by_tag", tags_sql("SELECT g AS graph_id, v AS id, round(r, 6) AS rank FROM p90", pagerank_sql(90)))
def _(spark, sf):
    return rounded(RK.pagerank(tag_graphs(spark, sf).checkpointed(), tol=1e-12), "rank")


def eigen_sql(rounds):
    parts = ["e0 AS (SELECT g, v, 1.0::DOUBLE / sqrt(n) AS x FROM vx JOIN nn USING (g))"]
    for k in range(1, rounds + 1):
        parts.append(f"y{k} AS (SELECT p.g, p.v, p.x + coalesce(i.x, 0) AS y FROM e{k - 1} p LEFT JOIN (SELECT a.g, a.t, sum(q.x * a.w) AS x FROM ar a JOIN e{k - 1} q ON q.g = a.g AND q.v = a.s GROUP BY 1, 2) i ON i.g = p.g AND i.t = p.v)")
        parts.append(f"e{k} AS (SELECT g, v, y / sqrt(sum(y * y) OVER (PARTITION BY g)) AS x FROM y{k})")
    return ",\n".join(parts)


@query("G25_eigenvector", users_sql("SELECT g AS graph_id, v AS id, round(x, 6) AS centrality FROM e60", eigen_sql(60)))
def _(spark, sf):
    return rounded(RK.eigenvector(users(spark, sf).checkpointed(), tol=1e-12), "centrality")


# ------------------------------------------------------------------ G29-G32: reports
@query("G29_measure_filter", directed_sql("SELECT g AS graph_id, v AS id, d / 10.0::DOUBLE AS degree FROM dg WHERE d > 50 ORDER BY d DESC, g, v LIMIT 7", DEG))
def _(spark, sf):
    d = C.degrees(users(spark, sf, True)).select("graph_id", "id", (F.col("degree") / 10).alias("degree"))
    return C.measure_filter(d, "degree", 5.0, 7)


TAG_MEASURES = ["density", "avg_degree", "avg_in_degree", "avg_out_degree", "avg_betweenness", "betweenness", "best_pagerank", "avg_clustering"]


@query("G30_tag_measures")
def _(spark, sf):
    return RP.subgraph_measures(tag_graphs(spark, sf).checkpointed())


@query("G30_measure_correlation")
def _(spark, sf):
    uses = tagged_flat(spark, sf).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    popular = uses.select(F.col("tag").alias("graph_id"), (F.col("n") > uses.select(F.avg("n")).scalar()).cast("double").alias("popular"))
    return RP.measure_label_correlation(RP.subgraph_measures(tag_graphs(spark, sf).checkpointed()), popular, TAG_MEASURES)


@query("G31_global_measures")
def _(spark, sf):
    contacts = TR.contact_edges(TR.contacts(ad.trajectories(spark, sf), 20.0, 2), 24.0)
    return RP.global_measures(contacts.select("src", "dst", "count", "duration"))


@query("G32_node_distributions")
def _(spark, sf):
    return RP.node_distributions(users(spark, sf).checkpointed())
