"""Hand-computed measures of small graphs; several graphs share a job by graph_id."""

import random

import pytest

from socigrain.operators.graph import cells, community as CM, components as CP, core as C, packed, paths as PA, rank as RK, stars, triangles as TRI

K4 = [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]
GRAPHS = {
    "path": [(1, 2), (2, 3), (3, 4), (4, 5)],
    "star": [(0, i) for i in range(1, 6)],
    "cliques": K4 + [(a + 4, b + 4) for a, b in K4] + [(4, 5)],
    "split": [(1, 2), (3, 4)],
}


def build(spark, graphs, directed=False, weights=None):
    rows = [(g, a, b, float((weights or {}).get((a, b), 1))) for g, es in graphs.items() for a, b in es]
    e = spark.createDataFrame(rows, "g string, src long, dst long, w double")
    return C.network(e, directed=directed, graph_id="g", weight="w").checkpointed()


@pytest.fixture(scope="module")
def net(spark):
    return build(spark, GRAPHS)


def by_node(df, value):
    return {(r["graph_id"], r["id"]): r[value] for r in df.collect()}


def test_components(spark, net, monkeypatch):
    comp = by_node(CP.connected_components(net), "component")
    assert comp["split", 2] == 1 and comp["split", 4] == 3
    assert {comp["path", i] for i in range(1, 6)} == {1}
    long = build(spark, {"long": [(i, i + 1) for i in range(1, 10_000)]})
    rounds, store = [], stars.cut
    monkeypatch.setattr(stars, "cut", lambda *a: rounds.append(1) or store(*a))
    assert CP.connected_components(long).select("component").distinct().count() == 1
    assert len(rounds) <= 20


def test_hops_and_summary(net):
    hops = PA.hop_measures(net, words=1, batches_at_once=1)
    sums = by_node(hops, "sum_dist")
    assert [sums["path", i] for i in range(1, 6)] == [10, 7, 6, 7, 10]
    s = {r["graph_id"]: r for r in PA.path_summary(net, hops).collect()}
    assert s["path"]["avg_path"] == pytest.approx(2.0) and s["path"]["diameter"] == 4
    assert s["star"]["global_reaching"] == pytest.approx(5 * (5 - 3) / 25)
    assert s["split"]["global_efficiency"] == pytest.approx(4 / 12)
    close = by_node(PA.closeness(hops, net), "closeness")
    assert close["star", 0] == 1.0 and close["star", 1] == pytest.approx(5 / 9)
    assert close["split", 1] == pytest.approx(1 / 3)


def test_more_sources_than_one_word(spark):
    # a circle in which everybody knows the ten next on either side
    ring = build(spark, {"ring": [(i, (i + k) % 150) for i in range(150) for k in range(1, 11)]})
    hops = PA.hop_measures(ring, words=1, batches_at_once=2)
    got = {(r["reach"], r["sum_dist"], r["ecc"]) for r in hops.collect()}
    assert got == {(149, 2 * sum(-(-k // 10) for k in range(1, 75)) + 8, 8)}


def test_betweenness(spark, net):
    b = by_node(PA.betweenness(net, sources_at_once=3), "betweenness")
    assert [b["path", i] for i in range(1, 6)] == pytest.approx([0, 1 / 2, 2 / 3, 1 / 2, 0])
    assert b["star", 0] == pytest.approx(1.0) and b["cliques", 4] == pytest.approx(12 / 21)
    e = {(r["graph_id"], r["src"], r["dst"]): r["betweenness"] for r in PA.edge_betweenness(net).collect()}
    assert e["cliques", 4, 5] == pytest.approx(16.0) and e["path", 2, 3] == pytest.approx(6.0)
    weighted = build(spark, {"w": [(1, 2), (2, 3), (1, 3)]}, weights={(1, 3): 10.0})
    assert by_node(PA.betweenness(weighted, weighted=True), "betweenness")["w", 2] == pytest.approx(1.0)
    assert by_node(PA.weighted_closeness(weighted), "closeness")["w", 2] == pytest.approx(1.0)


def test_mean_path_nodes(spark):
    square = build(spark, {"sq": [(1, 2), (2, 3), (3, 4), (4, 1)]})
    # from 1: itself 1, two neighbours 2, two paths of 3 nodes -> ceil(11 / 5)
    assert set(by_node(PA.mean_path_nodes(square), "path_nodes").values()) == {3}


def test_clustering(spark, net):
    c = by_node(TRI.clustering(net), "clustering")
    assert c["cliques", 1] == 1.0 and c["cliques", 4] == 0.5 and c["star", 0] == 0.0
    t = {r["graph_id"]: r["transitivity"] for r in TRI.transitivity(net).collect()}
    assert t["cliques"] == pytest.approx(24 / 30)
    w = build(spark, {"w": [(1, 2), (2, 3), (1, 3), (3, 4)]}, weights={(1, 2): 2, (2, 3): 4, (1, 3): 8})
    assert by_node(TRI.weighted_clustering(w), "clustering")["w", 1] == pytest.approx(0.5)
    d = build(spark, {"d": [(1, 2), (2, 3), (3, 1), (3, 4)]}, directed=True)
    got = by_node(TRI.directed_clustering(d), "clustering")
    assert got["d", 1] == pytest.approx(0.5) and got["d", 3] == pytest.approx(2 / 12)


def test_degree_measures(net):
    d = by_node(C.degrees(net), "degree")
    assert d["star", 0] == 5 and d["star", 1] == 1
    sizes = {r["graph_id"]: r for r in C.graph_sizes(net).collect()}
    assert sizes["cliques"]["edges"] == 13 and sizes["path"]["density"] == pytest.approx(0.4)
    assert sum(v for (g, _), v in d.items() if g == "cliques") == 26
    a = {r["graph_id"]: r["degree_assortativity"] for r in C.degree_assortativity(net).collect()}
    assert a["path"] == pytest.approx(-1 / 3) and a["star"] == pytest.approx(-1.0)
    h = {r["graph_id"]: r["degree_heterogeneity"] for r in C.degree_heterogeneity(net).collect()}
    assert h["star"] == pytest.approx(1.0 / (10 / 6))


def test_rank(spark):
    d = build(spark, {"d": [(1, 2), (2, 3), (3, 1), (4, 1), (1, 5)], "e": [(1, 2)]}, directed=True)
    r = by_node(RK.pagerank(d), "rank")
    for g in ("d", "e"):
        assert sum(v for (x, _), v in r.items() if x == g) == pytest.approx(1.0)
    assert r["e", 2] == pytest.approx(1.85 / 2.85, abs=1e-4)
    tri = build(spark, {"t": [(1, 2), (2, 3), (1, 3)]})
    assert by_node(RK.eigenvector(tri), "centrality")["t", 1] == pytest.approx(3 ** -0.5)


def test_hub_arcs_are_sliced(spark):
    star = build(spark, {"s": [(0, i) for i in range(1, 41)]})
    table = C.ArcTable(star.arcs(), slice_rows=10)
    assert table.arcs.select("_slice").distinct().count() > 1
    state = star.vertices.withColumnRenamed("id", "id")
    assert table.send(state).count() == 80


def test_communities(spark, net):
    two = C.Network(net.vertices.filter("graph_id = 'cliques'"), net.edges.filter("graph_id = 'cliques'"), False)
    labels = CM.communities(two)
    bounds = CM.modularity_bounds(two, labels).first()
    assert bounds["modularity"] == pytest.approx(12 / 13 - 0.5) and bounds["q_max"] == 0.5 and bounds["relative"] == 0.846
    assert CM.average_within_degree(two, labels).first()["avg_within_degree"] == pytest.approx(3.0)
    three = C.Network(net.vertices.filter("graph_id IN ('cliques', 'path')"), net.edges.filter("graph_id IN ('cliques', 'path')"), False)
    split = by_node(CM.girvan_newman(three, 1), "split_1")
    assert split["cliques", 1] == 1 and split["cliques", 8] == 5
    assert split["path", 1] != split["path", 5]  # every graph is split by itself


def brute_edge_betweenness(vertices, edges):
    near = {v: set() for v in vertices}
    for a, b in edges:
        near[a].add(b), near[b].add(a)
    out = dict.fromkeys(edges, 0.0)
    for s in vertices:
        dist, sigma, order = {s: 0}, {s: 1.0}, [s]
        for u in order:
            for v in near[u]:
                if v not in dist:
                    dist[v], sigma[v] = dist[u] + 1, 0.0
                    order.append(v)
                if dist[v] == dist[u] + 1:
                    sigma[v] += sigma[u]
        dep = dict.fromkeys(order, 0.0)
        for v in reversed(order):
            for u in near[v]:
                if dist.get(u) == dist[v] - 1:
                    part = sigma[u] / sigma[v] * (1 + dep[v])
                    dep[u] += part
                    out[min(u, v), max(u, v)] += part / 2
    return out


def brute_components(vertices, edges):
    root = {v: v for v in vertices}
    for _ in vertices:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


def brute_splits(edges, splits):
    vertices, left, out = sorted({v for e in edges for v in e}), list(edges), []
    for _ in range(splits):
        had = len(set(brute_components(vertices, left).values()))
        while left and len(set(brute_components(vertices, left).values())) == had:
            b = brute_edge_betweenness(vertices, left)
            left.remove(min(left, key=lambda e: (-round(b[e], 9), e)))
        out.append(brute_components(vertices, left))
    return out


def random_graph(seed, n, m):
    rnd = random.Random(seed)
    tree = [tuple(sorted((i, rnd.randrange(i)))) for i in range(1, n)]
    return sorted({*tree, *(tuple(sorted(rnd.sample(range(n), 2))) for _ in range(m))})


def test_girvan_newman_equals_plain_python(spark):
    graphs = {"cliques": GRAPHS["cliques"], "path": GRAPHS["path"], "pair": [(3, 9)], "tree": random_graph(1, 12, 0), "loose": random_graph(2, 9, 2)}
    net = build(spark, graphs)
    got = CM.girvan_newman(net, 2)
    rows = {(r["graph_id"], r["id"]): (r["split_1"], r["split_2"]) for r in got.collect()}
    want = {}
    for g, es in graphs.items():
        one, two = brute_splits([tuple(sorted(e)) for e in es], 2)
        want.update({(g, v): (one[v], two[v]) for v in one})
    assert rows == want
    more = net.vertices.unionByName(spark.createDataFrame([("pair", 77)], "graph_id string, id long"))
    numbered = by_node(CM.numbered_communities(got, "split_2", more), "community")
    assert numbered["pair", 77] == -1 and numbered["pair", 3] == 0 and numbered["pair", 9] == 1
    assert sorted({c for (g, _), c in numbered.items() if g == "cliques"}) == list(range(len({w[1] for (g, _), w in want.items() if g == "cliques"})))


def test_edge_betweenness_of_more_sources_than_a_row_holds(spark):
    edges = random_graph(5, 150, 120)
    got = {(r["src"], r["dst"]): r["betweenness"] for r in PA.edge_betweenness(build(spark, {"g": edges}), sources_at_once=100).collect()}
    want = brute_edge_betweenness(range(150), edges)
    assert got == pytest.approx(want)


def brute_distances(edges, weight, s):
    dist = {s: 0.0}
    while True:
        new = dict(dist)
        for (a, b), w in zip(edges, weight):
            for u, v in ((a, b), (b, a)):
                if u in dist and dist[u] + w < new.get(v, 1e300):
                    new[v] = dist[u] + w
        if new == dist:
            return dist
        dist = new


@pytest.mark.parametrize("delta", [None, 0.5])
def test_weighted_distances(spark, delta):
    edges = random_graph(7, 70, 60)
    rnd = random.Random(1)
    weights = {e: rnd.choice([0.25, 1.0, 1.5, 6.0]) for e in edges}
    net = build(spark, {"g": edges}, weights=weights)
    batches = packed.source_batches(net, 2048)  # its end deletes the numbering
    sources = next(batches)
    found = packed.Distances(net.arcs(), sources, delta)
    named = {(r["batch"], r["slot"]): r["id"] for r in sources.collect()}
    got = {}
    for r in found.state().collect():
        got.update({(named[r["batch"], i], r["id"]): d for i, d in enumerate(r["x"]) if d is not None})
    want = {(s, v): d for s in range(70) for v, d in brute_distances(edges, [weights[e] for e in edges], s).items()}
    assert got == want


def test_estimated_hops(spark):
    edges = random_graph(3, 400, 500)
    net = build(spark, {"g": edges, "path": [(i, i + 1) for i in range(20)]})
    exact = {(r["graph_id"], r["id"]): r for r in PA.hop_measures(net).collect()}
    near = {(r["graph_id"], r["id"]): r for r in PA.hop_estimates(net, lg_k=12).collect()}
    assert set(exact) == set(near)
    for key, e in exact.items():
        # five standard errors of 1.04 / sqrt(4096); the path's few vertices are counted exactly
        limit = 0 if key[0] == "path" else 5 * 1.04 / 64
        for c in ("reach", "sum_dist", "sum_inv"):
            assert near[key][c] == pytest.approx(e[c], rel=limit + 1e-9), (key, c)
        assert abs(near[key]["ecc"] - e["ecc"]) <= (0 if key[0] == "path" else 1)


def test_zero_weights_are_refused(spark):
    zero = build(spark, {"z": [(1, 2), (2, 3), (1, 3)]}, weights={(1, 2): 0.0})
    with pytest.raises(ValueError):
        PA.betweenness(zero, weighted=True)


@pytest.mark.parametrize("cell_edges", [3, 40, 10**6])
def test_triangles_equal_listed_ones(spark, cell_edges):
    rng = random.Random(cell_edges)
    graphs = {f"g{n}": sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(n * 4)}) for n in (12, 40, 70)}
    # a vertex that everybody knows, and one that all but a few do
    graphs["hub"] = sorted({(0, i) for i in range(1, 60)} | {(1, i) for i in range(2, 50)} | {(i, i + 1) for i in range(2, 59)})
    graphs["tree"] = [(0, i) for i in range(1, 30)]
    told = cells.triangles_by_cells(build(spark, graphs), cell_edges).collect()
    brute = []
    for g, es in graphs.items():
        near = set(es)
        top = max(max(e) for e in es) + 1
        brute += [(g, a, b, c) for a, b in es for c in range(b + 1, top) if (a, c) in near and (b, c) in near]
    assert sorted(tuple(r) for r in told) == sorted(brute)


def test_triangles_of_cells_that_come_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    rows = sorted({(g, *sorted(rng.sample(range(15), 2))) for g in range(30) for _ in range(40)})
    import pyarrow as pa

    def batches():
        for i in range(0, len(rows), 7):
            g, a, b = zip(*rows[i:i + 7])
            yield pa.RecordBatch.from_pydict({
                "graph_id": pa.array([None if x == 0 else f"{x:02}" for x in g], pa.string()), "src": [f"v{x:02}" for x in a], "dst": [f"v{x:02}" for x in b],
                "_cell": pa.array([0] * len(g), pa.int64()), "_flag": pa.array([2] * len(g), pa.int8())})

    monkeypatch.setattr(cells, "WEDGES", 50)
    told = [tuple(r.values()) for batch in cells._triangles_of_cells(batches()) for r in batch.to_pylist()]
    near = set(rows)
    brute = [(None if g == 0 else f"{g:02}", f"v{a:02}", f"v{b:02}", f"v{c:02}") for g, a, b in rows for c in range(b + 1, 15)
             if (g, a, c) in near and (g, b, c) in near]
    assert sorted(told, key=str) == sorted(brute, key=str)


def modularity_of(edges, label):
    m, inside, strength = len(edges), {}, {}
    for a, b in edges:
        for v in (a, b):
            strength[label[v]] = strength.get(label[v], 0) + 1
        if label[a] == label[b]:
            inside[label[a]] = inside.get(label[a], 0) + 1
    return sum(inside.get(c, 0) / m - (s / (2 * m)) ** 2 for c, s in strength.items())


def partitions(vertices):
    """Every way to split a list into groups, as vertex -> group."""
    def grow(i, label, used):
        if i == len(vertices):
            yield dict(label)
            return
        for c in range(used + 1):
            label[vertices[i]] = c
            yield from grow(i + 1, label, max(used, c + 1))
    yield from grow(0, {}, 0)


def hangs_together(edges, members):
    seen, todo = set(), [min(members)]
    while todo:
        v = todo.pop()
        if v not in seen:
            seen.add(v)
            todo += [b if a == v else a for a, b in edges if v in (a, b) and {a, b} <= members]
    return seen == members


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_communities_against_every_partition(spark, seed):
    rng = random.Random(seed)
    edges = sorted({tuple(sorted(rng.sample(range(8), 2))) for _ in range(12)})
    net = build(spark, {"g": edges})
    label = {i: c for (_, i), c in by_node(CM.communities(net), "community").items()}
    best = max(modularity_of(edges, p) for p in partitions(sorted(label)))
    assert modularity_of(edges, label) >= best - 1e-9
    for c in set(label.values()):
        members = {v for v in label if label[v] == c}
        assert hangs_together(edges, members) and min(members) == c


def test_communities_of_a_ring_of_cliques(spark):
    cliques = [(10 * k + i, 10 * k + j) for k in range(8) for i in range(5) for j in range(i + 1, 5)]
    edges = cliques + [(min(a, b), max(a, b)) for k in range(8) for a, b in [(10 * k, 10 * ((k + 1) % 8) + 1)]]
    label = {i: c for (_, i), c in by_node(CM.communities(build(spark, {"g": edges})), "community").items()}
    assert label == {v: v // 10 * 10 for v in label}


def test_communities_in_pieces_are_cut(spark, net):
    all_one = net.vertices.withColumn("community", net.vertices.id * 0)
    parts = by_node(CM._connected_parts(net, all_one), "community")
    assert parts["split", 1] == parts["split", 2] == 1 and parts["split", 3] == parts["split", 4] == 3
    assert {parts["cliques", i] for i in range(1, 9)} == {1}
