"""What must not grow: files, shuffles and rows of steps that the larger tables showed."""

import os
import random

import numpy as np
from pyspark.sql import functions as F

from socigrain.operators import stats as ST, text as TX, trajectory as TR
from socigrain.operators.graph import core as C, counted, paths as PA, reach
from socigrain.plans import adapter as ad
from socigrain.session import cut
from socigrain.sources import readers, writers


def test_individuals_share_files(spark, tmp_path):
    path = str(tmp_path / "population")
    traj = spark.range(900).select((F.col("id") % 300).alias("entity"), F.floor(F.col("id") / 300).alias("frame"),
                                   (F.col("id") + 0.25).alias("pos x"), F.lit(1.5).alias("pos y"))
    writers.write_population(traj, path)
    files = [f for folder, _, names in os.walk(path) for f in names if f.endswith(".csv")]
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = readers.load_population(spark, path)
    assert got.dtypes == [("entity", "string"), ("frame", "bigint"), ("pos_x", "double"), ("pos_y", "double")]
    assert sorted(map(tuple, got.collect())) == sorted((str(i % 300), i // 300, float(i), 2.0) for i in range(900))


def test_headers_are_told_apart_by_path(spark, tmp_path):
    for folder, header in (("a", "frame,pos_x"), ("b", "pos_x,frame")):
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / "part.csv").write_text(f"{header}\n1,2\n")
    headers = readers.file_headers(spark, str(tmp_path))
    assert sorted(r.header for r in headers.collect()) == ["frame,pos_x", "pos_x,frame"]
    assert sorted(r.ok for r in readers.compare_headers(headers, ["frame", "pos_x"]).collect()) == [False, True]
    assert sorted(r.ok for r in readers.check_columns(spark, str(tmp_path), ["frame", "pos_x"]).collect()) == [False, True]


def test_pairs_carry_pieces_of_positions(spark):
    rnd = random.Random(5)
    rows = [(e, f, None if rnd.random() < 0.1 else float(rnd.randrange(50)), float(rnd.randrange(50))) for e in range(5) for f in range(10 * e, 75 + 3 * e)]
    rows += [(0, 40, 1.0, 1.0), (0, 40, 1.0, 1.0), (3, 40, 2.0, 2.0), (1, None, 1.0, 1.0), (2, -1, 0.0, 0.0), (3, -1, 3.0, 4.0)]
    pairs = [(0, 1), (0, 3), (2, 3), (2, 3), (1, 9)]
    want = sorted(
        ((a, b, x[1], None if None in (x[2], y[2]) else ((x[2] - y[2]) ** 2 + (x[3] - y[3]) ** 2) ** 0.5)
         for a, b in set(pairs) for x in rows for y in rows if x[0] == a and y[0] == b and x[1] == y[1] and x[1] is not None), key=repr)
    traj = spark.createDataFrame(rows, "entity long, frame long, pos_x double, pos_y double").repartition(3)
    got = TR.pair_distances(traj, spark.createDataFrame(pairs, "entity_a long, entity_b long"))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "frame" not in join  # rows of single frames are never shuffled


def test_hops_keep_the_bits_of_two_rounds(spark, monkeypatch):
    """Long chains take many rounds; of those before the last only counts are stored."""
    found = []

    def kept(df, label="step", *rest):
        out = cut(df, label, *rest)
        if label == "bits":
            found.append({f.rpartition("/")[0] for f in out.inputFiles()})
            assert sum(os.path.isdir(x.removeprefix("file://")) for folders in found for x in folders) <= 2
        return out

    monkeypatch.setattr(reach, "cut", kept)
    net = C.network(spark.createDataFrame([("g", i, i + 1) for i in range(12)], "g string, src long, dst long"), directed=True, graph_id="g")
    got = {r.id: (r.reach, r.sum_dist, r.ecc) for r in PA.hop_measures(net).collect()}
    assert got == {i: (i, i * (i + 1) // 2, i) for i in range(13)}
    assert len(found) > 12


def test_passes_are_bounded():
    """Levels and dependencies of a pass are doubles on disk; a task holds a chunk's bits several times."""
    assert 16 * counted.PAIRS <= 1 << 30
    assert 8 * reach.CHUNK_WORDS <= 1 << 25


def test_hops_over_several_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(reach, "PIECE", 3)
    monkeypatch.setattr(reach, "SLAB", 4)
    rnd = random.Random(2)
    edges = {g: [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] for g, n, m in (("p", 150, 200), ("q", 9, 30), ("r", 70, 20))}
    rows = [(g, a, b) for g, es in edges.items() for a, b in es]
    for directed in (True, False):
        net = C.network(spark.createDataFrame(rows, "g string, src long, dst long"), directed=directed, graph_id="g")
        arcs = net.arcs().filter("src <> dst")
        numbered, parts = reach.gains(net, arcs, 1, 2, block=32)
        got = {}
        for part in parts:
            for r in part.collect():
                got.setdefault((r.graph_id, r.block * 32 + r.place), {})[r.step] = got.get((r.graph_id, r.block * 32 + r.place), {}).get(r.step, 0) + r.n
        idx = {(r.graph_id, r.id): r.idx for r in numbered.collect()}
        into = {}
        for r in arcs.collect():
            into.setdefault((r.graph_id, r.dst), set()).add((r.graph_id, r.src))
        for v, i in idx.items():
            seen, front, step = {(v[0], v[1])}, {v}, 0
            while front := {u for w in front for u in into.get(w, ())} - seen:
                step, seen = step + 1, seen | front
                assert got[v[0], i].pop(step) == len(front)
            assert not got.get((v[0], i))
        hops = {(r.graph_id, r.id): r for r in PA.hop_measures(net).collect()}
        assert set(hops) == set(idx)


def test_posts_without_a_parent_are_not_gathered(spark, tmp_path):
    rows = [(i, None if i == 7 else i % 5, "view" if i % 10 == 0 else "signup", 1.5, '{"k": %d}' % (i % 50)) for i in range(800)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.timestamp_seconds(F.col("event_id"))).repartition(8).write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame([(1, "a b"), (2, "c")], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        posts = ad.raw_posts(spark, str(tmp_path))
        got = posts.select("id", "retweeted_status.id", F.size("entities.hashtags")).collect()
        parents = ad.activity(spark, str(tmp_path)).filter("parent_id is null").select("id", "k")
        placed = posts.filter("in_reply_to_status_id is null and retweeted_status is null").groupBy(F.spark_partition_id().alias("at")).count()
        largest = max(r["count"] for r in placed.collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got)) == [(i, i * (i % 50 + 1) // 101 if i % 10 == 0 and i else None, {1: 2, 2: 1}.get(i % 50, 0)) for i in range(800)]
    assert parents.count() == 721
    assert largest < 400  # joined by the null key, all 721 would be in one partition


def test_quantiles_do_not_gather_a_group(spark):
    df = spark.range(200_000).select(F.lit("g").alias("k"), (F.pmod(F.col("id") * 7919, F.lit(200_000)) * 0.5).alias("v"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "6000")
        got = ST.exact_quantiles(df, ["k"], "v", [0.25, 0.5])
        assert sorted(map(tuple, got.collect())) == [("g", 0.25, 24999.875), ("g", 0.5, 49999.75)]
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    # joined by k, all values of the group would be sorted in one task: both sides are stored and the small one is sent
    assert "SortMergeJoin" not in plan and plan.count("FileScan parquet") >= 2


def test_pairs_of_neighbours_need_no_lambda(spark):
    texts = [["a", "b", "a", "b"], ["a", "b", "c"], ["c"], [], None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, tokens array<string>")
    found = []

    def counted(pairs, label, stored=TX.cut):
        if label == "pairs":
            found.append(pairs._jdf.queryExecution().optimizedPlan().toString())
        return stored(pairs, label)

    kept, TX.cut = TX.cut, counted
    try:
        got = TX.phrases_fit(docs, "tokens", 1, 0.0).select("a", "b", "link", "n", "score").collect()
    finally:
        TX.cut = kept
    # 3 words and 3 pairs; a, b: 3 times each
    assert [(r.a, r.b, r.link, r.n, round(r.score, 9)) for r in got] == [("a", "b", "", 3, round(2 * 6 / 9, 9))]
    assert found and "lambda" not in found[0]


def test_path_counts_of_blocks_against_every_path(spark):
    rng = random.Random(5)
    edges = [("g", a, b) for a, b in {tuple(rng.sample(range(24), 2)) for _ in range(60)}] + [("h", 0, i) for i in range(1, 20)] + [("h", 30, 30)]
    table = spark.createDataFrame(edges, "graph_id string, src long, dst long")
    for directed in (True, False):
        net = C.network(table, directed=directed, graph_id="graph_id").checkpointed()
        arcs = net.arcs().filter("src <> dst")
        into, pairs, own, sums = {}, 0, {}, {}
        for r in arcs.collect():
            into.setdefault((r.graph_id, r.src), set()).add((r.graph_id, r.dst))
        vertices = [(r.graph_id, r.id) for r in net.vertices.collect()]
        for v in vertices:
            counts, levels = {v: 1}, [{v}]
            while levels[-1]:
                onward = {w for u in levels[-1] for w in into.get(u, ())} - set(counts)
                counts |= {w: sum(counts[u] for u in levels[-1] if w in into.get(u, ())) for w in onward}
                levels.append(onward)
            rest = dict.fromkeys(counts, 0.0)
            for above, level in reversed(list(zip(levels, levels[1:]))):
                for u in above:
                    rest[u] = sum(counts[u] / counts[w] * (1 + rest[w]) for w in into.get(u, ()) if w in level)
            for u in set(counts) - {v}:
                own[u] = own.get(u, 0) + rest[u]
            pairs += len(counts)
            n = sum(counts[u] * (d + 1) for d, level in enumerate(levels) for u in level)
            sums[v] = -(-n // sum(counts.values()))
        # blocks of 16 vertices, 8 sources side by side, two chunks in a pass
        blocks = counted.Blocks(net, arcs, back=True, width=8, block=16, pairs=8 * 2 * len(vertices))
        got, held, passes = {}, 0, 0
        names = {(r.graph_id, r.idx): (r.graph_id, r.id) for r in blocks.numbered.collect()}
        for sources in blocks.passes():
            steps = PA._stored_levels(blocks, sources)
            held += sum(len(r.x) // 8 for r in steps.all().select("x").collect())
            for r in blocks.by_vertex(blocks.dependencies(steps).all()).collect():
                at = names[r.graph_id, r.idx]
                got[at] = got.get(at, 0) + r.own
            passes += 1
        assert passes == 2 and held == pairs  # a pair is held in the one level that reaches it
        assert {v: round(b, 9) for v, b in got.items() if b > 1e-12} == {v: round(b, 9) for v, b in own.items() if b > 1e-12}
        assert {(r.graph_id, r.id): r.path_nodes for r in PA.mean_path_nodes(net).collect()} == sums


def test_arcs_of_a_hub_are_added_in_runs():
    rng = np.random.default_rng(1)
    s, d = rng.integers(0, 50, 5000), np.sort(rng.choice([0, 0, 0, 3, 7, 9], 5000))
    at = np.arange(0, 50, 2)
    front, out, want = rng.random((25, 700)), np.zeros((10, 700)), np.zeros((10, 700))
    counted.add_along(out, front, at, s, d)
    on = s % 2 == 0
    np.add.at(want, d[on], front[s[on] // 2])
    assert np.allclose(out, want)
