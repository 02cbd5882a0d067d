"""Near copies at a shingle similarity of 0.8 or more against all pairs in plain Python."""

import pathlib
import random

import brute
import corpus_pipeline
import numpy as np
import pytest

from socigrain.llm import near_copies
from socigrain.session import shared_dir


def shingles(text):
    w = brute.words((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    root = brute.roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8])
    groups = {}
    for (d, _), r in zip(rows, root):
        groups.setdefault(r, []).append(d)
    return sorted(map(min, groups.values())), sets


def changed(rnd, words, n):
    out = list(words)
    for at in rnd.sample(range(len(out)), n):
        out[at] = f"c{rnd.random()}"
    return " ".join(out)


def planted():
    """One-line documents of which copies have scattered words changed, at 0.6 to 0.97; and a family of many such copies."""
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(30):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(300)] + passage
        rows += [(10 * i + k, changed(rnd, words, n) if n else " ".join(words)) for k, n in enumerate((0, 1, 2, 4, 6, 8, 12))]
    base = [f"f{i}" for i in range(200)]
    rows += [(1000 + i, changed(rnd, base, rnd.choice((1, 1, 2, 3, 4, 6)))) for i in range(60)]
    return rows + [(2000, "a b"), (2001, "A  b"), (2002, "a"), (2003, ""), (2004, None)]


@pytest.mark.parametrize("limit, rounds, often", [(16, 8, 4), (2, 8, 1), (2, 1, 1000)])
def test_near_copies_equal_all_pairs(spark, monkeypatch, limit, rounds, often):
    monkeypatch.setattr(near_copies, "LIST_LIMIT", limit)
    monkeypatch.setattr(near_copies, "ROUNDS", rounds)
    monkeypatch.setattr(near_copies, "SAMPLE", 1 if often == 1 else 16)
    monkeypatch.setattr(near_copies, "OFTEN", often)
    rows = planted()
    want, _ = expected(rows)
    got = near_copies.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in got.collect()) == want


def test_stage_removes_copies_with_scattered_changes(spark):
    rows = planted()
    want, sets = expected(rows)
    bands = [jaccard(sets[7 * i], sets[7 * i + k]) for i in range(30) for k in range(1, 7)]
    assert sum(0.8 <= x < 0.95 for x in bands) > 60 and sum(x < 0.8 for x in bands) > 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.dedup_documents(spark, docs, "").collect()) == want


def test_ranges_add_up_and_only_links_are_left(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "MANY", 0)
    rows = planted()[:14]
    want, _ = expected(rows)
    folder = pathlib.Path(shared_dir(spark)) / "socigrain"
    before = set(folder.glob("*"))
    got = near_copies.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    left = {p.name.partition("-")[0] for p in folder.glob("*") if p not in before and any(p.rglob("*.parquet"))}
    assert "links" in left and not left & {"sets", "sketches", "lists", "entries", "met", "verified", "near"}
    assert sorted(r.doc_id for r in got.collect()) == want


def test_odd_sketches_never_differ_more_than_the_sets():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 30, 500, 9000):
        a = np.unique(rnd.integers(0, 1 << 62, n).astype(np.uint64))
        for change in (0, 1, 25, 400):
            b = np.unique(np.concatenate([a[change:], rnd.integers(0, 1 << 62, change).astype(np.uint64)]))
            x, y = (np.frombuffer(near_copies.odd_sketch(s), np.uint8) for s in (a, b))
            assert len(x) * 8 == near_copies.SKETCH_BITS
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
