"""Substring, suffix, SimHash and line dedup against brute force."""

import hashlib
import random

import brute
import numpy as np
import pytest

from socigrain.llm import line_dedup, simhash, substring_dedup, suffix_dedup, superkmer
from socigrain.session import cut


@pytest.fixture(scope="module")
def rows():
    return brute.corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return brute.frame(spark, rows).cache()


@pytest.mark.parametrize("slot_rows", [2000, 2])
def test_substring(docs, rows, monkeypatch, slot_rows):
    monkeypatch.setattr(superkmer, "SLOT_ROWS", slot_rows)
    texts = [brute.words(r[1]) for r in rows]
    masks = brute.repeated(texts, 9)
    want = [(r[0], len(t), sum(m), b" ".join(w for w, x in zip(t, m) if not x).decode()) for r, t, m in zip(rows, texts, masks)]
    got = substring_dedup.remove_repeats(docs, 9, 4).collect()
    assert brute.by_key(got) == brute.by_key(want)


@pytest.mark.parametrize("slot_rows", [2000, 2])
def test_suffix(docs, rows, monkeypatch, slot_rows):
    monkeypatch.setattr(superkmer, "SLOT_ROWS", slot_rows)
    texts = [(r[1] or "").encode() for r in rows]
    want = []
    for r, t, m in zip(rows, texts, brute.repeated(texts, 30)):
        runs = sum(b and not a for a, b in zip([False, *m], m))
        want.append((r[0], len(t), sum(m), runs, bytes(c for c, x in zip(t, m) if not x)))
    got = suffix_dedup.remove_repeats(docs, 30, 12).collect()
    assert brute.by_key(got) == brute.by_key((d, n, g, s, bytes(k)) for d, n, g, s, k in want) == brute.by_key((*r[:4], bytes(r[4])) for r in got)


def test_registered_windows(spark, docs, rows):
    got = {r.doc_id: r for r in substring_dedup.digests(docs).collect()}
    texts = [brute.words(r[1]) for r in rows]
    for r, t, m in zip(rows, texts, brute.repeated(texts, 35)):
        if r[0] is not None and sum(x[0] == r[0] for x in rows) == 1:
            kept = b" ".join(w for w, x in zip(t, m) if not x)
            assert got[r[0]].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    for operator in (substring_dedup.digests, suffix_dedup.digests, simhash.digests, line_dedup.digests):
        assert operator(none).collect() == []


def test_loser_tree_orders_and_counts_prefixes():
    rnd = random.Random(3)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    runs = [sorted(strings[i::7]) for i in range(7)] + [[]]
    coded = [suffix_dedup.decoded(list(suffix_dedup.front_coded([(s, b"l", 1, 0, 0) for s in run]))) for run in runs]
    out = list(suffix_dedup.LoserTree(coded))
    assert [e[1] for e in out] == sorted(strings)
    for a, b in zip(out, out[1:]):
        assert b[0] == suffix_dedup.shared_prefix(a[1], b[1])


def test_repeated_offsets_one_by_one_and_by_class(monkeypatch):
    rnd = random.Random(9)
    for _ in range(60):
        length, n = 12, rnd.randint(2, 9)
        items = set()
        while len(items) < n:
            left = bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 6)))
            right = b"k" + bytes(rnd.choice(b"ab") for _ in range(length - 1 - rnd.randint(0, len(left))))
            items.add((right, left))
        rights, lefts = zip(*sorted(items))
        counts = [rnd.choice([1, 1, 2]) for _ in rights]
        lcps = [0] + [suffix_dedup.shared_prefix(a, b) for a, b in zip(rights, rights[1:])]
        found = {}
        for r, left, c in zip(rights, lefts, counts):
            for d in range(length - len(r), len(left) + 1):
                key = (d, left[:d], r[: length - d])
                found[key] = found.get(key, 0) + c
        want = [[found[d, left[:d], r[: length - d]] > 1 for d in range(length - len(r), len(left) + 1)] for r, left in zip(rights, lefts)]
        for few in (16, 0):
            monkeypatch.setattr(suffix_dedup, "FEW", few)
            got = suffix_dedup.repeated_offsets(list(rights), lcps, list(lefts), counts, length)
            assert [list(map(bool, g)) for g in got] == want


def test_super_kmers_cover_every_window_once():
    rnd = np.random.default_rng(2)
    data = rnd.integers(97, 100, 4000).astype(np.uint8)
    offsets = np.array([0, 5, 5, 900, 4000])
    text, start, count, off, least, content = superkmer.super_kmers(*superkmer.byte_units(data, offsets), 20, 6)
    windows = [(int(t), int(s) + j) for t, s, n in zip(text, start, count) for j in range(n)]
    assert windows == [(t, i) for t in range(4) for i in range(max(0, offsets[t + 1] - offsets[t] - 19))]
    assert (off < 20 - 6 + 1 + count).all() and (off >= 0).all()


@pytest.mark.parametrize("limit", [64, 1])
def test_simhash(docs, rows, monkeypatch, limit):
    monkeypatch.setattr(simhash, "CELL_LIMIT", limit)
    prints = [brute.fingerprint(r[1], 3) for r in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = brute.roots(len(rows), near)
    least = {}
    for r, c in zip(rows, root):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = [(r[0], f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, root)]
    assert brute.by_key(simhash.digests(docs).collect()) == brute.by_key(want)


def test_simhash_links_single_bits(spark, monkeypatch):
    rnd = random.Random(4)
    base = [rnd.getrandbits(64) for _ in range(4)]
    values = set(base)
    for b in base:
        for _ in range(40):
            x = b
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << rnd.randrange(64)
            values.add(x)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    want = brute.roots(len(values), [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2])
    for limit in (64, 2):
        monkeypatch.setattr(simhash, "CELL_LIMIT", limit)
        links = simhash.links(spark.createDataFrame([(v,) for v in signed], "_fp long")).collect()
        place = {v: i for i, v in enumerate(signed)}
        assert brute.roots(len(values), [(place[r.a], place[r.b]) for r in links]) == want


def test_simhash_tables_are_not_broadcast(docs, monkeypatch):
    """Cells come from an explode, which Spark takes for small: the driver must not gather them."""
    plans = []

    def kept(df, *label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, *label)

    monkeypatch.setattr(simhash, "cut", kept)
    simhash.groups(docs, words=3)
    cells = [p for p in plans if "Generate" in p and "Join" in p]
    assert cells and not any("BroadcastHashJoin" in p for p in cells)


def test_simhash_keeps_one_row_per_group(docs, rows):
    kept = simhash.keep_first(docs, words=3)
    assert kept.columns == docs.columns
    groups = simhash.groups(docs, words=3).select("_root").distinct().count()
    assert kept.count() == groups


def test_lines(docs, rows):
    gone = brute.lines_gone([(r[0], r[1]) for r in rows])
    want = []
    for r, g in zip(rows, gone):
        lines = (r[1] or "").split("\n")
        want.append((r[0], len(lines), len(g), "\n".join(x for i, x in enumerate(lines) if i not in g)))
    assert brute.by_key(line_dedup.remove_lines(docs).collect()) == brute.by_key(want)


def test_line_edits(spark):
    base = "a b c d e f g h i j".split()
    texts = [base, base[:3] + ["x"] + base[4:], base[:5] + base[6:], base[:2] + ["y"] + base[2:], base[:3] + ["x"] + base[4:8] + ["z", "j"], ["q", *base], base[:7], base[:6] + ["w"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.n_removed for r in line_dedup.remove_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: len(g) for i, g in enumerate(brute.lines_gone(rows))}
    assert got[1] == got[2] == got[3] == got[4] == got[5] == 1 and got[6] == got[7] == 0


def test_rewrite_keeps_columns(docs, rows):
    out = line_dedup.rewrite(docs)
    assert out.schema == docs.schema
    for r in out.collect():
        assert (r.text is None) == (r.n_chars is None) and (r.text is None or r.n_chars == len(r.text))
