"""Periodic runs against all periods tried in turn."""

import hashlib
import random
import zlib
from fractions import Fraction

import brute
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from socigrain.llm import periodic


def runs(w, least=6, exponent=4):
    n, smallest = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] == w[i + p]:
                j = i
                while j + p < n and w[j] == w[j + p]:
                    j += 1
                if j - i >= p:
                    smallest.setdefault((i, j + p - i), p)
                i = j
            i += 1
    return sorted(((s, m, p) for (s, m), p in smallest.items() if m >= least and m >= exponent * p), key=lambda r: (r[0], r[2]))


def looped(d, text):
    w = brute.words(text)
    h = None if d is None else zlib.crc32(str(d).encode())
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(d, words):
    found = runs(words)
    best = None
    for r in found:
        if best is None or Fraction(r[1], r[2]) > Fraction(best[1], best[2]):
            best = r
    gone = {i for s, m, p in found for i in range(s + p, s + m)}
    told = "".join(f"{s},{m},{p}\n" for s, m, p in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (d, len(found), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
            hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=50), st.integers(1, 6), st.integers(0, 30))
def test_runs_equal_all_periods(symbols, period, more):
    w = symbols + [symbols[-period:][i % len(symbols[-period:])] for i in range(more)] if symbols else []
    assert periodic.runs_of(w, 2, 2) == set(runs(w, 2, 2))
    assert periodic.runs_of(w) == set(runs(w))
    assert periodic.runs_of_words([bytes([64 + x]) for x in w]) == runs(w)


def test_common_extension():
    rnd = random.Random(4)
    w = [rnd.randint(1, 2) for _ in range(300)] * 2
    tree = periodic.SuffixTree(w)
    suffixes = sorted(range(len(w) + 1), key=lambda i: w[i:])
    assert [tree.rank[i] for i in suffixes] == list(range(len(w) + 1))
    pairs = [(rnd.randint(0, 600), rnd.randint(0, 600)) for _ in range(2000)]
    pairs = [(i, j) for i, j in pairs if i != j]
    got = tree.common(*map(np.array, zip(*pairs)))
    for (i, j), k in zip(pairs, got):
        assert w[i : i + k] == w[j : j + k] and (max(i, j) + k == len(w) or w[i + k] != w[j + k])


def test_stretches_keep_every_run_of_a_large_vocabulary():
    rnd = random.Random(6)
    w = [b"%d" % rnd.randint(0, 10**7) for _ in range(3000)]
    w[500:900] = [w[500 + i % 90] for i in range(400)]
    w[2000:2006] = [b"x"] * 6
    assert periodic.runs_of_words(w) == runs(w)
    ids = np.array([hash(x) % (1 << 22) + 1 for x in w])
    assert periodic.stretches(ids) == periodic.stretches(np.unique(ids, return_inverse=True)[1] + 1)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    out = brute.corpus(seed=8, n=60)
    for i in range(60):  # repeats of every period, some touching, some cut short
        part = " ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 9)))
        text = " ".join([part] * rnd.randint(3, 7)) + " " + " ".join([rnd.choice("xyz")] * rnd.randint(0, 9)) + " " + part
        out.append((1000 + i, text, "en", "s", 1, "clash", 7, "clash", "clash", "clash"))
    return out


def test_digests_equal_plain_python(spark, rows):
    got = periodic.digests(periodic.find_runs(periodic.looped(brute.frame(spark, rows)))).collect()
    want = [expected(r[0], looped(r[0], r[1])) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 40


def test_operator_keeps_rows_and_takes_empty_tables(spark, rows):
    docs = brute.frame(spark, rows)
    got = periodic.find_runs(docs).collect()
    assert sorted((r.n_words, [tuple(x) for x in r.runs]) for r in got) == sorted((len(brute.words(r[1])), runs(brute.words(r[1]))) for r in rows)
    assert periodic.digests(periodic.find_runs(periodic.looped(docs.limit(0)))).collect() == []
