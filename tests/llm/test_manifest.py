"""Merkle manifest against plain Python, over trees of several sweeps."""

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from socigrain.llm import merkle

FIELDS = "doc_id long, source string, lang string, n_chars long, text string, _tree string, leaf string, _pos string, changed int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(levels, i):
    for level in levels[:-1]:
        a = i // 16 * 16
        yield "".join(level[a:i]), "".join(level[i + 1 : a + 16])
        i //= 16


def expected(rows):
    trees = defaultdict(list)
    for r in rows:
        d, s, lang, n, t = r[:5]
        tampered = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        low = t if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        trees[s].append((d is not None, d or 0, leaf(r[:5]), leaf((d, s, lang, n, low)) if tampered else leaf(r[:5])))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels_of([x[2] for x in sorted(trees[s])]) for s in order}
    top = levels_of([built[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (own, d, first, changed) in enumerate(sorted(trees[s])):
            path = [*siblings(built[s], i), *siblings(top, k)]
            folded = changed
            for left, right in path:
                folded = h(left, folded, right)
            root = top[-1][0]
            out.append((d if own else None, first, built[s][-1][0], root, h(*[a + b for a, b in path]), folded, folded == root))
    return sorted(out, key=repr)


def rows_of(seed, sizes):
    rnd = random.Random(seed)
    out, d = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            d += rnd.randint(1, 4)
            text = rnd.choice([None, "", "Ab CÉ", f"Text {rnd.random()}", "ß日本 X" * 50])
            out.append((d, source, rnd.choice(["en", None, ""]), rnd.choice([None, 3]), text, "x", "y", "z", 1))
    rnd.shuffle(out)
    return out + out[:3] + [(None, "a", None, None, None, "x", "y", "z", 1)] * 2


def found(spark, rows):
    docs = spark.createDataFrame(rows, FIELDS).repartition(3)
    got = merkle.manifest(docs, F.crc32(docs.doc_id.cast("string").cast("binary")) % 5 == 0).collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_equals_plain_python(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    sizes = {"a": 700, None: 17, "": 16, "é": 1, "Z": 33, "one": 1, **{f"s{i}": 1 for i in range(20)}}
    rows = rows_of(levels, sizes)
    want = expected(rows)
    assert found(spark, rows) == want
    assert {w[-1] for w in want} == {True, False}


def test_manifest_of_one_source_one_row_and_none(spark):
    for rows in (rows_of(1, {"a": 40}), [(7, None, None, None, "T", "x", "y", "z", 1)], []):
        assert found(spark, rows) == expected(rows)
    assert expected([(7, None, None, None, "T")])[0][2:4] == (leaf((7, None, None, None, "T")),) * 2


def test_hot_source_is_cut_in_blocks(spark, monkeypatch):
    sizes = []
    real = merkle.sweep_up
    monkeypatch.setattr(merkle, "sweep_up", lambda leaves, levels: (sizes.append(len(leaves)), real(leaves, levels))[1])
    block = ["0" * 64] * merkle.BLOCK
    top, received = merkle.sweep_up(block, merkle.LEVELS)
    assert sizes == [merkle.BLOCK] and len(received) == 16**2 + 16 + 1
    assert dict(merkle.sweep_down(received, merkle.LEVELS, ())).keys() == set(range(merkle.BLOCK))
    assert all(merkle.fold(block[i], p) == top for i, p in merkle.sweep_down(received, merkle.LEVELS, ()))


def test_queue_delivers_by_label_then_sender():
    rnd = random.Random(2)
    sent = [((rnd.randint(0, 5), rnd.randint(0, 5)), i) for i in range(200)]
    queue = merkle.LabelQueue()
    for label, i in sent:
        queue.send(label, i, i)
    got = []
    while queue.heap:
        label, messages = queue.take()
        got += [(label, m) for m in messages]
    assert got == sorted(sent)


def test_manifest_of_the_awkward_corpus(spark):
    rows = brute.corpus(seed=9, n=20)
    docs = brute.frame(spark, rows)
    got = merkle.manifest(docs).collect()
    assert len(got) == len(rows) and all(r.verified and r.folded_root == r.root for r in got)
    assert sorted(r.leaf for r in got) == sorted(leaf((r[0], r[3], r[2], r[4], r[1])) for r in rows)
