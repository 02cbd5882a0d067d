"""The pipeline against its stages in plain Python, and the registered entry points."""

import base64
import hashlib
import random
import struct

import brute
import public_tokenizers
import pytest
import tiktoken


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables in which base rule, lines, copies and leaks all matter; too few labels to certify a cutoff."""
    out = tmp_path_factory.mktemp("sf")
    rows = [(*r[:5],) for r in brute.corpus(seed=11, n=40)]
    long_words = rows[8][1].replace("\n", " ").split()
    item = " ".join(long_words[4:34])
    rows.append((5001, " ".join(f"w{i}" for i in range(80)) + " " + item, "en", "s", 1))
    rows.append((5002, " ".join(f"v{i}" for i in range(80)), "en", "s", 1))
    rows.append((5003, "\n".join(f"v{i}" for i in range(80)), "en", "s", 1))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(0, item), (1, "nowhere " * 20)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out), rows, [(0, item), (1, "nowhere " * 20)]


def expected(rows, items):
    kept = []
    for r in rows:
        words = brute.words(r[1])
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        twice = {w for w in windows if windows.count(w) > 1} if len(words) < 2000 else set()
        inside = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
        if len(words) >= 50 and 100 * len(inside) <= 50 * len(words):
            kept.append(r)
    gone = brute.lines_gone([(r[0], r[1]) for r in kept])
    texts = [(r[0], "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in g)) for r, g in zip(kept, gone)]
    prints = [brute.fingerprint(t, 5) for _, t in texts]
    root = brute.roots(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    groups = {}
    for (d, t), c in zip(texts, root):
        groups.setdefault(c, []).append((d is None, d or 0, t))
    left = [min(g) for g in groups.values()]
    return [(None if n else d, t) for n, d, t in left if not brute.item_matches(t, items)]


def test_pipeline_equals_plain_python(spark, folder):
    import corpus_pipeline

    path, rows, items = folder
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in expected(rows, items):
        ids = library.encode_ordinary(t)
        want.append((d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, path).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert 5001 not in {g[0] for g in got} and 5002 in {g[0] for g in got}


def test_stages_keep_columns_and_take_empty_tables(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    extra = docs.withColumn("_text", docs.lang).withColumn("kept", docs.lang).withColumn("_doc", docs.doc_id)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder[0]).collect() == []
        out = stage(spark, extra, folder[0])
        assert out.columns == extra.columns and out.count() <= extra.count(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder[0]).collect() == []


def test_documents_are_linked_by_fingerprints_then_by_shingles(spark, folder):
    """7 and 8 are four bits of a fingerprint apart or more, but 0.8 similar; 1 and 2 within two bits, but less similar."""
    import corpus_pipeline

    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(10**9)}"
    while True:  # two words changed in 80: 10 of 76 shingles
        a = [word() for _ in range(80)]
        b = [*a[:-2], word(), word()]
        if (brute.fingerprint(" ".join(a), 5) ^ brute.fingerprint(" ".join(b), 5)).bit_count() > 3:
            break
    while True:  # twelve of 52 words replaced, and fingerprints near by chance
        base = [word() for _ in range(40)]
        near = [(t, brute.fingerprint(" ".join(t), 5)) for t in ([*base, *(word() for _ in range(12))] for _ in range(400))]
        pair = next(((x, y) for i, (x, p) in enumerate(near) for y, q in near[:i] if (p ^ q).bit_count() <= 2), None)
        if pair:
            break
    texts = [(7, a), (8, b), (1, pair[0]), (2, pair[1])]
    docs = spark.createDataFrame([(d, " ".join(t), "en", "s", 1) for d, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.dedup_documents(spark, docs, folder[0]).collect()) == [1, 7]


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
