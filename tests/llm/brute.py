"""Plain Python versions of the operators, and a small corpus with every awkward case."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import xxhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _text string, _doc long, n_words string, ids string, kept string"


def corpus(seed: int = 5, n: int = 60) -> list[tuple]:
    """Rows of COLUMNS: copies, shared passages, nulls, empty and long texts, repeated rows, clashing columns."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 7))) for _ in range(300)] + ["Ärger", "naïve", "日本", "K9", "x-1"]
    passage = " ".join(rnd.choice(words) for _ in range(70))
    lines = [" ".join(rnd.choice(words) for _ in range(rnd.randint(2, 16))) + "." for _ in range(12)]
    texts: list[str | None] = []
    for i in range(n):
        parts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(1, 6))]
        parts += rnd.sample(lines, rnd.randint(0, 4))
        if i % 4 == 0:
            parts.insert(rnd.randint(0, len(parts)), passage)
        rnd.shuffle(parts)
        texts.append("\n".join(parts))
    for i in range(8):  # copies, and copies but for a word
        texts.append(texts[i])
        changed = texts[i].split(" ")
        changed[len(changed) // 2] = "changed"
        texts.append(" ".join(changed))
    long_text = " ".join(rnd.choice(words) for _ in range(6000))
    texts += [None, None, "", "", " \n\t ", "one", "one two", "\n\n", "a b c", long_text, "rep rep " * 400, "aaaa" * 300, passage, passage[:-3]]
    out = []
    for i, text in enumerate(texts):
        out.append((i * 3 + 1, text, rnd.choice(["en", "de", None]), "s", None if text is None else len(text), "clash", 7, "clash", "clash", "clash"))
    out += [out[0], out[0], (None, *out[1][1:]), (None, *out[1][1:]), (None, None, *[None] * 8), (out[5][0], *out[6][1:])]
    return out


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def repeated(texts: list, length: int) -> list[list[bool]]:
    """Per text (a list or bytes), which units a window found elsewhere covers."""
    found = Counter(tuple(t[i : i + length]) for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = [False] * len(t)
        for i in range(len(t) - length + 1):
            if found[tuple(t[i : i + length])] > 1:
                mask[i : i + length] = [True] * length
        out.append(mask)
    return out


def fingerprint(text: str | None, k: int) -> int:
    ws = words(re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + k]), seed=42) for i in range(max(1, len(ws) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n: int, pairs) -> list[int]:
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def one_edit(a: tuple, b: tuple) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def lines_gone(rows: list[tuple], least: int = 5, near: int = 8) -> list[set[int]]:
    """Per (doc_id, text), the numbers of lines that repeat an earlier line; equal rows are one document."""
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    prints = {(d, t): None for d, t in rows}
    from pyspark.sql import SparkSession, functions as F

    spark = SparkSession.getActiveSession()
    keys = list(prints)
    hashed = spark.createDataFrame(keys, "d long, t string").select("d", "t", F.xxhash64(F.coalesce("t", F.lit(""))).alias("p")).collect()
    place = {(r.d, r.t): (r.d is None, r.d or 0, r.p) for r in hashed}
    first: dict[tuple, tuple] = {}
    for d, t in sorted(keys, key=place.__getitem__):
        for i, line in enumerate((t or "").split("\n")):
            w = tuple(words(line))
            if len(w) >= least:
                first.setdefault(w, (*place[d, t], i))
    drop = {a for a in first if len(a) >= near and any(len(b) >= near and first[b] < first[a] and a != b and one_edit(a, b) for b in first)}
    out = []
    for d, t in rows:
        gone = set()
        for i, line in enumerate((t or "").split("\n")):
            w = tuple(words(line))
            if len(w) >= least and (w in drop or first[w] != (*place[d, t], i)):
                gone.add(i)
        out.append(gone)
    return out


def item_matches(text: str | None, items: list[tuple]) -> dict:
    """item -> best similarity over its windows, from 0.8."""
    split = lambda x: re.findall(r"\w+", (x or "").lower())
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    out = {}
    ws = split(text)
    for name, item in items:
        wanted = split(item)
        if len(wanted) < 5:
            continue
        own, m = grams(wanted), min(len(wanted), len(ws))
        best = 0.0
        for p in range(len(ws) - m + 1):
            g = grams(ws[p : p + m])
            shared = sum((g & own).values())
            best = max(best, shared / (sum(g.values()) + sum(own.values()) - shared))
        if best >= 0.8:
            out[name] = best
    return out


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def bigram_counts(rows: list[tuple]):
    tokens = [[*words(re.sub(r"[A-Z]", lambda m: m[0].lower(), t or "")), None] for _, t in rows]
    unigram, bigram = Counter(), Counter()
    begins = 0
    for (d, _), ts in zip(rows, tokens):
        if not held_out(d):
            begins += 1
            unigram.update(ts)
            bigram.update(zip(["<s>", *ts[:-1]], ts))
    return tokens, unigram, bigram, begins


def by_key(rows, n_keys: int = 1) -> dict:
    """Rows as sorted lists per leading key, nulls included."""
    out = defaultdict(list)
    for r in rows:
        out[tuple(r)[:n_keys]].append(tuple(r)[n_keys:])
    return {k: sorted(v, key=repr) for k, v in out.items()}
