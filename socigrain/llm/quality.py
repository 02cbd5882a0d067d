"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document when a rate of its text exceeds a cutoff.  Per stratum and rule, the
cutoffs of a fixed grid are tested from lenient to strict: "this cutoff rejects more than
``risk / rules`` of the good documents" is refuted by the exact binomial tail of the good labelled
documents that it rejects.  Testing stops at the first cutoff that isn't refuted, so each sequence
keeps its level; the levels are ``error / (strata * rules)`` (Bonferroni).  With probability
1 - ``error`` no stratum loses more than ``risk`` of its good documents to the rules.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import cut, map_batches, text_of

SYMBOLS = b"#*$%&|<>"
#: Base rule: fewer words, or a larger percentage of words in repeated windows, fails.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
RISK, ERROR = 0.05, 0.05
#: Rule: numerator and denominator of its rate.
RULES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "upper_share": ("n_upper", "n_letters"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
}
#: Cutoffs of every rule, from lenient to strict.
GRID = {
    "word_length": [float(x) for x in range(40, 7, -1)],
    "symbols_per_word": [round(2.0 * 0.8**i, 4) for i in range(20)],
    "marks_per_word": [round(2.0 * 0.8**i, 4) for i in range(20)],
}
SHARES = [round(0.95 - 0.05 * i, 2) for i in range(17)]
#: A good document that a cutoff rejects counts as much as so many bad ones that it catches.
GOOD_WEIGHT = 20
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_upper", "n_letters"]
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def count_text(raw: bytes) -> tuple[int, ...]:
    """STATS of one UTF-8 text."""
    words = raw.split()
    n = len(words)
    chars = sum(map(len, words)) - (len(raw) - len(raw.translate(None, bytes(range(128, 192)))))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        found = Counter(windows)
        inside = np.zeros(n + 1, np.int32)
        for i, window in enumerate(windows):
            if found[window] > 1:
                inside[i] += 1
                inside[min(i + 3, n)] -= 1
        repeated = int((np.cumsum(inside[:n]) > 0).sum())
    gone = lambda table: len(raw) - len(raw.translate(None, table))
    return n, chars, gone(SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines), raw.count(b"!"), gone(_UPPER), gone(_LETTERS)


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with STATS of each whole text as columns (they replace columns of these names).

    Null and empty texts count as nothing; rows are independent, so repeated rows stay.
    """
    kept = [f for f in docs.schema if f.name not in STATS]
    schema = T.StructType([*kept, *(T.StructField(s, T.LongType()) for s in STATS)])
    names = [f.name for f in kept]

    def work(batch):
        raw = batch.column("_body").cast(pa.binary()).to_pylist()
        counted = np.array([count_text(x) for x in raw], np.int64).reshape(len(raw), len(STATS))
        columns = [*[batch.column(c) for c in names], *[pa.array(counted[:, i]) for i in range(len(STATS))]]
        yield pa.RecordBatch.from_arrays(columns, [*names, *STATS])

    return map_batches(docs.withColumn("_body", text_of(text)), schema, work)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rate(rule: str):
    top, bottom = RULES[rule]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)


def grid(rule: str) -> list[float]:
    return GRID.get(rule, SHARES)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(at most k of n), exactly summed: the p-value of "the rate is over p" after k hits."""
    if n == 0:
        return 1.0
    if k >= n * p:  # never small enough to certify, and long to sum
        return 1.0
    i = np.arange(k + 1)
    logs = np.array([math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in i])
    return float(min(1.0, np.exp(logs + i * math.log(p) + (n - i) * math.log1p(-p)).sum()))


def select_cutoff(cutoffs: Sequence[float], good: Sequence[int], bad: Sequence[int], n: int, risk: float, level: float) -> float | None:
    """The best certified cutoff; good[i] and bad[i]: labelled documents that cutoffs[i] rejects.

    Among certified cutoffs the one that catches most, good documents weighing GOOD_WEIGHT, wins;
    on a tie the most lenient.  None if nothing can be certified or nothing is caught.
    """
    best, chosen = 0, None
    for i, cutoff in enumerate(cutoffs):
        if binomial_tail(good[i], n, risk) > level:
            break
        if (gain := bad[i] - GOOD_WEIGHT * good[i]) > best:
            best, chosen = gain, cutoff
    return chosen


def certify(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(_stratum, one nullable cutoff per rule) from (_stratum, quality 0/1, STATS) rows.

    Counts per grid step are aggregated in Spark; only a stratum's few hundred counts meet in one
    task.  Rows without a label are ignored.  A stratum with too few good documents to certify
    anything, or without labels, gets no cutoff: there only the base rule holds.
    """
    rows = labelled.filter(F.col("quality").isNotNull() & ~base_failed())
    # step: how many cutoffs of the falling grid lie at or over the rate; those after it reject
    def step(rule: str):
        value = rate(rule)
        return F.size(F.filter(F.array(*[F.lit(c) for c in grid(rule)]), lambda cutoff: value <= cutoff))

    steps = F.array(*[F.struct(F.lit(r).alias("rule"), step(r).alias("step")) for r in RULES])
    counts = (
        rows.select("_stratum", "quality", F.explode(steps).alias("s"))
        .groupBy("_stratum", "s.rule", "s.step")
        .agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") != 1).cast("long")).alias("bad"))
    )
    strata = rows.agg(F.count_distinct("_stratum").alias("_strata"))
    names = list(RULES)

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        row: dict = {"_stratum": frame["_stratum"].iloc[0]}
        tests = int(frame["_strata"].iloc[0]) * len(names)
        for rule in names:
            part = frame[frame["rule"] == rule]
            cutoffs = grid(rule)
            good, bad = (np.zeros(len(cutoffs) + 1, np.int64) for _ in range(2))
            np.add.at(good, part["step"].to_numpy(), part["good"].to_numpy())
            np.add.at(bad, part["step"].to_numpy(), part["bad"].to_numpy())
            # cutoff i rejects the rows whose step is at most i
            row[rule] = select_cutoff(
                cutoffs, np.cumsum(good)[:-1].tolist(), np.cumsum(bad)[:-1].tolist(), int(good.sum()), risk / len(names), error / tests
            )
        return pd.DataFrame([row], columns=["_stratum", *names]).astype({r: float for r in names})

    schema = ", ".join(["_stratum string", *(f"{r} double" for r in names)])
    return counts.crossJoin(F.broadcast(strata)).groupBy("_stratum").applyInPandas(choose, schema)  # strata: one row


def judge(stats: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """``stats`` with base_failed and kept."""
    limits = cutoffs.select(F.col("_stratum"), *[F.col(r).alias(f"_cut_{r}") for r in RULES])
    keyed = stats.withColumn("_stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    passed = F.lit(True)
    for rule in RULES:
        limit = F.col(f"_cut_{rule}")
        passed = passed & (limit.isNull() | F.isnan(limit) | (rate(rule) <= limit))
    judged = keyed.join(limits, "_stratum", "left").withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & passed).drop("_stratum", *[f"_cut_{r}" for r in RULES])


def labelled_stats(stats: DataFrame, labels: DataFrame, stratum: str, doc_id: str = "doc_id") -> DataFrame:
    """Documents that have a label, with it; an id labelled twice counts once, as good if any label says so."""
    one = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias(doc_id)).agg(F.max("quality").alias("quality"))
    rows = stats.select(doc_id, F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum"), *STATS)
    return rows.join(one, doc_id)


def score(docs: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, STATS, base_failed, kept) of every row; the counts are stored once and used twice."""
    stats = cut(text_stats(docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), F.col(text).alias("text"))).drop("text"), "quality")
    cutoffs = certify(labelled_stats(stats, labels, "stratum"))
    return judge(stats, cutoffs, "stratum").drop("stratum")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    Null ids are judged like others but can't be labelled; repeated rows are judged alike.
    """
    own = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), F.col(doc_id).alias("_doc"), F.col(stratum).alias("_lang"), F.col(text).alias("_body"))
    stats = text_stats(packed.drop("_row"), "_body").drop("_body")
    cutoffs = cut(certify(labelled_stats(stats, labels, "_lang", "_doc")), "cutoffs")
    return judge(text_stats(packed, "_body"), cutoffs, "_lang").filter("kept").select("_row.*")
