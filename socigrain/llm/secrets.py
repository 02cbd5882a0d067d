"""Secret scan in DataFrame functions: patterns, and strings that randomness tests can't tell from noise.

Strings that mix letters and digits are candidates.  The smallest alphabet that explains one is
its encoding (decimal-coded strings and plain words are no candidates).  Three tests of "characters
are drawn at random from this alphabet" follow: chi-squared uniformity, the runs test about the
middle of the alphabet, and lag-one serial correlation; their Bonferroni minimum is the string's
p-value.  Structured strings reject randomness.  Since the power of the tests grows with length,
rejections are controlled within (encoding, length class): Benjamini-Hochberg at ``RATE`` over all
candidates of the class in the corpus, so at most that share of the strings declared structured are
random ones.  What isn't rejected is reported as kind ``random``.

P-values are kept in bins of a hundredth of their decimal logarithm, rounded up, so that the
procedure only needs counts per class and bin: a bounded table at any input size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import cut, keyed

#: The base patterns.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 8
# Runs that are too short would be dropped, so the lengths stand in the patterns: 16 and 32 characters.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"
RATE = 0.05
MAX_BIN = 3000
#: Encoding, its form and alphabet in order; the first form that fits is inferred.
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("hex_upper", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36_upper", "^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "^[0-9A-Za-z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "^[0-9A-Za-z+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "^[0-9A-Za-z_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_SPANS = "array<struct<start:int,end:int,match:string>>"


def matches(text: Column, pattern: str, where: Column) -> Column:
    """Leftmost non-overlapping matches with their code-point positions; none where ``where`` is false.

    The text's pieces between matches and the matches themselves alternate, so their lengths add
    up to positions.
    """
    pieces = F.split(text, pattern, -1)
    parts = F.zip_with(pieces, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")))
    found = F.filter(parts, lambda p: p["match"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(state, part):
        begin = state["at"] + part["gap"]
        end = begin + F.length(part["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), part["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    return F.when(where, F.aggregate(found, start, step, lambda s: s["out"])).otherwise(F.array().cast(_SPANS))


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with _assign, _access and _hex: the spans of each kind in ``_text``."""
    text, lower = F.col("_text"), F.lower("_text")
    named = F.lit(False)
    for word in ASSIGN_WORDS:
        named = named | lower.contains(word)
    long_enough = lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LEAST
    return (
        docs.withColumn("_assign", F.filter(matches(text, ASSIGN, named), long_enough))
        .withColumn("_access", matches(text, ACCESS, text.contains("AKIA")))
        .withColumn("_hex", matches(text, HEX, text.rlike(HEX)))
    )


def upper_tail(z: Column) -> Column:
    """P(normal > z), by the public five-term approximation (absolute error under 1e-7), mirrored for z < 0."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _encoding(match: Column) -> tuple[Column, Column]:
    """Index of the inferred encoding (null: none fits) and its alphabet."""
    index, alphabet = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, (_, form, letters) in reversed(list(enumerate(ENCODINGS))):
        fits = match.rlike(form)
        index, alphabet = F.when(fits, F.lit(i)).otherwise(index), F.when(fits, F.lit(letters)).otherwise(alphabet)
    return index, alphabet


def battery(rows: DataFrame) -> DataFrame:
    """``rows`` with _class and _bin for the string in ``match``; null where no encoding fits."""
    index, alphabet = _encoding(F.col("match"))
    rows = rows.withColumn("_e", index).withColumn("_alphabet", alphabet).withColumn("_n", F.length("match").cast("double"))
    rows = rows.withColumn("_a", F.length("_alphabet").cast("double"))
    rows = rows.withColumn("_x", F.expr("transform(filter(split(match, ''), c -> c <> ''), c -> cast(locate(c, _alphabet) - 1 AS double))"))
    sums = "aggregate({0}, 0D, (s, v) -> s + v)"
    # chi-squared: squared counts of the characters that occur
    rows = rows.withColumn("_squares", F.expr(sums.format("transform(array_distinct(_x), v -> power(size(filter(_x, u -> u = v)), 2))")))
    chi, df = F.col("_squares") * F.col("_a") / F.col("_n") - F.col("_n"), F.col("_a") - 1
    spread = 2 / (9 * df)
    uniform = upper_tail((F.pow(chi / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))
    # runs about the middle of the alphabet
    rows = rows.withColumn("_high", F.expr("transform(_x, v -> v >= _a / 2)"))
    rows = rows.withColumn("_n1", F.expr("cast(size(filter(_high, h -> h)) AS double)")).withColumn("_n2", F.col("_n") - F.col("_n1"))
    changes = "aggregate(zip_with(slice(_high, 1, size(_high) - 1), slice(_high, 2, size(_high) - 1), (p, q) -> if(p = q, 0D, 1D)), 0D, (s, v) -> s + v)"
    rows = rows.withColumn("_runs", 1 + F.expr(changes))
    product = 2 * F.col("_n1") * F.col("_n2")
    variance = product * (product - F.col("_n")) / (F.col("_n") * F.col("_n") * (F.col("_n") - 1))
    runs = F.when(variance > 0, 2 * upper_tail(F.abs(F.col("_runs") - product / F.col("_n") - 1) / F.sqrt(variance))).otherwise(0.0)
    # lag-one serial correlation
    rows = rows.withColumn("_mean", F.expr(sums.format("_x")) / F.col("_n"))
    rows = rows.withColumn("_d", F.expr("transform(_x, v -> v - _mean)"))
    rows = rows.withColumn("_power", F.expr(sums.format("transform(_d, v -> v * v)")))
    rows = rows.withColumn("_lag", F.expr(sums.format("zip_with(slice(_d, 1, size(_d) - 1), slice(_d, 2, size(_d) - 1), (p, q) -> p * q)")))
    serial = F.when(F.col("_power") > 0, 2 * upper_tail(F.abs(F.col("_lag") / F.col("_power") + 1 / F.col("_n")) * F.sqrt(F.col("_n")))).otherwise(0.0)
    p = F.least(F.lit(1.0), 3 * F.least(uniform, runs, serial))
    bins = F.least(F.lit(MAX_BIN), F.floor(-100 * F.log10(F.greatest(p, F.lit(1e-30)))).cast("int"))
    classes = F.col("_e") * 64 + F.floor(F.log2("_n")).cast("int")
    return rows.withColumn("_class", F.when(F.col("_e").isNotNull(), classes)).withColumn("_bin", F.when(F.col("_e").isNotNull(), F.greatest(F.lit(0), bins)))


def rejected_from(tested: DataFrame) -> DataFrame:
    """One row with _limits: class -> least bin that Benjamini-Hochberg rejects (absent: none is)."""
    counts = tested.filter("_class IS NOT NULL").groupBy("_class", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(W.partitionBy("_class"))
    below = F.sum("_n").over(W.partitionBy("_class").orderBy(F.desc("_bin")))
    passed = counts.select("_class", "_bin", (F.pow(F.lit(10.0), -F.col("_bin") / 100) <= RATE * below / total).alias("_ok")).filter("_ok")
    limits = passed.groupBy("_class").agg(F.min("_bin").alias("_limit"))
    return limits.agg(F.map_from_entries(F.collect_list(F.struct("_class", "_limit"))).alias("_limits"))  # at most encodings x length classes


def candidates() -> Column:
    """Spans of ``_text`` that mix letters and digits."""
    mixed = lambda s: s["match"].rlike("[0-9]") & s["match"].rlike("[A-Za-z]")
    return F.filter(matches(F.col("_text"), CANDIDATE, F.col("_text").rlike(CANDIDATE)), mixed)


def _kinded(spans: Column, kind: int) -> Column:
    """Spans that sort by start, then kind."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _spelt(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    part = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), part), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_spans, spans) of every row.

    Spans are ``kind:start:end`` in code points, end exclusive, comma-joined by start, then kind in
    the order of KINDS.  A random string that overlaps a base span isn't reported again.  Null and
    empty texts have no spans.  Rows are independent but for the rejection limits, to which every
    row, repeated ones too, contributes; null ids stay; an empty table stays empty.
    """
    rows = keyed(docs, doc_id, text)
    strings = rows.select("_doc", "_print", F.explode(candidates()).alias("_s")).select("_doc", "_print", "_s.start", "_s.end", "_s.match")
    tested = cut(battery(strings).select("_doc", "_print", "start", "end", "_class", "_bin"), "randomness")
    limit = F.coalesce(F.element_at("_limits", F.col("_class")), F.lit(MAX_BIN + 1))
    noise = tested.withColumn("_limits", rejected_from(tested).scalar()).filter(F.col("_class").isNotNull() & (F.col("_bin") < limit))
    noise = noise.groupBy("_doc", "_print").agg(F.collect_set(F.struct("start", "end")).alias("_noise"))
    base = F.concat(_kinded(F.col("_assign"), 0), _kinded(F.col("_access"), 1), _kinded(F.col("_hex"), 2))
    found = base_spans(rows).drop("_text").withColumn("_base", base)
    found = found.alias("l").join(noise.alias("r"), F.col("l._doc").eqNullSafe(F.col("r._doc")) & (F.col("l._print") == F.col("r._print")), "left")
    apart = lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    found = found.withColumn("_random", F.filter(F.coalesce("_noise", F.array().cast("array<struct<start:int,end:int>>")), apart))
    return found.select(
        F.col("l._doc").alias("doc_id"),
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        _spelt(F.col("_base")).alias("base_spans"),
        _spelt(F.concat("_base", _kinded(F.col("_random"), 3))).alias("spans"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random)."""
    return scan(docs).selectExpr("doc_id", "n_assign", "n_access", "n_hex", "sha2(base_spans, 256) AS base_sha256", "spans", "n_random")
