"""Documents whose sets of word shingles have a Jaccard similarity of 0.8 or more, all of them.

Prefix filter: with shingles in any one order, two such sets share one of their first
n - ceil(0.8 n) + 1 shingles, so sets only meet in the posting lists of these.  The order puts
common shingles last (a sample of the documents tells which; it decides the cost, not the result),
so a passage that many different documents hold makes no long list.

Candidates first meet as odd sketches: bit i of a set's sketch is the parity of its shingles that hash to i,
so two sketches differ in at most as many bits as the sets differ in shingles, and a pair whose sketches
differ in more than the similarity allows can't have it.  Only the other pairs are verified on the whole sets,
a range of hash values after the other where there are many: overlaps add up, and only a range is shuffled at a time.

A list of over ``LIST_LIMIT`` sets is not paired: all are compared with one of them, and those that
are similar are linked to it; the others go on among themselves.  Of the pairs between the two
sides only those can be similar whose other end is at 0.6 or more from the pivot (Jaccard distance
is a metric); they are compared where the links don't connect them anyway.  A list that is still
long after ``ROUNDS`` pivots is paired after all.  Components are those of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.graph.stars import star_components
from ..session import StoredSteps
from .common import bytes_of, chunks, cut, drop_cut, keyed, map_batches, release, scratch_path
from .simhash import first_rows
from .superkmer import word_units

LIST_LIMIT, ROUNDS = 16, 8
#: Ranges of hash values, a power of two, that sets are stored by; so many pairs are verified range by range.
RANGES, MANY = 4, 10_000
SKETCH_BITS = 2048
#: Of one in so many texts the shingles are counted; those seen so often come last, the commonest at the end.
SAMPLE, OFTEN, COMMON = 16, 4, 1 << 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    for low, high in chunks(column):
        data, offsets = bytes_of(column.slice(low, high - low))
        rolling, first = word_units(_LOWER[data], offsets)
        grams = rolling.grams(words)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= words:
                yield np.unique(grams[a : b - words + 1])
            else:
                yield rolling.ranges(np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64)


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _name(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes())


def prefix_length(n: int) -> int:
    """Shingles of a set of n that every set at 0.8 or more has one of."""
    return n - (4 * n + 4) // 5 + 1 if n else 0


def similar(inter: Column, union: Column) -> Column:
    return 5 * inter >= 4 * union


def signatures(docs: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """(_doc, _print, _sig): the hash of each row's shingle set."""

    def work(batch):
        names = [_name(s) for s in shingle_sets(batch.column("_text"), words)]
        yield pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("_print"), _signed(names)], ["_doc", "_print", "_sig"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(keyed(docs, doc_id, text), f"_doc {kind}, _print long, _sig long", work)


def common_shingles(texts: DataFrame, words: int) -> np.ndarray:
    """The commonest shingles of a sample of the different texts, at most COMMON, rarer ones first."""

    def work(batch):
        found = [s for s in shingle_sets(batch.column("_text"), words) if len(s)]
        if found:
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate(found))], ["_shingle"])

    part = texts.filter(F.pmod("_print", F.lit(SAMPLE)) == 0).select("_text")
    counts = map_batches(part, "_shingle long", work).groupBy("_shingle").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= OFTEN)
    rows = counts.orderBy(F.desc("_n"), "_shingle").limit(COMMON).collect()
    return np.array([r._shingle for r in reversed(rows)], np.int64).view(np.uint64)


def prefixes(texts: DataFrame, words: int, common: np.ndarray) -> DataFrame:
    """(_shingle, _sig, _n): the posting entries of every text's set of _n shingles; equal sets repeat them."""
    order = np.argsort(common)
    names = common[order]

    def prefix(shingles):
        p = prefix_length(len(shingles))
        at = np.searchsorted(names, shingles)
        hit = at < len(names)
        hit[hit] = names[at[hit]] == shingles[hit]
        rare = shingles[~hit]
        if len(rare) >= p:
            return rare[:p]
        last = shingles[hit][np.argsort(order[at[hit]])]
        return np.concatenate([rare, last[: p - len(rare)]])

    def work(batch):
        found = [(_name(s), len(s), prefix(s)) for s in shingle_sets(batch.column("_text"), words) if len(s)]
        if found:
            sizes = [len(p) for _, _, p in found]
            columns = [_signed(np.concatenate([p for _, _, p in found])), _signed(np.repeat(np.array([s for s, _, _ in found], np.uint64), sizes))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.repeat([n for _, n, _ in found], sizes).astype(np.int64))], ["_shingle", "_sig", "_n"])

    return map_batches(texts.select("_text"), "_shingle long, _sig long, _n long", work)


def odd_sketch(shingles: np.ndarray) -> bytes:
    """Of each of SKETCH_BITS classes of shingles, whether an odd number of the set is in it."""
    classes = (shingles * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    return np.packbits(np.bincount(classes.astype(np.int64), minlength=SKETCH_BITS) & 1 == 1).tobytes()


def sketches(texts: DataFrame, words: int) -> DataFrame:
    """(_sig, _n, _odd): size and odd sketch of every different set."""

    def work(batch):
        found = list(shingle_sets(batch.column("_text"), words))
        columns = [_signed([_name(s) for s in found]), pa.array([len(s) for s in found], pa.int64()), pa.array([odd_sketch(s) for s in found], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["_sig", "_n", "_odd"])

    return map_batches(texts.select("_text"), "_sig long, _n long, _odd binary", work).dropDuplicates(["_sig"])


def whole_sets(texts: DataFrame, words: int) -> DataFrame:
    """(_sig, _set, _range), stored: sorted shingle hashes of a range as bytes, once per text of ``of_sets``; empty ranges too."""
    bounds = np.arange(1, RANGES, dtype=np.uint64) * np.uint64((1 << 64) // RANGES)

    def work(batch):
        sig, held, at = [], [], []
        for s in shingle_sets(batch.column("_text"), words):
            sig += [_name(s)] * RANGES
            held += [x.tobytes() for x in np.split(s, np.searchsorted(s, bounds))]
            at += range(RANGES)
        yield pa.RecordBatch.from_arrays([_signed(sig), pa.array(held, pa.binary()), pa.array(at, pa.int32())], ["_sig", "_set", "_range"])

    rows = map_batches(texts.select("_text"), "_sig long, _set binary, _range int", work)
    path = scratch_path(texts.sparkSession, "sets")
    rows.write.partitionBy("_range").parquet(path)
    return texts.sparkSession.read.schema(rows.schema).parquet(path)


def of_sets(texts: DataFrame, prints: DataFrame, sigs: DataFrame) -> DataFrame:
    """One of the different texts of each of the sets ``sigs``, once."""
    one = prints.join(sigs.distinct(), "_sig", "left_semi").groupBy("_sig").agg(F.min("_print").alias("_print")).select("_print")
    # by _print already: repeated texts go before their sets are made, without another exchange
    return texts.join(one, "_print", "left_semi").dropDuplicates(["_print", "_text"])


def near_enough(pairs: DataFrame, odd: DataFrame, least: float) -> DataFrame:
    """(a, b, _near), stored: whether the sketches of each different pair allow a similarity of ``least``."""
    most = (1 - least) / (1 + least)  # of the shingles of both, how many one of them may have alone

    def work(batch):
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH_BITS // 8) for c in ("_x", "_y"))
        apart = np.bitwise_count(x ^ y).sum(axis=1)
        sizes = batch.column("_m").to_numpy() + batch.column("_n").to_numpy()
        near = apart <= most * sizes + 1e-6
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near)], ["a", "b", "_near"])

    left = odd.select(F.col("_sig").alias("a"), F.col("_n").alias("_m"), F.col("_odd").alias("_x"))
    right = odd.select(F.col("_sig").alias("b"), "_n", F.col("_odd").alias("_y"))
    met = pairs.distinct().join(left, "a").join(right, "b").select("a", "b", "_m", "_n", "_x", "_y")
    return cut(map_batches(met, "a long, b long, _near boolean", work), "near")


def overlaps(pairs: DataFrame, odd: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b, _inter, _union), stored, of every different pair of sets; 0 of 1 where it is under ``least``."""
    tested = near_enough(pairs, odd, least)
    release(pairs.sparkSession)
    far = tested.filter("NOT _near").select("a", "b", F.lit(0).cast("long").alias("_inter"), F.lit(1).cast("long").alias("_union"))
    steps, verified = _verified(tested.filter("_near"), odd, sets)
    out = cut(verified.unionByName(far), "overlaps")
    steps.drop()
    drop_cut(tested)
    release(pairs.sparkSession)
    return out


def _verified(pairs: DataFrame, odd: DataFrame, sets: DataFrame) -> tuple[StoredSteps, DataFrame]:
    """(a, b, _inter, _union) of different pairs, and the stored steps that it is read from."""

    def work(batch):
        inter, union = [], []
        for x, y in zip(batch.column("_x").to_pylist(), batch.column("_y").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            inter.append(len(np.intersect1d(x, y, assume_unique=True)))
            union.append(len(x) + len(y) - inter[-1])
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(inter, pa.int64()), pa.array(union, pa.int64())], ["a", "b", "_inter", "_union"])

    # a pair moves one of its sets: all ranges at once only where that is little beside the sets
    ranges = range(RANGES)
    n = pairs.count()
    at_once = [ranges] if n < MANY or 8 * n < odd.count() else [[r] for r in ranges]
    steps = StoredSteps(pairs.sparkSession, "verified")
    for some in at_once:
        part = sets.filter(F.col("_range").isin(*some))
        x = part.select(F.col("_sig").alias("a"), "_range", F.col("_set").alias("_x"))
        y = part.select(F.col("_sig").alias("b"), "_range", F.col("_set").alias("_y"))
        held = pairs.join(x, "a").join(y, ["b", "_range"]).select("a", "b", "_x", "_y")
        steps.add(map_batches(held, "a long, b long, _inter long, _union long", work))
        if len(at_once) > 1:
            release(pairs.sparkSession)
    return steps, steps.all().groupBy("a", "b").agg(F.sum("_inter").alias("_inter"), F.sum("_union").alias("_union"))


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b), a < b: entries of the same list whose sizes allow 0.8."""
    a, b = left.select("_shingle", F.col("_sig").alias("x"), F.col("_n").alias("m")), right.select("_shingle", F.col("_sig").alias("y"), F.col("_n").alias("n"))
    fits = (F.col("x") != F.col("y")) & (5 * F.col("m") >= 4 * F.col("n")) & (5 * F.col("n") >= 4 * F.col("m"))
    return a.join(b, "_shingle").filter(fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def counted(lists: DataFrame) -> DataFrame:
    """The lists of two or more entries, with their lengths ``_c``."""
    lengths = lists.groupBy("_shingle").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    return cut(lists.join(lengths, "_shingle"), "lists")


def links(docs: DataFrame, prints: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """(a, b): links between signatures whose closure is that of all pairs at 0.8 or more."""
    texts = keyed(docs, doc_id, text).select("_print", "_text")
    common = common_shingles(texts, words)
    release(docs.sparkSession)
    # entries before the exchange of all: those of a set stand side by side and pack well, most shingles occur once
    entries = cut(prefixes(texts, words, common), "entries", "zstd")
    several = entries.groupBy("_shingle").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("_shingle")
    met = cut(entries.join(several, "_shingle", "left_semi").distinct(), "met")
    drop_cut(entries)
    release(docs.sparkSession)
    lists = counted(met)
    drop_cut(met)
    release(docs.sparkSession)
    short, long = lists.filter(F.col("_c") <= LIST_LIMIT), lists.filter(F.col("_c") > LIST_LIMIT)
    odd = cut(sketches(of_sets(texts, prints, lists.select("_sig")), words), "sketches")
    release(docs.sparkSession)
    # whole sets only of those that have a partner to be verified, or stand in a list yet to be dealt with
    tested = near_enough(_pairs(short, short), odd, 0.8)
    near = tested.filter("_near")
    sets = whole_sets(of_sets(texts, prints, near.select(F.explode(F.array("a", "b")).alias("_sig")).unionByName(long.select("_sig"))), words)
    release(docs.sparkSession)
    steps, verified = _verified(near, odd, sets)
    first = cut(verified.filter(similar(F.col("_inter"), F.col("_union"))).select("a", "b"), "links")
    steps.drop()
    drop_cut(tested)

    def linked(pairs):
        return overlaps(pairs, odd, sets, 0.8).filter(similar(F.col("_inter"), F.col("_union"))).select("a", "b")

    def light(entries):
        short = entries.filter(F.col("_c") <= LIST_LIMIT)
        return linked(_pairs(short, short))

    found, border = [first], []
    long = long.drop("_c")
    for _ in range(ROUNDS):
        if long.isEmpty():
            break
        pivots = long.groupBy("_shingle").agg(F.min("_sig").alias("_pivot"))
        asked = long.join(pivots, "_shingle").filter("_sig <> _pivot")
        scored = overlaps(asked.select(F.col("_pivot").alias("a"), F.col("_sig").alias("b")), odd, sets, 0.6)
        found.append(scored.filter(similar(F.col("_inter"), F.col("_union"))).select("a", "b"))
        told = cut(asked.join(scored.select(F.col("a").alias("_pivot"), F.col("b").alias("_sig"), "_inter", "_union"), ["_pivot", "_sig"]), "told")
        is_similar = similar(F.col("_inter"), F.col("_union"))
        border.append((told.filter(is_similar), told.filter(~is_similar & (5 * F.col("_inter") >= 3 * F.col("_union")))))
        rest = counted(told.filter(~is_similar).select("_shingle", "_sig", "_n"))
        found.append(light(rest))
        long = rest.filter(F.col("_c") > LIST_LIMIT).drop("_c")
    else:
        found.append(linked(_pairs(long, long)))
    def done(links):
        """Stored, without what only the search needed."""
        links = cut(links.distinct(), "links")
        for table in (lists, odd, sets):
            drop_cut(table)
        release(docs.sparkSession)
        return links

    sure = reduce(DataFrame.unionByName, found).distinct()
    open_ = [b for b in border if not b[1].isEmpty()]
    if not open_:
        return done(sure)
    sure = cut(sure, "links")
    roots = cut(star_components(sure), "roots")

    def placed(entries):
        own = F.coalesce("component", "_sig")
        return entries.join(roots.withColumnRenamed("id", "_sig"), "_sig", "left").select("_shingle", "_sig", "_n", own.alias("_root"))

    for inner, outer in open_:
        x, y = placed(inner), placed(outer)
        apart = x.select("_shingle", F.col("_sig").alias("p"), F.col("_n").alias("m"), F.col("_root").alias("r")).join(
            y.select("_shingle", F.col("_sig").alias("q"), F.col("_n").alias("n"), F.col("_root").alias("s")), "_shingle"
        )
        fits = (F.col("r") != F.col("s")) & (5 * F.col("m") >= 4 * F.col("n")) & (5 * F.col("n") >= 4 * F.col("m"))
        sure = sure.unionByName(linked(apart.filter(fits).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))))
    return done(sure)


def keep_first(docs: DataFrame, words: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per component of similar documents: that of the least id (nulls last), then text.

    Texts without words have the same empty set; an empty table gives an empty result.
    """
    release(docs.sparkSession)
    prints = cut(signatures(docs, words, doc_id, text), "signatures")
    roots = star_components(links(docs, prints, words, doc_id, text))
    found = prints.join(roots.withColumnRenamed("id", "_sig"), "_sig", "left").withColumn("_root", F.coalesce("component", "_sig"))
    return first_rows(docs, found, doc_id, text)
