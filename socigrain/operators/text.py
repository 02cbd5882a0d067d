"""Text mining: language fallback, tokens, lemmas, phrases, dictionary, topics, coherence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import remove_stop_words, strip_noise, tokenize
from ..session import cut
from .skew import lookup_join, number_rows

# Languages that mean "unknown" and languages kept for text mining.
UNKNOWN_LANGS = ("und", "zxx", "pt", "qme")
KEPT_LANGS = ("en", "hr", "sl", "sr", "bs")
NO_LANGUAGE = "zxx"
KEPT_PARTS_OF_SPEECH = ("NOUN", "PROPN", "ADJ")
# Words a phrase may run across (gensim's documented English connector words).
CONNECTOR_WORDS = (
    "a", "an", "the", "for", "of", "with", "without", "at", "from", "to", "in", "on", "by", "and", "or",
)
PHRASE_DELIMITER = "_"


# ------------------------------------------------------------------ language fallback
def char_ngrams(text: Column, n: int = 3) -> Column:
    # one pass of overlapping look-ahead matches; a lambda over positions would redo the clean-up each time
    padded = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"(?U)[^\p{L}]+", " ")), F.lit(" "))
    return F.regexp_extract_all(padded, F.lit(f"(?=(.{{{n}}}))"), 1)


def language_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", n: int = 3) -> DataFrame:
    """(profile, gram, weight): every n-gram of a language with its log2 share, one added to each count.

    A ``gram`` of null holds the weight of n-grams that the language doesn't have.  Rows without a language
    or text don't count.
    """
    grams = labelled.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("profile"), F.explode(char_ngrams(F.col(text), n)).alias("gram"))
    counts = cut(grams.groupBy("profile", "gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    sizes = counts.groupBy("profile").agg(F.sum("n").alias("_size"))
    room = sizes.join(counts.agg(F.count_distinct("gram").alias("_kinds")))
    every = counts.unionByName(sizes.select("profile", F.lit(None).cast("string").alias("gram"), F.lit(0).cast("bigint").alias("n")))
    weight = F.log2((F.col("n") + 1) / (F.col("_size") + F.col("_kinds") + 1))
    return lookup_join(every, room, "profile", "inner").select("profile", "gram", weight.alias("weight"))


def detect_language(texts: DataFrame, profiles: DataFrame, key: str, text: str = "text", n: int = 3) -> DataFrame:
    """(key, detected): of the languages that share an n-gram with a text, the one in which it is most likely.

    N-grams that no language has don't count, and a text without others gets no row.  A score is what the
    n-grams gain over being unknown, plus their number times the weight of an unknown one: so an n-gram meets
    only the languages that have it, and these are few per n-gram.
    """
    grams = texts.select(key, F.explode(char_ngrams(F.col(text), n)).alias("gram"))
    unknown = profiles.filter(F.col("gram").isNull()).select("profile", F.col("weight").alias("_unknown"))
    known = lookup_join(profiles.filter(F.col("gram").isNotNull()), unknown, "profile", "inner")
    listed = F.collect_list(F.struct("profile", (F.col("weight") - F.col("_unknown")).alias("gain")))
    # the entry without a profile counts the known n-grams of a text in the same pass
    every = F.array_append(listed, F.struct(F.lit(None).cast("string").alias("profile"), F.lit(0.0).alias("gain")))
    # stored, so that Spark knows its size: sent to the texts where it is small, n-grams needn't be shuffled
    by_gram = cut(known.groupBy("gram").agg(every.alias("_in")), "by-gram")
    met = lookup_join(grams, by_gram, "gram", "inner").select(key, F.explode("_in").alias("_p"))
    sums = cut(met.groupBy(key, F.col("_p.profile").alias("profile")).agg(F.sum("_p.gain").alias("_gain"), F.count(F.lit(1)).alias("_n")), "gains")
    gains = sums.filter(F.col("profile").isNotNull()).drop("_n")
    lengths = sums.filter(F.col("profile").isNull()).select(key, "_n")
    best = lookup_join(lookup_join(gains, unknown, "profile", "inner"), lengths, key, "inner")
    score = F.col("_gain") + F.col("_n") * F.col("_unknown")
    # equal scores: the alphabetically first language
    return best.groupBy(key).agg(F.min_by("profile", F.struct(-score, F.col("profile"))).alias("detected"))


def lang_fallback(posts: DataFrame, profiles: DataFrame, key: str = "id", text: str = "full_text") -> DataFrame:
    """Detect the language again only where it is unknown; empty or hopeless texts get ``zxx``."""
    unknown = F.coalesce(F.col("lang"), F.lit("und")).isin(*UNKNOWN_LANGS)
    detected = detect_language(posts.filter(unknown & (F.trim(text) != "")), profiles, key, text)
    joined = posts.join(detected, key, "left")
    return joined.withColumn(
        "lang", F.when(unknown, F.coalesce("detected", F.lit(NO_LANGUAGE))).otherwise(F.col("lang"))
    ).drop("detected")


# ------------------------------------------------------------------ tokens and lemmas
def text_tokens(posts: DataFrame, stop_words: Sequence[str] = (), text: str = "full_text", out: str = "tokens") -> DataFrame:
    return posts.withColumn(out, remove_stop_words(tokenize(strip_noise(F.col(text))), stop_words))


def lemmatize(docs: DataFrame, lookup: DataFrame, key: str, tokens: str = "tokens",
              keep: Sequence[str] = KEPT_PARTS_OF_SPEECH) -> DataFrame:
    """Replace tokens by their lemma in (lang, form, lemma, upos); keep chosen parts of speech.

    Tokens the lookup does not know pass through.  Order is kept; a document's own tokens are the
    largest group any task collects.
    """
    words = docs.select(key, "lang", F.posexplode(tokens).alias("pos", "form"))
    found = lookup_join(words, lookup, ["lang", "form"], "left")
    kept = found.filter(F.col("lemma").isNull() | F.col("upos").isin(*keep)).withColumn(
        "lemma", F.coalesce("lemma", "form")
    ).filter("lemma <> ''")
    lemmas = _reassemble(kept, key, "pos", "lemma", "lemmas")
    return docs.join(lemmas, key, "left").withColumn(
        "lemmas", F.coalesce("lemmas", F.array().cast("array<string>"))
    )


def _reassemble(words: DataFrame, key: str, pos: str, word: str, out: str) -> DataFrame:
    return words.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(pos, word))), lambda x: x[word]).alias(out)
    )


def enrich_with(posts: DataFrame, lemmas: DataFrame, key: str = "id", col: str = "lemmas") -> DataFrame:
    """Left join of a post's lemmas; a missing one becomes an empty array."""
    return posts.join(lemmas.select(key, col), key, "left").withColumn(
        col, F.coalesce(col, F.array().cast("array<string>"))
    )


def corpus_slice(posts: DataFrame, top_users: int = 20, user: str | None = None, since=None) -> DataFrame:
    """Posts of the accounts posting most, optionally of one of them from a date on."""
    leaders = posts.groupBy("screen_name").agg(F.count(F.lit(1)).alias("_n")).orderBy(
        F.desc("_n"), "screen_name").limit(top_users)
    sliced = posts.join(leaders.select("screen_name"), "screen_name", "left_semi")
    if user is not None:
        sliced = sliced.filter(F.col("screen_name") == user)
    if since is not None:
        sliced = sliced.filter(F.col("created_at") >= F.lit(since).cast("timestamp"))
    return sliced


def word_counts(docs: DataFrame, key: str, tokens: str) -> DataFrame:
    return docs.select(key, F.explode(tokens).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ phrases
def _adjacent(tokens: str, connectors: Sequence[str]) -> Column:
    """Candidate pairs (pos, end, a, b): neighbours, or neighbours once connector words are skipped."""
    items = F.transform(F.col(tokens), lambda t, i: F.struct(t.alias("w"), i.alias("i")))
    if connectors:
        items = F.filter(items, lambda x: ~x["w"].isin(*connectors))
    right = F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0)))
    pairs = F.zip_with(
        F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0))),
        right,
        lambda x, y: F.struct(x["i"].alias("pos"), y["i"].alias("end"), x["w"].alias("a"), y["w"].alias("b")),
    )
    return pairs


def phrases_fit(docs: DataFrame, tokens: str, min_count: int, threshold: float, connectors: Sequence[str] = ()) -> DataFrame:
    """Scored pairs (a, b, n, score) with score = (n_ab - min_count) * V / (n_a * n_b) > threshold.

    V counts distinct words and distinct pairs.  Pairs reach across connector words; the words
    between are part of the pair (``link``).
    """
    words = docs.select(F.explode(tokens).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    if connectors:
        words = words.filter(~F.col("w").isin(*connectors))
        link = F.expr(f"array_join(slice({tokens}, p.pos + 2, p.end - p.pos - 1), '{PHRASE_DELIMITER}')")
        adjacent = _adjacent(tokens, connectors)
    else:
        # positions aren't needed, and neighbours need no lambda over the tokens
        link, rest = F.lit(""), F.greatest(F.size(tokens) - 1, F.lit(0))
        adjacent = F.arrays_zip(F.slice(tokens, F.lit(1), rest).alias("a"), F.slice(tokens, F.lit(2), rest).alias("b"))
    pairs = (
        docs.select(tokens, F.explode(adjacent).alias("p"))
        .select("p.a", "p.b", link.alias("link"))
        .groupBy("a", "b", "link")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    words, pairs = cut(words, "words"), cut(pairs, "pairs")
    vocabulary = words.select(F.count(F.lit(1))).scalar() + pairs.select(F.count(F.lit(1))).scalar()
    na = words.select(F.col("w").alias("a"), F.col("n").alias("na"))
    nb = words.select(F.col("w").alias("b"), F.col("n").alias("nb"))
    if threshold >= 0:
        pairs = pairs.filter(F.col("n") > min_count)
    joined = lookup_join(lookup_join(pairs, na, "a", "inner"), nb, "b", "inner")
    score = (F.col("n") - min_count) * vocabulary / F.col("na") / F.col("nb")
    return joined.withColumn("score", score).filter(F.col("score") > threshold).select("a", "b", "link", "n", "score")


def phrases_apply(docs: DataFrame, phrases: DataFrame, key: str, tokens: str, out: str, connectors: Sequence[str] = ()) -> DataFrame:
    """Join phrase words with ``_``, greedily from the left and without overlap.

    The phrase table is joined to word pairs rather than carried as one map, so it may grow with
    the vocabulary; it is stored first, so that Spark knows its size and sends a small one to the pairs
    instead of shuffling all pairs.  In a run of pairs that are all phrases every second one is taken, which is
    what a left-to-right scan does.
    """
    words = docs.select(key, tokens, F.explode_outer(_adjacent(tokens, connectors)).alias("p"))
    if connectors:
        link = F.expr(f"array_join(slice({tokens}, p.pos + 2, p.end - p.pos - 1), '{PHRASE_DELIMITER}')")
    else:
        link = F.lit("")
    pairs = words.filter("p is not null").select(key, "p.*", link.alias("link"))
    marked = lookup_join(pairs, cut(phrases.select("a", "b", "link"), "phrases"), ["a", "b", "link"], "inner")
    # consecutive phrase pairs share a word: pair i ends where pair i + 1 starts
    w = W.partitionBy(key).orderBy("pos")
    breaks = F.coalesce((F.lag("end").over(w) != F.col("pos")).cast("int"), F.lit(1))
    runs = marked.withColumn("_break", breaks).withColumn("_run", F.sum("_break").over(w))
    in_run = W.partitionBy(key, "_run").orderBy("pos")
    taken = runs.withColumn("_i", F.row_number().over(in_run)).filter(F.col("_i") % 2 == 1)
    spans = taken.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "end"))).alias("_spans"))
    joined = docs.join(spans, key, "left")
    # split the tokens at the first word of every phrase or single word
    t = F.col(tokens)
    covered = F.flatten(F.transform(F.col("_spans"), lambda s: F.sequence(s["pos"] + 1, s["end"])))
    starts = F.array_except(F.sequence(F.lit(0), F.size(t) - 1), covered)
    size = F.size(t)
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(size))
    merged = F.zip_with(starts, ends, lambda s, e: F.array_join(F.slice(t, s + 1, e - s), PHRASE_DELIMITER))
    result = F.when(F.col("_spans").isNull() | (size == 0), t).otherwise(merged)
    return joined.withColumn(out, result).drop("_spans")


def word_grams(docs: DataFrame, key: str, tokens: str, bigram: tuple[int, float] = (50, 50.0),
               trigram: tuple[int, float] = (20, 100.0), connectors: Sequence[str] = ()) -> DataFrame:
    """Bigram pass, then a trigram pass fitted on the bigrammed text."""
    bi = phrases_fit(docs, tokens, *bigram, connectors)
    # read three times
    once = cut(phrases_apply(docs, bi, key, tokens, "_bigrams", connectors), "bigrams")
    tri = phrases_fit(once, "_bigrams", *trigram, connectors)
    return phrases_apply(once, tri, key, "_bigrams", "word_grams", connectors).drop("_bigrams")


# ------------------------------------------------------------------ dictionary, topics
def dictionary(docs: DataFrame, tokens: str) -> DataFrame:
    """(word, word_id, n): ids 0, 1, ... in word order, numbered bucket by bucket of word prefixes."""
    counts = cut(docs.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    return number_rows(counts, [], ["word"], F.substring("word", 1, 2), "word_id", 0).select("word", "word_id", "n")


def bag_of_words(docs: DataFrame, key: str, tokens: str, words: DataFrame) -> DataFrame:
    """(key, word_id, n)."""
    counts = word_counts(docs, key, tokens)
    return lookup_join(counts, words.select("word", "word_id"), "word", "inner").select(key, "word_id", "n")


def bag_vectors(bag: DataFrame, key: str, vocabulary_size: int) -> DataFrame:
    """Sparse vectors of a bag of words for ``pyspark.ml``; the bag of one document is one group."""
    from pyspark.ml.linalg import Vectors, VectorUDT

    @F.udf(VectorUDT())
    def sparse(ids, counts):
        return Vectors.sparse(vocabulary_size, ids, counts)

    entries = bag.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("word_id", "n"))).alias("e"))
    return entries.select(
        key,
        sparse(
            F.transform("e", lambda x: x["word_id"].cast("int")), F.transform("e", lambda x: x["n"].cast("double"))
        ).alias("features"),
    )


def fit_topics(vectors: DataFrame, k: int = 10, passes: int = 10, seed: int = 7):
    """Online LDA of ``pyspark.ml``; each of the ``passes`` reads the whole corpus."""
    from pyspark.ml.clustering import LDA

    return LDA(k=k, maxIter=passes, optimizer="online", subsamplingRate=1.0, seed=seed, featuresCol="features").fit(vectors)


def describe_topics(model, words: DataFrame, terms: int = 10) -> DataFrame:
    """(topic, rank, word, weight): k * terms rows joined to the dictionary."""
    t = model.describeTopics(terms)
    rows = t.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "z"))
    ids = rows.select("topic", "rank", F.col("z.termIndices").cast("bigint").alias("word_id"),
                      F.col("z.termWeights").alias("weight"))
    return ids.join(words.select(F.col("word_id").cast("bigint").alias("word_id"), "word"), "word_id", "left").drop("word_id")


def topic_coherence(docs: DataFrame, key: str, tokens: str, topics: DataFrame, window: int = 110) -> DataFrame:
    """(topic, coherence): c_v of each topic's words; ``topics`` holds (topic, word).

    A word's sliding windows in a document form merged intervals, so windows are counted by interval
    lengths and overlaps and never listed one by one.  Intervals are cut at every ``window`` starts; a word
    has a few per part, and words meet inside a part, so a long document is many small joins.
    """
    eps = 1e-12
    size = F.size(tokens)
    last = F.greatest(size - window, F.lit(0))
    total = docs.filter(size > 0).select(F.sum(last + 1)).scalar()
    words = topics.select("word").distinct()
    seen = (
        docs.select(key, last.alias("last"), F.posexplode(tokens).alias("pos", "word"))
        .join(F.broadcast(words), "word", "left_semi")
        .select(key, "word", F.greatest(F.col("pos") - window + 1, F.lit(0)).alias("s"), F.least("pos", "last").alias("e"))
    )
    part = F.explode(F.sequence(F.floor(F.col("s") / window), F.floor(F.col("e") / window))).alias("part")
    pieces = seen.select(key, "word", "s", "e", part).select(
        key, "word", "part", F.greatest("s", F.col("part") * window).alias("s"), F.least("e", F.col("part") * window + (window - 1)).alias("e")
    )
    w = W.partitionBy(key, "word", "part").orderBy("s", "e")
    # ends rise with starts, so the row before has the largest end so far
    fresh = F.coalesce((F.col("s") > F.lag("e").over(w) + 1).cast("int"), F.lit(1))
    merged = (
        pieces.withColumn("_f", fresh).withColumn("_run", F.sum("_f").over(w))
        .groupBy(key, "word", "part", "_run").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    )
    single = merged.groupBy("word").agg((F.sum(F.col("e") - F.col("s") + 1) / total).alias("p"))
    of_topic = merged.join(F.broadcast(topics.select("topic", "word")), "word", "inner")
    a = of_topic.select(key, "topic", "part", F.col("word").alias("wa"), F.col("s").alias("sa"), F.col("e").alias("ea"))
    b = of_topic.select(key, "topic", "part", F.col("word").alias("wb"), F.col("s").alias("sb"), F.col("e").alias("eb"))
    overlap = F.least("ea", "eb") - F.greatest("sa", "sb") + 1
    together = (
        a.join(b, [key, "topic", "part"], "inner").filter((F.col("sa") <= F.col("eb")) & (F.col("sb") <= F.col("ea")))
        .groupBy("topic", "wa", "wb").agg((F.sum(overlap) / total).alias("pab"))
    )
    pairs = topics.select("topic", F.col("word").alias("wa")).join(topics.select("topic", F.col("word").alias("wb")), "topic")
    scored = (
        pairs.join(together, ["topic", "wa", "wb"], "left")
        .join(single.select(F.col("word").alias("wa"), F.col("p").alias("pa")), "wa", "left")
        .join(single.select(F.col("word").alias("wb"), F.col("p").alias("pb")), "wb", "left")
        .na.fill(0.0, ["pab", "pa", "pb"])
    )
    joint = F.col("pab") + eps
    npmi = F.coalesce(F.try_divide(F.log(joint / F.greatest(F.col("pa") * F.col("pb"), F.lit(eps))), -F.log(joint)), F.lit(0.0))
    vectors = scored.select("topic", "wa", "wb", npmi.alias("x"))
    sums = vectors.groupBy("topic", "wb").agg(F.sum("x").alias("t"))
    cosine = vectors.join(sums, ["topic", "wb"], "inner").groupBy("topic", "wa").agg(
        F.try_divide(F.sum(F.col("x") * F.col("t")), F.sqrt(F.sum(F.col("x") * F.col("x"))) * F.sqrt(F.sum(F.col("t") * F.col("t")))).alias("c")
    )
    return cosine.groupBy("topic").agg(F.avg("c").alias("coherence"))
