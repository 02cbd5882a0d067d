"""Text mining over the documents table and the posts."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import text as T
from ..operators import rollups as R, text as TX
from ..session import cut
from . import adapter as ad
from .adapter import FLAT, with_ctes as sql
from .registry import query
from .rollup_queries import rounded

STOP_WORDS = ["the", "and", "of", "in", "is", "la", "le", "un", "der", "die", "und", "el", "de"]
TOKENS = "tok AS (SELECT doc_id, lang, list_filter(regexp_extract_all(lower(" + ad.strip_sql("text") + r"""),
  '[\p{L}\p{M}\p{Pc}]+'), lambda t: length(t) BETWEEN 2 AND 15 AND t[1] <> '_') AS all_tokens FROM documents),
docs AS (SELECT doc_id, lang, list_filter(all_tokens, lambda t: t NOT IN ('""" + "', '".join(STOP_WORDS) + """')) AS tokens FROM tok),
words AS (SELECT doc_id, lang, unnest(tokens) AS w, unnest(range(0, len(tokens))) AS pos FROM docs)"""


def docs(spark, sf):
    d = ad.documents(spark, sf)
    return TX.text_tokens(d, STOP_WORDS, "text").drop("text")


def hashed(items):
    return F.md5(F.array_join(items, " "))


# ------------------------------------------------------------------ T01-T05
GRAMS = r"""padded AS (SELECT doc_id, lang, ' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' ' AS p FROM documents),
chars AS (SELECT doc_id, lang, unnest(string_split(p, '')) AS c, unnest(range(0, len(string_split(p, '')))) AS i FROM padded),
grams AS (SELECT doc_id, lang, gram FROM (SELECT doc_id, lang, c || lead(c, 1) OVER w || lead(c, 2) OVER w AS gram FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE gram IS NOT NULL),
cnt AS (SELECT lang AS profile, gram, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY 1, 2),
sizes AS (SELECT profile, sum(n) AS size FROM cnt GROUP BY 1),
prof AS (SELECT profile, gram, log2((n + 1) / (size + kinds + 1)) AS weight
  FROM (SELECT * FROM cnt UNION ALL SELECT profile, NULL, 0 FROM sizes) JOIN sizes USING (profile), (SELECT count(DISTINCT gram) AS kinds FROM cnt))"""


@query("T01_language_profiles", sql(GRAMS, select="SELECT profile, gram, round(weight, 6) AS weight FROM prof"))
def _(spark, sf):
    return TX.language_profiles(ad.documents(spark, sf)).withColumn("weight", F.round("weight", 6))


@query("T01_lang_fallback", sql(GRAMS, select="""
  , known AS (SELECT k.profile, k.gram, k.weight - u.weight AS gain, u.weight AS unknown
    FROM prof k JOIN prof u ON u.profile = k.profile AND u.gram IS NULL WHERE k.gram IS NOT NULL),
  lengths AS (SELECT doc_id, count(*) AS n FROM grams WHERE gram IN (SELECT gram FROM known) GROUP BY 1),
  scores AS (SELECT doc_id, profile, sum(gain) + any_value(n) * any_value(unknown) AS score
    FROM grams JOIN known USING (gram) JOIN lengths USING (doc_id) GROUP BY 1, 2),
  best AS (SELECT doc_id, profile, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, profile) AS i FROM scores)
  SELECT d.doc_id, coalesce(profile, 'zxx') AS detected FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id AND i = 1"""))
def _(spark, sf):
    d = ad.documents(spark, sf)
    profiles = cut(TX.language_profiles(d))
    unknown = d.withColumn("lang", F.lit("und"))
    return TX.lang_fallback(unknown, profiles, "doc_id", "text").select("doc_id", F.col("lang").alias("detected"))


@query("T02_strip_noise", f"SELECT doc_id, md5({ad.strip_sql('text')}) AS h FROM documents")
def _(spark, sf):
    return ad.documents(spark, sf).select("doc_id", F.md5(T.strip_noise(F.col("text"))).alias("h"))


@query("T03_tokenize", sql(TOKENS, select="SELECT doc_id, len(all_tokens) AS n, md5(array_to_string(all_tokens, ' ')) AS h FROM tok"))
def _(spark, sf):
    d = TX.text_tokens(ad.documents(spark, sf), (), "text")
    return d.select("doc_id", F.size("tokens").alias("n"), hashed("tokens").alias("h"))


@query("T04_remove_stop_words", sql(TOKENS, select="SELECT doc_id, len(tokens) AS n, md5(array_to_string(tokens, ' ')) AS h FROM docs"))
def _(spark, sf):
    return docs(spark, sf).select("doc_id", F.size("tokens").alias("n"), hashed("tokens").alias("h"))


LOOKUP = """lk AS (SELECT lang, w AS form, w[1:5] AS lemma, ['NOUN', 'VERB', 'ADJ', 'ADV'][length(w) % 4 + 1] AS upos
  FROM (SELECT DISTINCT lang, w FROM words WHERE length(w) >= 6))"""


def _lookup(spark, sf):
    """A lemma table derived from the vocabulary: long words, cut to five letters."""
    v = docs(spark, sf).select("lang", F.explode("tokens").alias("form")).distinct().filter(F.length("form") >= 6)
    pos = F.element_at(F.array(*[F.lit(x) for x in ("NOUN", "VERB", "ADJ", "ADV")]), (F.length("form") % 4 + 1).cast("int"))
    return v.select("lang", "form", F.substring("form", 1, 5).alias("lemma"), pos.alias("upos"))


@query("T05_lemmatize", sql(TOKENS, LOOKUP, select="""
  , le AS (SELECT doc_id, count(*) AS n, md5(string_agg(coalesce(lemma, w), ' ' ORDER BY pos)) AS h FROM words LEFT JOIN lk ON lk.lang = words.lang AND form = w
    WHERE lemma IS NULL OR upos IN ('NOUN', 'PROPN', 'ADJ') GROUP BY doc_id)
  SELECT d.doc_id, coalesce(n, 0) AS n, coalesce(h, md5('')) AS h FROM docs d LEFT JOIN le ON le.doc_id = d.doc_id"""))
def _(spark, sf):
    d = TX.lemmatize(docs(spark, sf), _lookup(spark, sf), "doc_id")
    return d.select("doc_id", F.size("lemmas").cast("bigint").alias("n"), hashed("lemmas").alias("h"))


# ------------------------------------------------------------------ T06, T07: phrases
def fit_sql(words, out, min_count, threshold):
    """Phrase table of a (doc_id, w, pos) relation."""
    return f"""{out}_p AS (SELECT x.w AS a, y.w AS b, count(*) AS n FROM {words} x JOIN {words} y ON y.doc_id = x.doc_id AND y.pos = x.pos + 1 GROUP BY 1, 2),
{out}_u AS (SELECT w, count(*) AS n FROM {words} GROUP BY w),
{out} AS (SELECT a, b, p.n, CAST(p.n - {min_count} AS DOUBLE) * ((SELECT count(*) FROM {out}_u) + (SELECT count(*) FROM {out}_p)) / ua.n / ub.n AS score
  FROM {out}_p p JOIN {out}_u ua ON ua.w = a JOIN {out}_u ub ON ub.w = b
  WHERE CAST(p.n - {min_count} AS DOUBLE) * ((SELECT count(*) FROM {out}_u) + (SELECT count(*) FROM {out}_p)) / ua.n / ub.n > {threshold})"""


def apply_sql(words, phrases, out):
    """Left-to-right scan: at each position take the pair if it is a phrase, else the word."""
    return f"""{out}_f AS (SELECT x.doc_id, x.pos, x.w, y.w AS nx, p.a IS NOT NULL AS hit FROM {words} x LEFT JOIN {words} y ON y.doc_id = x.doc_id AND y.pos = x.pos + 1
  LEFT JOIN {phrases} p ON p.a = x.w AND p.b = y.w),
{out}_s AS (SELECT doc_id, pos, hit, w, nx FROM {out}_f WHERE pos = 0
  UNION ALL SELECT f.doc_id, f.pos, f.hit, f.w, f.nx FROM {out}_s s JOIN {out}_f f ON f.doc_id = s.doc_id AND f.pos = s.pos + CASE WHEN s.hit THEN 2 ELSE 1 END),
{out} AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, CASE WHEN hit THEN w || '_' || nx ELSE w END AS w FROM {out}_s)"""


BI, TRI = (5, 5.0), (3, 10.0)


@query("T06_phrases_fit", sql(TOKENS, fit_sql("words", "ph", *BI), select="SELECT a, b, n, round(score, 4) AS score FROM ph"))
def _(spark, sf):
    return rounded(TX.phrases_fit(cut(docs(spark, sf)), "tokens", *BI).drop("link"), "score", digits=4)


@query("T07_phrases_apply", sql(TOKENS, fit_sql("words", "ph", *BI), apply_sql("words", "ph", "bg"), select="""
  SELECT doc_id, count(*) AS n, md5(string_agg(w, ' ' ORDER BY pos)) AS h FROM bg GROUP BY doc_id"""))
def _(spark, sf):
    d = cut(docs(spark, sf))
    p = TX.phrases_apply(d, TX.phrases_fit(d, "tokens", *BI), "doc_id", "tokens", "grams")
    return p.filter(F.size("grams") > 0).select("doc_id", F.size("grams").cast("bigint").alias("n"), hashed("grams").alias("h"))


@query("T07_word_grams", sql(TOKENS, fit_sql("words", "ph", *BI), apply_sql("words", "ph", "bg"), fit_sql("bg", "th", *TRI), apply_sql("bg", "th", "tg"), select="""
  SELECT doc_id, count(*) AS n, md5(string_agg(w, ' ' ORDER BY pos)) AS h FROM tg GROUP BY doc_id"""))
def _(spark, sf):
    g = TX.word_grams(cut(docs(spark, sf)), "doc_id", "tokens", BI, TRI)
    return g.filter(F.size("word_grams") > 0).select("doc_id", F.size("word_grams").cast("bigint").alias("n"), hashed("word_grams").alias("h"))


# ------------------------------------------------------------------ T08-T12
@query("T08_dictionary", sql(TOKENS, select="SELECT w AS word, row_number() OVER (ORDER BY w) - 1 AS word_id, count(*) AS n FROM words GROUP BY w"))
def _(spark, sf):
    return TX.dictionary(docs(spark, sf), "tokens")


@query("T08_bag_of_words", sql(TOKENS, select="""
  , d AS (SELECT w, row_number() OVER (ORDER BY w) - 1 AS word_id FROM (SELECT DISTINCT w FROM words))
  SELECT doc_id, word_id, count(*) AS n FROM words JOIN d USING (w) GROUP BY 1, 2"""))
def _(spark, sf):
    d = cut(docs(spark, sf))
    return TX.bag_of_words(d, "doc_id", "tokens", TX.dictionary(d, "tokens"))


def _topics(spark, sf, k, passes):
    d = cut(docs(spark, sf))
    words = cut(TX.dictionary(d, "tokens"))
    size = words.count()
    vectors = cut(TX.bag_vectors(TX.bag_of_words(d, "doc_id", "tokens", words), "doc_id", size))
    model = TX.fit_topics(vectors, k, passes)
    return d, TX.describe_topics(model, words, 10)


@query("T09_lda_topics")
def _(spark, sf):
    return _topics(spark, sf, 4, 5)[1]


@query("T10_topic_coherence")
def _(spark, sf):
    d, topics = _topics(spark, sf, 4, 5)
    return TX.topic_coherence(d, "doc_id", "tokens", cut(topics.select("topic", "word")))


COHERENCE_WINDOW = 12


@query("T10_coherence_of_frequent_words", sql(TOKENS, select=f"""
  , ranked AS (SELECT lang, w, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) AS rk FROM words GROUP BY lang, w),
  topics AS (SELECT lang AS topic, w FROM ranked WHERE rk <= 6),
  sizes AS (SELECT doc_id, greatest(len(tokens) - {COHERENCE_WINDOW}, 0) AS last FROM docs WHERE len(tokens) > 0),
  total AS (SELECT CAST(sum(last + 1) AS DOUBLE) AS t FROM sizes),
  hits AS (SELECT DISTINCT doc_id, w, unnest(range(greatest(pos - {COHERENCE_WINDOW} + 1, 0), least(pos, last) + 1)) AS s
    FROM words JOIN sizes USING (doc_id) WHERE w IN (SELECT w FROM topics)),
  p1 AS (SELECT w, count(*) / any_value(t) AS p FROM hits, total GROUP BY w),
  p2 AS (SELECT a.w AS wa, b.w AS wb, count(*) / any_value(t) AS p FROM hits a JOIN hits b USING (doc_id, s), total GROUP BY 1, 2),
  x AS (SELECT topic, x.w AS wa, y.w AS wb, coalesce(p2.p, 0) + 1e-12 AS j, greatest(pa.p * pb.p, 1e-12) AS m
    FROM topics x JOIN topics y USING (topic) LEFT JOIN p2 ON p2.wa = x.w AND p2.wb = y.w JOIN p1 pa ON pa.w = x.w JOIN p1 pb ON pb.w = y.w),
  v AS (SELECT topic, wa, wb, ln(j / m) / -ln(j) AS x FROM x),
  c AS (SELECT topic, wa, sum(x * t) / (sqrt(sum(x * x)) * sqrt(sum(t * t))) AS c
    FROM v JOIN (SELECT topic, wb, sum(x) AS t FROM v GROUP BY 1, 2) USING (topic, wb) GROUP BY 1, 2)
  SELECT topic, round(avg(c), 6) AS coherence FROM c GROUP BY topic"""))
def _(spark, sf):
    """Coherence of each language's six most frequent words."""
    d = cut(docs(spark, sf))
    counts = d.select(F.col("lang").alias("topic"), F.explode("tokens").alias("word")).groupBy("topic", "word").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(W.partitionBy("topic").orderBy(F.desc("n"), "word"))
    topics = cut(counts.withColumn("place", place).filter("place <= 6").select("topic", "word"))
    return rounded(TX.topic_coherence(d, "doc_id", "tokens", topics, COHERENCE_WINDOW), "coherence")


@query("T11_text_rollup", sql(TOKENS, select="""
  , o AS (SELECT lang, w, row_number() OVER (PARTITION BY lang ORDER BY doc_id, pos) - 1 AS i FROM words)
  SELECT lang, i // 1000 AS chunk, md5(string_agg(w, ' ' ORDER BY i)) AS h FROM o GROUP BY 1, 2"""))
def _(spark, sf):
    c = R.concat_lists(docs(spark, sf), ["lang"], "tokens", ["doc_id"], F.floor(F.col("doc_id") / 20), chunk=1000)
    return c.select("lang", F.col("chunk").cast("bigint").alias("chunk"), hashed("items").alias("h"))


@query("T12_corpus_slice", sql(FLAT, select="""
  SELECT id, screen_name FROM flat WHERE screen_name IN (SELECT screen_name FROM flat GROUP BY 1 ORDER BY count(*) DESC, screen_name LIMIT 20)
    AND created_at >= TIMESTAMP '2024-01-10'"""))
def _(spark, sf):
    return TX.corpus_slice(ad.flat(spark, sf), 20, since="2024-01-10").select("id", "screen_name")
