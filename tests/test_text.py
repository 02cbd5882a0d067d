import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from socigrain.functions import text as T
from socigrain.operators import text as TX

SENTENCES = [
    "Anna Maria Kovač reads the morning paper", "The mayor met Anna Maria Kovač on Monday",
    "Anna Maria Kovač opened a school", "Flood warning near the river", "Flood warning lifted today",
    "Šibenik school wins a prize", "Nobody saw Anna Maria Kovač leave", "The river rose", "A quiet day in Šibenik",
]


def test_tokens(spark):
    got = spark.range(1).select(T.tokenize(F.lit("Ćevapi 2day _x a ŠTO_je covid19 " + "z" * 16 + " U2"))).first()[0]
    assert got == ["ćevapi", "day", "što_je", "covid"]
    noise = "RT @Some-one: see https://t.co/aB1?x=1 now @you_2!"
    assert spark.range(1).select(T.strip_noise(F.lit(noise))).first()[0] == "RT : see  now !"
    assert spark.range(1).select(T.strip_repost_prefix(F.lit(noise))).first()[0].startswith("see")


def _docs(spark, stop=("the", "a", "on", "in")):
    df = spark.createDataFrame(list(enumerate(SENTENCES)), "id long, full_text string")
    return TX.text_tokens(df, stop)


def test_three_word_name_becomes_one_token(spark):
    grams = TX.word_grams(_docs(spark), "id", "tokens", (1, 3.0), (1, 3.0))
    rows = [r[0] for r in grams.orderBy("id").select("word_grams").collect()]
    assert sum("anna_maria_kovač" in r for r in rows) == 4
    assert not any({"the", "on"} & set(r) for r in rows)
    assert any("šibenik" in t for r in rows for t in r)


def test_phrases_do_not_overlap(spark):
    docs = spark.createDataFrame([(1, ["new", "york", "city", "is", "new", "york"]), (2, []), (3, ["a", "a", "a", "a", "a"])], "id long, tokens array<string>")
    table = spark.createDataFrame([("new", "york", ""), ("york", "city", ""), ("a", "a", "")], "a string, b string, link string")
    got = {r["id"]: r["out"] for r in TX.phrases_apply(docs, table, "id", "tokens", "out").collect()}
    assert got == {1: ["new_york", "city", "is", "new_york"], 2: [], 3: ["a_a", "a_a", "a"]}


def test_phrases_reach_across_connectors(spark):
    docs = spark.createDataFrame([(i, ["city", "of", "light", f"w{i}"]) for i in range(4)], "id long, tokens array<string>")
    table = TX.phrases_fit(docs, "tokens", 1, 1.0, TX.CONNECTOR_WORDS)
    assert [(r["a"], r["link"], r["b"], r["n"]) for r in table.collect()] == [("city", "of", "light", 4)]
    got = TX.phrases_apply(docs, table, "id", "tokens", "out", TX.CONNECTOR_WORDS).orderBy("id").first()["out"]
    assert got == ["city_of_light", "w0"]


def test_lemmas_keep_order_and_unknown_words(spark):
    docs = spark.createDataFrame([(1, "en", ["dogs", "ran", "zzz"]), (2, "en", [])], "id long, lang string, tokens array<string>")
    lookup = spark.createDataFrame([("en", "dogs", "dog", "NOUN"), ("en", "ran", "run", "VERB")], "lang string, form string, lemma string, upos string")
    got = {r["id"]: r["lemmas"] for r in TX.lemmatize(docs, lookup, "id").collect()}
    assert got == {1: ["dog", "zzz"], 2: []}


def test_language_fallback(spark):
    train = spark.createDataFrame([("the cat and the dog with the hat", "en"), ("der hund und die katze mit dem hut", "de")], "text string, lang string")
    profiles = TX.language_profiles(train)
    posts = spark.createDataFrame([(1, "und", "the dog and the hat"), (2, "und", ""), (3, "hr", "der hund"), (4, "zxx", "mit der katze und dem")], "id long, lang string, full_text string")
    got = {r["id"]: r["lang"] for r in TX.lang_fallback(posts, profiles).collect()}
    assert got == {1: "en", 2: "zxx", 3: "hr", 4: "de"}


def test_language_scores_use_every_ngram(spark):
    rows = [("en", "the cat and the dog"), ("en", "a rare zyx"), ("de", "der hund und die katze"), ("de", None), (None, "der hund"), ("hr", "")]
    train = spark.createDataFrame(rows, "lang string, text string")
    texts = {1: "zyx", 2: "der der cat", 3: "the hund", 4: "qqq", 5: "a rare", 6: "katze zyx und zyx"}

    def grams(text):
        padded = f" {(text or '').strip()} "
        return [padded[i:i + 3] for i in range(len(padded) - 2)]

    counts = {lang: Counter(g for at, t in rows if at == lang for g in grams(t)) for lang in ("en", "de")}
    kinds = len(set(counts["en"]) | set(counts["de"]))

    def weight(lang, g):
        return math.log2((counts[lang][g] + 1) / (counts[lang].total() + kinds + 1))

    want = {}
    for key, t in texts.items():
        met = [g for g in grams(t) if any(c[g] for c in counts.values())]
        scores = {lang: sum(weight(lang, g) for g in met) for lang, c in counts.items() if any(c[g] for g in met)}
        if scores:
            want[key] = min(scores, key=lambda lang: (-scores[lang], lang))
    profiles = TX.language_profiles(train)
    for r in profiles.filter("gram IS NOT NULL").collect():
        assert r["weight"] == pytest.approx(weight(r["profile"], r["gram"]))
    posts = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = TX.detect_language(posts, profiles, "id").collect()
    assert {r["id"]: r["detected"] for r in got} == want and 4 not in want and want[1] == "en"


def test_coherence_prefers_words_seen_together(spark):
    rows = [(i, ["sun", "sea", f"x{i}"]) for i in range(6)] + [(i, ["tax", f"y{i}"]) for i in range(6, 9)] + [(i, ["moon", f"z{i}"]) for i in range(9, 12)]
    docs = spark.createDataFrame(rows, "id long, tokens array<string>")
    topics = spark.createDataFrame([(0, "sun"), (0, "sea"), (1, "tax"), (1, "moon")], "topic int, word string")
    got = {r["topic"]: r["coherence"] for r in TX.topic_coherence(docs, "id", "tokens", topics).collect()}
    assert abs(got[0] - 1.0) < 1e-6 and got[1] < 0.5


@pytest.mark.parametrize("window", [1, 4, 9, 500])
def test_coherence_equals_listed_windows(spark, window):
    rng = random.Random(window)
    docs = {i: [rng.choice("aaabbcdefgh") for _ in range(n)] for i, n in enumerate((0, 1, 3, 4, 30, 400))}
    topics = [(0, "a"), (0, "b"), (0, "c"), (1, "c"), (1, "d"), (1, "nowhere"), (2, "a")]
    seen = [set(t[s:s + window]) for t in docs.values() if t for s in range(max(len(t) - window, 0) + 1)]

    def share(*words):
        return sum(set(words) <= win for win in seen) / len(seen)

    want = {}
    for topic in (0, 1, 2):
        words = [w for t, w in topics if t == topic]
        x = {}
        for a in words:
            for b in words:
                joint, apart = share(a, b) + 1e-12, share(a) * share(b)
                x[a, b] = math.log(joint / max(apart, 1e-12)) / -math.log(joint) if joint != 1 else 0.0
        total = {b: sum(x[a, b] for a in words) for b in words}
        cosines = [sum(x[a, b] * total[b] for b in words) / math.sqrt(sum(x[a, b] ** 2 for b in words) * sum(t * t for t in total.values()))
                   for a in words if any(x[a, b] for b in words) and any(total.values())]
        want[topic] = sum(cosines) / len(cosines) if cosines else None
    df = spark.createDataFrame(list(docs.items()), "id long, tokens array<string>")
    got = TX.topic_coherence(df, "id", "tokens", spark.createDataFrame(topics, "topic int, word string"), window).collect()
    for r in got:
        assert r["coherence"] == (None if want[r["topic"]] is None else pytest.approx(want[r["topic"]], abs=1e-6))
    assert len(got) == 3


def test_topics(spark):
    docs = _docs(spark)
    words = TX.dictionary(docs, "tokens")
    size = words.count()
    assert [r["word_id"] for r in words.orderBy("word").collect()] == list(range(size))
    model = TX.fit_topics(TX.bag_vectors(TX.bag_of_words(docs, "id", "tokens", words), "id", size), 3, 2)
    described = TX.describe_topics(model, words, 4).collect()
    assert len(described) == 12 and all(r["word"] for r in described)


def test_repeated_text_steps_are_stored_and_small_tables_sent(spark):
    docs = spark.createDataFrame([(i, ["new", "york", "city", f"w{i}"]) for i in range(30)], "id long, tokens array<string>")
    phrases = TX.phrases_fit(docs, "tokens", 5, 0.1)
    plan = lambda df: df._jdf.queryExecution().toString()
    applied = TX.phrases_apply(docs, phrases, "id", "tokens", "out")
    assert "hashpartitioning(a#" not in plan(applied) and {tuple(r.out)[:3] for r in applied.collect()} == {("new_york", "city", f"w{i}") for i in range(30)}
    assert any("/bigrams-" in f for f in TX.word_grams(docs, "id", "tokens", (5, 0.1), (5, 0.1)).inputFiles())
    assert all("/words-" in f for f in TX.dictionary(docs, "tokens").inputFiles())
    texts = spark.createDataFrame([(1, "the house of the king"), (2, "das haus des herrn"), (3, "12"), (4, "the the das")], "id long, text string")
    profiles = TX.language_profiles(spark.createDataFrame([("en", "the house and the king"), ("de", "das haus und der herr")], "lang string, text string"))
    found = TX.detect_language(texts, profiles, "id")
    assert "regexp_extract_all" not in plan(found) and {tuple(r) for r in found.collect()} == {(1, "en"), (2, "de"), (4, "en")}
