import json

import pytest
from pyspark.sql import functions as F

from socigrain.functions import arrays as A, dates as D, text as T
from socigrain.operators import accounts as AC, baseline as B, edges as ED, posts as P, rollups as R
from socigrain.plans.post_queries import TOPICS
from socigrain.sources import readers, writers
from socigrain.sources.schemas import CLEAN_POST

BIG = 1594998198841798658


def post(id, user, at="Sun Jul 17 11:27:28 +0000 2022", text="t", tags=(), mentions=(), **more):
    return {
        "id": id, "created_at": at, "full_text": text, "lang": "en", "favorite_count": 1, "is_quote_status": False,
        "user": {"id": user, "id_str": str(user), "screen_name": f"u{user}"},
        "entities": {"hashtags": [{"text": t} for t in tags], "user_mentions": [{"id": m, "screen_name": f"u{m}"} for m in mentions]},
    } | more


@pytest.fixture()
def landed(spark, tmp_path):
    original = post(1, 10, text="hello", tags=["A", "A"])
    quoted = post(2, 11, at="Sun Jul 17 11:30:00 +0000 2022", text="q", tags=["B"])
    posts_a = [
        original,
        post(3, 12, at="Sun Jul 17 12:27:28 +0000 2022", text="RT he", tags=["A"], mentions=[10], retweeted_status=original),
        post(4, 12, at="Sun Jul 17 13:00:00 +0000 2022", text="see", is_quote_status=True, quoted_status=quoted, in_reply_to_status_id=1, in_reply_to_user_id=10),
        post(BIG, 13, at="Mon Jul 18 00:00:00 +0000 2022", text=None),
        post(9, 13, at="Fri Jul 01 00:00:00 +0000 2022", text="too early"),
    ]
    posts_b = [quoted, original, post(5, 13, at="Sun Jul 17 14:00:00 +0000 2022", retweeted_status=post(BIG + 1, 99), mentions=[13, 12])]
    for day, rows in (("2022-07-17", posts_a), ("2022-07-18", posts_b)):
        (tmp_path / day).mkdir()
        (tmp_path / day / "u.json").write_text(json.dumps(rows))
    return readers.scan_posts_json(spark, str(tmp_path))


def test_clean_posts(landed):
    clean = P.clean_posts(landed, "2022-07-20", min_date="2022-07-10 00:00:00")
    assert [f.split()[0] for f in CLEAN_POST.split(", ")] == clean.columns
    rows = {r["id"]: r for r in clean.collect()}
    assert set(rows) == {1, 2, 3, 4, 5, BIG}
    assert rows[3]["full_text"] == "hello" and rows[BIG]["full_text"] == ""
    assert rows[3]["is_repost"] and not rows[3]["is_original"] and rows[3]["repost_delay_sec"] == 3600
    assert rows[3]["original_tags"] == [] and rows[3]["repost_tags"] == ["A", "A"]
    assert rows[4]["is_quote"] and rows[4]["is_reply"] and rows[4]["is_original"] and rows[4]["quote_tags"] == ["B"]
    assert (rows[1]["in_repost_cnt"], rows[1]["in_reply_cnt"], rows[1]["in_repost_delay_sec"]) == (1, 1, 3600.0)
    assert rows[2]["in_quote_cnt"] == 1 and rows[2]["in_repost_delay_sec"] == 0.0
    assert rows[5]["repost_of_id"] == BIG + 1  # 64-bit exact


def test_rollup_relations(landed):
    clean = P.posts_view(P.clean_posts(landed, "d"))
    r = R.account_rollup(clean)
    assert r.filter("original_cnt + out_repost_cnt <> total_out_cnt").isEmpty()
    view = {x["user_id"]: x for x in R.account_view(
        r.sparkSession.createDataFrame([(10, "x"), (77, "y")], "user_id long, created_at string"), r).collect()}
    assert view[77]["total_out_cnt"] == 0 and view[77]["in_repost_delay_sec"] is None


def test_edges(spark, landed):
    flat = P.flat_posts(landed)
    nodes = spark.createDataFrame([(10, "u10"), (12, "u12"), (13, "u13")], "user_id long, screen_name string")
    mentions = [tuple(r) for r in ED.mention_edges(nodes, flat).collect()]
    assert sorted(mentions) == [(12, 10), (13, 12)]  # no self mention, duplicates of a post id gone
    reposts = ED.repost_edges(nodes, flat).select("src", "dst", "delay_sec").collect()
    assert [tuple(r) for r in reposts] == [(10, 12, 3600)]  # author 99 is no node


def test_follow_lists(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"1": {"friends_count": 2, "followers_count": 0, "friends": [2, 9], "followers": []}}))
    (tmp_path / "2.json").write_text(json.dumps({"2": {"friends_count": 1, "followers_count": 0, "friends": [1], "followers": []}}))
    lists = readers.scan_follow_lists(spark, str(tmp_path))
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    assert sorted(map(tuple, ED.follow_edges(nodes, lists).collect())) == [(1, 2), (2, 1)]
    assert tuple(readers.follow_coverage(nodes, lists).first()) == (3, 2, 1)


def test_ids_and_marks(spark, tmp_path):
    (tmp_path / "ids.json").write_text("[1, 2, 3]")
    (tmp_path / "objs.json").write_text('[{"id": 7}, {"id": 8}]')
    (tmp_path / "marks.json").write_text('{"1": 5, "2": 6, "1": 9}')
    assert readers.read_ids(spark, str(tmp_path / "ids.json")).count() == 3
    assert readers.read_ids(spark, str(tmp_path / "objs.json"), "id").count() == 2
    assert readers.read_ids(spark, str(tmp_path / "none.json")).count() == 0
    marks = readers.read_marks(spark, str(tmp_path / "marks.json"))
    assert sorted(map(tuple, marks.collect())) == [(1, 9), (2, 6)]
    rows = spark.createDataFrame([(10, 1), (4, 1), (1, 3)], "id long, user_id long")
    assert sorted(map(tuple, B.newer_than_marks(rows, marks).select("id").collect())) == [(1,), (10,)]
    after = B.advance_marks(marks, rows)
    assert B.newer_than_marks(rows, after).isEmpty()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi",\nthere', ["A", "A"])], "id long, text string, tags array<string>")
    writers.write_clean_csv(df, str(tmp_path / "csv"))
    back = readers.scan_dated_csv(spark, str(tmp_path / "csv"), "id bigint, text string, tags string", {"tags": "string"})
    assert back.collect() == df.collect()
    empty = spark.createDataFrame([], "src long, dst long")
    assert not writers.write_edges(empty, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_one_to_many_is_checked(spark):
    left = spark.createDataFrame([(1,), (1,)], "k long")
    with pytest.raises(Exception, match="not unique"):
        R.validated_one_to_many(left, left, "k").collect()


def test_locations(spark):
    raw = spark.createDataFrame(
        [(1, None), (2, " zg \n"), (3, "Zaprešić,croatia"), (4, "\U0001F1ED\U0001F1F7"), (5, "novi VINODOLSKI"), (6, "Paris"), (7, "")],
        "id long, location string")
    places = ["ZG", "\U0001F1ED\U0001F1F7", "Novi Vinodolski"]
    full = raw.select("*", *[F.lit(None).cast("string").alias(c) for c in ("name", "screen_name", "description", "created_at", "id_str")],
                      *[F.lit(False).alias(c) for c in ("protected", "verified")],
                      *[F.lit(11).alias(c) for c in ("followers_count", "friends_count", "listed_count", "favourites_count", "statuses_count")])
    for listed in (places, spark.createDataFrame([(p,) for p in places], "p string")):
        got = {r["user_id"]: (r["is_local"], r["clean_location"]) for r in AC.clean_accounts(_typed(full), listed).collect()}
        assert got == {1: (False, None), 2: (True, "Zagreb"), 3: (True, "Hrvatska"), 4: (True, "Hrvatska"),
                       5: (True, "Novi Vinodolski"), 6: (False, None), 7: (False, None)}
    title = raw.sparkSession.range(1).select(T.title_case(F.lit("zaprešić,croatia o'neil 3d")).alias("t")).first()[0]
    assert title == "zaprešić,croatia o'neil 3d".title()


def _typed(df):
    return df


def test_bands_have_open_edges(spark):
    df = spark.createDataFrame([(0,), (1,), (20_000,), (59_999,), (60_000,), (300_001,), (359_999,), (360_000,)], "f long")
    got = [r[0] for r in df.select(AC.follower_band(F.col("f"))).collect()]
    assert got == [None, "0-20000", None, "40000-60000", None, "300000-360000", "300000-360000", None]


def test_scalars(spark):
    one = spark.range(1)
    label = lambda d: one.select(D.monday_week_label(F.lit(d).cast("timestamp"))).first()[0]
    assert [label(d) for d in ("2022-01-01", "2022-01-03", "2022-11-06", "2023-01-01", "2024-01-01")] == [
        "2022-00", "2022-01", "2022-44", "2023-00", "2024-01"]
    assert one.select(A.revive_list(F.lit("['A', 'A']"))).first()[0] == ["A", "A"]
    assert one.select(A.revive_list(F.lit("[912539725071777792]"), "bigint")).first()[0] == [912539725071777792]
    pairs = one.select(A.paired_items(F.array(*[F.lit(x) for x in "abcde"]))).first()[0]
    assert [tuple(p) for p in pairs] == [("a", "b"), ("c", "d")]
    war = TOPICS["ukraine_war"]
    flags = [one.select(T.topic_flag(F.lit(t), *war)).first()[0] for t in ("the war", "a reward", "peace")]
    assert flags == [True, False, False]
    keys = spark.createDataFrame([("fly10",), ("fly9",), ("fly1",)], "n string").orderBy(T.natural_sort_key(F.col("n")))
    assert [r[0] for r in keys.collect()] == ["fly1", "fly9", "fly10"]
    wide = ["fly" + "9" * 20, "fly1" + "0" * 20, "fly1" + "0" * 19 + "1"]
    found = spark.createDataFrame([(x,) for x in wide], "n string").orderBy(T.natural_sort_key(F.col("n"))).collect()
    assert [r[0] for r in found] == [wide[0], *sorted(wide[1:])]
