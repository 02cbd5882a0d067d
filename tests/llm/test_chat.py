"""Chat formatting against plain Python, and its way back."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from socigrain.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string, t string, formatted int, ts int"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    bits = [*chat.CONTROLS, "\\", "<", ">", "<|", "im_start|>", "\n", "日本", "word ", " ", "[", "/s>", "<<", "SYS>>", "$1", "\\E", "\U0001f600"]
    out = []
    for conv in range(60):
        for turn in range(rnd.randint(1, 9)):
            text = rnd.choice([None, "", "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 12)))])
            out.append((conv, turn * 3 - 4, rnd.choice(["user", "assistant", "assistant", "system", None, "a<|im_sep|>b", "x\ny"]), text, "p", "t", 1, 2))
    out += [(None, None, "assistant", "lost", "p", "t", 1, 2), (None, 2, None, None, "p", "t", 1, 2)]
    out += [(100, i, rnd.choice(["user", "assistant"]), f"t{i} " * (i % 7), "p", "t", 1, 2) for i in range(1500)]
    return out + out[:2] + [(5, 0, "user", "long " * 200_000, "p", "t", 1, 2)]


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r[:4])
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    return {c: [(r[2] or "", r[3] or "") for r in sorted(rs, key=key)] for c, rs in out.items()}


def escaped(t):
    t = t.replace("\\", "\\\\")
    for c in chat.CONTROLS:
        t = t.replace(c, c[0] + "\\" + c[1:])
    return t


def formatted(turns):
    out, spans, before = "", [], None
    for i, (role, text) in enumerate(turns):
        if i and role == before:
            out += chat.NEXT
        else:
            out += ("" if not i else chat.END) + chat.START + escaped(role) + chat.SEP
        if role == "assistant":
            spans.append((len(out), len(out) + len(escaped(text))))
        out += escaped(text)
        before = role
    return out + chat.END, spans


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_format_and_way_back(spark, rows):
    made = chat.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want = by_conversation(rows)
    got = {r.conv_id: (r.formatted, [tuple(s) for s in r.loss]) for r in made.collect()}
    assert got == {c: formatted(t) for c, t in want.items()}
    read = made.select("conv_id", chat.turns_of(F.col("formatted")).alias("turns")).collect()
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in read} == want
    told = {r.conv_id: tuple(r)[1:] for r in chat.digests(made).collect()}
    for c, turns in want.items():
        masked = "".join(t for role, t in turns if role == "assistant")
        assert told[c] == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(masked), sha(masked), len(got[c][0]))


def test_controls_only_come_from_the_template(spark, rows):
    made = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in made:
        left = r.formatted
        for c in (chat.START, chat.SEP, chat.NEXT, chat.END):
            left = left.replace(c, "\0")
        assert not any(c in left for c in chat.CONTROLS)


def test_neighbours_of_one_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d")]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert made.formatted == "<|im_start|>user<|im_sep|>a<|im_next|>b<|im_end|><|im_start|>assistant<|im_sep|>c<|im_next|>d<|im_end|>"
    assert [made.formatted[a:b] for a, b in made.loss] == ["c", "d"]


def test_long_conversations_in_parts(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA)
    whole = {r.conv_id: r.formatted for r in chat.format_conversations(turns).collect()}
    parts = chat.format_conversations(turns, part_turns=100)
    assert parts.filter("conv_id = 100").count() == 15
    read = parts.select("conv_id", "part", chat.turns_of(F.col("formatted")).alias("turns")).collect()
    told = {}
    for r in sorted(read, key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.part)):
        told.setdefault(r.conv_id, []).extend(tuple(t) for t in r.turns)
    want = by_conversation(rows)
    assert told[100] == want[100] and set(told) == set(want) == set(whole)


def test_sums_before(spark):
    for n in (1, 2, chat.RUN - 1, chat.RUN, chat.RUN + 1, 3 * chat.RUN + 5):
        row = spark.createDataFrame([([*range(1, n + 1)],)], "xs array<long>").select(chat.sums_before(F.col("xs")).alias("s")).first()
        assert row.s == [i * (i + 1) // 2 for i in range(n)]


def test_empty_table_and_native_plan(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.format_conversations(none)).collect() == []
    plan = chat.digests(chat.format_conversations(none))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
