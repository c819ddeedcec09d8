"""Chat formatting against a plain formatter and reader, and against forged marks."""

import random

import pytest
from pyspark.sql import functions as F

from larkspan.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BITS = ["[INST]", "[/INST]", "</s>", "<s>", "[\\INST]", "[\\\\/INST]", "<\\s>", "\\", "[", "<", " ", "ok", "\n", "é", "[ANS]", "[/SYS", "]", "[ROLE] x [/ROLE] ", "🙂", "$1"]


def in_order(roles):
    moves = {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
    return all(m in moves for m in zip(["", *roles], roles)) and roles[-1] == "assistant"


def test_round_trip_of_hostile_texts(spark):
    rnd = random.Random(5)
    text = lambda: "".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 9)))
    rows = []
    for c in range(60):
        for i in range(rnd.randint(1, 7)):
            rows.append((c, i * 100, rnd.choice(["user", "assistant", "system", "tool", "", "[INST]", "a [/ROLE] b"]), text()))
    rnd.shuffle(rows)
    got = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    got = got.select("*", chat.joined().alias("formatted"), chat.learned_text().alias("learned")).withColumn("turns", chat.read_turns(F.col("formatted")))
    for r in got.collect():
        mine = [(role, t) for c, _, role, t in sorted(rows) if c == r.conv_id]
        assert [tuple(x) for x in r.turns] == mine and r.n_turns == len(mine)
        assert r.learned == "".join(t for role, t in mine if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
        learned = [s.text for s in r.segments if s.loss]
        assert len(learned) == sum(role == "assistant" for role, _ in mine)
        assert not any(mark in s for s in learned for mark in chat.BRACKETS.controls())
        assert r.in_order == in_order([role for role, _ in mine])


def test_the_training_text_itself(spark):
    rows = [(1, 2, "assistant", "hi"), (1, 0, "system", "be brief"), (1, 1, "user", "say [INST]")]
    got = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).select(chat.joined().alias("x"), "in_order").first()
    assert got.x == "<s>[SYS] be brief [/SYS][INST] say [\\INST] [/INST][ANS] hi </s>" and got.in_order


@pytest.mark.parametrize("turns", [3, 2000])
def test_long_conversations_keep_their_order(spark, turns):
    rows = [(1, i, ["user", "assistant"][i % 2], f"t{i}") for i in range(turns)] + [(2, i, "user" if i % 2 == 0 or i == 701 else "assistant", "x") for i in range(turns)]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()}
    assert [s.text for s in got[1].segments if s.text.startswith("t")] == [f"t{i}" for i in range(turns)]
    assert got[1].in_order == (turns % 2 == 0) and not got[2].in_order
    assert got[2].end_state == ("refused" if turns > 701 else "asked")


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = [(None, None, None, None, 1, "p"), (1, 0, "user", "b", 2, "q"), (1, 0, "user", "a", 3, "r"), (1, 0, "user", "a", 4, "s"), (1, None, "assistant", None, 5, "t"), (1, 9, "user", "z" * 300000, 6, "u")]
    docs = spark.createDataFrame(rows, SCHEMA + ", part int, segments string")
    got = {r.conv_id: r for r in chat.format_chats(docs).select("conv_id", chat.read_turns(chat.joined()).alias("t"), "in_order").collect()}
    assert [tuple(x) for x in got[None].t] == [("", "")]
    assert [tuple(x) for x in got[1].t] == [("assistant", ""), ("user", "a"), ("user", "a"), ("user", "b"), ("user", "z" * 300000)]
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_templates_that_could_be_forged_are_refused():
    good = chat.BRACKETS
    make = lambda **x: chat.Template(**({k: getattr(good, k) for k in ("begin", "roles", "other", "named", "moves", "start", "final")} | x))
    for bad in ({"begin": "<<s>"}, {"begin": ""}, {"named": "a\\b"}, {"roles": {"user": chat.Marks("[A]", "[B]"), "assistant": chat.Marks("[A]", "[C]")}}, {"moves": {("opened", "robot"): "asked"}}):
        with pytest.raises(ValueError):
            make(**bad)


def test_equals_the_sql(spark):
    import duckdb

    from larkspan.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()['op12_chat']})").fetchall()
    got = [tuple(r) for r in queries.queries()["op12_chat"](spark, sf).select(*cols).collect()]
    assert sorted(got) == sorted(want) and -7 in {r[0] for r in got}
