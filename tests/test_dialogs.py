import pytest
from pyspark.sql import functions as F

from textloom.operators.dialogs import (
    concat_dialogs,
    instruct_rejects,
    instruct_to_dialog,
    size_report,
    transcript_to_dialog,
    turns_to_dialog,
)
from textloom.plans.merge import ChatSet, merge_chat_sets

SYSTEM, USER, AI = "The talk.", "[|Human|]", "[|AI|]"


def plain_transcript(text):
    out = []
    for piece in text.replace(SYSTEM, "").split(USER):
        piece = piece.strip()
        if AI in piece:
            user, answer = piece.split(AI, 1)
            out += [("user", user.strip()), ("assistant", answer.strip())]
    return out


@pytest.mark.parametrize(
    "text",
    [
        "",
        "no marker",
        f"{SYSTEM}\n{USER} q1\n{AI} a1 {USER} q2 {AI} a2\n",
        f"{SYSTEM}{SYSTEM} {USER}q{AI}a{AI}b",
        f"{USER}   {USER} lost question {USER} q {AI}",
        f"{AI} answer without question {USER} x",
        " \n  ",
    ],
)
def test_transcripts(spark, text):
    df = spark.createDataFrame([(text,)], "input string")
    got = transcript_to_dialog(df, "s", system_prefix=SYSTEM).first()
    assert [tuple(m) for m in got.dialog] == plain_transcript(text)
    assert got.source == "s"


def test_instructions(spark):
    rows = [("q", "c", "a"), ("q", "", "a"), ("q", None, "a"), (None, "c", "a"), ("q", "c", None)]
    df = spark.createDataFrame(rows, "instruction string, context string, response string")
    got = [[tuple(m) for m in r.dialog] for r in instruct_to_dialog(df, "s").collect()]
    assert got == [
        [("user", "q c"), ("assistant", "a")],
        [("user", "q"), ("assistant", "a")],
        [("user", "q"), ("assistant", "a")],
        [("user", "q c"), ("assistant", None)],
    ]
    assert instruct_rejects(df).count() == 1
    bare = instruct_to_dialog(df.drop("context"), "s")
    assert {r.dialog[0].content for r in bare.collect()} == {"q"}


def test_concat_keeps_duplicates_and_order(spark):
    df = spark.createDataFrame([("q", "a")], "instruction string, response string")
    first, second = instruct_to_dialog(df, "x"), instruct_to_dialog(df, "y")
    merged = concat_dialogs([first, second, first])
    assert [(r.source, r.source_ord) for r in merged.orderBy("source_ord").collect()] == [
        ("x", 0),
        ("y", 1),
        ("x", 2),
    ]
    assert {(r.source, r["rows"]) for r in size_report(merged).collect()} == {
        ("x", 2),
        ("y", 1),
        (None, 3),
    }


def test_turns_are_put_in_order(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(12)]
    rows += [(2, 0, "user", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [m.content for m in r.dialog] for r in turns_to_dialog(df.repartition(5)).collect()}
    assert got == {1: [f"t{t}" for t in range(12)], 2: ["only"]}


def test_rejects_are_counted_while_rows_are_written(spark, tmp_path):
    asked = [(1, "q", "a"), (2, None, "a"), (3, "q", None), (4, None, None)]
    rows = spark.createDataFrame(asked, "k long, instruction string, response string").repartition(3)
    talks = spark.createDataFrame([("z", f"{USER} a {AI} b {USER} c"), ("y", None), ("x", "")], "name string, input string")
    inputs = {
        "one": ChatSet(lambda c: instruct_to_dialog(rows, "one", keep=["k"], counts=c).withColumn("name", F.lit(None).cast("string")), "k"),
        "two": ChatSet(lambda c: transcript_to_dialog(talks, "two", keep=["name"], counts=c).withColumn("k", F.lit(None).cast("long")), "name"),
        "none": ChatSet(lambda c: instruct_to_dialog(rows.limit(0), "none", keep=["k"], counts=c).withColumn("name", F.lit(None).cast("string")), "k"),
    }
    merged, report = merge_chat_sets(spark, inputs, f"{tmp_path}/merged")
    assert {(r.source, r["rows"], r.rejects) for r in report.collect()} == {("one", 2, 2), ("two", 3, 1), (None, 5, 3)}
    # Keys of different types, and one place after the other.
    assert sorted((r.pos, r.k, r.name) for r in merged.collect()) == [
        (0, 1, None), (1, 3, None), (2, None, "x"), (3, None, "y"), (4, None, "z")
    ]
