import math

import pytest
from pyspark.sql import functions as F

from textloom.functions.text import (
    SIZE_UNITS,
    WHITESPACE,
    human_size,
    lex,
    lex_count,
    lexer_pattern,
    literal_pattern,
    render_prompt,
    strip,
)
from textloom.operators.dialogs import DIALOG_TYPE
from textloom.sources.writers import prepared_path


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


@pytest.mark.parametrize("text", ["", "  ", " a b \n", "​x", "a\x1c", "\x85y　"])
def test_strip(spark, text):
    assert one(spark, strip(F.lit(text))) == text.strip()


def size_label(size):
    if size == 0:
        return "0B"
    power = max(k for k in range(len(SIZE_UNITS)) if 1024**k <= size)
    return f"{round(size / math.pow(1024, power), 2)} {SIZE_UNITS[power]}"


def test_human_size(spark):
    sizes = [0, 1, 999, 1023, 1024, 1025, 1034, 1152, 1536, 1024**2 - 1, 123456789]
    sizes += [1024**k for k in range(1, 9)] + [1024**8 * 999, 5 * 1024**3 + 12345678]
    df = spark.createDataFrame([(str(s),) for s in sizes], "b string")
    size = F.col("b").cast("decimal(38,0)")
    got = [r[0] for r in df.select(human_size(size)).collect()]
    assert got == [size_label(s) for s in sizes]


def test_lexer(spark):
    text = "<s>[INST] a_b ü9!\x0b</s> \U0001f600x <s"
    tokens = ["<s>", "[", "INST", "]", "a_b", "ü9", "!", "</s>", "\U0001f600", "x", "<", "s"]
    assert one(spark, lex(F.lit(text), lexer_pattern())) == tokens
    assert one(spark, lex_count(F.lit(text), lexer_pattern())) == len(tokens)


@pytest.mark.parametrize("marker", ["[|Human|]", "a.b*c", "\\E", "#x y"])
def test_literal_pattern(spark, marker):
    text = f"1{marker}2{marker}3"
    assert one(spark, F.split(F.lit(text), literal_pattern(marker))) == ["1", "2", "3"]


def plain_prompt(dialog, system):
    text = "<s>[INST] "
    if system:
        text += f"<<SYS>>\n{system}\n<</SYS>>\n\n"
    for i, (role, content) in enumerate(dialog):
        if role == "user":
            text += ("<s>[INST] " if i else "") + f"{content} [/INST]"
        else:
            text += f" {content} </s>"
    return text


@pytest.mark.parametrize("system", [None, "", "Be brief."])
@pytest.mark.parametrize(
    "dialog",
    [
        [],
        [("user", "hi")],
        [("assistant", "first"), ("user", "second")],
        [("system", "rules"), ("user", "q"), ("assistant", "a")],
        [("user", "q"), ("assistant", "a"), ("user", "r"), ("user", "s"), ("assistant", None)],
    ],
)
def test_render_prompt(spark, dialog, system):
    df = spark.createDataFrame([(dialog, system)], f"dialog {DIALOG_TYPE}, system string")
    expected = plain_prompt(dialog, system)
    assert df.select(render_prompt(F.col("dialog"), system)).first()[0] == expected
    assert df.select(render_prompt(F.col("dialog"), F.col("system"))).first()[0] == expected


def test_prepared_path():
    assert prepared_path("out", "org/name", None, "org/tok", 512) == "out/name--None-tok-512"
    assert prepared_path("out", "name", "nl", "tok", 8) == "out/name--nl-tok-8"
