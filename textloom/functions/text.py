"""String expressions: stripping, markers, the lexer, prompt rendering and size labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What the lexer takes for parts of a word and for white space.
WORD = r"\p{L}\p{N}_"
SPACES = " \t\n\x0b\f\r"

# The prompt format of the chat samples.
TURN_OPEN = "[INST] "
TURN_CLOSE = " [/INST]"
ANSWER_MARKER = "[/INST]"
SYSTEM_OPEN = "<<SYS>>\n"
SYSTEM_CLOSE = "\n<</SYS>>\n\n"

# The size units, each 1024 times the one before.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def literal_pattern(marker: str) -> str:
    """A regular expression that matches ``marker`` itself, in Java and RE2 alike."""
    return re.escape(marker).replace("\\ ", " ").replace("\\\n", "\\n")


def lexer_pattern(*specials: str) -> str:
    """Spelled-out specials first, then words, then single other characters; no white space."""
    specials = "|".join(literal_pattern(s) for s in specials or ("<s>", "</s>"))
    return specials + rf"|[{WORD}]+|[^{WORD} \t\n\x0B\f\r]"


def lex(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def lex_count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def system_block(system_prompt: Column) -> Column:
    return F.concat(F.lit(SYSTEM_OPEN), system_prompt, F.lit(SYSTEM_CLOSE))


def render_prompt(
    dialog: Column, system_prompt: Column | str | None = None, bos: str = "<s>", eos: str = "</s>"
) -> Column:
    """One training prompt per dialog; every role but ``user`` is rendered as an answer."""
    opening = F.lit(bos + TURN_OPEN)
    if isinstance(system_prompt, str):
        system_prompt = F.lit(system_prompt) if system_prompt else None
    if system_prompt is not None:
        given = system_prompt.isNotNull() & (system_prompt != "")
        opening = F.concat(opening, F.when(given, system_block(system_prompt)).otherwise(""))

    def turn(message: Column, index: Column) -> Column:
        content = F.coalesce(message["content"], F.lit("None"))
        reopen = F.when(index > 0, bos + TURN_OPEN).otherwise("")
        return F.when(
            message["role"] == "user", F.concat(reopen, content, F.lit(TURN_CLOSE))
        ).otherwise(F.concat(F.lit(" "), content, F.lit(f" {eos}")))

    return F.concat(opening, F.array_join(F.transform(dialog, turn), ""))


def human_size(size: Column) -> Column:
    """``0B``, else the size in the largest fitting unit with at most two decimals.

    ``size`` is an integer or decimal column.  Hundredths are counted in exact decimal
    arithmetic and rounded half to even.
    """
    exact = size.cast("decimal(30,0)")
    powers = [F.lit(str(1024**k)).cast("decimal(25,0)") for k in range(len(SIZE_UNITS))]
    power = sum((F.when(exact >= p, 1).otherwise(0) for p in powers[1:]), F.lit(0))
    base = F.element_at(F.array(*powers), power + 1)
    scaled = exact * 100
    whole = F.call_function("div", scaled, base)
    twice = scaled % base * 2
    up = (twice > base) | ((twice == base) & (whole % 2 == 1))
    hundredths = whole + F.when(up, 1).otherwise(0)
    cents = F.lpad((hundredths % 100).cast("string"), 2, "0")
    number = F.concat(
        F.call_function("div", hundredths, F.lit(100)).cast("string"),
        F.lit("."),
        F.regexp_replace(cents, "(?<=.)0$", ""),
    )
    unit = F.element_at(F.array(*[F.lit(u) for u in SIZE_UNITS]), power + 1)
    return F.when(exact == 0, "0B").otherwise(F.concat(number, F.lit(" "), unit))


def path_tail(name: str) -> str:
    return name.split("/")[-1]
