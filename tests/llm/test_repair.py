"""Repairs against trying all edits, and the cases named in the docstring."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest

from textloom.llm import queries, repair

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """conv, turn, role, text after damage, conversations apart."""
    out = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        show = [" " if v is None else str(v) for v in (conv, turn)]
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(":".join(show).encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        out[conv] += [] if fate == 0 else [(turn, role, text)] * (2 if fate == 3 else 1)
    return out


def ordered(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest())
    return sorted(rows, key=key)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def follows(state, initial):
    """States by the roles so far: nothing, s, u, a."""
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, initial))


def cheapest(kinds):
    """Least cost and first audit of ``(initial, fault)`` turns, from the back, with whole texts compared."""

    @cache
    def best(at, state, inserted):
        found = []
        if at == len(kinds) and state in ("", "a"):
            found.append((0, ""))
        if inserted < 3:
            for initial in "ua":
                if (to := follows(state, initial)) and (rest := best(at, to, inserted + 1)):
                    found.append((rest[0] + 3, "I" + rest[1]))
        if at < len(kinds):
            initial, fault = kinds[at]
            options = [("D", 4, state)]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                options += [("K", more, follows(state, initial))]
                options += [("R", 3 + more, follows(state, r)) for r in "ua"]
            for edit, cost, to in options:
                if to is not None and (rest := best(at + 1, to, 0)):
                    found.append((rest[0] + cost, edit + rest[1]))
        return min(found, default=None)

    return best(0, "", 0)


def apply(rows, audit):
    state, out, rest = "", [], list(rows)
    for edit in audit:
        due = {"": "user", "s": "user", "a": "user", "u": "assistant"}[state]
        if edit == "I":
            out.append((due, ""))
        else:
            _, role, text = rest.pop(0)
            if edit == "D":
                continue
            out.append((due if edit == "R" else role, text))
        state = out[-1][0][0]
    assert not rest and GRAMMAR.match("".join(role[0] for role, _ in out))
    return out


def brute(rows):
    out = []
    for conv, own in damaged(rows).items():
        own = ordered(own)
        kinds = faults(own)
        initials = [r[1][:1] for r in own]
        numbers = [r[0] for r in own if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit = cheapest(tuple(zip(initials, kinds, strict=True)))
        lines = "\n".join(f"{role}:{text}" for role, text in apply(own, audit))
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest()))
    return sorted(out, key=repr)


def made_up(rng, conversations, turns):
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", "Long text. ", "tail.\x0b", None, "Yes.", "é…"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "User"]
    rows = []
    for conv in range(conversations):
        at = 0
        for _ in range(rng.randrange(1, turns)):
            at += rng.choice((1, 1, 1, 2, 0))
            rows.append((conv, at if rng.random() > 0.05 else None, rng.choice(roles), rng.choice(texts)))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS conv", "1 AS copy", "'y' AS audit", "2 AS pos")
    df = df.repartition(3)
    found = repair.report(repair.damage(df), df.drop("conv").withColumnRenamed("conv_id", "conv"))
    return sorted(map(tuple, found.collect()), key=repr)


def test_repairs_equal_trying_all_edits(spark):
    rows = made_up(random.Random(1), 400, 9)
    rows += [(None, k, r, t) for k, (r, t) in enumerate([("user", "Hi."), ("assistant", "Ho."), ("user", "Hi.")])]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("segment, block", [(1, 2), (3, 2), (7, 64)])
def test_long_conversations_in_segments(spark, monkeypatch, segment, block):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = made_up(random.Random(segment), 20, 40)
    # One conversation has a third of all rows.
    rows += [(99, k, ("user", "assistant", "user")[k % 3], f"Turn {k}" + "." * (k % 4 > 0)) for k in range(len(rows) // 2)]
    assert got(spark, rows) == brute(rows)


def test_repaired_turns_are_given_out(spark):
    rows = made_up(random.Random(3), 50, 8)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = {}
    for r in repair.repaired(repair.turns(df)).orderBy("conv", "place").collect():
        found.setdefault(r.conv, []).append((r.role, r.text))
    for conv in {r[0] for r in rows}:
        own = ordered([(t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv])
        kinds = tuple(zip([r[1][:1] for r in own], faults(own), strict=True))
        assert found.get(conv, []) == apply(own, cheapest(kinds)[1])


def test_empty_and_very_long(spark):
    assert got(spark, []) == []
    rows = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", None), (2, None, None, None), (2, None, None, None)]
    assert got(spark, rows) == brute(rows)


def test_grammar_gives_back_the_sequences():
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 9, rng.integers(0, 50)) for _ in range(60)] + [np.zeros(17, np.int64), np.array([1, 2] * 30)]
    packed, rules = repair.re_pair(sequences)
    assert len(packed) == len(sequences) and rules

    def expand(symbol):
        base = len(repair.TERMINALS)
        return [symbol] if symbol < base else [x for part in rules[symbol - base] for x in expand(part)]

    for given, short in zip(sequences, packed, strict=True):
        assert [x for s in short.tolist() for x in expand(s)] == given.tolist()
    assert sum(map(len, packed)) < sum(map(len, sequences))


def test_ropes_compare_like_text():
    rng = random.Random(6)
    ropes = [repair.Rope(t) for t in ("", "K", "KI", "D", "KIK", "KK")]
    for _ in range(300):
        ropes.append(rng.choice(ropes) + rng.choice(ropes))
    for a, b in itertools.islice(itertools.product(ropes[::7], ropes[::5]), 3000):
        assert a.before(b) == (str(a) < str(b))


def test_query_against_trying_all_edits(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.QUERIES["op12_conversation_repair"](spark, sf_dir)
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found.columns == columns
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)
