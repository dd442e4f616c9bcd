"""Repair of conversation structure: cheapest edits by dynamic programming on compressed sequences.

Every turn becomes one symbol, of its role and its first fault.  A repair keeps, reroles or deletes each
turn and inserts empty ones, so that the roles read: a system turn or none, then user and assistant in
turn.  Four states say how far this pattern is read, and a symbol is a 4 x 4 matrix of least costs, with
the edits that reach them; matrices multiply by minimum and sum.

*Grammar.*  The sequences of many conversations are compressed together by Re-Pair: the most frequent
pair of neighbours becomes a rule, again and again.  A rule has one matrix, the product of its two
parts', made once and shared by all conversations that use the rule.  Its edits are ropes that point at
the ropes of the parts, and are only written out for results.

*Ties* go to the edits that come first as text.  That is safe to decide rule by rule: for the same
turns, state and cost, none of two different edits begins with the other (what it has more would be
insertions, which cost).

*Long conversations* are cut into segments of ``SEGMENT`` turns; their matrices are multiplied in blocks
of ``BLOCK`` neighbours until one is left, so the dynamic program holds no conversation whole.  Only the
hash of a repaired conversation is one task's, as a hash is read from front to end: it streams over
sorted rows and holds one batch of them, and the edits.

Defined results: a null role or text counts as one space; null turns come first; rows of equal turns
follow each other by role and digest of their text; a null conversation is one like any other; a role is
known by its first character, and any but s, u and a must be reroled or deleted; conversations without
rows, and those of which nothing is left, give an empty repair; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.order import running_total
from textloom.sources.scratch import materialise

SEGMENT, BLOCK = 4096, 64
# Rules beyond this many would only save time.
MAX_RULES = 512
PIECE_SYMBOLS = 1 << 20

WHITE = " \t\n\x0b\x0c\r"
# Roles s, u, a and others: sound, truncated, blank and duplicate turns.
SYMBOLS = "suaoSUAO01234567"
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
MOVES = [{START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {}]
# Roles that may follow each other: su, ua and au.
LEGAL = np.zeros((4, 4), dtype=bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 3, 4, 3, 3


# ---- ropes and matrices --------------------------------------------------------------------------


class Rope:
    """Edits as text, or as two ropes one after the other."""

    __slots__ = ("left", "right", "text", "size")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if left is None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return other if not self.size else self
        return Rope(left=self, right=other)

    def leaves(self) -> Iterator[str]:
        todo = [self]
        while todo:
            rope = todo.pop()
            if rope.left is None:
                yield rope.text
            else:
                todo += (rope.right, rope.left)

    def __str__(self) -> str:
        return "".join(self.leaves())

    def before(self, other: Rope) -> bool:
        """Whether this text comes first; parts that both ropes share are passed over unread."""
        ours, theirs = [self], [other]
        while ours and theirs:
            a, b = ours.pop(), theirs.pop()
            if a is b:
                continue
            if a.left is not None and (b.left is None or a.size >= b.size):
                ours += (a.right, a.left)
                theirs.append(b)
            elif b.left is not None:
                theirs += (b.right, b.left)
                ours.append(a)
            else:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text < b.text
                if a.size > n:
                    ours.append(Rope(a.text[n:]))
                if b.size > n:
                    theirs.append(Rope(b.text[n:]))
        return bool(theirs)


Entry = tuple[int, Rope]
Row = dict[int, Entry]
Matrix = dict[int, Row]


def _put(row: Row, state: int, cost: int, edits: Rope) -> None:
    known = row.get(state)
    if known is None or cost < known[0] or (cost == known[0] and edits.before(known[1])):
        row[state] = (cost, edits)


def times_row(row: Row, matrix: Matrix) -> Row:
    out: Row = {}
    for middle, (cost, edits) in row.items():
        for state, (more, rest) in matrix.get(middle, {}).items():
            _put(out, state, cost + more, edits + rest)
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    return {state: times_row(row, b) for state, row in a.items()}


def _insertions() -> Matrix:
    """Any number of turns put in between: from each state, the fewest that lead to another."""
    out: Matrix = {}
    for start in range(STATES):
        row, state, cost = {start: (0, Rope())}, start, 0
        while True:
            state, cost = MOVES[1].get(state, MOVES[2].get(state)), cost + INSERT
            if state in row:
                break
            row[state] = (cost, Rope("I" * (cost // INSERT)))
        out[start] = row
    return out


def _turn(role: int, fault: int) -> Matrix:
    """What may be done with one turn."""
    out: Matrix = {}
    for state in range(STATES):
        row: Row = {}
        if fault < BLANK:
            extra = LEFT_TRUNCATED if fault == TRUNCATED else 0
            if state in MOVES[role]:
                _put(row, MOVES[role][state], extra, Rope("K"))
            for wanted in (1, 2):
                if state in MOVES[wanted]:
                    _put(row, MOVES[wanted][state], REROLE + extra, Rope("R"))
        _put(row, state, DELETE, Rope("D"))
        out[state] = row
    return out


BETWEEN = _insertions()
UNIT: Row = {START: (0, Rope())}
# All turns that have to go are one symbol of the grammar.
GONE = 8
TERMINALS = [times(BETWEEN, _turn(k % 4, k // 4)) for k in range(9)]
_SYMBOLS = np.frombuffer(SYMBOLS.encode(), np.uint8)
CODE = np.full(256, GONE, dtype=np.int64)
CODE[_SYMBOLS[:8]] = np.arange(8)
ROLE, FAULT = (np.zeros(256, dtype=np.int64) for _ in range(2))
ROLE[_SYMBOLS], FAULT[_SYMBOLS] = np.arange(16) % 4, np.arange(16) // 4


def ended(row: Row) -> Entry:
    """The cheapest whole repair."""
    found: Row = {}
    closed = times_row(row, BETWEEN)
    for state in (START, ASSISTANT):
        if state in closed:
            _put(found, 0, *closed[state])
    return found[0]


# ---- Re-Pair -------------------------------------------------------------------------------------


def re_pair(sequences: list[np.ndarray]) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """The sequences in symbols of a grammar, and its rules ``len(TERMINALS) + k -> (left, right)``."""
    rules: list[tuple[int, int]] = []
    # One array, with -1 after each sequence.
    data = np.concatenate([np.append(s, -1) for s in sequences]) if sequences else np.zeros(0, np.int64)
    while len(rules) < MAX_RULES:
        width = len(TERMINALS) + len(rules)
        left, right = data[:-1], data[1:]
        inside = np.flatnonzero((left >= 0) & (right >= 0))
        if not len(inside):
            break
        codes = left[inside] * width + right[inside]
        counts = np.bincount(codes, minlength=width * width)
        best = int(counts.argmax())
        if counts[best] < 2:
            break
        at = inside[codes == best]
        if best // width == best % width:
            # Of a run of the same symbol every second place begins a pair.
            begins = np.concatenate(([True], np.diff(at) > 1))
            first = np.maximum.accumulate(np.where(begins, at, 0))
            at = at[(at - first) % 2 == 0]
        data = data.copy()
        data[at] = width
        data = np.delete(data, at + 1)
        rules.append((best // width, best % width))
    ends = np.flatnonzero(data == -1)
    return [s[s >= 0] for s in np.split(data, ends + 1)[: len(ends)]], rules


class Solver:
    """Matrices of the rules of one grammar, bottom up."""

    def __init__(self, rules: list[tuple[int, int]]):
        self.matrices = list(TERMINALS)
        for left, right in rules:
            self.matrices.append(times(self.matrices[left], self.matrices[right]))

    def rows(self, symbols: np.ndarray, starts: list[int]) -> Matrix:
        out: Matrix = {state: {state: (0, Rope())} for state in starts}
        for symbol in symbols.tolist():
            out = times(out, self.matrices[symbol])
        return out


ENTRY = T.ArrayType(
    T.StructType(
        [T.StructField(c, T.IntegerType()) for c in ("state", "end")]
        + [T.StructField("cost", T.LongType()), T.StructField("edits", T.StringType())]
    )
)
ENTRIES = pa.list_(
    pa.struct([("state", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])
)
COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _entries(matrix: Matrix, last: bool) -> list[dict]:
    """A matrix as rows; of a conversation's last segment only whole repairs matter."""
    ends = {s: {0: ended(row)} if last else row for s, row in matrix.items()}
    return [
        {"state": s, "end": e, "cost": c, "edits": str(r)} for s, row in ends.items() for e, (c, r) in row.items()
    ]


def _matrix(entries: list[dict]) -> Matrix:
    out: Matrix = {}
    for e in entries:
        out.setdefault(e["state"], {})[e["end"]] = (e["cost"], Rope(e["edits"]))
    return out


# ---- turns, symbols and segments -----------------------------------------------------------------


def damage(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copy``: rows spoilt by a checksum of conversation and turn.

    Of 20 values, 0 drops the row, 1 empties its text, 2 takes its full stops, 3 repeats it, 4 makes it
    the user's.  Nulls count as one space, but stay as conversation and turn.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in (id, turn)])
    rows = df.select(
        F.col(id).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, space).alias("role"),
        F.coalesce(text, space).alias("text"),
        (F.crc32(key) % 20).alias("_fate"),
    ).where(F.col("_fate") != 0)
    fate = F.col("_fate")
    spoilt = F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv",
        "turn",
        F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        spoilt.alias("text"),
        F.explode(copies).alias("copy"),
    )


def turns(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copy`` of rows as they are."""
    space = F.lit(" ")
    return df.select(
        F.col(id).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, space).alias("role"),
        F.coalesce(text, space).alias("text"),
        F.lit(0).alias("copy"),
    )


ORDER = ["turn", "role", "digest", "copy"]


def _digest() -> Column:
    return F.unhex(F.md5("text")).alias("digest")


def _symbol() -> Column:
    """The symbol of a turn that is no duplicate."""
    bare = F.rtrim("text", F.lit(WHITE))
    fault = (
        F.when(bare == "", F.lit(BLANK))
        .when(F.substring(bare, -1, 1).isin(".", "!", "?"), F.lit(SOUND))
        .otherwise(F.lit(TRUNCATED))
    )
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.substring(F.lit(SYMBOLS), fault * 4 + place + 1, F.lit(1)).alias("symbol")


def keyed(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, digest, copy, symbol``: the turns without their texts."""
    return rows.select("conv", "turn", "role", _digest(), "copy", _symbol())


def symbols(keys: DataFrame) -> DataFrame:
    """``conv, pos, n, symbol``: every turn in its place, with its first fault."""
    placed = running_total(keys, [*ORDER, "symbol"], F.lit(1), ["conv"], name="pos", whole="n")
    placed = materialise(placed.select("conv", "role", "digest", "symbol", "pos", "n"), "turns")
    first = placed.groupBy("conv", "role", "digest").agg(F.min("pos").alias("first"))
    first = first.toDF("_conv", "_role", "_digest", "first")
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (
        F.col("digest") == F.col("_digest")
    )
    again = F.translate("symbol", "suaoSUAO", "45674567")
    seen = (F.col("pos") > F.col("first")) & ~F.col("symbol").isin(*SYMBOLS[8:12])
    return placed.join(first, same).select(
        "conv", "pos", "n", F.when(seen, again).otherwise(F.col("symbol")).alias("symbol")
    )


def segments(marked: DataFrame) -> DataFrame:
    """``conv, seg, n, symbols``: runs of turns; all but a conversation's first begin with the turn before."""
    seg = F.call_function("div", "pos", F.lit(SEGMENT))
    last = ((F.col("pos") + 1) % SEGMENT == 0) & (F.col("pos") + 1 < F.col("n"))
    into = F.when(last, F.array(seg, seg + 1)).otherwise(F.array(seg))
    rows = marked.select("conv", "pos", "n", "symbol", F.explode(into).alias("seg"))
    rows = rows.groupBy("conv", "seg", "n").agg(F.array_sort(F.collect_list(F.struct("pos", "symbol"))).alias("row"))
    text = F.array_join(F.transform("row", lambda r: r["symbol"]), "")
    return rows.select("conv", "seg", F.ceil(F.col("n") / SEGMENT).alias("n"), text.alias("symbols"))


def solve_segments(rows: DataFrame) -> DataFrame:
    """``conv, seg, n, entries`` and counts of faults of every segment."""

    def counted(text: np.ndarray, lead: int) -> list[int]:
        faults = np.bincount(FAULT[text[lead:]], minlength=4)
        illegal = ~LEGAL[ROLE[text[:-1]], ROLE[text[1:]]]
        return [int(x) for x in (faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal.sum())]

    def solved(batch: pa.RecordBatch) -> pa.RecordBatch:
        seg, n = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        texts = [np.frombuffer(t.encode(), np.uint8) for t in batch.column(3).to_pylist()]
        leads = [int(s > 0) for s in seg]
        # Equal sequences are one; only what they mean for the edits counts.
        numbers: dict[bytes, int] = {}
        own = [numbers.setdefault(CODE[t[k:]].tobytes(), len(numbers)) for t, k in zip(texts, leads, strict=True)]
        packed, rules = re_pair([np.frombuffer(b, np.int64) for b in numbers])
        solver, known, entries = Solver(rules), {}, []
        for number, s, total in zip(own, seg, n, strict=True):
            key = (number, s == 0, s == total - 1)
            if key not in known:
                starts = [START] if s == 0 else list(range(STATES))
                known[key] = _entries(solver.rows(packed[number], starts), s == total - 1)
            entries.append(known[key])
        counts = zip(*(counted(t, k) for t, k in zip(texts, leads, strict=True)), strict=True)
        columns = [*batch.columns[:3], pa.array(entries, ENTRIES), *(pa.array(c, pa.int64()) for c in counts)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum([len(t) for t in batch.column(3).to_pylist()])
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, before + PIECE_SYMBOLS, side="right")))
                yield solved(batch.slice(at, stop - at))
                at = stop

    schema = T.StructType(
        [rows.schema[c] for c in ("conv", "seg", "n")]
        + [T.StructField("entries", ENTRY)]
        + [T.StructField(c, T.LongType()) for c in COUNTS]
    )
    return rows.mapInArrow(run, schema)


def join_segments(solved: DataFrame) -> DataFrame:
    """``conv, cost, audit`` and counts of every conversation that has turns."""

    def product(block: pa.Table) -> pa.Table:
        block = block.sort_by("seg")
        matrices = [_matrix(e) for e in block["entries"].to_pylist()]
        out = matrices[0]
        for more in matrices[1:]:
            out = times(out, more)
        entries = _entries(out, last=False)
        first = block.slice(0, 1)
        return pa.table(
            {
                "conv": first["conv"],
                "seg": first["block"],
                "n": pa.array([-(-first["n"][0].as_py() // BLOCK)], pa.int64()),
                "entries": pa.array([entries], ENTRIES),
                **{c: pa.array([sum(block[c].to_pylist())], pa.int64()) for c in COUNTS},
            }
        )

    done = []
    while not solved.where(F.col("n") > 1).isEmpty():
        done.append(solved.where(F.col("n") == 1))
        block = F.call_function("div", "seg", F.lit(BLOCK)).alias("block")
        several = solved.where(F.col("n") > 1).select(*solved.columns, block)
        solved = materialise(several.groupBy("conv", "block").applyInArrow(product, solved.schema), "segments")
    for more in done:
        solved = solved.unionByName(more)
    whole = F.col("entries")[0]
    return solved.select("conv", *COUNTS, whole["cost"].alias("cost"), whole["edits"].alias("audit"))


# ---- results -------------------------------------------------------------------------------------


def diagnose(rows: DataFrame, everyone: DataFrame) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation.

    ``rows`` has ``conv, turn, role, text, copy``; ``everyone`` has ``conv``, also those without rows.
    """
    keys = materialise(keyed(rows), "turns")
    solved = materialise(solve_segments(segments(symbols(keys))), "segments")
    found = join_segments(solved).withColumnRenamed("conv", "_conv")
    # Turns are counted once; a conversation of null turns alone has no gaps.
    spread = keys.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")
    )
    spread = spread.withColumnRenamed("conv", "_of")
    names = ["gaps", *COUNTS, "cost"]
    out = everyone.select("conv").distinct()
    out = out.join(found, F.col("conv").eqNullSafe(F.col("_conv")), "left")
    out = out.join(spread, F.col("conv").eqNullSafe(F.col("_of")), "left")
    return out.select(
        "conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names], F.coalesce("audit", F.lit("")).alias("audit")
    )


def _edited(rows: DataFrame, found: DataFrame, make, new: dict[str, tuple[T.DataType, pa.DataType]]) -> DataFrame:
    """What ``make(row of found)`` says of every conversation, its turns streamed in their order.

    ``new`` are the types of result columns that ``found`` lacks.
    """
    names = found.columns
    nothing = {"turn": "long", "role": "string", "digest": "binary", "copy": "int", "text": "string"}
    head = found.select(F.lit(0).alias("row"), "*", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    blank = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in names[1:]]
    body = rows.select(F.lit(1).alias("row"), "conv", *blank, "turn", "role", _digest(), "copy", "text")
    stream = head.unionByName(body).repartition("conv").sortWithinPartitions("conv", "row", *ORDER)
    kept = make.columns or names
    schema = T.StructType([T.StructField(c, new[c][0]) if c in new else found.schema[c] for c in [*kept, *new]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, arrow = None, None
        for batch in batches:
            arrow = pa.schema([(c, new[c][1] if c in new else batch.schema.field(c).type) for c in schema.names])
            out = []
            for row in batch.to_pylist():
                if row["row"]:
                    editor.turn(row["role"], row["text"])
                    continue
                if editor is not None:
                    out += editor.end()
                editor = make({c: row[c] for c in names})
            if editor is not None:
                out += editor.ready()
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if editor is not None:
            yield pa.RecordBatch.from_pylist(editor.end(), schema=arrow)

    return stream.select("row", *names, "role", "text").mapInArrow(run, schema)


class Editor:
    """Follows the edits over the turns of one conversation, and hands on what is left of them."""

    def __init__(self, found: dict):
        self.found, self.state, self.at = found, START, 0

    def put(self, role: str, text: str) -> None:
        raise NotImplementedError

    def _add(self, text: str) -> None:
        """A turn of the role that is due."""
        due = 2 if self.state == USER else 1
        self.state = MOVES[due][self.state]
        self.put("assistant" if due == 2 else "user", text)

    def _insert(self) -> None:
        edits = self.found["audit"]
        while self.at < len(edits) and edits[self.at] == "I":
            self._add("")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self._insert()
        edit = self.found["audit"][self.at]
        self.at += 1
        if edit == "K":
            self.state = MOVES["sua".index(role[0])][self.state]
            self.put(role, text)
        elif edit == "R":
            self._add(text)

    def end(self) -> list[dict]:
        self._insert()
        return self.ready(over=True)

    def ready(self, over: bool = False) -> list[dict]:
        """Result rows that are known by now."""
        raise NotImplementedError


class Hashing(Editor):
    """One row a conversation, with the hash of its repaired turns."""

    columns: list[str] = []

    def __init__(self, found: dict):
        super().__init__(found)
        self.digest, self.first = sha256(), True

    def put(self, role: str, text: str) -> None:
        self.digest.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first = False

    def ready(self, over: bool = False) -> list[dict]:
        return [{**self.found, "repaired_sha256": self.digest.hexdigest()}] if over else []


class Writing(Editor):
    """The repaired turns, given out batch by batch."""

    columns = ["conv"]

    def __init__(self, found: dict):
        super().__init__(found)
        self.rows, self.place = [], 0

    def put(self, role: str, text: str) -> None:
        self.rows.append({"conv": self.found["conv"], "place": self.place, "role": role, "text": text})
        self.place += 1

    def ready(self, over: bool = False) -> list[dict]:
        rows, self.rows = self.rows, []
        return rows


TEXT = (T.StringType(), pa.string())


def report(rows: DataFrame, everyone: DataFrame) -> DataFrame:
    """``diagnose`` and ``repaired_sha256``, the hash of the repaired ``role:text`` lines."""
    found = materialise(diagnose(rows, everyone), "diagnosis")
    return _edited(rows, found, Hashing, {"repaired_sha256": TEXT})


def repaired(rows: DataFrame) -> DataFrame:
    """``conv, place, role, text``: the turns of every conversation after its repair."""
    found = materialise(diagnose(rows, rows), "diagnosis").select("conv", "audit")
    return _edited(rows, found, Writing, {"place": (T.LongType(), pa.int64()), "role": TEXT, "text": TEXT})
