"""Personal data by patterns and a semi-Markov conditional random field.

Patterns find the base spans: e-mail and IP addresses, payment cards and phone numbers.  On top of
them a semi-Markov model scores whole candidate spans, up to ``MAX_CHUNKS`` pieces between blanks,
by features of the span as a whole (digits and their groups, checksum, shape, the words before it), and
dynamic programming chooses boundaries and kinds of a line's spans together.  It finds forms that the
patterns cannot reach: local phone numbers, addresses written apart or without a dot, ``[at]`` and
``[dot]``, IPv6, cards grouped by other signs.  What it finds is added, unless it overlaps a base span.

A candidate holds a digit, an ``@`` or an ``[at]``, so the dynamic programme runs over the stretches of
pieces within ``MAX_CHUNKS`` of those; elsewhere there is nothing to choose, and the result is that of
the whole line.  The model is trained here, on at most ``SAMPLE`` different lines of documents chosen by
a hash, whose base spans are their labels, and on ``GENERATED`` labelled lines of the forms above and of
dates, prices, versions and other numbers that are no personal data.

Defined results: a null text counts as empty and has no spans; texts of any length are read whole;
offsets are code points, ends exclusive; rows are judged one by one, repeated or not; masking replaces
each span by ``<kind>``; only ``keep`` and the text are read, and other columns may have any names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
MAX_CHUNKS = 5
SAMPLE, GENERATED = 1500, 2000
# Characters of a line of the sample, around its first sign.
LINE_CHARS = 400
STEPS, RATE, RIDGE = 300, 0.5, 1e-5
# Training examples whose sums are taken together.
BUCKET = 512
# An added span must beat having none by this much.
MARGIN = 2.0

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive, and not from inside a run of digits: the same matches in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SIGNS = r"[0-9@]|[\[(][Aa][Tt][\])]"
SIGNAL = re.compile(SIGNS)
CHUNK = re.compile(r"\S+")
EDGES = "\"'.,;:!?()[]{}<>|*#$%&"
DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each ``@`` takes the whole run of name characters before it."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            free = match.end()
            yield start, free
        else:
            # Nothing before this sign can belong to a later match.
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and kind."""
    found = [(s, 0, e) for s, e in emails(text)]
    if SIGNAL.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = "".join(DIGITS.findall(m[0]))
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGITS.findall(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


# ---- whole-span features and the semi-Markov model -------------------------------------------

# Words that announce a kind.
CUES = (
    frozenset("email e-mail mail mailto contact".split()),
    frozenset("ip address host server".split()),
    frozenset("card visa mastercard amex credit debit".split()),
    frozenset("phone tel telephone call fax mobile".split()),
)
CUE_OF = {word: kind + 1 for kind, words in enumerate(CUES) for word in words}
# What is known of a piece; a candidate's features are sums, extremes and ends of these.
FACTS = (
    "digits letters odd ats at_mark dot_mark dots colons slashes groups longest shortest first_group "
    "last_group v6 boxed breaks opens closes cue plus joined word zero at_first at_last signal"
).split()
AT_MARKS, DOT_MARKS = ("@", "[at]", "(at)"), ("[dot]", "(dot)")
GROUP = re.compile(r"[0-9]+")
HEX = re.compile(r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}")
BOXED = re.compile(r"[0-9]+(?:\[\.\][0-9]+){3}")
JOINED = re.compile(r"[\w.+-]+(?:@|[\[(]at[\])])[\w-]+(?:\.[\w-]+)*", re.IGNORECASE)


def facts(piece: str) -> tuple[int, ...]:
    core = piece.strip(EDGES)
    low = piece.strip(",;:.!?").lower()
    at_mark, dot_mark = low in AT_MARKS, low in DOT_MARKS
    groups = [len(g) for g in GROUP.findall(core)]
    digits = sum(groups)
    letters = 0 if at_mark or dot_mark else sum(c.isalpha() for c in core)
    joined = JOINED.fullmatch(core) is not None
    known = digits + letters + sum(core.count(c) for c in "-.()+/_@:[]")
    ats = piece.count("@") + low.count("[at]") + low.count("(at)")
    v6 = HEX.fullmatch(core) is not None and (core.count("::") == 1 or core.count(":") == 7)
    return (
        digits, letters, 0 if at_mark or dot_mark else len(core) - known, ats, at_mark, dot_mark,
        core.count("."), core.count(":"), core.count("/"), len(groups),
        max(groups, default=0), min(groups, default=99), groups[0] if groups else 0, groups[-1] if groups else 0,
        v6 and digits > 0, BOXED.fullmatch(core) is not None,
        piece[-1] in ",;:.!?" and not at_mark, piece.count("("), piece.count(")"),
        CUE_OF.get(core.lower(), 0), core.startswith("+"), joined,
        letters > 0 and not digits and not ats, core.startswith("0"),
        not at_mark and core.startswith("@"), not at_mark and core.endswith("@"), SIGNAL.search(piece) is not None,
    )


def features_of(known: np.ndarray, count: int, digits: Sequence[str]) -> np.ndarray:
    """Features of every run of ``count`` pieces; the first is constant."""
    runs = len(known) - count + 1
    at = {name: k for k, name in enumerate(FACTS)}
    sums = np.zeros((len(known) + 1, known.shape[1]), dtype=np.int64)
    np.cumsum(known, axis=0, out=sums[1:])
    total = sums[count:] - sums[:-count]

    def of(name: str, place: int) -> np.ndarray:
        return known[place : place + runs, at[name]]

    def whole(name: str) -> np.ndarray:
        return total[:, at[name]]

    def last(name: str) -> np.ndarray:
        return of(name, count - 1)

    n, groups, ats, dots = whole("digits"), whole("groups"), whole("ats"), whole("dots")
    longest = np.max([of("longest", k) for k in range(count)], axis=0)
    shortest = np.min([of("shortest", k) for k in range(count)], axis=0)
    plain = (whole("letters") + whole("odd") + ats + whole("colons") + whole("dot_mark") == 0) & (n > 0)
    card = plain & (12 <= n) & (n <= 19)
    checked = np.zeros(runs, dtype=bool)
    for k in np.flatnonzero(card):
        checked[k] = luhn("".join(digits[k : k + count]))
    none = np.zeros(runs, dtype=bool)
    one = ats == 1
    single = one & (of("joined", 0) > 0) if count == 1 else none
    apart = one & (of("at_mark", 1) > 0) & (of("letters", 0) > 0) if count == 3 else none
    spelled = one & (of("at_mark", 1) > 0) & (of("dot_mark", 3) > 0) if count == 5 else none
    half = one & ((of("at_last", 0) > 0) | (of("at_first", 1) > 0)) & (whole("letters") > 0) if count == 2 else none
    shaped = single | apart | spelled | half
    hosted = (last("letters") > 0) & ((last("dots") > 0) | spelled)
    inner_break = whole("breaks") > last("breaks")
    word = whole("word") > 0
    cue = known[:, at["cue"]]
    before = np.concatenate(([0], cue[: runs - 1]))
    earlier = np.concatenate(([0, 0], cue[: max(0, runs - 2)]))[:runs]
    nanp = plain & (groups == 3) & (n == 10) & (last("last_group") == 4) & (shortest == 3) & (longest == 4)
    trunk = plain & (of("zero", 0) > 0) & (9 <= n) & (n <= 15)
    boxed = whole("boxed") > 0
    # A number that goes on beyond the candidate.
    numeric = (known[:, at["digits"]] > 0) & (known[:, at["letters"]] + known[:, at["odd"]] == 0)
    closed = known[:, at["breaks"]] > 0
    goes_on = np.concatenate((numeric[count:], [False])) & ~closed[count - 1 :]
    went_on = np.concatenate(([False], (numeric & ~closed)[: runs - 1]))
    fours = card & checked & (groups == 4) & (shortest == 4) & (longest == 4)
    columns = [
        np.ones(runs), single, single & hosted, apart & hosted, apart & ~hosted, spelled, half & hosted,
        half & ~hosted, one & ~shaped, ats > 1, one & (last("letters") == 0),
        (whole("v6") > 0) & (count == 1), (whole("v6") > 0) & (count > 1), boxed & (count == 1), boxed & (count > 1),
        plain, card, card & checked, card & checked & (groups >= 3) & (longest <= 6), card & ~checked,
        plain & (n < 7), plain & (7 <= n) & (n < 9), plain & (9 <= n) & (n <= 11), n > 19,
        of("plus", 0) > 0, plain & (of("plus", 0) > 0) & (9 <= n) & (n <= 15),
        nanp, nanp & (whole("opens") > 0), (whole("opens") != whole("closes")), trunk & (groups > 1) & (longest >= 3),
        trunk & (groups == 1), plain & (groups == 3) & (n <= 8), plain & (whole("slashes") > 0),
        (groups == 4) & (dots >= 3) & (longest <= 3), plain & (groups == 1), plain & (count > 1) & (groups > 5),
        np.full(runs, count > 1), plain & (count > 1), word & (ats == 0), word & (n > 0) & one, inner_break,
        of("cue", 0) > 0, (of("at_mark", 0) + last("at_mark") + of("dot_mark", 0) + last("dot_mark")) > 0,
        (of("signal", 0) + last("signal") == 0) & (ats == 0), whole("colons") > 0, whole("letters") > 0,
        goes_on & plain, went_on & plain, fours,
        (shortest < 2) & plain, plain & (shortest < 3) & (of("zero", 0) == 0),
        *((before == k + 1) | (earlier == k + 1) for k in range(len(CUES))),
    ]
    return np.stack(columns, axis=1).astype(float)


FEATURES = 55


@dataclass
class Stretch:
    """Neighbouring pieces of a line, and the features of every candidate among them."""

    chunks: list[tuple[int, int]]
    spans: list[tuple[int, int]]  # first piece, pieces
    features: np.ndarray


def bounds(text: str, chunks: list[tuple[int, int]], first: int, count: int) -> tuple[int, int]:
    """Where a candidate begins and ends in the text, without the punctuation around it."""
    start, end = chunks[first][0], chunks[first + count - 1][1]
    while end > start and text[end - 1] in EDGES:
        end -= 1
    while start < end and text[start] in EDGES and not (text[start] == "(" and ")" in text[start:end]):
        start += 1
    return start, end


def signal_lines(text: str) -> Iterator[tuple[int, int]]:
    """Lines that have a digit, an ``@`` or an ``[at]``."""
    mark = SIGNAL.search(text)
    while mark:
        start = text.rfind("\n", 0, mark.start()) + 1
        end = text.find("\n", mark.start())
        end = len(text) if end < 0 else end
        yield start, end
        mark = SIGNAL.search(text, end)


def stretches(text: str) -> Iterator[Stretch]:
    """The stretches of all lines: pieces that can share a candidate, and two words before them."""
    for start, end in signal_lines(text):
        chunks = [m.span() for m in CHUNK.finditer(text, start, end)]
        begins = [c[0] for c in chunks]
        low = high = 0
        for mark in SIGNAL.finditer(text, start, end):
            piece = bisect_right(begins, mark.start()) - 1
            if piece < high - MAX_CHUNKS + 1:
                continue  # a sign of the piece that was the last one
            if high and piece - MAX_CHUNKS - 1 > high:
                yield _stretch(text, chunks[low:high])
                low = high
            if not high or low == high:
                low = max(low, piece - MAX_CHUNKS - 1)
            high = min(len(chunks), piece + MAX_CHUNKS)
        if high > low:
            yield _stretch(text, chunks[low:high])


def _stretch(text: str, chunks: list[tuple[int, int]]) -> Stretch:
    written_as = [text[s:e] for s, e in chunks]
    known = np.array([facts(p) for p in written_as], dtype=np.int64).reshape(len(chunks), len(FACTS))
    digits = ["".join(DIGITS.findall(p)) if f[0] <= 19 else "" for p, f in zip(written_as, known, strict=True)]
    signs = np.concatenate(([0], np.cumsum(known[:, FACTS.index("signal")])))
    # A candidate has something left between the punctuation around it.
    solid = np.concatenate(([0], np.cumsum(known[:, :3].sum(axis=1) + known[:, 3] + known[:, 6] > 0)))
    spans, features = [], []
    for count in range(1, min(MAX_CHUNKS, len(chunks)) + 1):
        some = (signs[count:] > signs[:-count]) & (solid[count:] > solid[:-count])
        first = np.flatnonzero(some)
        spans += [(k, count) for k in first.tolist()]
        features.append(features_of(known, count, digits)[first])
    return Stretch(chunks, spans, np.concatenate(features))


@dataclass
class SpanModel:
    """Weights per kind; having no entity over a piece scores 0."""

    weights: np.ndarray

    def decode(self, stretch: Stretch) -> list[tuple[int, int, int]]:
        """``(first piece, pieces, kind)`` of the best segmentation.

        Having none scores 0, so only candidates that score above it can be part of it.
        """
        scores = stretch.features @ self.weights.T - MARGIN
        kinds, top = scores.argmax(axis=1), scores.max(axis=1)
        ending: dict[int, list[int]] = {}
        for k in np.flatnonzero(top > 0).tolist():
            ending.setdefault(sum(stretch.spans[k]), []).append(k)
        if not ending:
            return []
        n = len(stretch.chunks)
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        for end in range(1, n + 1):
            best[end] = best[end - 1]
            for k in ending.get(end, ()):
                first = stretch.spans[k][0]
                if best[first] + top[k] > best[end]:
                    best[end], back[end] = best[first] + top[k], (first, end - first, int(kinds[k]))
        out, end = [], n
        while end > 0:
            if back[end]:
                out.append(back[end])
                end = back[end][0]
            else:
                end -= 1
        return out[::-1]

    def spans(self, text: str) -> list[Span]:
        """Spans found by the model alone."""
        found = []
        for stretch in stretches(text):
            for first, count, kind in self.decode(stretch):
                start, end = bounds(text, stretch.chunks, first, count)
                if end > start:
                    found.append((start, kind, end))
        return found


def apart_from(spans: Sequence[Span], base: Sequence[Span]) -> list[Span]:
    """The spans that overlap none of ``base``, in linear time but for sorting."""
    begins, reach, far = [], [], 0
    for start, _, end in sorted(base):
        far = max(far, end)
        begins.append(start)
        reach.append(far)
    out = []
    for span in spans:
        before = bisect_left(begins, span[2])
        if not before or reach[before - 1] <= span[0]:
            out.append(span)
    return out


def all_spans(text: str, model: SpanModel) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those the model adds."""
    base = base_spans(text)
    if not SIGNAL.search(text):
        return base, base
    return base, sorted(base + apart_from(model.spans(text), base))


# ---- labelled lines --------------------------------------------------------------------------


def _checked(rng: np.random.Generator, size: int) -> str:
    body = "".join(map(str, rng.integers(0, 10, size - 1)))
    return next(body + d for d in "0123456789" if luhn(body + d))


def labelled_lines(count: int, seed: int) -> list[tuple[str, list[Span]]]:
    """Lines of invented words with one entity that the patterns miss, or with other numbers."""
    rng = np.random.default_rng(seed)

    def some(*options):
        return options[int(rng.integers(len(options)))]

    def number(size: int, low: int = 0) -> str:
        return str(int(rng.integers(max(low, 1), 10))) + "".join(map(str, rng.integers(0, 10, size - 1)))

    def word(least: int = 2, most: int = 9) -> str:
        return "".join(rng.choice(list("aeioustrnlmdphk"), int(rng.integers(least, most + 1))))

    def email() -> str:
        name = word(3) + some("", f".{word(3)}", f"_{word()}", number(2))
        host, end = word(3), some("com", "org", "net", "de", "co.uk")
        at, dot = some("[at]", "(at)", "[AT]"), some("[dot]", "(dot)")
        return some(
            f"{name} @ {host}.{end}", f"{name}@{host}", f"{name} {at} {host}.{end}", f"{name}{at}{host}.{end}",
            f"{name} {at} {host} {dot} {end.split('.')[0]}", f"{name}@ {host}.{end}", f"{name} @{host}.{end}",
        )

    def ip() -> str:
        parts = [f"{int(v):x}" for v in rng.integers(0, 65536, 8)]
        cut = int(rng.integers(1, 5))
        return some(
            ":".join(parts), ":".join(parts[:cut]) + "::" + ":".join(parts[cut + 2 : 7]),
            "[.]".join(map(str, rng.integers(0, 256, 4))),
        )

    def card() -> str:
        digits = some("4", "5", "3") + ""
        while not luhn(digits) or len(digits) != 16:
            digits = _checked(rng, 16)
        return some(".", "_", "/", "  ", ".", " -").join(digits[k : k + 4] for k in range(0, 16, 4))

    def phone() -> str:
        a, b, c = number(3, 2), number(3), number(4)
        return some(
            f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}", f"0{a}-{b}{c}", f"0{a} {b} {c}",
            f"0{number(2)} {c} {number(4)}", f"00{number(2)} {number(2)} {c} {number(4)}", f"({a}) {b} {c}",
        )

    def other() -> str:
        year, day, month = some("19", "20") + number(2), int(rng.integers(1, 29)), int(rng.integers(1, 13))
        return some(
            f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{month}/{day}/{year}",
            f"{day} {word()} {year}", f"{number(2)}:{number(2)}", f"{month}:{number(2)}:{number(2)}",
            f"{number(1)}.{number(2)}", f"${number(1)},{number(3)}.00", f"v{month}.{day}.{number(1)}",
            f"{year}-{int(year) + 5}", f"{number(2)} {number(2)} {number(2)}", number(int(rng.integers(1, 12))),
            f"{number(1)} @ {number(1)}", f"@{word()}", f"{word()} @ {number(2)}", f"{number(2)}%",
            f"{number(3)}-{number(3)}", f"{number(2)}-{number(2)}-{number(2)}", f"{word(1, 2)}{number(2)}-{number(4)}",
            f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}", f"{number(3)} {number(3)}", f"{number(5)}-{number(4)}",
            f"{number(3)}, {number(3)}, {number(4)}", f"{word()}@", f"{number(4)} {number(4)}", f"{number(1)} {word()} {number(3)}",
        )

    makers, lines = (email, ip, card, phone), []
    for _ in range(count):
        kind = int(rng.integers(-3, len(KINDS)))
        entity = makers[kind]() if kind >= 0 else other()
        left = [word(1) for _ in range(int(rng.integers(0, 9)))]
        if rng.random() < 0.4:
            cue = list(CUES[kind if kind >= 0 else int(rng.integers(4))])
            left += [sorted(cue)[int(rng.integers(len(cue)))] + some("", ":", ":")]
        if kind < 0 and rng.random() < 0.5:
            left += [other(), word()]
        text = "".join(w + " " for w in left)
        span = [(len(text), kind, len(text) + len(entity))] if kind >= 0 else []
        text += entity + some("", "", ".", ",", " ") + "".join(" " + word(1) for _ in range(int(rng.integers(0, 9))))
        base = base_spans(text)
        lines.append((text, sorted(base + apart_from(span, base))))
    return lines


def train(texts: Sequence[str], generated: int = GENERATED, seed: int = 17) -> SpanModel:
    """Maximum likelihood of the base spans of ``texts``, and of the spans of generated lines."""
    lines = [(text, base_spans(text)) for text in texts] + labelled_lines(generated, seed)
    examples: list[Stretch] = []
    gold: list[tuple[int, int]] = []
    rows = 0
    for text, spans in lines:
        known = {(s, e): k for s, k, e in spans}
        for stretch in stretches(text):
            if not len(stretch.spans):
                continue
            for k, (first, count) in enumerate(stretch.spans):
                kind = known.get(bounds(text, stretch.chunks, first, count)) if known else None
                if kind is not None:
                    known.pop(bounds(text, stretch.chunks, first, count))
                    gold.append((rows + k, kind))
            rows += len(stretch.spans)
            examples.append(stretch)
    weights = np.zeros((len(KINDS), FEATURES))
    weights[:, 0] = -4.0
    if not examples:
        return SpanModel(weights)
    features = np.concatenate([e.features for e in examples])
    right = np.zeros((rows, len(KINDS)))
    for k, kind in gold:
        right[k, kind] = 1
    sums = Sums([np.array(e.spans) for e in examples], [len(e.chunks) for e in examples])
    seen = np.full_like(weights, 1e-6)
    for _ in range(STEPS):
        expected = sums.marginals(features @ weights.T)
        slope = RIDGE * weights + (expected - right).T @ features / len(examples)
        seen += slope**2
        weights = weights - RATE * slope / np.sqrt(seen)
    return SpanModel(weights)


def log_sum(scores: np.ndarray) -> np.ndarray:
    """Logarithms of the sums of the exponentials of each row; a row has a finite value."""
    most = scores.max(axis=1)
    return most + np.log(np.exp(scores - most[:, None]).sum(axis=1))


class Sums:
    """The forward and backward sums of many stretches, side by side in buckets of like length."""

    def __init__(self, spans: Sequence[np.ndarray], sizes: Sequence[int]):
        starts = np.concatenate(([0], np.cumsum([len(s) for s in spans])))
        order = np.argsort(-np.asarray(sizes), kind="stable")
        self.buckets = []
        for at in range(0, len(order), BUCKET):
            part = order[at : at + BUCKET]
            rows = np.concatenate([np.arange(starts[e], starts[e + 1]) for e in part])
            line = np.repeat(np.arange(len(part)), [len(spans[e]) for e in part])
            first, count = np.concatenate([spans[e] for e in part]).T
            self.buckets.append((np.array([sizes[e] for e in part]), rows, line, first, count))

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        """Probability of every candidate and kind."""
        out = np.empty_like(scores)
        total = log_sum(scores)
        for sizes, rows, line, first, count in self.buckets:
            most = int(sizes[0])
            table = np.full((len(sizes), most + MAX_CHUNKS, MAX_CHUNKS), -np.inf)
            table[line, first, count - 1] = total[rows]
            ahead = np.full((len(sizes), most + 1), -np.inf)
            behind = np.full((len(sizes), most + MAX_CHUNKS + 1), -np.inf)
            ahead[:, 0] = 0
            behind[np.arange(len(sizes)), sizes] = 0
            for end in range(1, most + 1):
                n = int(np.searchsorted(-sizes, -end, side="right"))
                ways = [ahead[:n, end - 1]]
                ways += [ahead[:n, end - c] + table[:n, end - c, c - 1] for c in range(1, min(MAX_CHUNKS, end) + 1)]
                ahead[:n, end] = log_sum(np.stack(ways, axis=1))
            for start in range(most - 1, -1, -1):
                n = int(np.searchsorted(-sizes, -start, side="left"))
                ways = [behind[:n, start + 1]]
                ways += [table[:n, start, c - 1] + behind[:n, start + c] for c in range(1, MAX_CHUNKS + 1)]
                behind[:n, start] = log_sum(np.stack(ways, axis=1))
            all_of = ahead[np.arange(len(sizes)), sizes]
            around = ahead[line, first] + behind[line, first + count] - all_of[line]
            out[rows] = np.exp(scores[rows] + around[:, None])
        return out


def fit(df: DataFrame, text: str = "text") -> SpanModel:
    """Train on at most ``SAMPLE`` different lines that have a sign, chosen by their hash, and on generated ones.

    Lines reach the driver cut to ``LINE_CHARS`` characters around their first sign; the bound holds for
    the training sample only.
    """
    line = F.explode(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda s: s.rlike(SIGNS)))
    lines = df.select(line.alias("line"))
    place = F.greatest(F.lit(1), F.regexp_instr("line", F.lit(SIGNS)) - LINE_CHARS // 4)
    cut = F.substring(F.col("line"), place, F.lit(LINE_CHARS))
    rows = lines.select(cut.alias("line")).select("line", F.xxhash64("line").alias("h"))
    # Hashes are spread evenly: only some times the sample's size goes to the sort, of any input.
    different = rows.agg(F.approx_count_distinct("h")).first()[0]
    share = min(1.0, 4 * SAMPLE / max(1, different))
    rows = rows.where(F.col("h") <= int(-(2**63) + share * (2**64 - 2048)))
    # Copies are merged before the shuffle.
    rows = rows.groupBy("h", "line").agg(F.count(F.lit(1)).alias("n")).orderBy("h", "line").limit(SAMPLE)
    sample = [r["line"] for r in rows.select("line").collect()]
    if different and not sample:
        raise ValueError("no line of the sample was found")
    return train(sample)


# ---- operators -------------------------------------------------------------------------------


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with its spans replaced; overlapping spans become one, named after the first."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find(
    df: DataFrame, model: SpanModel, text: str = "text", keep: Sequence[str] = ("doc_id",), mask: str | None = None
) -> DataFrame:
    """``keep, n_email, n_ip, n_card, n_phone, base_sha256, spans`` and, if named, the masked text.

    The counts and the digest are of the base spans, ``spans`` lists all of them.
    """
    more = [(f"n_{k}", T.LongType()) for k in KINDS]
    more += [("base_sha256", T.StringType()), ("spans", T.StringType())]
    if mask:
        more.append((mask, T.StringType()))
    inner = [f"_k{i}" for i in range(len(keep))]
    schema = T.StructType(
        [T.StructField(k, df.schema[c].dataType) for c, k in zip(keep, inner, strict=True)]
        + [T.StructField(f"_m{i}", m[1]) for i, m in enumerate(more)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in more]
            for value in batch.column(len(keep)):
                content = value.as_py()
                base, spans = all_spans(content or "", model)
                row = [sum(s[1] == k for s in base) for k in range(len(KINDS))]
                row += [hashlib.sha256(written(base).encode()).hexdigest(), written(spans)]
                if mask:
                    row.append(None if content is None else masked(content, spans))
                for column, cell in zip(columns, row, strict=True):
                    column.append(cell)
            types = [pa.int64()] * len(KINDS) + [pa.string()] * (len(more) - len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=schema.names,
            )

    rows = df.select(*[F.col(c).alias(k) for c, k in zip(keep, inner, strict=True)], F.col(text).alias("_read"))
    out = rows.mapInArrow(run, schema)
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(keep, inner, strict=True)],
        *[F.col(f"_m{i}").alias(m[0]) for i, m in enumerate(more)],
    )
