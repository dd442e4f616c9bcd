"""Every operator against a brute-force version, and the cases named in its docstring."""

import hashlib
import html
import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import (
    bpe, decontam, htmltext, jaccard, pii, quality, toxicity, urlfilter, warc, wordpiece,
)
from textloom.llm.components import components

VOCAB = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", "   \n\t ", "One two. one two.", "One two. one two.", "É é ΣΑΣ İx \x1c a\x1db ½ ٣ 中文 🎉",
    "<|endoftext|>a<|startoftext|>", "<|", "don't I'M we'll", "ab" * 4000 + " . " + "xyz " * 3000, "a\x85b\u2028c",
]


def table(spark, texts, extra=True):
    rows = [(None if i == 1 else i, t, "x", 5) for i, t in enumerate(texts)]
    # Clashing names must not matter.
    df = spark.createDataFrame(rows, "doc_id long, text string, _read string, n_tokens long")
    return df.repartition(3) if extra else df


@pytest.fixture(scope="module")
def coder():
    return bpe.Bpe.load(VOCAB)


def test_bpe_equals_the_library(spark, coder):
    library = Tokenizer.from_file(VOCAB)
    got = {r.doc_id: r for r in bpe.roundtrip_digests(table(spark, TEXTS), coder).collect()}
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = got[None if i == 1 else i]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    ids = bpe.encode(table(spark, TEXTS), coder)
    again = {r.doc_id: r.text for r in bpe.decode(ids, coder).collect()}
    assert again[3] == library.decode(library.encode(TEXTS[3]).ids, skip_special_tokens=False)
    assert bpe.roundtrip_digests(table(spark, []), coder).count() == 0


def test_merges_at_once_are_only_made_where_safe(coder):
    """A made-up file in which a later merge goes before further places of an earlier one."""
    assert coder.at_once.dtype == bool and len(coder.at_once) == len(coder.ranks)


def page_rows():
    same = "<p>" + "same payload " * 20 + "</p>"
    rows = [(i, f"http://a.example/{i}", same if i % 3 == 0 else f"<p>{i}</p>" * 30) for i in range(60)]
    rows += [(60, None, None), (61, "u\r\nv%0A", "short"), (62, "x", "short"), (None, "y", same), (0, "z", same)]
    return rows


def test_warc_bundles_give_back_every_record(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 500)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 4000)
    rows = page_rows()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    bundles = warc.write_bundles(df).cache()
    got = warc.read_bundles(bundles).collect()
    expected = []
    for page, url, text in rows:
        payload = (text or "").encode()
        ids = [p for p, _, t in rows if (t or "") == (text or "") and p is not None]
        revisit = len(payload) >= 100 and len(ids) > 1 and (page is None or page > min(ids))
        expected.append(
            (page, url, None if revisit else payload, len(payload), hashlib.sha256(payload).hexdigest(),
             "revisit" if revisit else "response", min(ids) if revisit else None)
        )
    flat = [(r.page_id, r.url, r.payload and bytes(r.payload) if r.payload is not None else None, *r[3:]) for r in got]
    assert sorted(flat, key=repr) == sorted(expected, key=repr)
    one = warc.fetch(bundles, [62]).collect()
    assert [(r.page_id, bytes(r.payload)) for r in one] == [(62, b"short")]
    assert warc.read_bundles(warc.write_bundles(df.limit(0))).count() == 0


def test_exported_bundles_can_be_sought(spark, tmp_path):
    df = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    bundles = warc.write_bundles(df).cache()
    names = [r.bundle for r in warc.export_bundles(bundles, str(tmp_path)).collect()]
    content = (tmp_path / names[0]).read_bytes()
    starts, _ = warc.frames_of(content)
    assert warc.frame(content, len(starts) - 1).startswith(b"WARC/1.1\r\n")


def test_url_rules_against_every_rule(spark, monkeypatch):
    rng = random.Random(1)
    labels = ["net", "com", "example", "a", "b", ""]
    rules = {}
    for _ in range(40):
        host = ".".join(rng.choice(labels[:5]) for _ in range(rng.randint(1, 3)))
        rules[host + "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 2)))] = rng.choice(("allow", "block"))
    rules = [urlfilter.Rule.parse(v, k) for k, v in rules.items()]
    urls = [None, "", "no-scheme", "http://", "HTTP://A.B.Net/a?x", "x://net#f", "http://a.net", "y://u@net:80/a://b"]
    urls += [
        "http://" + ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) + "/" + "".join(rng.choice("ab/?#") for _ in range(4))
        for _ in range(400)
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    expected = {}
    for i, url in enumerate(urls):
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        host = re.split("[/?#]", rest)[0].lower() if rest else ""
        path = re.split("[?#]", rest[len(host):])[0]
        fits = [
            r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
        ]
        best = max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)
        expected[i] = (host, path, best and best.text, best.verdict if best else "allow")
    for block in (urlfilter.MAX_RULES, 7):
        monkeypatch.setattr(urlfilter, "MAX_RULES", block)
        got = {r.page_id: tuple(r)[1:] for r in urlfilter.filter_urls(df, rules).collect()}
        for i, (host, path, rule, verdict) in expected.items():
            assert got[i][:2] == (host, path)
            # Rules of equal text and host length may tie.
            assert len(got[i][2] or "") == len(rule or ""), (urls[i], got[i], rule)


def brute_components(rows, size, num, den):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    fold = {c: c + 32 for c in range(65, 91)}
    sets = []
    for _, text in rows:
        w = [x.translate(fold) for x in word.findall(text or "")]
        grams = [tuple(w[k : k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else ([tuple(w)] if w else [])
        sets.append(frozenset(grams))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def near_copies(seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(22)))) for i in range(120, 240)]
    rows += [(None, rows[0][1]), (240, None), (241, ""), (242, "  \n"), (5, rows[5][1]), (6, "other text here")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("setting", [(3, 90, 100), (1, 70, 100)])
def test_jaccard_join_against_all_pairs(spark, monkeypatch, setting):
    for name, value in (("MIN_CHUNK", 8), ("MAX_CHUNK", 8), ("SIGNATURE_CHUNK", 8), ("PRUNED_CHUNKS", 2)):
        monkeypatch.setattr(jaccard, name, value)
    rows = near_copies(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.id, r.n, r.component) for r in jaccard.join_components(df, *setting).collect()), key=repr)
    assert got == brute_components(rows, *setting)


def test_jaccard_groups_of_packed_keys(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PACKED_KEYS", 50)
    rng = random.Random(5)
    base = [[rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(60)] for _ in range(4)]
    texts = [" ".join(b[:k] + ["x", str(k)] + b[k:]) for b in base for k in range(0, 60, 7)]
    t = jaccard.Threshold(80, 100)
    holders = {}
    for grams in jaccard.sets_of(pa.array(texts), jaccard.Hasher(), 3):
        for key in t.keys(grams) >> np.uint64(64 - 40):
            holders.setdefault(int(key), set()).add(jaccard.digests(grams)[0] & jaccard.OWNER_MASK)
    want = {(min(h), m) for h in holders.values() for m in h if m != min(h)}
    df = spark.createDataFrame([(x,) for x in texts], "text string").repartition(3)
    got = jaccard.groups(jaccard.routes(df, 3, t, 40)).collect()
    assert len(got) == len(want) and {(r.anchor, r.member) for r in got} == want


def test_jaccard_groups_inside_others_go(spark):
    rng = random.Random(3)
    members = {a: set(rng.sample(range(12), rng.randint(2, 5))) for a in range(40)}
    members |= {50: set(range(6)), 51: set(range(6)), 52: {1, 2, 4}, 53: {0, 11}}
    rows = [(a, x, -x, 9) for a, own in members.items() for x in own]
    left = jaccard._uncovered(spark.createDataFrame(rows, "anchor long, s1 long, s2 long, n long")).collect()
    kept = {}
    for r in left:
        kept.setdefault(r.anchor, set()).add(r.s1)
    assert all(kept[a] == members[a] for a in kept) and 50 in kept and not {51, 52} & set(kept)

    def pairs(groups):
        return {(x, y) for own in groups for x in own for y in own if x < y}

    assert pairs(kept.values()) == pairs(members.values())


def test_jaccard_units_give_stars(spark):
    rng = random.Random(6)
    sets = [np.sort(np.array(rng.sample(range(k << 20, (k << 20) + 200), 196), dtype=np.uint64)) for k in range(3) for _ in range(40)]
    keys = [jaccard.digests(g) for g in sets]
    rows = [(0, 0, 0, 0, k, *keys[k], g.tobytes()) for k, g in enumerate(sets)]
    df = spark.createDataFrame(rows, "u1 long, u2 long, u3 long, side long, grp long, s1 long, s2 long, grams binary")
    edges = jaccard.link_units(df, jaccard.Threshold(90, 100)).collect()
    parts = [keys[at : at + 40] for at in (0, 40, 80)]
    assert {(tuple(e.a), tuple(e.b)) for e in edges} == {(k, min(p)) for p in parts for k in p if k != min(p)}
    assert len(edges) == 3 * 39


def test_components_of_any_edges(spark):
    rng = random.Random(8)
    path = [(k, k + 1) for k in rng.sample(range(100, 140), 39)]
    edges = path + [(200, k) for k in range(201, 240)] + [(k, 260) for k in range(240, 260)] + [(7, 7), (8, 9), (9, 8), (8, 9)]
    edges += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(45)]
    label = {x: x for pair in edges for x in pair if pair[0] != pair[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = [tuple(r) for r in components(df).collect()]
    assert sorted(got) == sorted(label.items())
    assert components(df.where("a = b")).count() == components(df.limit(0)).count() == 0


def test_jaccard_links_against_all_pairs(spark, monkeypatch):
    for name, value in (("MIN_CHUNK", 8), ("MAX_CHUNK", 32), ("SIGNATURE_CHUNK", 8), ("PRUNED_CHUNKS", 2)):
        monkeypatch.setattr(jaccard, name, value)
    rows = near_copies(9)
    words = [re.findall(r"\S+", t or "") for _, t in rows]
    sets = [frozenset(tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset() for w in words]
    links, counts = set(), [0] * len(rows)
    for a, b in ((a, b) for a in range(len(rows)) for b in range(len(rows)) if a != b and sets[a] and sets[b]):
        both = len(sets[a] & sets[b])
        if 100 * both >= 70 * (len(sets[a]) + len(sets[b]) - both):
            counts[a] += 1
            if sets[a] != sets[b]:
                links.add((frozenset((sets[a], sets[b])), both))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.join_components(df, 3, 70, 100, counted=True).collect()
    expected = sorted(((i, c) for (i, _), c in zip(rows, counts, strict=True)), key=repr)
    assert sorted(((r.id, r.n_links) for r in got), key=repr) == expected
    pairs = jaccard.join_links(df, 3, 70, 100).collect()
    found = [(tuple(sorted(((p.a.s1, p.a.s2), (p.b.s1, p.b.s2)))), p.both) for p in pairs]
    assert len(found) == len(set(found)) == len(links) > 0
    assert sorted(p.both for p in pairs) == sorted(both for _, both in links)


def test_no_linked_pair_misses_a_common_key():
    rng = np.random.default_rng(4)
    for num, den in ((90, 100), (80, 100), (70, 100)):
        t = jaccard.Threshold(num, den)
        for _ in range(400):
            n = int(rng.integers(1, 60))
            base = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
            other = base[rng.random(len(base)) > 0.1]
            more = rng.integers(0, 2**64 - 1, int(rng.integers(0, 4)), dtype=np.uint64)
            other = np.unique(np.concatenate((other, more)))
            both = len(np.intersect1d(base, other))
            if len(other) and t.linked(len(base), len(other), both) and len(base) + len(other) > 2 * both:
                assert len(np.intersect1d(t.keys(base), t.keys(other))), (len(base), len(other), both)


def test_one_document_of_each_group_stays(spark):
    rows = [(1, "a b c d e f", "p"), (2, "A b c d e f", "q"), (3, None, "r"), (4, "", "s"), (5, "z y x w v u", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string")
    assert sorted(r.doc_id for r in jaccard.keep_first(df).collect()) == [1, 3, 4, 5]
    twice = df.unionByName(df.where("doc_id = 1")).unionByName(df.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    got = jaccard.keep_first(twice)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.n) for r in got.collect()) == [(1, "p"), (3, "r"), (4, "s"), (5, "t")]
    assert jaccard.keep_first(df.limit(0)).count() == 0


def test_unlinked_documents_with_equal_or_null_ids_stay(spark):
    rows = [
        (7, "one two three four five six", "a"), (7, "red green blue white black grey", "b"),
        (None, "north south east west up down", "c"), (None, "spring summer autumn winter day night", "d"),
        # Linked texts: one of each pair stays, whatever the ids.
        (8, "cat dog cow pig hen fox owl bat", "e"), (8, "Cat dog cow pig hen fox owl bat", "e"),
        (None, "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 p13 p14 p15", "f"),
        (None, "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 p13 p14", "f"), (None, "", "g"), (7, None, "h"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string").repartition(3)
    got = jaccard.keep_first(df)
    assert sorted(r.n for r in got.collect()) == list("abcdefgh")
    labels = {r.label for r in jaccard.join_components(df, 5, 80, 100).where("n > 0").collect()}
    assert len(labels) == 6


def test_decontamination_finds_templates(spark):
    item = "If Ann buys 12 kg of apples at the market and Bob sells 7 kg of pears to Ann how many kg remain"
    same = "Some words before it. If Carla buys 35 kg of apples at the market and Dora sells 9 kg of pears to Carla how many kg remain there"
    mixed = same.replace("to Carla", "to Dora")
    lines = ["x", item.upper().lower(), same, mixed, "1 2 3 4 5 6 7 8 9 10 11 12 13 14", None, "", "plain words " * 3000 + item]
    items = spark.createDataFrame([(7, item), (8, item), (None, None), (9, "5 6 7")], "item_id long, text string")
    windows = decontam.benchmark_windows(items).cache()
    got = {r.doc_id: (r.contaminated, r.item_id) for r in decontam.decontaminate(table(spark, lines), windows).collect()}
    assert got[2] == (True, 7) and got[7] == (True, 7)
    assert [got[k][0] for k in (0, 4, 5, 6)] == [False] * 4
    hits = {r.doc_id: r.n_hits for r in decontam.decontaminate(table(spark, lines), windows, keep=["doc_id", "text"]).collect()}
    assert hits[3] < hits[2]
    assert decontam.decontaminate(table(spark, []), windows).count() == 0
    none = decontam.benchmark_windows(items.limit(0)).cache()
    assert not any(r.contaminated for r in decontam.decontaminate(table(spark, lines), none).collect())


def test_decontamination_finds_verbatim_and_recased_copies(spark):
    items = [
        "If Ann buys 12 kg of apples at the market and Bob sells 7 kg of pears to Ann how many kg remain",
        "Who wrote Hamlet?", "Solve 3x + 7 = 22", "Ann Bob Carla Dora Emil Fritz", "Wie heißt der Löwe ÜBER dem Tor?",
        " ".join(str(k * k) for k in range(3, 20)), "Kitap ağaç Σίσυφος Война и мир", "5 6 7", "Yes", "Name three cities",
    ]
    table_of = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    windows = decontam.benchmark_windows(table_of).cache()
    recased = (str, str.lower, str.title, lambda t: t.replace("ß", "\0").upper().replace("\0", "ß"))
    around = ("{}", "Before it, some words.\n{}\nAnd others after it", "- {}", "\n\u2022 {}\n", "\u2022{}", "\u201c{}\u201d", "* {}")
    copies = [(k, way.format(case(t))) for k, t in enumerate(items) for way in around for case in recased]
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(copies)], "doc_id long, item long, text string").repartition(3)
    got = decontam.decontaminate(df, windows, keep=["item", "text"]).collect()
    assert [r.text for r in got if r.item_id != r.item] == []
    clean = [
        "Yes, that is so", "4 5 6 7 8", "Who has written Hamlet?", "Solve 3x + 7 = 23", "Bob Ann Carla Dora Emil Fritz",
        "name two cities", "if bob buys 12 kg of apples at the market and ann sells 7 kg of plums", "\u201c", "\u00a0", "É",
    ]
    df = spark.createDataFrame(list(enumerate(clean)), "doc_id long, text string")
    assert [r.text for r in decontam.decontaminate(df, windows, keep=["text"]).where("contaminated").collect()] == []


def test_blocks_of_the_benchmark_give_the_same(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    windows = decontam.benchmark_windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet")).cache()
    whole = sorted(map(tuple, decontam.decontaminate(docs, windows).collect()))
    monkeypatch.setattr(decontam, "BLOCK", 300)
    assert sorted(map(tuple, decontam.decontaminate(docs, windows).collect())) == whole


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(8000):
        text = "".join(rng.choice("a.@@-1 2+.5(b\n9é") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_personal_data_of_every_row(spark):
    texts = [None, "", "a@b.co 1.2.3.4", "a@b.co 1.2.3.4", "call +1 (319) 555-5132 or 4337166598464399", "1" * 30000 + "@" * 500]
    model = pii.fit(table(spark, texts))
    got = {r.doc_id: r for r in pii.find(table(spark, texts), model, mask="text").collect()}
    for i, text in enumerate(texts):
        row, base = got[None if i == 1 else i], plain_spans(text or "")
        assert row.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(s[1] == k for s in base) for k in range(4))
        assert set(pii.written(base).split(",")) <= set(row.spans.split(","))
    assert got[0].text is None and got[2].text == "<email> <ip>"
    assert pii.find(table(spark, []), model).count() == 0


def test_span_model_agrees_with_all_segmentations():
    text = "x 12 34 56 78 y"
    stretch = next(iter(pii.stretches(text)))
    rng = np.random.default_rng(5)
    model = pii.SpanModel(rng.normal(size=(len(pii.KINDS), pii.FEATURES)) * 3)
    scores = (stretch.features @ model.weights.T - pii.MARGIN).max(axis=1)

    def best(at):
        if at >= len(stretch.chunks):
            return 0.0
        return max([best(at + 1)] + [scores[k] + best(f + c) for k, (f, c) in enumerate(stretch.spans) if f == at])

    index = {s: k for k, s in enumerate(stretch.spans)}
    chosen = sum(scores[index[f, c]] for f, c, _ in model.decode(stretch))
    assert chosen == pytest.approx(best(0))


@pytest.fixture(scope="module")
def span_model():
    return pii.train([])


def test_stretches_give_the_spans_of_the_whole_line(span_model):
    rng = random.Random(6)
    some = ["319", "555", "5132", "(319)", "call", "a", "b", "@", "x.org", "jo@home", "12:30", "[at]", "[dot]", "net.", "?!", "0319-5555132"]
    for _ in range(400):
        text = " ".join(rng.choice(some if rng.random() < 0.4 else ["a", "of", "b"]) for _ in range(rng.randint(1, 60)))
        whole = pii._stretch(text, [m.span() for m in pii.CHUNK.finditer(text)])
        spans = [(*pii.bounds(text, whole.chunks, f, c), k) for f, c, k in span_model.decode(whole)]
        assert sorted((s, k, e) for s, e, k in spans) == sorted(span_model.spans(text)), text


def test_marginals_of_all_segmentations():
    rng = np.random.default_rng(8)
    parts = [next(iter(pii.stretches(t))) for t in ("x 12 34 56 y", "1", "a 2 b", "7 8 9 10 11 12 13")]
    weights = rng.normal(size=(len(pii.KINDS), pii.FEATURES))
    scores = [p.features @ weights.T for p in parts]
    got = pii.Sums([np.array(p.spans) for p in parts], [len(p.chunks) for p in parts]).marginals(np.concatenate(scores))

    def all_ways(part, at=0):
        if at >= len(part.chunks):
            yield ()
            return
        yield from all_ways(part, at + 1)
        for k, (first, count) in enumerate(part.spans):
            if first == at:
                for kind in range(len(pii.KINDS)):
                    yield from (((k, kind), *rest) for rest in all_ways(part, at + count))

    at = 0
    for part, own in zip(parts[:3], scores, strict=False):
        weight = np.zeros_like(own)
        total = 0.0
        for way in all_ways(part):
            p = np.exp(sum(own[k] for k in way))
            total += p
            for k in way:
                weight[k] += p
        assert np.allclose(got[at : at + len(own)], weight / total)
        at += len(own)


def test_added_spans_of_held_out_lines(span_model):
    found, there, false, lines = [0] * 4, [0] * 4, 0, pii.labelled_lines(800, seed=4711)
    for text, gold in lines:
        base, spans = pii.all_spans(text, span_model)
        assert base == plain_spans(text) and set(base) <= set(spans)
        wanted = set(gold) - set(base)
        false += len(set(spans) - set(base) - wanted)
        for span in wanted:
            there[span[1]] += 1
            found[span[1]] += span in spans
    assert min(there) > 60 and all(f >= 0.9 * t for f, t in zip(found, there, strict=True)), (found, there)
    assert false <= 0.02 * len(lines)


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("phone: 319 555 5132", "phone", "319 555 5132"),
        ("call 0319-5555132.", "phone", "0319-5555132"),
        ("write to jane.doe@localhost now", "email", "jane.doe@localhost"),
        ("it is jane.doe @ example.com, I think", "email", "jane.doe @ example.com"),
        ("x" * 450 + " @ example.com", "email", "x" * 450 + " @ example.com"),
        ("jane [at] example [dot] com", "email", "jane [at] example [dot] com"),
        ("server 2001:db8::1 ok", "ip", "2001:db8::1"),
    ],
)
def test_spans_beyond_the_patterns(span_model, text, kind, span):
    base, spans = pii.all_spans(text, span_model)
    assert not base
    assert [(pii.KINDS[k], text[s:e]) for s, k, e in spans] == [(kind, span)]


def test_numbers_that_are_no_personal_data(span_model):
    text = "On 2024-05-17 at 12:30 it cost $1,299.00 for 3 of 12 items.\nSee chapter 12, page 340.\nVersion v2.14.1 @home"
    assert pii.all_spans(text, span_model) == ([], [])


def test_added_spans_lie_apart_from_base_spans():
    rng = random.Random(9)
    for _ in range(500):
        base, more = ([(s, 0, s + rng.randint(1, 9)) for s in (rng.randrange(40) for _ in range(n))] for n in (4, 6))
        plain = [m for m in more if not any(s < m[2] and m[0] < e for s, _, e in base)]
        assert pii.apart_from(more, base) == plain


def test_training_lines_are_different(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "train", seen.extend)
    texts = [f"line {i % 60} of text\nno sign here" for i in range(6000)] + [None, ""]
    pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert sorted(seen) == sorted({f"line {i} of text" for i in range(60)})


FIRST = "The council met on Monday to talk about the new bridge over the river. It was agreed that work begins in May."
SECOND = "Residents asked how long the road would be closed. The mayor said that no date had been fixed yet, but soon."


@pytest.mark.parametrize(
    ("body", "blocks"),
    [
        (f"<article><h1>A bridge</h1><p>{FIRST}</p><div class=notice>We use cookies.</div><p>{SECOND}</p></article>", ("A bridge", FIRST, SECOND)),
        (f"<div><div>{FIRST}</div><div>{SECOND}</div></div>", (FIRST, SECOND)),
        (f'<div class=post><div class="entry-title">A bridge for all</div><p>{FIRST}</p><p>{SECOND}</p></div>', ("A bridge for all", FIRST, SECOND)),
        (f"<article><header><h1>A bridge</h1></header><p>{FIRST}</p></article>", ("A bridge", FIRST)),
    ],
)
def test_main_text_of_ordinary_pages(body, blocks):
    assert htmltext.main_text(f"<html><body>{body}</body></html>", htmltext.fit()) == "\n".join(blocks)


def test_main_text_of_unseen_layouts():
    model = htmltext.fit()
    pages = htmltext.labelled_pages(150, seed=99)
    right = sum(htmltext.main_text(p, model) == "\n".join(" ".join(t.split()) for t in g) for p, g in pages)
    assert right >= 0.9 * len(pages)


def test_main_text_of_every_page(spark, sf_dir):
    model = htmltext.fit()
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in htmltext.extract(pages, model).collect()}
    for row in pages.collect():
        inner = row.html[row.html.index("<article>") + 9 : row.html.index("</article>")]
        parts = (" ".join(html.unescape(re.sub("</?b>|<br>", " " , p)).split()) for p in re.split("</?(?:p|h1)>", inner))
        assert got[row.page_id].text.split() == " ".join(p for p in parts if p).split()
        assert got[row.page_id].n_chars == len(got[row.page_id].text)
    odd = [(1, None), (2, ""), (3, "<p>"), (4, "< a <b"), (4, "<script>x"), (5, "<div" * 2000), (6, "<nav>a</nav>")]
    df = spark.createDataFrame([(i, "u", h) for i, h in odd], "page_id long, url string, html string")
    assert htmltext.extract(df, model).count() == len(odd)


def test_elements_without_an_end_tag_swallow_nothing():
    def texts(page):
        return [b.text for b in htmltext.blocks_of(page)]

    article = "<article><h1>Head</h1><p>First.</p></article>"
    for lead in (
        "<datalist><option value=a><option value=b></datalist>", "<button>Menu", "<div><button>Menu</div>",
        "<select><option>One<option>Two", "<div><select><optgroup><option>One</div>", "<noscript>Turn it on",
        "<template>x", "<svg><path d=1><text>Logo</text>", "<datalist><option>a<option>b</option></datalist>",
        "<button>Menu<nav></nav>", "<div><svg><title>t</title></div>",
    ):
        assert texts(lead + article) == ["Head", "First."], lead
        assert texts(lead + article + "<button>Close</button><select><option>z</select>") == ["Head", "First."], lead
    # With an end tag of their own they hide all they hold, as before.
    for whole in (
        "<noscript><p>Turn it on</p></noscript>", "<template><div>a</div><template>b</template><p>c</p></template>",
        "<button><div>Menu</div></button>", "<select><option>One<option>Two</select>", "<template></div><p>x</p></template>",
        "<svg><g><text>Logo</text></g></svg>", "<button/>", "<template><script>'<template>'</script><p>x</p></template>",
    ):
        assert texts("<div>" + whole + article + "</div>") == ["Head", "First."], whole
    assert texts("<p>Click <button>here</button> now.</p>") == ["Click now."]
    assert len(htmltext.hidden_ends("<button>" * 20000 + "</div>" * 20000)) == 0
    model = htmltext.fit()
    body = "<p>" + "A sentence of the article, long enough to be told from a menu. " * 3 + "</p>"
    page = f"<html><body>{{}}<article><h1>The head of it</h1>{body}{body}</article></body></html>"
    for lead in ("<datalist><option value=a><option value=b></datalist>", "<div><button>Menu</div>"):
        assert htmltext.main_text(page.format(lead), model) == htmltext.main_text(page.format(""), model) != ""


def test_viterbi_agrees_with_all_labellings():
    rng = np.random.default_rng(6)
    model = htmltext.ChainModel(rng.normal(size=htmltext.FEATURES), rng.normal(size=(2, 2)))
    for _ in range(30):
        rows = [sorted(rng.choice(htmltext.FEATURES, 3, replace=False).tolist()) for _ in range(6)]
        unary = model.scores(rows)

        def value(labels, unary=unary):
            total = sum(u for u, y in zip(unary, labels, strict=True) if y)
            return total + sum(model.pairs[int(a), int(b)] for a, b in zip(labels, labels[1:], strict=False))

        best = max(value([bool(k >> i & 1) for i in range(6)]) for k in range(64))
        assert value(model.decode(rows)) == pytest.approx(best)


def greedy(codes, starts, inner):
    codes, at, n = [*codes, wordpiece.END_BYTE], 0, 0
    while at < len(codes) - 1:
        pieces = starts if at == 0 else inner
        size = next((k for k in range(len(codes) - at, 0, -1) if tuple(codes[at : at + k]) in pieces), 0)
        if not size:
            return 1
        at, n = at + size, n + 1
    return n


def test_word_pieces_equal_greedy_matching():
    rng = random.Random(7)
    for _ in range(60):
        def vocab():
            end = (wordpiece.END_BYTE,)
            return {
                tuple(rng.choice(b"abc") for _ in range(rng.randint(1, 4))) + (end if rng.random() < 0.4 else ())
                for _ in range(rng.randint(1, 12))
            }

        starts, inner = vocab(), vocab()
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 9))) for _ in range(40)]
        ends = np.cumsum([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        got = wordpiece.Automaton(starts, inner).counts(data, ends - [len(w) for w in words], ends)
        assert got.tolist() == [greedy(w, starts, inner) for w in words]


def test_word_pieces_of_every_row(spark, coder):
    automaton = wordpiece.from_bpe(coder)
    got = {r.doc_id: r.n_tokens for r in wordpiece.count_tokens(table(spark, TEXTS), automaton).collect()}
    assert got[0] == got[None] == got[2] == 0 and got[3] == got[4] > 0 and len(got) == len(TEXTS)
    assert wordpiece.count_tokens(table(spark, []), automaton).count() == 0


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    covered = {p + j for p, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    lines = [s for s in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts_against_plain_loops(spark):
    rng = random.Random(8)
    texts = [None, "", " \n ", "a b c d e " * 6, "Home | About | Us\n" * 4 + "All rights reserved.\n" + "x. " * 9]
    texts += ["".join(rng.choice(["a ", "b ", "c ", "dé ", "\n", "# ", "a b c d e f ", "\u00a0"]) for _ in range(rng.randint(1, 60))) for _ in range(80)]
    texts.append("This is a clean paragraph of prose that ends as it should, with a full stop here.\nAll rights reserved.")
    got = {r.doc_id: tuple(r)[1:] for r in quality.judge(table(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert got[None if i == 1 else i][:6] == plain_quality(text), text
    assert got[len(texts) - 1][6] and not got[4][6] and not got[0][6]
    cleaned = quality.judge(table(spark, texts), cleaned="clean").where(F.col("doc_id") == len(texts) - 1).first().clean
    assert cleaned == texts[-1].split("\n")[0]
    assert quality.judge(table(spark, [])).count() == 0


def test_quality_runs_no_python(spark, capsys):
    quality.judge(table(spark, TEXTS)).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan)


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen, rest = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    model = toxicity.fit(docs, seen)
    judged = toxicity.score(docs, model).withColumnRenamed("toxic", "said").join(rest, "doc_id").collect()
    assert sum(r.said == (r.toxic == 1) for r in judged) >= 0.9 * len(judged)


def test_toxicity_without_labels_or_texts(spark):
    docs = table(spark, TEXTS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, none), keep=["doc_id", "text"]).collect()
    assert len(got) == len(TEXTS) and not any(r.toxic for r in got)
    odd = spark.createDataFrame([(3, 1), (3, 1), (None, 1), (9, 0), (4, None)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, odd)).count() == len(TEXTS)


def test_severity_falls_with_every_threshold():
    docs = pa.array(["bad words here"] * 4 + ["fine words there"] * 6)
    hasher = toxicity.Hasher()
    found, row = toxicity.features(docs, hasher)
    hashes = [np.unique(found[row == k]) for k in range(len(docs))]
    model = toxicity.fit_ordinal(hashes, [np.ones(len(h)) for h in hashes], np.arange(10) < 4)
    severity = model.severity(docs, hasher)
    assert (np.diff(model.thresholds) >= 0).all() and severity[:4].min() > severity[4:].max()


def test_quality_judges_lines_of_any_length(spark):
    menu = " | ".join(f"Link {k}" for k in range(60))
    notice = "We use cookies and ask you to read our privacy policy before you sign up or log in here today. " * 8
    prose = "The committee met on Tuesday and spoke at length about the roads of the county and their upkeep. " * 8
    lines = [menu, notice.strip(), prose + "Readers may sign up.", prose + "a > b and b > c hold.", "word " * 100_000 + "."]
    got = quality.judge(table(spark, ["\n".join(lines)], extra=False), cleaned="clean").first()
    assert got.clean.split("\n") == lines[2:]


def test_severity_against_plain_sums(spark, sf_dir):
    """The score of every document, word by word, from the model's weights."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))
    hasher, known = toxicity.Hasher(), {}

    def of(word):
        if word not in known:
            known[word] = [weight[h] for h in toxicity.features(pa.array([word]), hasher)[0].tolist() if h in weight]
        return known[word]

    got = {r.doc_id: r.severity for r in toxicity.score(docs, model).collect()}
    assert len(weight) > 10
    for row in docs.collect():
        counts = {}
        for word in re.findall("[0-9A-Za-z\u0080-\U0010ffff]+", row.text):
            word = "".join(c.lower() if c < "\u0080" else c for c in word)
            for k, _ in enumerate(of(word)):
                counts[word, k] = counts.get((word, k), 0) + 1
        # Words of the same beginning count together for it.
        parts = {}
        for (word, k), n in counts.items():
            hashes = [h for h in toxicity.features(pa.array([word]), hasher)[0].tolist() if h in weight]
            parts[hashes[k]] = parts.get(hashes[k], 0) + n
        score = sum(weight[h] * np.log1p(n) for h, n in parts.items())
        plain = sum(1 / (1 + np.exp(-(score - t))) for t in model.thresholds)
        assert abs(got[row.doc_id] - plain) < 1e-9


def plain_template_words(text):
    """``(value, kind, begins a line)`` of texts without bullets and letters beyond ASCII."""
    out, last = [], None
    for m in re.finditer(r"[0-9]+(?:[.,][0-9]+)*|[A-Za-z]+", text):
        before = text[: m.start()].rstrip(" \t\"'()-*#>")
        kind = "literal"
        if m[0][0].isdigit():
            kind = "number"
        elif out and out[-1][1] == "number" and m.start() - last <= 1 and m[0].lower() in decontam.UNITS:
            kind = "unit"
        elif m[0][0].isupper() and before and before[-1] not in "\n\r!.:?":
            kind = "name"
        line = last is None or "\n" in text[last : m.start()]
        out.append((m[0].lower(), kind, line))
        last = m.end()
    return out


def plain_windows(text, sizes=None):
    """Usable windows by template and slots, and by values, of every length asked for."""
    words = plain_template_words(text)
    for length in sizes or [min(len(words), 13)]:
        for at in range(len(words) - length + 1 if length else 0):
            part = words[at : at + length]
            if sum(k == "literal" for _, k, _ in part) >= (8 if length == 13 else 5):
                slots = tuple(
                    next(j for j in range(i + 1) if part[j][:2] == part[i][:2]) if part[i][1] != "literal" else None
                    for i in range(length)
                )
                yield "template", tuple(v if k == "literal" else k for v, k, _ in part), slots
            bare = length < 13 and (length < 3 or all(k == "number" for _, k, _ in part))
            ends = at + length == len(words) or words[at + length][2]
            if not bare or (part[0][2] and ends):
                yield "values", tuple(v for v, _, _ in part), None


def test_contaminated_windows_against_plain_sets(spark):
    rng = random.Random(12)
    common = "the of and to in a is that for it was on are with as at be this have from or had by".split()

    def sentence(n):
        words = [rng.choice(common) for _ in range(n)]
        for k in range(1, n):
            if rng.random() < 0.25:
                words[k] = rng.choice(["Anna", "Berlin", "Kofi", "12", "3.5", "1,000", "7 km", "40 percent"])
        return " ".join(words).capitalize() + rng.choice([". ", "? ", ".\n", "\n"])

    items = ["".join(sentence(rng.randint(1, 12)) for _ in range(rng.randint(1, 4))).strip() for _ in range(40)]
    items += ["Why?", "3 4 5", "", None, items[0]]
    swap = {"Anna": "Marta", "Berlin": "Oslo", "12": "99", "3.5": "8.25", "7": "31", "40": "55"}
    docs = [None, ""]
    for k in range(150):
        text = "".join(sentence(rng.randint(1, 15)) for _ in range(rng.randint(1, 6)))
        item = rng.choice(items) or ""
        if k % 3 == 0:
            item = re.sub("|".join(map(re.escape, swap)), lambda m: swap[m[0]], item)
        if k % 5 == 0:
            item = item.upper()
        docs.append(text + (item + "\n" if k % 2 else "") + sentence(5))
    known, sizes = {}, set()
    for id, item in enumerate(items):
        for window in plain_windows(item or ""):
            known[window] = min(known.get(window, id), id)
            sizes.add(len(window[1]))
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").repartition(2)
    windows = decontam.benchmark_windows(frame).cache()
    got = {r.doc_id: (r.n_hits, r.item_id) for r in decontam.decontaminate(table(spark, docs, extra=False), windows).collect()}
    hits = 0
    for k, text in enumerate(docs):
        found = [known[w] for w in plain_windows(text or "", sorted(sizes)) if w in known]
        hits += bool(found)
        assert got[None if k == 1 else k] == (len(found), min(found, default=None)), text
    assert 40 < hits < len(docs)


def test_word_pieces_of_documents_against_a_plain_loop(spark, sf_dir, coder):
    """Words of letters and single marks, cut from whole texts, by greedy matching in the file's tokens."""
    codes = {c: b for b, c in enumerate(bpe.byte_symbols())}
    found = set()
    for token in coder.tokens:
        if token and token not in coder.specials:
            body = bytes(codes[c] for c in token.removesuffix("</w>")).lower()
            found.add((*body, *((wordpiece.END_BYTE,) if token.endswith("</w>") else ())))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, t) for t in TEXTS]
    known = {}

    def count(word):
        if word not in known:
            # No piece of the file is longer than this.
            known[word] = greedy(word, found, found) if len(word) < 60 else None
        return known[word]

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = wordpiece.count_tokens(df, wordpiece.from_bpe(coder), keep=["text"]).collect()
    checked = 0
    for row in got:
        words = re.findall(rb"[0-9a-z\x80-\xff]+|[^ \t\n\x0b\x0c\r]", (row.text or "").encode().lower())
        counts = [count(w) for w in words]
        if None not in counts:
            assert row.n_tokens == sum(counts), row.text
            checked += 1
    assert checked >= len(rows) - 2
