"""Spelling variants, personal data and resampling, held against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import common, pii, resample, variants
from cohortlake.llm.queries import ORACLE_SQL, QUERIES


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- spelling variants --------------------------------------------------------------------------


def counted(rows):
    total = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected_variants(words):
    near = collections.defaultdict(set)
    masks = collections.defaultdict(list)
    for w in words:
        for i in range(len(w)):
            masks[w[:i], w[i + 1 :]].append(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in masks.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def as_tuples(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_against_all_pairs(spark, given, sf):
    docs = given("documents")
    words = counted(zip(docs.doc_id, docs.text, strict=True))
    df = QUERIES["op11_spelling_variants"](spark, sf)
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert df.count() == len(words) > 1000
    assert as_tuples(df) == expected_variants(words)


@pytest.mark.parametrize("block, pack", [(4, 3), (4, 200), (128, 16)])
def test_tiles_of_any_size(spark, monkeypatch, block, pack):
    """Large groups are split into blocks, small ones packed, and every pair is found once."""
    monkeypatch.setattr(variants, "BLOCK", block)
    monkeypatch.setattr(variants, "PACK", pack)
    rng = random.Random(3)
    words = {}
    for _ in range(60):
        base = "".join(rng.choice("abé") for _ in range(rng.choice([5, 6, 7, 8, 40, 41])))
        words[base] = rng.randint(3, 50)
        for _ in range(6):
            at = rng.randrange(len(base))
            edit = rng.choice([base[:at] + base[at + 1 :], base[:at] + "c" + base[at:], base[:at] + "d" + base[at + 1 :]])
            words[edit] = rng.randint(3, 9)
    words = {w: n for w, n in words.items() if len(w) >= 5}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = [tuple(sorted((r.a, r.b))) for r in variants.near_pairs(frame).collect()]
    assert len(found) == len(set(found))
    names = sorted(words)
    assert set(found) == {(a, b) for a in names for b in names if a < b and one_edit(a, b)}
    near = {w: row[4] for w, *row in [(r[0], *r) for r in expected_variants(words)]}
    assert near == {w: sum(one_edit(w, x) for x in names) for w in names}


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(23)]
    rows = spark.createDataFrame(chain, "word string, form string")
    assert {(r.word, r.root) for r in variants.roots(rows).collect()} == {(a, "w23") for a, _ in chain}
    assert variants.roots(rows.where("false")).count() == 0


def test_runs_across_pieces(monkeypatch):
    text = "Abc dé×÷ÿ x.y ÀÖ ".encode() * 40 + "é".encode() * 50 + b" end"
    whole = [r for runs in variants.runs_of(text) for r in runs]
    assert whole == [low(r).encode() for r in re.findall("[A-Za-zÀ-ÿ]+", text.decode())]
    for piece in range(1, 30):
        monkeypatch.setattr(common, "PIECE", piece)
        assert [r for runs in variants.runs_of(text) for r in runs] == whole


def test_variants_of_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    more = rows + [(100 + i, "colour colours kolour") for i in range(7)] + [(None, "color Color cÔlor")] * 4
    spark = odd_docs.sparkSession
    df = spark.createDataFrame(more, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS key")
    assert as_tuples(variants.spelling_variants(df)) == expected_variants(counted(more))
    assert variants.spelling_variants(no_docs).count() == 0


# --- personal data ------------------------------------------------------------------------------


def expected_base(text):
    """The base spans by the plain patterns."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        doubled = [x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))]
        if 12 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def random_text(rng):
    pieces = [
        "a@b.c", "x.y@", "@@", "q@r", ".", "-", "+", " ", "1.2.3.4", "256", "0001", "..", "+1 (555) 010-9999",
        "4111 1111 1111 1111", "4111111111111111", "é", "_", "%", "12", "7", "GB82 WEST 1234 5698 7654 32",
        "DE89370400440532013000", "IBAN", "078-05-1120", "SSN", "call 555 010 9999", "order", "\n", "(", ")",
    ]
    return "".join(rng.choice(pieces) + rng.choice(["", "", " "]) for _ in range(rng.randint(0, 30)))


def test_base_spans_against_plain_patterns():
    rng = random.Random(5)
    for _ in range(4000):
        text = random_text(rng)
        spans = pii.spans_of(text)
        assert [s[:3] for s in spans if s.kind in pii.BASE] == expected_base(text), text
        assert spans == sorted(spans, key=lambda s: (s.start, pii.KINDS.index(s.kind)))
        for span in spans:
            assert 0 <= span.score <= 1
            if span.kind in pii.ADDED:
                assert all(span.end <= o.start or o.end <= span.start for o in spans if o is not span)


def test_span_digests_against_brute_force(spark, given, sf):
    docs = given("documents")
    df = QUERIES["op12_personal_data"](spark, sf)
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == len(docs)
    found = 0
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        base, row = expected_base(text), rows[doc_id]
        told = [f"{k}:{a}:{b}" for k, a, b in base]
        assert row.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        numbers = collections.Counter(k for k, _, _ in base)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [numbers[k] for k in pii.BASE]
        assert set(told) <= set(row.spans.split(",")) or not told
        found += len(base)
    assert found > 20


def test_checks_and_words_nearby():
    def kinds(text):
        return [(s.kind, text[s.start : s.end]) for s in pii.spans_of(text)]

    assert kinds("to GB82 WEST 1234 5698 7654 32 NOW") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("to GB83 WEST 1234 5698 7654 32") == []
    assert kinds("my SSN is 078-05-1120.") == [("identity", "078-05-1120")]
    assert kinds("part 078-05-1120 of it") == kinds("SSN 000-05-1120") == []
    assert kinds("tel. 0171 555 0199") == [("number", "0171 555 0199")]
    assert kinds("lot 0171 555 0199") == []
    score = lambda text: pii.spans_of(text)[0].score
    assert score("card 4111111111111111") > score("it is 4111111111111111") > score("order 4111111111111111")
    assert pii.mask("mail a@b.co, +1 555 010 9999") == "mail [email], [phone]"


@pytest.mark.parametrize(
    "unit",
    ["1", "1.", "1 ", "a", "a@", "@", "+1", "+1(", "1-", "A", "AB12 ", "1.1.1.", "GB82 A", "a@b.", "(1", "."],
)
def test_long_texts_take_linear_time(unit):
    import time

    begin = time.perf_counter()
    pii.spans_of(unit * (400_000 // len(unit)))
    assert time.perf_counter() - begin < 10


def test_personal_data_of_odd_rows(odd_docs, no_docs):
    extra = "*", "1 AS kind", "2 AS spans", "3 AS start", "4 AS n_email"
    rows = odd_docs.selectExpr(*extra)
    rows = rows.withColumn("text", F.when(F.col("doc_id") == 5, F.lit("é a@b.co a@b.co")).otherwise(F.col("text")))
    found = pii.span_digests(rows).collect()
    assert len(found) == rows.count()
    assert [r.spans for r in found if r.doc_id == 5] == ["email:2:8,email:9:15"] * 2
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.spans == "" and r.base_sha256 == empty for r in found if r.doc_id != 5)
    assert pii.span_digests(no_docs).count() == 0
    masked = pii.redacted(rows)
    assert masked.columns == rows.columns
    assert [r.text for r in masked.where("doc_id = 5").collect()] == ["é [email] [email]"] * 2
    assert masked.where("text IS NULL").count() == rows.where("text IS NULL").count()


# --- resampling ---------------------------------------------------------------------------------


def feature_buckets(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    features = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in features]


def expected_draw(rows, target):
    bags = [(i, *feature_buckets(t)) for i, t in rows]
    own = collections.Counter(b for _, _, bag in bags for b in bag)
    theirs = collections.Counter(b for t in target for b in feature_buckets(t)[1])
    size, other = sum(own.values()), sum(theirs.values())
    gain = [
        math.floor(1000 * math.log((theirs[b] + 1) * (size + 10000) / ((own[b] + 1) * (other + 10000))))
        for b in range(10000)
    ]
    out = []
    for i, n, bag in bags:
        weight = math.floor(sum(gain[b] for b in bag) / len(bag)) if bag else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(bag), weight, score, None, n])
    fit = [row for row in out if row[5] >= 20]
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(fit[: 25 * len(fit) // 100], 1):
        row[4] = rank
    return sorted((tuple(row[:5]) for row in out), key=repr)


def drawn(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=repr)


def test_resampling_against_brute_force(spark, given, sf):
    docs, target = given("documents"), given("benchmark")
    df = QUERIES["op13_resampling"](spark, sf)
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert drawn(df) == expected_draw(list(zip(docs.doc_id, docs.text, strict=True)), target.text)


@pytest.mark.parametrize("digit", [1, 5, 12])
def test_radix_sort_of_hot_and_extreme_keys(spark, monkeypatch, digit):
    monkeypatch.setattr(resample, "DIGIT", digit)
    rng = random.Random(digit)
    ids = [None, -(1 << 63), (1 << 63) - 1, -1, 0, 1 << 32, 7] if digit > 1 else [None, 3, 4]
    rows = [(rng.choice(ids), 0, rng.randint(39, 60), 0, rng.choice([-5, 0, 0, 0, 9])) for _ in range(700)]
    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    frame = spark.createDataFrame(rows, schema).repartition(5)
    found = sorted(resample.ranked(frame).collect(), key=lambda r: r.pos)
    assert [r.pos for r in found] == list(range(700))
    wanted = sorted(rows, key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    assert [tuple(r)[:5] for r in found] == wanted


def test_digits_cover_every_bit(spark):
    rows = spark.createDataFrame([(5, 1, 0x1234567)], "a long, b long, c long")
    exprs = resample.digits([("a", 3), ("none", 0), ("b", 1), ("c", 25)], 10)
    got = rows.select(*[e.alias(f"d{i}") for i, e in enumerate(exprs)]).first()
    assert sum(d << (10 * i) for i, d in enumerate(got)) == 5 | 1 << 3 | 0x1234567 << 4


def test_features_across_pieces(monkeypatch):
    text = "Aa bB,1é ü x9\0 y ".encode() * 30 + b"z" * 40
    whole = [np.concatenate(part) for part in [list(resample.features_of(text))]]
    for piece in range(1, 25):
        monkeypatch.setattr(common, "PIECE", piece)
        assert sorted(np.concatenate(list(resample.features_of(text)))) == sorted(whole[0])


def test_resampling_of_odd_rows(odd_docs, no_docs):
    spark = odd_docs.sparkSession
    text = " ".join(f"word{i}" for i in range(25))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(None, text)] * 5 + [(20, text + " more"), (20, text), (20, text), (21, text)]
    clash = "*", "1 AS n_features", "2 AS weight", "3 AS score", "4 AS rank", "5 AS pos", "6 AS digit"
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(*clash)
    target = spark.createDataFrame([(1, "word3 word4"), (2, None)], "item_id long, text string")
    assert drawn(resample.resampled(df, target)) == expected_draw(rows, ["word3 word4", None])
    assert drawn(resample.resampled(df, target.where("false"))) == expected_draw(rows, [])
    assert resample.resampled(no_docs, target).count() == 0
    assert pa.types.is_int64(resample.resampled(no_docs, target).toArrow().schema.field("rank").type)


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_resampling"])
def test_same_as_sql(spark, sf, given, odd_docs, name, odd):
    documents, benchmark = given("documents"), given("benchmark")  # noqa: F841
    if odd:
        documents = odd_docs.select("doc_id", "text").toPandas()
        documents["doc_id"] = documents.doc_id.astype("Int64")
        tables = spark.createDataFrame(benchmark)
        df = (
            variants.spelling_variants(odd_docs)
            if name.startswith("op11")
            else resample.resampled(odd_docs, tables)
        )
    else:
        df = QUERIES[name](spark, sf)
    result = duckdb.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(result.columns)
    theirs = [tuple(row) for row in result.select(*df.columns).fetchall()]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(theirs, key=repr)
