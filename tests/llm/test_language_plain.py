"""The language report against a plain version: one text at a time, dictionaries, double precision."""

import math
import random
import string
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from funnelwright.llm import language, registered

from .test_language import SYLLABLES, labelled

TOP = 0xFFFFFFFF


def grams(text):
    """Counts of a text's places, from its letters and single spaces."""
    lower = "".join(c.lower() if c in string.ascii_uppercase or ("À" <= c <= "Þ" and c != "×") else c for c in text or "")
    kept = bytearray()
    gap = False
    for byte in lower.encode():
        letter = 0x61 <= byte <= 0x7A or byte >= 0x80
        if letter:
            kept.append(byte)
        elif not gap:
            kept.append(0x20)
        gap = not letter
    found = {}
    for order in (1, 2, 3):
        for i in range(len(kept) - order + 1):
            h = (int.from_bytes(kept[i : i + order], "big") + (order << 28)) * 0x9E3779B1 & TOP
            place = ((h ^ (h >> 15)) * 0x85EBCA6B & TOP) >> 20
            found[place] = found.get(place, 0) + 1
    return found


def dot(a, b):
    if len(b) < len(a):
        a, b = b, a
    return sum(v * b.get(k, 0) for k, v in a.items())


def unit(v):
    size = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / size for k, x in v.items()} if size else {}


def added(rows):
    out = {}
    for row in rows:
        for k, v in row.items():
            out[k] = out.get(k, 0) + v
    return out


def clusters(rows, k=4):
    mean = added(rows)
    order = sorted(range(len(rows)), key=lambda i: dot(rows[i], mean))
    k = min(k, len(rows))
    centres = [rows[order[(2 * j + 1) * len(rows) // (2 * k)]] for j in range(k)]
    for _ in range(10):
        member = [max(range(k), key=lambda j, r=r: dot(r, centres[j])) for r in rows]
        sums = [added([r for r, m in zip(rows, member, strict=True) if m == j]) for j in range(k)]
        centres = [unit(s) or c for s, c in zip(sums, centres, strict=True)]
    return centres


def length_class(counted):
    return sum(sum(counted.values()) > bound for bound in (60, 120, 250, 500, 1000, 4000))


def plain_report(rows, place_of):
    """doc_id, language, score and acceptance of each (doc_id, text, lang); ``place_of`` orders a language's sample."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    training = [(place_of[i], grams(t), lang) for i, t, lang in rows if t is not None and lang is not None and not held(i)]
    frequency = added([dict.fromkeys(g, 1) for _, g, _ in training])
    weigh = lambda g: unit(
        {k: math.sqrt(n) * (math.log((1 + len(training)) / (1 + frequency.get(k, 0))) + 1) for k, n in g.items()}
    )
    centres, shown = [], {}
    for lang in sorted({x for _, _, x in training}):
        own = [g for _, g, x in sorted(training, key=lambda r: r[0]) if x == lang and g][:500]
        vectors = [weigh(g) for g in own]
        centres += [(lang, c) for c in clusters(vectors)]
        shown[lang] = [[] for _ in range(7)]
        for half in (0, 1):
            others = clusters(vectors[1 - half :: 2])
            for g, v in zip(own[half::2], vectors[half::2], strict=True):
                shown[lang][length_class(g)].append(1 - max(dot(v, c) for c in others))
    reach = {lang: [0.95] * 7 for lang in shown}
    for k in range(7):
        pooled = [d for classes in shown.values() for d in classes[k]]
        for lang, classes in shown.items():
            if len(classes[k]) >= 30:
                reach[lang][k] = max(classes[k]) + 0.15
            elif len(pooled) >= 5:
                reach[lang][k] = max(pooled) + 0.15
            elif k:
                reach[lang][k] = reach[lang][k - 1]
    for far in reach.values():
        for k in range(5, -1, -1):
            far[k] = max(far[k], far[k + 1])
    out = {}
    for i, text, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            out[i] = ("und", 0.0, None)
            continue
        counted = grams(text)
        v = weigh(counted)
        score, lang = max(((dot(v, c), x) for x, c in centres), key=lambda s: s[0])
        out[i] = (lang, score, min(reach[lang][length_class(counted)], 0.95) - (1 - score))
    return out


def test_report_against_the_plain_version(spark, documents, rng):
    rows = labelled(rng, 120)
    rows = [(i, f"{rng.choice(['', '.', '12 ', 'É '])}{t}{rng.choice(['', '!', ' - '])}", lang) for i, t, lang in rows]
    rows += [(500, None, "en"), (501, "", None), (502, "42 !?", "de"), (503, "Привет мир " * 30, None), (504, "sch", None), (505, "½ ²", None)]
    rows += [(600 + n, "".join(rng.choices(string.ascii_letters + "  ", k=40 * n)), None) for n in range(1, 8)]
    docs = documents(rows)
    place_of = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64("doc_id")).collect()}
    expected = plain_report(rows, place_of)
    got = {r["doc_id"]: r for r in language.language_report(docs).collect()}
    assert set(got) == set(expected)
    for i, (lang, score, margin) in expected.items():
        assert got[i]["lang_pred"] == lang and got[i]["score"] == pytest.approx(score, abs=1e-4), i
        if margin is None or abs(margin) > 1e-4:
            assert got[i]["accepted"] == (margin is not None and margin > 0), i
    assert any(not got[i]["accepted"] for i in (503, 607)) and all(got[i]["lang_pred"] in SYLLABLES for i in (503, 504))


def test_query_against_the_plain_version_on_a_small_table(spark, documents, tmp_path, rng):
    rows = labelled(rng, 60)
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    expected = plain_report(rows, {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64("doc_id")).collect()})
    got = registered.queries()["op3_language"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["lang_pred"], r["score"]) == (expected[r["doc_id"]][0], pytest.approx(expected[r["doc_id"]][1], abs=1e-4))


def test_counts_do_not_depend_on_the_text_before():
    rng = random.Random(3)
    texts = ["".join(rng.choices("aBé .1", k=rng.randrange(12))) for _ in range(300)]
    together = language.counts(pa.array(texts))
    for text, row in zip(texts, together, strict=True):
        assert {int(k): int(row[k]) for k in row.nonzero()[0]} == grams(text)
