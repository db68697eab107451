import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa

from funnelwright.llm import ppm, words

from .helpers import lower_ascii

WORD = re.compile("[^\x20\x09-\x0d]+")
ORDER = ppm.ORDER


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    """Counts and scores from the definitions, with dictionaries."""
    tokens = lambda t: [*WORD.findall(lower_ascii(t or "")), None]
    symbols = lambda t: [257] * ORDER + list((t or "").encode()) + [256]
    counted = collections.Counter(w for i, t in rows if not held_out(i) for w in tokens(t))
    total, distinct = sum(counted.values()), len(counted)
    trie = collections.defaultdict(collections.Counter)
    for i, t in rows:
        if not held_out(i):
            s = symbols(t)
            for p in range(ORDER, len(s)):
                for k in range(ORDER + 1):
                    trie[tuple(s[p - k : p])][s[p]] += 1

    def log_probability(s, p):
        out, excluded = 0.0, set()
        for k in range(ORDER, -1, -1):
            free = {x: n for x, n in trie.get(tuple(s[p - k : p]), {}).items() if x not in excluded}
            if not free:
                continue
            whole = sum(free.values()) + len(free)
            if s[p] in free:
                return out + math.log10(free[s[p]] / whole)
            out += math.log10(len(free) / whole)
            excluded |= free.keys()
        return out - math.log10(257 - len(excluded))

    out = []
    for i, t in rows:
        w, s = tokens(t), symbols(t)
        base = sum(math.log10((counted[x] + 1) / (total + distinct + 1)) for x in w)
        score = sum(log_probability(s, p) for p in range(ORDER, len(s)))
        out.append((i, held_out(i), len(w), sum(counted[x] > 0 for x in w), total, base, score))
    return out


def agree(got, rows):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    got, expected = sorted(map(tuple, got), key=order), sorted(brute(rows), key=order)
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], abs_tol=1e-6) and math.isclose(a[6], b[6], abs_tol=1e-6)


def rows_of(prose):
    rows = [(i, prose(40)) for i in range(40)] + [(50, None), (51, ""), (52, " "), (52, "天 xyz"), (None, "abc abc")]
    return rows + [(53, prose(3000)), (54, "a" * 500), rows[0], rows[0]]


def test_scores_against_definition(documents, prose):
    rows = rows_of(prose)
    agree(ppm.language_model_report(documents(rows)).collect(), rows)


def test_shards_and_rare_words_do_not_change_scores(documents, prose, monkeypatch):
    monkeypatch.setattr(ppm, "FREQUENT", 5)
    monkeypatch.setattr(ppm, "HELD", 10)
    monkeypatch.setattr(ppm, "SHARD", 200)
    monkeypatch.setattr(ppm, "GROUP_BYTES", 500)
    rows = rows_of(prose)
    agree(ppm.language_model_report(documents(rows)).collect(), rows)


def test_nothing_to_learn_from(documents):
    held = [i for i in range(100) if held_out(i)][:2]
    rows = [(held[0], "ab c"), (held[1], None)]
    got = {r["doc_id"]: r for r in ppm.language_model_report(documents(rows)).collect()}
    assert math.isclose(got[held[0]]["score"], -5 * math.log10(257)) and got[held[0]]["n_known"] == 0
    assert got[held[1]]["n_tokens"] == 1 and got[held[1]]["train_tokens"] == 0
    assert ppm.language_model_report(documents([])).count() == 0


def test_probabilities_sum_to_one():
    texts = ["abracadabra", "abba", "cab", ""]
    packed = np.concatenate(list(ppm.grams(*words.buffer(pa.array(texts), lower=False))))
    keys, n = np.unique(packed, return_counts=True)
    low = ppm._level(keys, n.astype(float), 1)
    trie = ppm.Trie(ppm.build_shard(keys, n.astype(float), low), low)
    for context in (b"abra", b"xxab", b"xxxx", b"aaaa"):
        stem = 0
        for byte in context:
            stem = stem << ppm.BITS | byte
        packed = np.array([stem << ppm.BITS | s for s in range(ppm.SYMBOLS)])
        assert math.isclose(np.exp(trie.log_probabilities(packed)).sum(), 1.0, abs_tol=1e-9)


def test_segments_do_not_change_grams(monkeypatch, prose):
    column = pa.array([prose(40), "", None, prose(3), "x"], pa.string())
    whole = np.concatenate(list(ppm.grams(*words.buffer(column, lower=False))))
    monkeypatch.setattr(ppm, "SEGMENT", 7)
    assert np.array_equal(np.concatenate(list(ppm.grams(*words.buffer(column, lower=False)))), whole)


def test_adaptive_code_length(documents):
    repeated, random = "abcd " * 200, "".join(chr(33 + i * 7919 % 94) for i in range(1000))
    docs = documents([(1, repeated), (2, random), (3, None)])
    bits = {r["doc_id"]: r["bits"] for r in ppm.adaptive_code_length(docs).collect()}
    assert bits[1] < 0.5 * 1000 < bits[2] and math.isclose(bits[3], math.log2(257))
