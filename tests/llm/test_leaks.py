import hashlib
import re

import pyarrow as pa
from .helpers import lower_ascii

from funnelwright.llm import leaks

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall(lower_ascii(text or ""))


def brute(texts, items, window):
    windows = {}
    for i, t in items:
        w = words_of(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for t in texts:
        w, hit, found = words_of(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def brute_longest(text, items, window):
    """(words, item, first word) of the longest match that holds a window, by trying every pair of places."""
    w, best = words_of(text), (0, None, None, None)
    for i, t in items:
        v = words_of(t)
        for p in range(len(w)):
            for q in range(len(v)):
                n = 0
                while p + n < len(w) and q + n < len(v) and w[p + n] == v[q + n]:
                    n += 1
                if v and n >= min(window, len(v)):
                    best = min(best, (-n, p, i is None, str(i)), key=lambda m: (m[0], m[1] or 0, m[2] or False, m[3] or ""))
    return (0, None, None) if best[1] is None else (-best[0], None if best[2] else best[3], best[1])


def frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_report_against_brute_force(spark, documents, prose):
    items = [(i, prose(n)) for i, n in enumerate([30, 12, 10, 9, 1, 0, 40])]
    items += [(7, None), (8, "!!"), (0, items[0][1]), (None, prose(15)), (11, items[0][1])]
    middle = " ".join(items[0][1].split()[5:20])
    texts = [None, "", "?!", prose(300), prose(50) + " " + items[0][1] + " " + prose(20), "É " + middle.upper(), middle]
    texts += [items[3][1], items[4][1] + "-" + items[4][1], items[10][1], items[6][1] * 2, prose(20000) + " " + middle]
    rows = list(enumerate(texts)) + [(4, texts[4]), (None, texts[4])]
    got = leaks.leak_report(documents(rows), frame(spark, items)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i, (n, hit, found) in enumerate(brute(texts, items, leaks.WINDOW)):
        row = by_id[i]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n, hit, len(found))
        assert row["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert row["contaminated"] == (hit > 0)


def test_random_shards_against_brute_force(rng, monkeypatch):
    for _ in range(200):
        few = rng.choice([1, 2, 3, 30])
        text = lambda n: " ".join(f"w{rng.randrange(few)}" for _ in range(n))  # noqa: E731, B023
        items = [(i, rng.choice([None, "", text(rng.randrange(1, 25))])) for i in range(rng.randrange(6))]
        texts = [rng.choice([None, "", text(rng.randrange(40))]) for _ in range(rng.randrange(1, 9))]
        window = rng.choice([2, 3, 10])
        block = leaks.Benchmark([i for i, _ in items], pa.array([t for _, t in items], pa.string()), window)
        monkeypatch.setattr(leaks, "_benchmark", lambda a, w, block=block: block)
        made = leaks._document_hits(pa.array(texts, pa.string()), ["x"], window)
        assert list(zip(made["n_words"], made["n_hit"], made["items"], strict=True)) == brute(texts, items, window)
        longest = list(zip(made["longest"], made["longest_item"], made["longest_at"], strict=True))
        assert longest == [brute_longest(t, items, window) for t in texts]


def test_longest_matches(spark, documents, prose):
    item = prose(25)
    part = " ".join(item.split()[3:17])
    docs = documents([(1, "zz " + part + " zz"), (2, " ".join(item.split()[3:9]))])
    rows = {r["item_at"]: r for r in leaks.longest_matches(docs, frame(spark, [(5, item)])).collect()}
    assert (rows[3]["n_words"], rows[3]["doc_id"], rows[3]["doc_at"]) == (len(words_of(part)), 1, 1)


def test_longest_matches_of_text_ids(spark, prose):
    item = prose(25)
    docs = spark.createDataFrame([("b", "zz " + item), ("a", item), (None, "zz")], "doc_id string, text string")
    found = leaks.longest_matches(docs, spark.createDataFrame([("i", item)], "item_id string, text string")).collect()
    assert len(found) == len(words_of(item)) and {r["doc_id"] for r in found} == {"a"}
    assert all(r["n_words"] == len(found) - r["item_at"] for r in found)


def test_the_longest_match_of_items_that_share_a_passage(spark, documents, prose):
    shared, tail = prose(12), prose(30)
    items = [(1, shared + " q1"), (2, shared + " " + tail), (3, "q3 " + shared), (4, shared + " " + tail)]
    text = "aa " + shared + " bb " + shared + " " + " ".join(words_of(tail)[:7]) + " cc"
    row = leaks.leak_report(documents([(1, text)]), frame(spark, items)).first()
    expected = brute_longest(text, items, leaks.WINDOW)
    assert (row["longest"], row["longest_item"], row["longest_at"]) == expected and expected[1] == "2"


def test_blocks_do_not_change_results(spark, documents, prose, monkeypatch):
    items = [(i, prose(20)) for i in range(30)]
    docs = documents([(i, prose(5) + " " + items[i][1]) for i in range(30)])
    whole = sorted(leaks.leak_report(docs, frame(spark, items)).collect())
    monkeypatch.setattr(leaks, "BLOCK_BYTES", 300)
    assert sorted(leaks.leak_report(docs, frame(spark, items)).collect()) == whole


def test_filter_and_empty_tables(spark, documents, prose):
    item = prose(12)
    docs = documents([(1, item), (2, prose(30)), (3, None)])
    kept = leaks.decontaminate(docs, frame(spark, [(1, item)]))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert leaks.decontaminate(docs, frame(spark, [])).count() == 3
    assert leaks.leak_report(documents([]), frame(spark, [(1, item)])).count() == 0


