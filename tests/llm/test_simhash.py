import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from funnelwright.llm import simhash
from funnelwright.llm.components import components

from .helpers import lower_ascii

WORD = re.compile("[^\x20\x09-\x0d]+")


def fingerprint(text):
    w = WORD.findall(lower_ascii(text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def classes(fps, ids, distance=4):
    """The smallest id reachable from each row, by comparing all pairs."""
    parent = list(range(len(fps)))

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("block", [5, simhash.BLOCK])
def test_fingerprints_against_definition(prose, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    texts = [None, "", " \t", "one", "a b c", "a  b\nc\td", "Ä B\x0bc\x0cd e", " lead", "trail ", prose(100), prose(5000)]
    made = simhash.fingerprint_texts(pa.array(texts, pa.string())).tolist()
    assert made == [fingerprint(t) for t in texts]


def near_copies(prose, rng):
    rows, n = [], 0
    for _ in range(12):
        base = prose(250).split()
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((n, " ".join(copy)))
            n += 1
    rng.shuffle(rows)
    return rows + [(90, None), (91, ""), (92, " "), (91, ""), (None, rows[0][1]), (None, "solitary words without number")]


def test_groups_against_all_pairs(documents, prose, rng):
    rows = near_copies(prose, rng)
    got = simhash.simhash_report(documents(rows)).collect()
    fps = [fingerprint(t) for _, t in rows]
    expected = zip([i for i, _ in rows], [f"{f:016x}" for f in fps], classes(fps, [i for i, _ in rows]), strict=True)
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_one_row_of_each_group_stays(documents, prose, rng):
    rows = near_copies(prose, rng)
    docs = documents(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    fps = [fingerprint(t) for _, t in rows]
    expected = set(classes(fps, [i for i, _ in rows]))
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_anchors_meet_for_every_split_of_the_distance(rng):
    syndromes = simhash._syndromes()
    one = np.array([rng.getrandbits(64) for _ in range(2000)], dtype=np.uint64)
    other = one.copy()
    for k in range(4):  # up to four flipped bits
        other[k * 400 :] ^= np.uint64(1) << np.array([rng.randrange(64) for _ in one[k * 400 :]], dtype=np.uint64)
    homes = np.stack(simhash.home_anchors(one, syndromes))
    index, anchors = simhash.visited_anchors(other, 4, syndromes)
    met = {(i, a) for i, a in zip(index.tolist(), anchors.tolist(), strict=True)}
    assert all(any((i, int(h)) in met for h in homes[:, i]) for i in range(len(one)))


def test_crowded_anchors_are_cut_into_cells(spark, rng, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 64)
    monkeypatch.setattr(simhash, "SMALL", 16)
    start = rng.getrandbits(64)
    fps = {start}
    while len(fps) < 600:  # a chain of near values around one point, and distant ones
        f = rng.choice(sorted(fps)) ^ (1 << rng.randrange(64)) if rng.random() < 0.9 else rng.getrandbits(64)
        fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = components(simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")))
    root = {r["node"]: r["root"] for r in found.collect()}
    got = [root.get(s, s) for s in signed]
    assert got == classes(fps, signed)


def test_components(spark):
    links = spark.createDataFrame(
        [(1, 2), (2, 3), (3, 3), (9, 8), (8, 9), (9, 8), (None, 4), (5, None)] + [(i, i + 1) for i in range(100, 140)],
        "x long, y long",
    )
    got = {r["node"]: r["root"] for r in components(links).collect()}
    expected = {2: 1, 3: 1, 9: 8} | {i: 100 for i in range(101, 141)}
    assert {k: v for k, v in got.items() if k != v} == expected
    assert components(links.limit(0)).count() == 0


def test_empty_table(documents):
    assert simhash.simhash_report(documents([])).count() == 0
    assert simhash.keep_one(documents([])).count() == 0
