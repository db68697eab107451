import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from funnelwright.llm import packing
from funnelwright.llm.registered import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_runs_give_the_same_ids_as_whole_texts(tokenizer, rng, prose):
    texts = [None, "", " ", "don't, we're 'tis ,'s 's\" <|endoftext|> A<|startoftext|>b <|ENDOFTEXT|>", "ΑΣ, İI a≠b ≮"]
    texts += ["J̌ T̈ é ,̸ ≮", prose(500), "a" * 5000]
    letters = " \n\t'\",.!<>|=aAbtsJjK019é̸́ßΣ—日​\x0b\x1c\x85　"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(500)]
    encoder = packing.Encoder(PATH)
    assert encoder._by_runs
    for _ in range(2):  # the second time from the table
        ids, bounds = encoder.encode(pa.array(texts, pa.string()), packing.END_ID)
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == ids_of(tokenizer, text), repr(text)


def test_runs_sharing_a_slot(tokenizer, prose, monkeypatch):
    monkeypatch.setattr(packing, "_SHIFT", np.uint64(62))
    monkeypatch.setattr(packing.Encoder, "SLOTS", 4)
    encoder = packing.Encoder(PATH)
    for _ in range(3):
        texts = [prose(50) for _ in range(20)]
        ids, bounds = encoder.encode(pa.array(texts), packing.END_ID)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [ids_of(tokenizer, t) for t in texts]


def test_other_tokenizers_get_whole_texts(prose):
    path = tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = [prose(30), None, "", " a  b ", "<|endoftext|> x"]
    ids, bounds = packing.Encoder(path).encode(pa.array(texts, pa.string()), packing.END_ID)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [ids_of(plain, t) for t in texts]


def test_windows_are_within_capacity_and_near_equal(rng):
    for n in (1, 2, 7, 300):
        sizes = np.array([rng.randrange(1, 1000) for _ in range(n)])
        window = packing.windows(sizes, 1000)
        sums = np.bincount(window, weights=sizes)
        assert sums.max() <= 1000 and len(window) == n
    assert sums.min() > 800


def test_window_count_rises_until_all_fit():
    assert len(set(packing.windows(np.array([600, 600, 600]), 1000).tolist())) == 3


def check(rows, pieces, tokenizer, capacity):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    expected = {}
    for doc_id, text in rows:
        expected.setdefault((doc_id, len(ids_of(tokenizer, text))), []).append(ids_of(tokenizer, text))
    assert by_doc.keys() == expected.keys()
    for key, copies in expected.items():
        own = sorted(by_doc[key], key=lambda p: p["start"])
        at = 0
        for p in own[:: len(copies)] if len(copies) > 1 else own:
            ids = np.array(copies[0][p["start"] : p["start"] + p["length"]], dtype="<u4")
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids.tobytes())
            at += p["length"]
        assert at == key[1] and len(own) % len(copies) == 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in own])
        assert [p["offset"] for p in own] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity


def test_every_id_lies_in_one_piece(documents, prose, tokenizer):
    rows = [(i, prose(n)) for i, n in enumerate([1, 10, 200, 3000, 9000, 40, 60])] + [(90, None), (91, ""), (None, "x y")]
    rows += [rows[2], rows[2]]
    check(rows, packing.pack_documents(documents(rows), PATH).collect(), tokenizer, packing.CAPACITY)


def test_groups_and_padding(spark, rng, monkeypatch):
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    rows = [(i, 0, n := rng.choice([rng.randrange(1, 900), 128, 128]), 0, n) for i in range(5000)]
    from funnelwright.session import staged

    pieces = staged(spark.createDataFrame(rows, kind), "pieces")
    packed = packing.pack(pieces, 1000, 500).collect()
    sums = {}
    for p in packed:
        sums[p["sequence_id"]] = sums.get(p["sequence_id"], 0) + p["length"]
    assert len(packed) == 5000 and max(sums.values()) <= 1000
    assert sum(sums.values()) / (1000 * len(sums)) > 0.9


def test_sequences_hold_the_ids(documents, prose, tokenizer):
    from funnelwright.session import staged

    rows = [(1, prose(100)), (2, prose(2000)), (3, None)]
    pieces = staged(packing.tokenised(documents(rows), PATH, capacity=512, keep_ids=True), "pieces")
    packed = packing.pack(pieces, 512)
    built = {r["sequence_id"]: r for r in packing.sequences(packed, 512).collect()}
    for p in packed.collect():
        ids = np.frombuffer(built[p["sequence_id"]]["ids"], dtype="<u4")
        wanted = ids_of(tokenizer, dict(rows)[p["doc_id"]])[p["start"] : p["start"] + p["length"]]
        assert ids[p["offset"] : p["offset"] + p["length"]].tolist() == wanted
    for r in built.values():
        n = r["length"]
        assert len(r["ids"]) == 4 * (n if n & (n - 1) == 0 else 512)


def test_empty_table(documents):
    assert packing.pack_documents(documents([]), PATH).count() == 0
