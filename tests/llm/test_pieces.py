import hashlib

import pytest
import sentencepiece

from funnelwright.llm import pieces
from funnelwright.llm.registered import PIECE_MODEL, tokenizer_path


@pytest.fixture(scope="module")
def path():
    return tokenizer_path(PIECE_MODEL)


@pytest.fixture(scope="module")
def model(path):
    return sentencepiece.SentencePieceProcessor(model_file=path)


ODD = ["", " ", "   ", "a", "\n\t\r", "▁", "a ▁ b", "\x00", "naïve ﬁ ½", "漢字かな", "🙂🙂 x", "<s> </s> <unk> <0x41>", "a" * 3000, "=" * 500]


def test_encoding_equals_the_library(path, model, rng):
    alphabet = "aab  ▁▁\x00\n\t<s>é🙂漢字ا=====--eertth ing"
    texts = [*ODD, "".join(chr(c) for c in range(1, 0x3000)), "the" * 2000]
    texts += ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)]
    own = pieces.Pieces(path)
    assert own.encode(texts) == model.encode(texts)
    assert [own.decode(ids) for ids in own.encode(texts)] == [model.decode(ids) if ids else "" for ids in model.encode(texts)]


def test_kept_words_do_not_change_results(path, model, prose, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 3)
    monkeypatch.setattr(pieces, "KEPT_LENGTH", 4)
    own = pieces.Pieces(path)
    texts = [prose(40) for _ in range(20)]
    assert own.encode(texts) == model.encode(texts)


def test_a_difference_from_the_library_fails(path):
    own = pieces.Pieces(path)
    own.pair_ranks = own.pair_ranks.max() - own.pair_ranks
    with pytest.raises(ValueError, match="differs"):
        own.checked(["unconventional misunderstandings throughout"])


def test_report(spark, documents, path, model, prose):
    texts = [*ODD, prose(5000), "twice", "twice"]
    rows = [(i, text) for i, text in enumerate(texts)] + [(900, None), (None, "no id"), (3, "id again")]
    found = pieces.piece_report(documents(rows), path)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def expected(doc_id, text):
        ids = model.encode(text or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return doc_id, len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids) if ids else "")

    assert sorted(map(tuple, found.collect()), key=repr) == sorted((expected(*row) for row in rows), key=repr)
    assert pieces.piece_report(documents([]), path).collect() == []


def test_encode_and_decode_keep_other_columns(spark, path, prose):
    texts = [prose(20), "", "x  y", None]
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, decoded string")
    encoded = pieces.encode(docs, path)
    assert encoded.columns == ["doc_id", "decoded", "piece_ids"]
    back = {r["doc_id"]: (r["text"], r["decoded"]) for r in pieces.decode(encoded, path).collect()}
    assert back == {i: (t or "", "kept") for i, t in enumerate(texts)}
