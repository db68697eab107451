import string
import zlib

import numpy as np
import pyarrow as pa

from funnelwright.llm import language

SYLLABLES = {"en": ["the", "ing", "and", "er", "wh"], "de": ["sch", "ung", "der", "ä", "tz"], "fr": ["eau", "é", "que", "ou", "ç"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def labelled(rng, n=150):
    return [(i, text(rng, lang := rng.choice(sorted(SYLLABLES)), rng.randrange(3, 200)), lang) for i in range(n)]


def test_held_out_accuracy_and_special_texts(documents, rng):
    rows = labelled(rng)
    rows += [(900, None, "en"), (901, "", "de"), (902, "123 !? ½ ² _", None), (903, "天地玄黄" * 100, None), (None, rows[0][1], "en")]
    rows += [rows[3], (904, text(rng, "fr", 30_000), None)]
    got = language.language_report(documents(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r for r in got}
    held = [(by_id[i]["lang_pred"], lang) for i, _, lang in rows[:150] if by_id[i]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 and not by_id[i]["accepted"] for i in (900, 901, 902))
    assert by_id[903]["lang_pred"] in SYLLABLES and not by_id[903]["accepted"]
    assert by_id[904]["lang_pred"] == "fr" and by_id[904]["accepted"]
    assert all(by_id[i]["accepted"] for i, _, _ in rows[:150])


def test_labels_of_held_out_rows_are_not_learnt(documents, rng):
    rows = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in labelled(rng)]
    assert "xx" not in language.fit(documents(rows)).languages


def test_filter_keeps_columns_and_known_rows(documents, rng):
    rows = labelled(rng) + [(900, None, None), (901, "Привет мир " * 40, None), (902, "...", None)]
    docs = documents(rows)
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(150))


def test_unlearnt_latin_languages_and_letter_noise_are_rejected(documents, rng):
    finnish = ["kaikki", "ihmi", "syn", "tyvät", "vapai", "oikeu", "jär", "koh", "taan", "yksi", "löl", "lä", "hengessä"]
    other = [" ".join("".join(rng.choices(finnish, k=rng.randrange(1, 4))) for _ in range(n)) for n in (100, 300, 1000)]
    noise = ["".join(rng.choices(string.ascii_lowercase + " " * 5, k=n)) for n in (1000, 5000, 20_000)]
    rows = labelled(rng, 400)
    docs = documents(rows + [(1000 + i, t, None) for i, t in enumerate(other + noise)])
    got = {r["doc_id"]: r["accepted"] for r in language.language_report(docs).collect()}
    assert not any(got[1000 + i] for i in range(6))
    assert all(got[i] for i, _, _ in rows)


def test_reach_follows_what_members_show():
    classes = len(language.LENGTHS) + 1
    many, far = np.full((2, classes), language.ENOUGH), np.full((2, classes), 0.3)
    far[1], far[0, 2] = 0.9, 0.5
    got = language.reaches(many, far)
    assert np.allclose(got[0], [0.65, 0.65, 0.65, 0.45, 0.45, 0.45, 0.45]) and np.allclose(got[1], language.FURTHEST)
    many[:, :2] = 1
    assert np.allclose(language.reaches(many, far)[0, :3], [0.95, 0.95, 0.65])


def test_without_labels_nothing_is_known(documents):
    got = language.language_report(documents([(1, "some words", None), (2, None, None)])).collect()
    assert {(r["lang_pred"], r["score"], r["accepted"]) for r in got} == {("und", 0.0, False)}
    assert language.language_report(documents([])).count() == 0


def test_counts_ignore_what_is_no_letter_and_text_borders():
    one = language.counts(pa.array(["ab  cd", "É", None]))
    two = language.counts(pa.array(["AB!!cd", "é", ""]))
    assert np.array_equal(one, two) and one[2].sum() == 0
    assert np.array_equal(language.counts(pa.array(["cd", "ab"]))[1], language.counts(pa.array(["ab"]))[0])
