import hashlib
import re

from funnelwright.llm import pii


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


TEXTS = [
    None,
    "",
    "mail a.b+c@d-e.fg.hi, x@y and @z.com or a@b.c_d@e.f._g@h.i",
    "é 10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.004 1.2.3 0000000255.1.1.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 378282246310005 1 2 3",
    "call +49 (30) 1234-5678. or +1 2 or +1234567890123456 +1 555 010 9999 ",
    "a@b.c " * 1000 + "9" * 5000,
    "." * 50_000 + "a" * 50_000,
]


def test_spans_hold_all_matches_of_the_fixed_patterns(documents):
    rows = list(enumerate(TEXTS)) + [(2, TEXTS[2]), (None, TEXTS[3])]
    got = pii.pii_report(documents(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i, text in enumerate(TEXTS):
        spans = base(text or "")
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        row = by_id[i]
        assert row["base_sha256"] == hashlib.sha256(line.encode()).hexdigest(), text[:50]
        assert [row[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(s[0] == k for s in spans) for k in pii.KINDS[:4]]


def test_random_texts_against_plain_patterns(rng):
    for _ in range(2000):
        text = "".join(rng.choice("0123459. -+()@ab_%\n") for _ in range(rng.randrange(40)))
        assert [s for s in pii.proposals(text) if s[0] != "iban"] == base(text), repr(text)


def test_mod97_confirms_account_numbers():
    good, bad = "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32"
    assert [s[0] for s in pii.proposals(f"pay {good} now") if s[0] == "iban"] == ["iban"]
    assert not [s for s in pii.proposals(f"pay {bad} now") if s[0] == "iban"]


def test_account_numbers_before_other_words_are_found():
    one, two = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    grouped = "DE89 3704 0044 0532 0130 00"
    for text in (f"{one} BIC COBADEFFXXX", f"{one} 2024 now", f"{grouped} BIC COBADEFFXXX", f"pay {grouped} {two} 7 A", f"XX12 {one} B"):
        got = [text[s:e] for k, s, e, *_ in pii.proposals(text) if k == "iban"]
        assert got == [x for x in (one, grouped, two) if x in text], text
    assert not [s for s in pii.proposals("DE88370400440532013000 BIC COBADEFFXXX") if s[0] == "iban"]


def test_context_words_move_the_score():
    plain, helped = "zzz 10.0.0.1 zzz", "server address 10.0.0.1"
    against = "version 10.0.0.1"
    scores = [pii.score(t, "ip", t.index("10"), t.index("10") + 8) for t in (plain, helped, against)]
    assert scores[2] < scores[0] < scores[1]


def test_empty_table(documents):
    assert pii.pii_report(documents([])).count() == 0


def test_context_words_are_whole_words():
    number = "+49 30 1234567 89"
    plain = pii.score(f"the number {number} here", "phone", 11, 11 + len(number))
    for before in ("hotel", "basically", "calls tel"):
        text = f"{before} {number}"
        change = pii.score(text, "phone", len(before) + 1, len(text)) - plain
        assert round(change, 3) == (0.2 if before == "calls tel" else 0.0)
    # a word that the reach of the context cuts is seen whole
    text = "hotel" + " " * (pii.NEAR - 3) + number
    assert pii.score(text, "phone", len(text) - len(number), len(text)) == plain
