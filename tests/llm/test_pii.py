"""Personal data: the base columns of the query against plain patterns, spelled-out addresses, secrets of letters, bounds."""

import hashlib
import random
import re
import time

import pytest

from panelwright.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base(text):
    """The fixed kinds by their patterns alone."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, "email", m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, "ip", m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, "card", m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def test_base_columns_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op2_pii_spans"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in ("email", "ip", "card", "phone")]
        spans = [s for s in r.spans.split(",") if s]
        assert set(joined.split(",")) - {""} <= set(spans)
        places = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in set(spans) - set(joined.split(","))))
        assert all(0 <= a < b <= len(texts[r.doc_id]) for a, b in places) and all(b <= c for (_, b), (c, _) in zip(places, places[1:]))


def test_base_spans_of_random_texts():
    pick = random.Random(8)
    for _ in range(3000):
        text = "".join(pick.choice(["1", "23", "4", ".", "@", "a", "b.c", "-", " ", "+", "(", ")", "255", "%", "4111111111111111"]) for _ in range(pick.randint(0, 25)))
        assert pii.base_spans(text) == base(text), text


@pytest.fixture(scope="module")
def field():
    return pii.Field(pii.default_weights())


def found(text, field):
    return [(kind, text[a:b]) for kind, a, b in pii.added_spans(text, pii.base_spans(text), field)]


@pytest.mark.parametrize("text, want", [
    ("joe.doe [at] mail [dot] site [dot] com", [("email", "joe.doe [at] mail [dot] site [dot] com")]),
    ("write to john_doe (at) research (dot) example (dot) org today", [("email", "john_doe (at) research (dot) example (dot) org")]),
    ("password: hunterpass", [("secret", "hunterpass")]),
    ("the password = correcthorse and more", [("secret", "correcthorse")]),
    ("the secret: of life is not known", []),
    ("a password is needed here", []),
    ("see (at) page 4, version 2.0 of 2024", []),
])
def test_spans_that_patterns_miss(text, want, field):
    assert found(text, field) == want


def test_the_bound_leaves_out_nothing(field):
    """All candidates with a positive score, found with and without the bound."""
    texts = [t for t, _ in pii.labelled(150, seed=31)] + ["12 34 5678 (9) " * 10, "1.2.3 4-5 6/7 a8 " * 8, "x (at) y dot z 1 " * 5]
    for text in texts:
        tokens = [(m.start(), m.end()) for m in pii._TOKEN.finditer(text)]
        triggers = pii._triggers(text, tokens)
        plain = {(i, j, k): s for i, j in pii.candidates(text, tokens, triggers)
                 for k, s in enumerate(field.sum(pii.span_features(text, tokens, i, j))) if s > 0}
        quick = {(i, j, k): s for i, j, k, s in field.spans(text, tokens, triggers)}
        assert quick.keys() == plain.keys() and all(abs(quick[x] - plain[x]) < 1e-9 for x in plain)


def test_stretches_far_apart_and_close(field):
    """Decoding around triggers equals decoding the whole text, also where one token is thousands of characters long."""
    for gap in ("x" * 5000, "word " * 60, "y" * 4500 + " z ", " " * 6000):
        text = f"call (555) 123-4567 {gap} ssn 123-45-6789 and {gap} password: hunterpass"
        assert pii.added_spans(text, [], field) == pii.decode(text, field)


def test_tables_of_numbers_are_cheap(field):
    pick = random.Random(3)
    text = " ".join(str(pick.randint(0, 10 ** pick.randint(1, 6))) for _ in range(15_000))
    start = time.perf_counter()
    pii.added_spans(text, pii.base_spans(text), field)
    assert time.perf_counter() - start < 30 * len(text) / 1e6 + 2
