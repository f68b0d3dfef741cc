import hashlib
import random
import re
import time

import pytest

from reviewsent.llm import pii
from reviewsent.llm.pii import KINDS, Model, all_spans, base_spans, find_personal_data, luhn, redact, training_texts

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


@pytest.fixture(scope="module")
def model():
    return Model()


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def random_texts():
    rng = random.Random(9)
    atoms = ["a", "b.c", "@", "@x.de", ".", "..", "1", "25", "256", "192.168.0.1", "+", "+1 (555) 123-4567", "4111 1111 1111 1111",
             "-", " ", "(", ")", "é", "\n", "4111111111111111", "+49", "x@y@z.com", "%", "0001", "12345678901234567890"]
    return ["".join(rng.choice(atoms) for _ in range(rng.randint(1, 14))) for _ in range(4000)]


def test_patterns_as_given():
    for text in random_texts():
        assert base_spans(text) == plain(text), text


def test_base_spans_stay_and_added_ones_touch_none(model):
    for text in random_texts()[:800]:
        base, spans = all_spans(text, model)
        assert set(base) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
        for kind, start, end in set(spans) - set(base):
            assert all(end <= s or start >= e for _, s, e in base)


def test_held_out_regions(model):
    found, gold = set(), set()
    for n, (text, spans) in enumerate(training_texts(300, seed=99)):
        found |= {(n, *s) for s in all_spans(text, model)[1]}
        gold |= {(n, *s) for s in spans}
    assert len(found & gold) / len(gold) > 0.85 and len(found & gold) / len(found) > 0.93


def test_forms_beyond_the_patterns(model):
    text = "call (555) 123-4567 or write name @ example.com today"
    assert {(k, text[s:e]) for k, s, e in all_spans(text, model)[1]} == {
        ("phone", "(555) 123-4567"), ("email", "name @ example.com")}


def test_clean_numbers_stay(model):
    text = "In 1999 and 2005, page 12 of 300: version 4.0. costs 12,50 at 12:30 on 31.12.2019 with 17 of 250 left."
    assert all_spans(text, model)[1] == [] and redact(text, []) == text


def test_long_texts_are_linear(model):
    start = time.time()
    for text in ("a" * 1_000_000, "1" * 1_000_000, "@" * 200_000, "+ " * 200_000, "a" * 500_000 + "@", "1." * 100_000, "x1 " * 30_000):
        all_spans(text, model)
    assert time.time() - start < 60


def test_rows(docs, model):
    rows = [(1, "mail a.b@c.de now"), (2, None), (3, ""), (4, "ü 10.0.0.1 and +1 (555) 123-4567"), (4, "x"), (4, "x"), (None, "x")]
    found = {(r["doc_id"], r["spans"]): r for r in find_personal_data(docs(rows)).collect()}
    assert found[1, "email:5:13"]["n_email"] == 1
    assert found[4, "ip:2:10,phone:15:32"]["base_sha256"] == hashlib.sha256(b"ip:2:10,phone:15:32").hexdigest()
    assert found[2, ""]["base_sha256"] == found[3, ""]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert find_personal_data(docs(rows)).count() == len(rows)
    assert find_personal_data(docs(rows).where("doc_id > 9")).count() == 0
    redacted = {r["doc_id"]: r for r in pii.redact_personal_data(docs(rows[:4])).collect()}
    assert redacted[1]["text"] == "mail <email> now" and redacted[2]["text"] is None and redacted[4]["chunk"] == "c"
