import random

import numpy as np
import pyarrow as pa
import pytest

from reviewsent.llm import words
from reviewsent.llm.chunks import count_chunks, dump, load, pack, slices, unpack
from reviewsent.llm.words import hash_shingles, hash_words, lower_ascii


@pytest.mark.parametrize("one_pass", [words.PASS, 16])
def test_equal_words_have_equal_hashes(monkeypatch, one_pass):
    monkeypatch.setattr(words, "PASS", one_pass)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "ab", "é", "\x1c", "a\x0bb", "\n", "long" * 30, ""]) for _ in range(rng.randint(0, 30)))
             for _ in range(200)] + ["", " ", "\n\n"]
    raw = [lower_ascii(t) for t in texts]
    hashes, counts = hash_words(raw)
    assert counts.tolist() == [len(t.split()) for t in raw]
    known = {}
    for word, h in zip((w for t in raw for w in t.split()), hashes.tolist()):
        assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)
    shingles, sizes = hash_shingles(hashes, counts)
    expected = [[tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []) for w in (t.split() for t in raw)]
    assert sizes.tolist() == [len(e) for e in expected]
    seen = {}
    for s, h in zip((s for e in expected for s in e), shingles.tolist()):
        assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_lower_case_is_ascii_only():
    assert lower_ascii("AÉİ") == "aÉİ".encode() and lower_ascii(None) == b""


def test_messages_and_slices():
    one, other = load(dump(np.arange(5), ["x", None]))
    assert one.tolist() == list(range(5)) and other == ["x", None]
    batch = pa.record_batch({"a": list(range(300))})
    assert [b.num_rows for b in slices([batch], 128)] == [128, 128, 44]


def test_chunks_hold_every_row_once(docs):
    rows = [(i % 50, f"text {i}" if i % 7 else None) for i in range(200)] + [(None, "x"), (None, None)]
    table = docs(rows)
    chunks, size = count_chunks(table)
    assert size == sum(len(t or "") for _, t in rows) and chunks >= 1
    found = []
    for r in pack(table, 5, "doc_id", "text", by=("doc_id",)).groupBy("chunk").agg({"packed": "collect_list"}).collect():
        part = unpack([bytes(m) for m in r[1]])
        assert part == sorted(part, key=lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or ""))
        found += part
    assert sorted(found, key=str) == sorted(rows, key=str)
