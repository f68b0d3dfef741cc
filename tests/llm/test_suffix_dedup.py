import hashlib
import random

import numpy as np
import pytest

from reviewsent.llm import suffix_dedup
from reviewsent.llm.suffix_dedup import LENGTH, remove_repeats, repeats_of, sort_suffixes


def brute(rows):
    first = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for doc, text in data:
        if doc is not None:
            for i in range(len(text) - LENGTH + 1):
                w = text[i:i + LENGTH]
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in data:
        gone = np.zeros(len(text), bool)
        if doc is not None:
            for i in range(len(text) - LENGTH + 1):
                if first[text[i:i + LENGTH]] < doc:
                    gone[i:i + LENGTH] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int(sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)))
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cases():
    rng = random.Random(5)
    words = ["the", "of", "né", "añ", "x", "über", "tion", "and\n", "aa", "zzyx"]
    say = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    passage, base = say(30), say(200)
    rows = [(i, say(rng.randint(1, 120))) for i in range(40)]
    rows += [(i, say(rng.randint(1, 40)) + passage + say(9)) for i in range(40, 70)]
    rows += [(i, base) for i in range(70, 80)] + [(i, base[i:] + say(3)) for i in range(80, 90)]
    rows += [(90, None), (91, ""), (92, "a" * 49), (93, "a" * 5000), (94, "b" + "a" * 300), (95, "ab" * 200),
             (96, "ba" * 90), (97, passage + passage), (97, passage), (97, passage), (None, base), (None, passage),
             (98, "\0" * 120), (99, "\0" * 60 + "x"), (-3, base[:60]), (100, base)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_RUNS, 2])
def test_same_as_brute_force(docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot)
    monkeypatch.setattr(suffix_dedup, "MAX_RUN", 64)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    rows = cases()
    found = [tuple(r)[:5] for r in remove_repeats(docs(rows)).collect()]
    assert sorted(found, key=str) == brute(rows)


def test_empty_table(docs):
    assert remove_repeats(docs([(1, "x")]).where("doc_id > 1")).collect() == []


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh", bytes(range(256)), b"a"])
def test_suffix_order(alphabet):
    rng = random.Random(1)
    text = bytes(rng.choice(alphabet) for _ in range(400)) * 2
    wanted = np.array(sorted(rng.sample(range(len(text)), 500)))
    order, words = sort_suffixes(text, wanted)
    keys = [text[i:i + LENGTH] for i in order.tolist()]
    assert keys == sorted(keys) and sorted(order.tolist()) == wanted.tolist()
    inside = order <= len(text) - LENGTH
    same = repeats_of(order[inside], words)
    keys = [k for k, i in zip(keys, inside) if i]
    assert same.tolist() == [i > 0 and keys[i] == keys[i - 1] for i in range(len(keys))]
