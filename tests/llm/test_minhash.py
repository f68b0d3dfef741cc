import random
import re

import numpy as np
import pytest

from reviewsent.llm import minhash
from reviewsent.llm.components import components
from reviewsent.llm.minhash import drop_copies, group_copies


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def closure(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    edges = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i]
             if a is not None and b is not None and (a == b or 100 * len(s & t) >= 75 * len(s | t) and s & t)]
    label = closure([d for d, _ in rows if d is not None], edges)
    return sorted(((d, len(s), label.get(d), d is None or label[d] == d) for d, s in sets), key=str)


def cases():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ß", "THE"]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]

    def change(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        return words
    base = say(120)
    rows = [(i, " ".join(say(rng.randint(1, 80)))) for i in range(40)]
    rows += [(i, " ".join(change(base, rng.randint(0, 5)))) for i in range(40, 110)]
    chain = say(100)
    for i in range(110, 140):
        chain = change(chain, 2)
        rows.append((i, "\n".join(chain).upper()))
    rows += [(140, None), (141, ""), (142, " \t"), (143, "a b"), (144, "A  B"), (145, "a b c"), (None, "a b"),
             (None, " ".join(base)), (146, "x"), (146, "x"), (-7, " ".join(base)), (147, " ".join(["ab"] * 5000)),
             (148, "ab ab ab ab ab ab"), (150, "p q r s t u"), (150, "k l m n o p"), (151, "k l m n o p")]
    rng.shuffle(rows)
    return rows


def test_same_as_brute_force(docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "GROUP", 8)
    rows = cases()
    assert sorted(map(tuple, group_copies(docs(rows)).collect()), key=str) == brute(rows)


def several_texts():
    """Documents with two texts each, whose near copies (no exact ones) are other documents."""
    rng = random.Random(8)
    say = lambda: [f"v{rng.randrange(5000)}" for _ in range(80)]
    near = lambda words: words[:40] + ["new"] + words[41:]
    rows = []
    for k in range(6):
        one, other, last = say(), say(), say()
        rows += [(100 * k + 50, " ".join(one)), (100 * k + 50, " ".join(other)), (100 * k + 51, " ".join(near(one))),
                 (100 * k + 20, " ".join(near(other))), (100 * k + 70, " ".join(last)), (100 * k + 20, " ".join(near(last))),
                 (100 * k + 80, None), (100 * k + 80, " ".join(near(near(last)))), (100 * k + 81, " ")]
    rng.shuffle(rows)
    return rows


def test_each_text_of_a_document_links(docs):
    rows = several_texts()
    expected = brute(rows)
    found = group_copies(docs(rows))
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert {r["component_id"] for r in found.collect()} == {100 * k + i for k in range(6) for i in (20, 81)}


def test_one_row_stays_per_document_and_text(docs):
    rows = several_texts() + [(7, "one two three four five six"), (7, "one two three four five six"), (7, "another text"),
                              (8, "ONE two three four five six"), (None, "x"), (None, "x"), (9, None), (9, None), (9, "")]
    table = docs(rows)
    found = drop_copies(table)
    assert found.columns == table.columns
    kept = {d for d, _, _, k in brute(rows) if k}
    expected = {r for r in rows if r[0] in kept and r[0] is not None}
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str) == sorted([*expected, (None, "x"), (None, "x")], key=str)


def test_empty_table(docs):
    assert drop_copies(docs([(1, "x")]).where("doc_id > 1")).collect() == []
    assert group_copies(docs([(1, "x")]).where("doc_id > 1")).collect() == []


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(99, i) for i in range(50)],
             "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)], "none": []}[shape]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [e for e in edges if e[0] != e[1]]
    assert found == closure({n for e in real for n in e}, real)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 62, 2000, np.uint64)
    one, other = np.unique(values[:1500]), np.unique(values[500:])
    rows = minhash.signatures([one, other])
    assert abs((rows[0] == rows[1]).mean() - 0.5) < 0.2
