import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from reviewsent.llm import pitman_yor
from reviewsent.llm.pitman_yor import CLASSES, LEAVES, Bucket, Totals, score_documents


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def rows():
    rng = random.Random(11)
    follow = {"the": ["cat", "dog", "Éa"], "a": ["cat", "bird"], "cat": ["sat", "ran"], "dog": ["ran"], "bird": ["sang"],
              "sat": ["on"], "on": ["the", "a"], "ran": ["to"], "to": ["the"], "sang": ["on"], "Éa": ["ran"]}
    out = []
    for i in range(400):
        word, text = rng.choice(["the", "a"]), []
        for _ in range(rng.randint(1, 40)):
            text.append(word)
            word = rng.choice(follow[word]) if rng.random() < 0.95 else f"rare{rng.randrange(900)}"
            if word not in follow:
                text.append(word)
                word = "the"
        out.append((i, " ".join(text).replace("the", "THE") if i % 3 else "\n".join(text)))
    return out + [(900, None), (901, ""), (902, " \t "), (903, "x"), (903, "x"), (None, "the cat"), (904, "the " * 3000)]


def test_base_columns_and_better_than_base(docs, monkeypatch):
    monkeypatch.setattr(pitman_yor, "CHUNK_BYTES", 500)
    monkeypatch.setattr(pitman_yor, "GROUP", 8)
    data = rows()
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    count = Counter(t for d, text in data if not out(d) for t in tokens(text))
    n, v = sum(count.values()), len(count)
    found = score_documents(docs(data)).collect()
    expected = Counter((d, out(d), len(tokens(t)), sum(count[x] > 0 for x in tokens(t)), n,
                        round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in tokens(t)), 6)) for d, t in data)
    assert Counter((*r[:5], round(r["base_score"], 6)) for r in found) == expected
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)  # both negative
    assert all(r["score"] < 0 for r in found)
    again = score_documents(docs(data)).collect()
    assert abs(sum(r["score"] for r in again) / sum(r["score"] for r in found) - 1) < 0.02


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    n = 30
    entry = np.unique(rng.integers(0, n, 4000) * LEAVES + rng.integers(0, 3, 4000) * CLASSES + rng.integers(0, 3, 4000))
    bucket = Bucket.__new__(Bucket)
    bucket.words, bucket.count = np.arange(n).astype(np.uint64), rng.integers(1, 400, len(entry))
    bucket._set(entry // LEAVES, entry % LEAVES)
    bucket.first_seating()
    model = Totals([*bucket.totals(), *bucket.counts_of_counts()])
    for _ in range(4):
        bucket.sweep(model, rng)
        assert (bucket.tables <= bucket.count).all() and (bucket.pair_tables <= bucket.pair_count).all()
        model = model.with_seating(bucket.totals())
    root, pair, leaf = bucket.probabilities(model)
    unknown = model.predict(0, 0, 0, 0, model.uniform)
    assert root.sum() + unknown == pytest.approx(1)
    for context in range(3):
        mine = bucket.pair_class == context
        rest = 1 - pair[mine].sum()
        other = np.setdiff1d(np.arange(n), bucket.pair_word[mine])
        assert rest == pytest.approx(sum(model.predict(1, context, 0, 0, root[w]) for w in other)
                                     + model.predict(1, context, 0, 0, unknown))


def test_seating_follows_the_restaurant():
    """Tables of n customers at a sure parent have a known mean."""
    model = Totals([(0, 0, 0.0, 0.0)])
    model.discount[0] = 0.5
    n, mean = 40, 1.0
    for k in range(1, n):
        mean += 1.0 / (1.0 + k - 0.5 * mean)
    found = model.seat(0, 0, np.full(20_000, n), np.ones(20_000), np.random.default_rng(3)).mean()
    assert found == pytest.approx(mean, rel=0.05)


def test_degenerate_tables(docs):
    assert score_documents(docs([(1, "x")]).where("doc_id > 1")).collect() == []
    lone = [d for d in range(60) if zlib.crc32(str(d).encode()) % 7 == 2][0]
    found = score_documents(docs([(lone, "a b")])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found] == [(3, 0, 0, 0, 0)]


def test_words_are_contexts(docs, monkeypatch):
    """Each of 200 words has a successor of its own, also where entries after frequent words are salted."""
    rng = random.Random(5)
    data = [(i, " ".join(f"the first{k} second{k}" for k in (rng.randrange(200) for _ in range(30)))) for i in range(200)]
    found = {}
    for frequent in (pitman_yor.FREQUENT, 0):
        monkeypatch.setattr(pitman_yor, "CHUNK_BYTES", 4000)
        monkeypatch.setattr(pitman_yor, "frequent_words", lambda texts, buckets, limit, n=frequent, f=pitman_yor.frequent_words: (
            f(texts, buckets, limit) if n else pitman_yor.Frequent(np.zeros(0, np.uint64), np.zeros(0, np.uint64), buckets)))
        held = [r for r in score_documents(docs(data)).collect() if r["held_out"]]
        found[frequent] = sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held)
        monkeypatch.undo()
    salted, plain = found.values()
    assert salted > -1.0  # of three words one is a choice of 200; 15 classes of contexts would add a choice of 13: -1.14
    assert salted == pytest.approx(plain, rel=0.05)  # totals of frequent words settle a pass later


def test_merged_entries_keep_their_places(monkeypatch):
    """Each chunk finds its own entries among the merged ones, also when they are merged a few messages at a time."""
    rng = np.random.default_rng(4)
    sent = []
    for _ in range(23):
        rows = sorted({tuple(r) for r in rng.integers(0, 6, (40, 3)).tolist()})
        names = np.sort(rng.choice(1000, 6, replace=False)).astype(np.uint64) + np.uint64(5 << 32)
        sent.append((names, np.array(rows), rng.integers(0, 9, len(rows))))
    count = Counter()
    for names, rows, n in sent:
        for row, k in zip(names[rows].tolist(), n.tolist()):
            count[tuple(row)] += k
    for group in (4, 23):
        monkeypatch.setattr(pitman_yor, "GROUP", group)
        (words, contexts, context, word, learned), places = pitman_yor.merge_entries([
            (*pitman_yor.unpack_entries(*pitman_yor.pack_entries(names, *rows.T)), n) for names, rows, n in sent])
        two, one = words[contexts // CLASSES][context], words[contexts % CLASSES][context]
        merged = list(zip(two.tolist(), one.tolist(), words[word].tolist()))
        assert merged == sorted(count) and dict(zip(merged, learned.tolist())) == count
        for (names, rows, _), at in zip(sent, places):
            assert [merged[k] for k in at] == [tuple(r) for r in names[rows].tolist()]


def test_entries_are_sent_once(docs, spark, monkeypatch, tmp_path):
    """What a run leaves: tokens, restaurants and scores; no shuffle of entries or restaurants, no passing messages.
    Sent once to be merged and again to be answered, entries and restaurants took several times the texts."""
    rng = random.Random(8)
    data = [(i, " ".join(f"{rng.randrange(1 << 60):x}" for _ in range(100))) for i in range(300)]
    monkeypatch.setattr(pitman_yor, "CHUNK_BYTES", 100_000)
    monkeypatch.setattr("reviewsent.sources.shared.new_path", lambda _, name: f"{tmp_path}/{name}-{rng.random()}")
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()  # other sessions have folders beside it
    shuffled = lambda: sum(p.stat().st_size for f in blocks.localDirsString() for p in Path(f).glob("*/shuffle_*.data"))
    before = shuffled()
    found = score_documents(docs(data))
    most, ends = before + 0.2 * sum(len(text) for _, text in data), time.monotonic() + 30
    while shuffled() > most and time.monotonic() < ends:  # Spark may still be deleting
        time.sleep(0.2)
    assert shuffled() <= most
    assert found.count() == len(data)
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["numbered_tokens", "restaurants", "scores"]
