import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewsent.llm import divergence
from reviewsent.llm.divergence import Vocabulary, audit_sources, kept_terms, stretches, transducers
from reviewsent.llm.chunks import dump
from reviewsent.llm.transducer import build, term_spans
from reviewsent.sources.shared import stage_table


def walk(terms, words):
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    starts, ends = term_spans(data)
    assert len(starts) == len(words)
    return build(terms).ordinals(data, starts, ends).tolist()


@pytest.mark.parametrize("seed", range(6))
def test_ordinals_are_places_in_the_sorted_list(seed):
    rng = random.Random(seed)
    letters = ["ab", "abcdefgh", "aé東z", "Zßa\U0001F600"][seed % 4]
    make = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 7))).encode()
    terms = sorted({make() for _ in range(rng.choice([1, 5, 400]))})
    words = [make() for _ in range(500)] + terms + [t[:-1] or t for t in terms] + [t + b"a" for t in terms]
    words = [w for w in words if len(term_spans(np.frombuffer(w + b" ", np.uint8))[0]) == 1]
    place = {t: i for i, t in enumerate(terms)}
    assert walk(terms, words) == [place.get(w, -1) for w in words]


def test_states_are_merged():
    """Words over the same endings: the smallest automaton has a state per remaining language."""
    terms = sorted((a + b + c).encode() for a in "abcd" for b in "efgh" for c in ("", "s", "ing"))
    found = build(terms)
    residuals = {tuple(sorted(t[k:] for t in terms if t.startswith(p))) for t in terms for k in range(len(t) + 1) for p in [t[:k]]}
    assert len(found.final) == len(residuals)
    assert walk(terms, terms) == list(range(len(terms)))


def test_no_terms():
    assert walk([], [b"a"]) == [-1]


def test_shards_that_begin_alike():
    terms = sorted({b"samestart" + bytes([97 + i, 97 + j]) for i in range(9) for j in range(9)} | {b"a", b"samestar", b"z", b"samestart"})
    shards = [(at, terms[at][:8], dump(*build(terms[at:at + 10]).arrays())) for at in range(0, len(terms), 10)]
    words = [*terms, b"samestartzz", b"same", b"b", b"zz", b"A"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    data = np.r_[data, np.uint8(32)]
    assert Vocabulary(shards).ordinals(data, *term_spans(data)).tolist() == [*range(len(terms)), -1, -1, -1, -1, -1]


@pytest.mark.parametrize("most", [1, 7, 5000, 1 << 22])
def test_stretches_keep_terms_whole(most):
    rng = random.Random(most)
    texts = [b"", b"x" * 9000, " ".join("é" * rng.randint(1, 9) for _ in range(50)).encode(), b"a.b..c", b"y" * 4096, b"", b"end"]
    seen = []
    for data, starts, ends, text in stretches(texts, most):
        seen += [(int(t), bytes(data[a:b])) for a, b, t in zip(starts, ends, text)]
    assert seen == [(n, w) for n, t in enumerate(texts) for w in
                    [bytes(np.frombuffer(t + b" ", np.uint8)[a:b]) for a, b in zip(*term_spans(np.frombuffer(t + b" ", np.uint8)))]]


def brute_force(rows, min_docs, top):
    terms_of = lambda t: divergence.re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+",
                                               "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        df[lang].update(set(terms_of(text)))
        counts[lang, source].update(terms_of(text))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        whole = sum((counts[lang, s] for s in sources), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found[:limit], 1)]
    return Counter(out)


def corpus(n, sources):
    rng = random.Random(n)
    words = ["the", "The", "é", "É", "東京", "x", "ab", "abc", "über", "𝛼𝛽", "rare", "it", "s"]
    rows = []
    for i in range(n):
        source = rng.choice(sources) if rng.random() < 0.7 else sources[0]
        pool = words[rng.randint(0, 4):] if source == sources[0] else words
        text = "".join(rng.choice(pool) + rng.choice([" ", "1", "'", "\n", "-", "[", "{", "@"]) for _ in range(rng.choice([0, 3, 30])))
        rows.append((rng.choice([text, text, text, None]), rng.choice(["en", "en", "de", None, "few"[:3] if i % 40 == 0 else "en"]), source))
    return rows + [("", "empty", "a"), (None, "empty", "b"), ("only these words", "one", "a")] + [("same text again", "en", "s1")] * 9


def frame(spark, rows):
    return (spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
            .withColumn("ordinal", F.lit("clash")).withColumn("n", F.lit("clash")).repartition(3))


@pytest.mark.parametrize("sources", [["s0", "s1", None, "", "ü", "z"], [f"s{i}" for i in range(23)]])
def test_equals_brute_force(spark, monkeypatch, sources):
    monkeypatch.setattr(divergence, "TILE", 8)  # several tiles and blocks
    monkeypatch.setattr(divergence, "BLOCK", 3)
    rows = corpus(300, sources)
    found = Counter(tuple(r) for r in audit_sources(frame(spark, rows), min_docs=4, top=5).collect())
    assert found == brute_force(rows, 4, 5)


def test_passes_and_shards_give_the_same_counts(spark):
    rows = frame(spark, corpus(200, ["a", "b"])).na.fill("")
    kept = stage_table(kept_terms(rows, 3), "kept")
    whole = divergence.recount(rows, stage_table(transducers(kept), "whole"))
    parts = divergence.recount(rows, stage_table(transducers(kept, shard_terms=2), "parts"), most=1)
    bag = lambda df: Counter(tuple(r) for r in df.collect())
    assert bag(parts) == bag(whole) and whole.count() > 10


def test_gathered_rows_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(divergence, "GATHERED", 3)
    rows = corpus(120, ["a", "b", "c"])
    assert Counter(tuple(r) for r in audit_sources(frame(spark, rows), 3, 4).collect()) == brute_force(rows, 3, 4)


def test_empty_table(spark):
    assert audit_sources(frame(spark, [("x", "en", "s")]).where("doc_id > 5")).collect() == []


def test_large_counts_stay_exact(spark):
    """Shares of counts beyond 2**63 / 10**9."""
    row = spark.createDataFrame([(40_000_000_000, 90_000_000_000, 7)], "n long, total long, v long")
    assert row.select(divergence.share("n", "total", "v")).first()[0] == 1 + 10**9 * 40_000_000_005 // 90_000_000_035
