import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from reviewsent.llm import pii, quality
from reviewsent.llm.packing import CAPACITY
from reviewsent.llm.suffix_dedup import LENGTH
from test_minhash import brute as near_copies


@pytest.fixture(scope="module")
def folder_of(spark, docs, tmp_path_factory):
    def write(rows):
        path = str(tmp_path_factory.mktemp("corpus"))
        docs(rows).write.parquet(f"{path}/documents.parquet")
        return path
    return write


def rows():
    rng = random.Random(21)
    words = "the of and to in house river walks little green under tower said that it was winter stone".split()
    say = lambda n: " ".join(rng.choice(words) + rng.choice(["", "s", "er", "x"]) for _ in range(n))
    base, passage = say(150), say(60)
    out = [(i, say(rng.randint(20, 400))) for i in range(40)]
    out += [(i, base if i % 2 else base + f" tail {i}") for i in range(40, 50)]
    out += [(i, f"{say(70)} {passage} {say(70)}") for i in range(50, 56)]
    out += [(56, "mail jo.e@mail.example.com or +1 (555) 123-4567 " + say(50)), (57, "short text"), (58, None), (59, ""),
            (60, "### $$$ &&& " * 100), (61, "again and again it was so " * 40), (62, say(4000)), (None, say(90))]
    rng.shuffle(out)
    return out


def brute(data, verdicts):
    data = [(d, t) for d, t in data if verdicts[d]]
    stays = {r[0] for r in near_copies(data) if r[3]}
    data = [(d, t) for d, t in data if d in stays]
    first = {}
    for d, t in data:
        b = t.encode()
        for i in range(len(b) - LENGTH + 1 if d is not None else 0):
            first[b[i:i + LENGTH]] = min(first.get(b[i:i + LENGTH], d), d)
    model, tokenizer = pii.Model(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = Counter()
    for d, t in data:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - LENGTH + 1 if d is not None else 0):
            gone[i:i + LENGTH] |= first[b[i:i + LENGTH]] < d
        t = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        t = pii.redact(t, pii.all_spans(t, model)[1])
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [0]
        start, piece = 0, 0
        while start < len(ids):
            n = (len(ids) - start) % CAPACITY or CAPACITY
            out[d, piece, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())] += 1
            start, piece = start + n, piece + 1
    return out


def test_same_as_brute_force(spark, docs, folder_of):
    data = rows()
    verdicts = {r["doc_id"]: r["kept"] for r in quality.judge_quality(docs(data)).collect()}
    assert not any(verdicts[d] for d in (57, 58, 59, 60, 61)) and sum(verdicts.values()) >= 50
    found = corpus_pipeline.run(spark, folder_of(data)).collect()
    assert Counter(tuple(r[:5]) for r in found) == brute(data, verdicts)
    ends = Counter()
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= CAPACITY


def test_stages_keep_the_columns_and_act(spark, docs):
    table = docs(rows())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, table, "")
        assert after.schema.simpleString() == table.schema.simpleString(), name
        before, rest = table.count(), after.count()
        assert 0 < rest <= before
        assert (rest < before) == (name in ("quality rules", "near dedup")), name
        assert {(r["lang"], r["source"], r["chunk"]) for r in after.collect()} == {("en", "s", "c")}


def test_empty_table(spark, docs):
    table = docs([(1, "x")]).where("doc_id > 1")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table, "").collect() == []


def test_registered():
    import __spark_entry__
    from reviewsent.llm.queries import ORACLE, QUERIES
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
