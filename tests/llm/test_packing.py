import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewsent.llm.packing import CAPACITY, load_encoder, pack_documents, sweep


def test_pieces_and_places(docs):
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice(["the", "Über", "naïve", "x1", "\n", "東京"]) for _ in range(n))
    rows = [(i, say(rng.choice([1, 5, 60, 400, 1500, 5000]))) for i in range(80)]
    rows += [(i, "same text") for i in range(80, 140)]
    rows += [(140, None), (141, ""), (142, "<|endoftext|> x"), (143, "x"), (143, "x"), (None, "y")]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = pack_documents(docs(rows)).collect()
    expected = Counter()
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        start, piece = 0, 0
        while start < len(ids):
            n = (len(ids) - start) % CAPACITY or CAPACITY
            part = ids[start:start + n]
            expected[doc, piece, start, n, zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
            start, piece = start + n, piece + 1
    assert Counter((*r[:5], tuple(r["ids"])) for r in found) == expected
    inside = defaultdict(list)
    for r in found:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for places in inside.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= CAPACITY
        total += end
    assert len(inside) <= math.ceil(total / CAPACITY) + 1


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps.remove(fit)
            gaps.append(fit - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(5))
def test_sweep_is_about_as_good_as_one_by_one(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 100), rng.randint(1, 60), 37, 100]) for _ in range(600)]
    placed = sweep(dict(Counter(lengths)), 100)
    used = defaultdict(list)
    for length, low, high, first, offset in placed:
        for k in range(high - low):
            used[first + k].append((offset, length))
    for places in used.values():
        assert sum(n for _, n in places) <= 100
        assert sorted(o for o, _ in places) == [sum(n for p, n in places if p < o) for o in sorted(o for o, _ in places)]
    assert Counter(n for p in used.values() for _, n in p) == Counter(lengths)
    assert len(used) <= best_fit_decreasing(lengths, 100) * 1.01 + 1


def test_empty_table(docs):
    assert pack_documents(docs([(1, "x")]).where("doc_id > 1")).collect() == []


def test_ids_of_all_characters():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = load_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for low in range(1, 0x30000, 64):
        text = "".join(f"a{c}b1{c}2 {c}{c}.{c}\n" for c in map(chr, range(low, low + 64)) if not "\ud800" <= c <= "\udfff")
        assert encoder.encode(text, allowed_special="all") == tokenizer.encode(text, add_special_tokens=False).ids
