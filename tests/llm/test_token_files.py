import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewsent.llm import token_files
from reviewsent.llm.token_files import PARTS, Encoder, Shard, pack_bits, read_ids, write_ids
from reviewsent.sources.shared import new_path

PATH = public_tokenizers.path(token_files.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def ids_of(encoder: Encoder, texts: list[str]) -> list[list[int]]:
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    assert ends[-1] == len(ids) and not ids[ends - 1].any()
    return [ids[a:b - 1].tolist() for a, b in zip(np.r_[0, ends], ends)]


def test_parts_give_the_ids_of_whole_texts(spark, library):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts += ["", "don't it's we'LL I'm'd 'tis", "a  b\n\n c \t\n", "x.'s y!'t", "<|endoftext|> a<|endoftext|>", " é À.’s ß,ſ;", "a  b　 c \n d",
              "1,2 3. 4", "\nA b.\nC\n\nD \nE\r\nF x\n1\n.", " ", "  ", " a", "b ", "é ° x","\x00\x01 \x1c\x1d a\x85 b", "wörld—dash …  "]
    assert all("".join(PARTS.findall(t)) == t for t in texts)
    assert ids_of(Encoder(PATH), texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_parts_are_safe_around_every_character(library):
    encoder = Encoder(PATH)
    for low in range(1, 0x110000, 4096):
        texts = ["".join(f"a{c}b {c}.{c} a. {c}  {c}\n{c}'s{c} {c}{c}! x" for c in map(chr, range(at, at + 64)) if not "\ud800" <= c <= "\udfff")
                 for at in range(low, low + 4096, 64 if low < 0x3000 else 512) if at + 64 <= 0x110000]
        assert ids_of(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_random_mixtures(library, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 50)  # forgotten again and again
    rng = random.Random(5)
    pieces = [" ", "  ", "\n", "\t", "a", "Zé", "ſ", "'s", "'", "'ll", "1", "²", ".", "!?", "’", " ", " ", "東", "ǅ", "́", "_", "<|endoftext|>"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    assert ids_of(Encoder(PATH), texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("width", [1, 3, 7, 8, 11, 16, 17, 20, 32])
def test_bits_and_random_access(width):
    rng = np.random.default_rng(width)
    block, n = 24, 203
    ids = rng.integers(0, 1 << width, n).astype(np.uint32)
    ids[:3] = 0, (1 << width) - 1, 0
    content, offsets = b"", []
    for at in range(0, n, block):
        offsets.append(len(content))
        content += pack_bits(ids[at:at + block], width) + b"\n"
    bits = "".join(f"{int(i):0{width}b}"[::-1] for i in ids[:block])
    assert bits == "".join(f"{b:08b}"[::-1] for b in content[:-(-block * width // 8)])[:len(bits)]
    tail = token_files.struct.pack(token_files.TAIL, 5, n, 1, len(offsets), block, width, token_files.MAGIC)
    index = [np.array(offsets, "<i8"), np.array([9], "<i8"), np.array([n], "<i8"), np.array([False])]
    shard = Shard(content + b"".join(x.tobytes() for x in index) + tail + b"\n")
    assert (shard.shard, shard.doc_ids.tolist(), shard.sizes.tolist()) == (5, [9], [n])
    for start, stop in [(0, n), (23, 25), (100, 100), (n - 1, n), (0, 1), (47, 150)]:
        assert shard.ids(start, stop).tolist() == ids[start:stop].tolist()


def test_another_file_is_refused():
    with pytest.raises(ValueError):
        Shard(b"x" * 100)


@pytest.mark.parametrize("block", [5, 1 << 16])
def test_round_trip(spark, docs, library, block, monkeypatch):
    monkeypatch.setattr(token_files, "STRETCH_BYTES", 50 * block)
    rng = random.Random(block)
    say = lambda n: " ".join(rng.choice(["the", "Über", "naïve", "x1", "\n", "東京", "'s"]) for _ in range(n))
    rows = [(i * 3 - 50, say(rng.choice([1, 5, 60, 400]))) for i in rng.sample(range(60), 60)]
    rows += [(7001, None), (7002, ""), (8000, "same"), (8000, "same"), (None, "null id"), (-1 << 63, "least"), ((1 << 63) - 1, "most")]
    rows += [(7000, "hot " * (i % 4)) for i in range(80)]
    path = new_path(spark, "ids")
    write_ids(docs(rows), path, block=block, shard_bytes=300)
    found = sorted(read_ids(spark, path).collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len(keys) == len(rows)
    expected = Counter((doc, tuple(library.encode(text or "", add_special_tokens=False).ids) + (0,)) for doc, text in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in found) == expected
    start = 0
    for r in found:
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes()))
        start += r["n_tokens"]


def test_stretches_are_short_and_whole():
    batches = [pa.RecordBatch.from_pydict({"doc_id": range(at, at + 1000), "text": ["wort " * 1000] * 1000, "part": [3] * 1000}) for at in (0, 1000)]
    found = list(token_files._stretches(batches))  # 10 MB; encoding takes some 20 times a stretch
    assert [k for keys, _, _ in found for k in keys.to_pylist()] == list(range(2000)) and {part for _, _, part in found} == {3}
    assert max(texts.nbytes for _, texts, _ in found) < 5 << 20


def test_files_are_small_and_several(spark, docs):
    path = new_path(spark, "ids")
    write_ids(docs([(i, "word " * 200) for i in range(50)]), path, shard_bytes=2000)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    shards = [Shard(bytes(r["content"])) for r in files]
    assert len(shards) > 8 and sum(s.n_ids for s in shards) == 50 * 202
    assert all(s.width == 16 and len(s.content) < 2 * s.n_ids + 17 * len(s.sizes) + 8 * len(s.offsets) * 2 + 60 for s in shards)


def test_empty_table(spark, docs):
    path = new_path(spark, "ids")
    write_ids(docs([(1, "x")]).where(F.col("doc_id") > 1), path)
    assert read_ids(spark, path).collect() == []
