import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from reviewsent.llm.pieces import MODEL, Pieces, decode_ids, encode_documents
from reviewsent.llm.queries import op7_sentencepiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def cases():
    rng = random.Random(6)
    atoms = ["the", "ing", "ation", "über", "Ж", "東京", "🙂", " ", "  ", "\n", "\t", "1", "2024", "é", "q", "xx", ".", "...", "\0", "<s>",
             "l'", "Hello", "世", " ", "é"]
    rows = [(i, "".join(rng.choice(atoms) for _ in range(rng.randint(1, 60)))) for i in range(150)]
    return rows + [(200, None), (201, ""), (202, " "), (203, "a" * 3000), (204, " " * 500 + "x"), (205, "abcdefgh" * 400),
                   (206, "x"), (206, "x"), (None, "null key"), (207, "the " * 5000), (208, "東" * 200)]


def test_same_as_library_and_back(docs, library):
    rows = cases()
    found = encode_documents(docs(rows)).withColumn("back", decode_ids(F.col("ids"), Pieces())).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        text = texts[r["doc_id"]] or ""
        ids = library.encode(text)
        assert r["ids"] == ids, text
        assert r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r["back"] == text


def test_empty_table(docs):
    assert encode_documents(docs([(1, "x")]).where("doc_id > 1")).collect() == []


def test_documents(spark, folder, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op7_sentencepiece(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r["ids_crc32"] == zlib.crc32(np.array(library.encode(texts[r["doc_id"]]), "<u4").tobytes())
        assert r["text_sha256"] == r["decoded_sha256"]
