import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from reviewsent.llm import oracle, quality
from reviewsent.llm.queries import ORACLE, QUERIES
from reviewsent.llm.quality import js_distance, judge_quality, keep_good

NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (doc, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def cases():
    rng = random.Random(12)
    atoms = ["a", "the", "of", "É", "x|y", "#", "10%", "東京", " ", "🙂", "zz"]
    rows = [(i, " ".join(rng.choice(atoms) + rng.choice(["", "", "\n", "\t"]) for _ in range(rng.randint(0, 90))))
            for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "a b c d e f"), (203, "a b c d e f"), (None, "x " * 30),
             (204, "\n".join(["same line"] * 5 + ["", " "])), (205, "a b c d e a b c d e a b c d e"),
             (206, " ".join(f"w{i % 7000}" for i in range(20_000))), (207, "<" * 500), (208, "a\x0bb\x0cc\x1cd\x85e")]
    return rows


def test_base_columns(docs):
    rows = cases()
    found = [tuple(r[n] for n in NAMES) for r in judge_quality(docs(rows)).collect()]
    assert Counter(found) == Counter(brute(*r) for r in rows)


def test_symbol_junk_goes_and_prose_stays(docs):
    rng = random.Random(13)
    words = "the of and to in house river walks little green under tower said that it was winter".split()
    prose = [(i, " ".join(rng.choice(words) for _ in range(120)) + ".") for i in range(60)]
    junk = [(100, " ".join(rng.choice(words) + "###***%%%" for _ in range(120))), (101, " ".join(w.upper() * 2 for w in words * 5))]
    verdict = {r["doc_id"]: r["kept"] for r in judge_quality(docs(prose + junk)).collect()}
    assert not verdict[100] and not verdict[101]
    assert sum(verdict[i] for i, _ in prose) >= 58
    table = docs([*prose, *junk, (None, prose[0][1])])
    kept = keep_good(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(
        [*(i for i, k in verdict.items() if k), None], key=str)


def letters(rng):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))


def prose_of(rng, words):
    """A fifth of the words are common ones, evenly spread, as in the given documents."""
    common = "the of and to in a is that it for on was be with as by".split()
    return " ".join(rng.choice(common) if i % 5 == 0 else letters(rng) for i in range(words))


def test_word_strings_go_and_prose_stays(docs):
    rng = random.Random(14)
    prose = [(i, prose_of(rng, rng.randint(130, 600))) for i in range(100)]
    strings = [(200 + i, " | ".join(letters(rng) + letters(rng) for _ in range(rng.randint(60, 300)))) for i in range(20)]
    strings += [(300 + i, " ".join(letters(rng) for _ in range(rng.randint(100, 600)))) for i in range(20)]
    found = {r["doc_id"]: r for r in judge_quality(docs(prose + [(*r, None) for r in strings])).collect()}
    assert all(found[i]["kept"] for i, _ in prose)
    assert not any(found[i]["kept"] or found[i]["base_failed"] for i, _ in strings)
    assert all(found[i]["class_distance"] < 0.28 for i, _ in strings)  # so the words decide


def test_short_prose_with_personal_data_stays(docs):
    rng = random.Random(15)
    prose = [(i, prose_of(rng, 200)) for i in range(60)]
    short, junk = [], []
    for i, size in enumerate(range(200, 501, 10)):
        data = (f" {rng.randrange(10**15, 10**16)} +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} "
                f"ab.{rng.randrange(10, 99)}@mail7.example.com 144.137.{rng.randrange(100, 255)}.239 ")
        text = prose_of(rng, 200)
        short.append((100 + i, text[:size - len(data) - 20] + data + text[-20:]))
        junk.append((200 + i, " ".join(w + rng.choice(["###", "***", "%%%"]) for w in text.split())[:size + 60]))
    kept = {r["doc_id"]: r["kept"] for r in judge_quality(docs(prose + [(*r, None) for r in short + junk])).collect()}
    assert all(kept[i] for i, _ in short)
    assert not any(kept[i] for i, text in junk)


SYLLABLES = {
    "fi": "ka la ta va nen sta lla kuu jär vi mai sä tuu li ko ti", "pl": "prze ści ło wa nie sze dom rzy ką ły mo kra wie czo ra my",
    "ru": "пре ста ло го ни ка сем во де рам при ход луч тем ско ры", "el": "κα λη με ρα σπι τι θα λασ σα που νε ρο χω ρι φω ς",
    "tr": "gü neş ev ler de yı lın bah çe su yun ka dar lık tı ğı", "zh": "山 水 日 月 人 大 小 天 地 风 雨 花 草 木 石 光"}


def of_language(rng, name, words):
    parts = SYLLABLES[name].split()
    said = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w.capitalize() + "." if i % 9 == 8 else w for i, w in enumerate(said))


@pytest.mark.parametrize("least", [20, 1000])
def test_no_language_is_lost(docs, monkeypatch, least):
    monkeypatch.setattr(quality, "MIN_REFERENCE", least)
    rng = random.Random(21)
    rows = [(i, prose_of(rng, 200)) for i in range(60)]
    names = list(SYLLABLES)
    rows += [(1000 + i, of_language(rng, names[i % 6], rng.randint(100, 400)), names[i % 6]) for i in range(240)]
    junk = [(2000 + i, " ".join(w + rng.choice(["###", "***", "%%%"]) for w in of_language(rng, names[i % 6], 150).split()),
             names[i % 6]) for i in range(12)]
    strings = [(3000 + i, " ".join(letters(rng) for _ in range(200)), ["en", None][i % 2]) for i in range(10)]
    table = docs(rows + junk + strings)
    kept = {r["doc_id"]: r["kept"] for r in judge_quality(table).collect()}
    assert all(kept[r[0]] for r in rows)
    assert not any(kept[r[0]] for r in strings)
    if least == 20:  # with a reference of each language
        assert not any(kept[r[0]] for r in junk)
    assert {r["doc_id"] for r in keep_good(table).collect()} == {d for d, k in kept.items() if k}
    con = duckdb.connect()
    con.register("documents", table.toArrow())
    monkeypatch.setattr(oracle, "MIN_REFERENCE", least)
    assert {r[0]: r[-1] for r in con.execute(oracle.quality_sql()).fetchall()} == kept


def test_only_the_largest_languages_have_references(docs, monkeypatch):
    monkeypatch.setattr(quality, "MIN_REFERENCE", 2)
    monkeypatch.setattr(quality, "MAX_LANGUAGES", 3)
    rng = random.Random(22)
    rows = [(i, of_language(rng, "fi", 150), f"x{i % 8}") for i in range(41)]
    found = quality.language_references(docs(rows).select("lang", quality.histograms(F.col("text")).alias("f")))
    assert sorted(found) == ["x0", "x1", "x2"]


def test_no_references(docs):
    assert judge_quality(docs([(1, "x")]).where("doc_id > 1")).collect() == []
    rows = judge_quality(docs([(1, "word " * 9 + "a b c d e f g h", None), (2, " ".join(map(str, range(400))), "xx")])).collect()
    assert {r["doc_id"]: r["kept"] for r in rows}[2]


def test_distance(spark):
    row = spark.range(1).selectExpr("array(1, 0) AS a", "array(0, 2) AS b", "array(1, 1) AS c", "array(0, 0) AS d")
    found = row.select(*[js_distance(row[c], [1.0, 0.0]).alias(c) for c in "abcd"]).first()
    assert found["a"] == 0 and found["b"] == 1 and found["c"] == pytest.approx(0.5579, abs=1e-4) and found["d"] is None


def test_same_as_sql(spark, folder):
    for name in ORACLE:
        assert difference(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) is None
