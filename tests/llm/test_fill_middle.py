import hashlib
import random

import pytest
import regex
from pyspark.sql import functions as F

from reviewsent.llm.fill_middle import LINE, fill_in_middle, restored, transform

CASES = ["", "\n", "\n\n\n", "one line", "a\nb", "a\nb\n", "\na", "x\r\ny\r\n", "é東\n\U0001F600\n", "line\n" * 300, "a <P> b\nc", "<S>", "x<M>",
         "<P", "<\nP>\n", "P>\n<S\n>", "<<\n", "\x00\n\x0b z\n"]


def slow(text, doc, seed=7, rate=100, spm=50):
    """Without regular expressions: lines are walked one character at a time."""
    units, line = [], ""
    for c in text or "":
        line += c
        if c == "\n":
            units.append(line)
            line = ""
    units += [line] if line else []
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(f"<{c}>" in text for c in "PSM") or h3 % 100 >= rate:
        return n, "plain", None, None, text or ""
    low, high = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (60, 100), (0, 50)])
def test_equals_brute_force_and_restores(spark, docs, rate, spm):
    rng = random.Random(rate + spm)
    texts = CASES + ["".join(rng.choice("ab\n<>PSM é") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (None, "no id\nhere"), (5, "again\n5"), (5, "again\n5"), (-3, "minus\n")]
    found = fill_in_middle(docs(rows), rate=rate, spm=spm)
    found = found.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    got = sorted((repr((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])) for r in found))
    assert got == sorted(repr((d, *slow(t, d, rate=rate, spm=spm))) for d, t in rows)
    assert sorted(map(repr, ((r["doc_id"], r["back"]) for r in found))) == sorted(repr((d, t or "")) for d, t in rows)
    assert rate == 0 or {"spm", "psm"} & {r["form"] for r in found}


def test_other_units():
    words = regex.compile(r"(\s*+\S++\s*+)*+")
    n, form, low, middle, output = transform(" a b\tc  ", 3, words, rate=100)
    assert n == 3 and form != "plain" and sorted(output.replace("<P>", "").replace("<S>", "").replace("<M>", "")) == sorted(" a b\tc  ")
    assert transform("no digits", 3, regex.compile(r"(\d+)*+")) == (0, "plain", None, None, "no digits")


def test_a_text_of_very_many_lines():
    text = "x\n" * 2_000_000
    n, form, low, middle, output = transform(text, 1, regex.compile(f"({LINE})*+"))
    assert n == 2_000_000 and len(output) == len(text) + 9 and low % 2 == 0 and middle % 2 == 0


def test_empty_table(docs):
    assert fill_in_middle(docs([(1, "x")]).where("doc_id > 1")).collect() == []
