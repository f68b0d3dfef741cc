import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from reviewsent.llm.langid import FAMILY_OF, Identifier, features, fit_svm, gram_counts, identify_language, training_sample
from reviewsent.llm.queries import op4_language_id

PARTS = {"en": "the of and th er ing ou tion wh", "de": "der die und sch ich ung ver ei", "fr": "le la et eau eux ou que é",
         "es": "el la que ción ar os ñ ado", "fi": "ja on ää lla kki yy"}


def say(rng, lang, n):
    parts = PARTS[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_learns_languages_and_odd_rows(docs):
    rng = random.Random(1)
    rows = [(i, say(rng, lang, rng.randint(8, 60)), lang) for i, lang in enumerate(rng.choices(sorted(PARTS), k=600))]
    odd = [(1000, None, "en"), (1001, "", "de"), (1002, "12 + 3", "fr"), (1003, say(rng, "fi", 4000), None),
           (None, say(rng, "es", 40), "es"), (1004, say(rng, "de", 30), None), (1004, say(rng, "de", 30), None)]
    found = identify_language(docs(rows + odd)).collect()
    assert len(found) == len(rows) + len(odd)
    truth = {i: lang for i, _, lang in rows} | {1003: "fi", None: "es", 1004: "de"}
    for r in found:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (1000, 1001, 1002):
            assert r["lang_pred"] == "und"
    judged = [r["lang_pred"] == truth[r["doc_id"]] for r in found if r["doc_id"] in truth and r["held_out"]]
    assert sum(judged) / len(judged) > 0.97


def test_degenerate_tables(docs):
    assert identify_language(docs([(1, "abc", "en")]).where("doc_id > 1")).collect() == []
    assert {r["lang_pred"] for r in identify_language(docs([(1, "abc", None), (2, "x", None)])).collect()} == {"und"}
    assert {r["lang_pred"] for r in identify_language(docs([(1, "abc", "en"), (3, "x", "en")])).collect()} == {"en"}


def test_held_out_accuracy(spark, folder):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = [r for r in op4_language_id(spark, folder).collect() if r["held_out"]]
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in found]
    assert sum(right) / len(right) >= 0.95


def test_sample_has_a_bound(docs):
    """Repeated ids, repeated texts and many languages stay within it, and the draw is the smallest hashes."""
    rows = [(7, f"text {i}", "en") for i in range(300)] + [(i, "copy", "de") for i in range(300)]
    rows += [(i, f"{i % 40}", "fr") for i in range(200)] + [(i, "x", f"l{i}") for i in range(100)] + [(1, None, "en"), (2, "y", None)]
    df = docs(rows).withColumn("held_out", F.lit(False))
    found = training_sample(df, bound=50, languages=4).collect()
    langs = sorted(r["lang"] for r in found)
    assert {lang: langs.count(lang) for lang in langs} == {"en": 50, "de": 1, "fr": 40, "l0": 1}
    hashes = df.where("lang = 'en'").where("text IS NOT NULL").select("text", F.xxhash64("text", F.lit("language sample")).alias("h")).collect()
    smallest = {r["text"] for r in sorted(hashes, key=lambda r: r["h"])[:50]}
    assert {r["text"] for r in found if r["lang"] == "en"} == smallest
    assert len(identify_language(docs(rows), bound=50, languages=4).collect()) == len(rows)


def test_two_levels_against_plain_votes():
    """The decision of both levels, voted for pair by pair with machines of its own."""
    rng = random.Random(2)
    langs = [lang for lang in sorted(PARTS) for _ in range(25)]
    counts = [gram_counts(say(rng, lang, 12)) for lang in langs]
    x = features(np.array(counts))
    identifier = Identifier(counts, langs)

    def vote(labels, rows, one):
        classes = sorted({labels[i] for i in rows})
        wins, sums = dict.fromkeys(classes, 0), dict.fromkeys(classes, 0.0)
        for n, a in enumerate(classes):
            for b in classes[n + 1:]:
                both = [i for i in rows if labels[i] in (a, b)]
                w, c = fit_svm(x[both], np.array([1 if labels[i] == a else -1 for i in both], np.float32))
                margin = float(w @ one + c)
                wins[a if margin >= 0 else b] += 1
                sums[a] += 1 / (1 + np.exp(-3 * margin))
                sums[b] += 1 / (1 + np.exp(3 * margin))
        return max(classes, key=lambda k: (wins[k], sums[k]))

    families = [FAMILY_OF[lang] for lang in langs]
    for lang in sorted(PARTS) * 4:
        text = say(rng, lang, 5)
        one = features(gram_counts(text))
        family = vote(families, range(len(langs)), one)
        assert identifier.predict(text)[0] == vote(langs, [i for i, f in enumerate(families) if f == family], one)
