"""Quality rules: repetition and size rules, then distribution divergence from language references.

Two histograms are made of every whole text: one over character classes, one over the
common words of each language. Each language's reference is the mean histogram of the
documents of that language, over all rows. A document is compared with every reference by
the Jensen-Shannon distance and judged by the nearest; short documents are guarded, as
their histograms say little. Everything is SQL functions, without a shuffle of texts.

Common words are known for the languages of :data:`COMMON_WORDS` only, so words judge texts of
these languages and of a null ``lang``. Character classes judge every text whose language has a
reference: those languages, and any other with :data:`MIN_REFERENCE` texts long enough (the
:data:`MAX_LANGUAGES` largest of them). A text of a language without a reference is judged by the
base rules alone, as nothing is known that it could diverge from.

Defined results for odd input: a null, empty or blank text has no words, so it fails the
base rules. Repeated rows are judged alike, one row each. A null ``lang`` adds to no reference and
is judged by those of the languages of :data:`COMMON_WORDS`; with no reference at all, the base rules alone decide.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from reviewsent.sources.shared import stage_table

#: Frequent function words. A word of several languages counts in each.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "by"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem",
           "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
}
WORDS = sorted({word for words in COMMON_WORDS.values() for word in words})

SPACE = r"[\x20\x09-\x0D]+"
#: Character classes as pairs of name and pattern of the characters; the rest is ``other``.
CLASSES = {"lower": r"[^a-z]+", "upper": r"[^A-Z]+", "digit": r"[^0-9]+", "space": r"[^\x20\x09-\x0D]+",
           "stop": r"[^.,;:!?'\"()\-]+", "symbol": r"[^#*$%&|<>@^_=+~/\\{}\[\]`]+"}

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Below so many characters or words a histogram is not compared.
GUARD_CHARS, GUARD_WORDS = 250, 100
#: Texts that make a reference of a language without a word list, and most such languages.
MIN_REFERENCE, MAX_LANGUAGES = 100, 200
#: Largest Jensen-Shannon distance (0 to 1) from the nearest reference. A text without common words lies 0.32 to 0.33
#: from references with a fifth of common words, so the word distance must stay below that.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.34, 0.27


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda variable is never computed again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _covered(words: Column, hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: sort the windows by hash, keep those
    with an equal neighbour, and join the places they cover."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(pair):
        n = F.size(pair)

        def place(p, i):
            before = F.when(i > 0, F.get(pair, i - 1)["h"] == p["h"]).otherwise(False)
            after = F.when(i < n - 1, F.get(pair, i + 1)["h"] == p["h"]).otherwise(False)
            return F.when(before | after, p["i"])
        return F.sort_array(F.filter(F.transform(pair, place), lambda i: i.isNotNull()))

    def covered(places):
        state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            places, state,
            lambda s, i: F.struct((s["n"] + i + 5 - F.greatest(i, s["end"])).alias("n"), (i + 5).alias("end")),
            lambda s: s["n"])
    return _let(_let(pairs, repeated), covered)


def _repeat_words(words: Column) -> Column:
    """Words in five-word windows found twice or more in the text, the first ones included."""
    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 5),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)]))

    def count(w, h):
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_covered(w, h))
    return F.when(F.size(words) < 6, 0).otherwise(_let(words, lambda w: _let(windows(w), lambda h: count(w, h))))


def _histogram(places: Column, bins: int) -> Column:
    """Counts of 1..bins in an array of small numbers."""
    return _let(places, lambda p: F.array(*[F.size(p) - F.size(F.array_remove(p, F.lit(i + 1))) for i in range(bins)]))


def _lines_repeated(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _common(words: Column) -> Column:
    """Numbers (from 1) of the common words among ``words``, case ignored."""
    numbers = F.create_map(*[x for i, w in enumerate(WORDS) for x in (F.lit(w), F.lit(i + 1))])
    lower = F.transform(F.filter(words, lambda w: F.length(w) <= max(map(len, WORDS))), F.lower)
    return F.transform(F.filter(lower, lambda w: w.isin(WORDS)), lambda w: F.element_at(numbers, w))


def _histograms(t: Column, words: Column) -> list[Column]:
    """Sizes and the two histograms of a text."""
    n = F.length(t)
    classes = [F.length(F.regexp_replace(t, pattern, "")) for pattern in CLASSES.values()]
    return [n.cast("long").alias("n_chars"), F.size(words).cast("long").alias("n_words"),
            _let(F.array(*classes), lambda c: F.concat(
                c, F.array(n - F.aggregate(c, F.lit(0), lambda a, x: a + x)))).alias("classes"),
            _let(_histogram(_common(words), len(WORDS)), lambda c: F.concat(
                c, F.array(F.size(words) - F.aggregate(c, F.lit(0), lambda a, x: a + x)))).alias("common")]


def histograms(text: Column) -> Column:
    """What the references need of a text (null: as empty)."""
    return _let(F.coalesce(text, F.lit("")), lambda t: _let(_words(t), lambda w: F.struct(*_histograms(t, w))))


def quality_features(text: Column) -> Column:
    """A struct of the base counts and the two histograms of a text (null: as empty)."""
    def of_words(t, words):
        return F.struct(
            F.length(F.regexp_replace(t, SPACE, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            _lines_repeated(t).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"), *_histograms(t, words))
    return _let(F.coalesce(text, F.lit("")), lambda t: _let(_words(t), lambda w: of_words(t, w)))


def _entropy(distribution: Column) -> Column:
    return -F.aggregate(distribution, F.lit(0.0), lambda s, x: s + F.when(x > 0, x * F.log2(x)).otherwise(0.0))


def js_distance(counts: Column, *references: list[float] | Column) -> Column:
    """The smallest Jensen-Shannon distance (base 2, 0 to 1) of a histogram from reference distributions, of which null
    ones are passed over; null if it is empty. The divergence is the entropy of the mean less the mean of the entropies."""
    def nearest(p):
        own = _entropy(p)

        def divergence(reference):
            if isinstance(reference, Column):
                q, other = reference, _entropy(reference)
            else:
                q = F.array(*[F.lit(float(x)) for x in reference])
                other = F.lit(float(-sum(x * math.log2(x) for x in reference if x > 0)))
            mean = _entropy(F.zip_with(p, q, lambda a, b: (a + b) / 2))
            return lambda h: F.when(q.isNotNull(), mean - (h + other) / 2)
        all_of = [divergence(r) for r in references]
        return _let(own, lambda h: F.sqrt(F.greatest(F.array_min(F.array(*[d(h) for d in all_of])), F.lit(0.0))))

    def of(c):
        n = F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
        return _let(n, lambda total: F.when(total > 0, _let(F.transform(c, lambda x: x / total), nearest)))
    return _let(counts, of)


def language_references(rows: DataFrame) -> dict[str, dict[str, list[float]]]:
    """Mean histograms per language, over all texts long enough; ``rows`` has ``lang`` and the :func:`histograms` ``f``.

    Languages without a word list get one of character classes, the :data:`MAX_LANGUAGES` that have the most texts,
    :data:`MIN_REFERENCE` at least. One row per language, whatever the number of documents.
    """
    sizes = {"classes": len(CLASSES) + 1, "common": len(WORDS) + 1}
    guards, whole = _guards(F.col("f")), {"classes": F.col("f.n_chars"), "common": F.col("f.n_words")}
    sums = [F.avg(F.when(guards[k], F.get(F.col(f"f.{k}"), F.lit(i)) / whole[k])).alias(f"{k}_{i}")
            for k, n in sizes.items() for i in range(n)]
    means = rows.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count_if(guards["classes"]).alias("texts"), *sums)
    listed = F.col("lang").isin(list(COMMON_WORDS))
    wanted = (means.where(listed | (F.col("texts") >= MIN_REFERENCE)).orderBy(listed.desc(), F.desc("texts"), "lang")
              .limit(len(COMMON_WORDS) + MAX_LANGUAGES))
    found, others = {}, 0
    for row in wanted.collect():
        others += row["lang"] not in COMMON_WORDS
        if others > MAX_LANGUAGES:  # a listed language without texts left its place to one more
            break
        found[row["lang"]] = {k: values for k, n in sizes.items() if (k == "classes" or row["lang"] in COMMON_WORDS)
                              and (values := [row[f"{k}_{i}"] for i in range(n)])[0] is not None}
    return found


def _guards(f: Column) -> dict[str, Column]:
    return {"classes": f["n_chars"] >= GUARD_CHARS, "common": f["n_words"] >= GUARD_WORDS}


def distance(f: Column, lang: Column, kind: str, references: dict[str, dict[str, list[float]]]) -> Column:
    """From the nearest reference, those of the languages with word lists and the text's own; null for a short text
    and for one that has nothing to be compared with."""
    known = [r[kind] for name, r in sorted(references.items()) if name in COMMON_WORDS and kind in r]
    own = {name: r[kind] for name, r in sorted(references.items()) if name not in COMMON_WORDS and kind in r}
    judged = lang.isNull() | lang.isin([*COMMON_WORDS, *own])
    if own:
        table = F.create_map(*[x for name, values in own.items() for x in (F.lit(name), F.array(*map(F.lit, values)))])
        known.append(F.try_element_at(table, lang))
    return F.when(_guards(f)[kind] & judged, js_distance(f[kind], *known)) if known else F.lit(None).cast("double")


def base_failed(f: Column) -> Column:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])


def passes(f: Column, lang: Column, references: dict[str, dict[str, list[float]]]) -> Column:
    """True for a text that meets the base rules and lies near a reference, where there is one to compare it with."""
    near = {k: F.coalesce(distance(f, lang, k, references), F.lit(0.0)) for k in ("classes", "common")}
    return ~base_failed(f) & (near["classes"] <= MAX_CLASS_DISTANCE) & (near["common"] <= MAX_WORD_DISTANCE)


def judge_quality(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance, word_distance)``, one row per row of ``documents``.

    The features, some numbers per text, are written once: the references need all of them before any
    document is judged.
    """
    rows = stage_table(documents.select(F.col(key), F.col(lang).alias("lang"), quality_features(F.col(text)).alias("f")),
                       "quality_features")
    references, f, own = language_references(rows), F.col("f"), F.col("lang")
    return rows.select(key, *(f"f.{n}" for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                       base_failed(f).alias("base_failed"), passes(f, own, references).alias("kept"),
                       distance(f, own, "classes", references).alias("class_distance"),
                       distance(f, own, "common", references).alias("word_distance"))


def keep_good(documents: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``documents`` that pass, unchanged. Histograms are computed twice, for the references and
    for the verdicts, so no text is written."""
    references = language_references(documents.select(F.col(lang).alias("lang"), histograms(F.col(text)).alias("f")))
    return documents.where(_let(quality_features(F.col(text)), lambda f: passes(f, F.col(lang), references)))
