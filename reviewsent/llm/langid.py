"""Language identification in two levels: the family first, then the languages within it.

Both levels are one-versus-one linear support vector machines on hashed byte bigrams and trigrams
of the whole text. They are fitted on a bounded sample of the labelled training rows, at most
:data:`SAMPLE` distinct texts of each of the :data:`LANGUAGES` languages with most training rows, drawn by hash;
everything else covers all rows.

Defined results for odd input: a null text, or one without a letter, is ``und`` with score 0. Rows
without ``lang`` are predicted but not learned from, and so are rows of languages beyond the bound. A row without ``doc_id`` counts as remainder 0.
With one learned language all others get it; with none, all are ``und``. Repeated rows are
predicted alike, one row each.
"""

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewsent.llm.chunks import dump, load, mapped, slices
from reviewsent.sources.shared import stage_table

#: Families of language codes. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tt",
    "indic": "hi ur bn mr gu pa ne si",
    "semitic": "ar he am mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: Bounds of the training sample: distinct texts per language, and languages, of which those with most rows are learned.
SAMPLE, LANGUAGES = 1000, 200
DIMENSIONS = 4096
LETTER = regex.compile(r"\p{L}")
HELD_OUT = 2

RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def held_out(key: Column) -> Column:
    """The rows never learned from: crc32 of the key as text leaves 2 on division by 4."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT


def gram_counts(text: str) -> np.ndarray:
    """Hashed counts of the byte bigrams and trigrams of the whole text, A-Z in lower case."""
    data = np.frombuffer(b" " + text.encode("utf-8", "surrogatepass").lower() + b" ", np.uint8)
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(data) - 1, 1 << 20):
        part = data[at:at + (1 << 20) + 2].astype(np.uint32)
        two = part[:-1] << 8 | part[1:]
        three = two[:-1] << 8 | part[2:]
        n = min(1 << 20, len(two))
        for codes, salt in ((two[:n], np.uint32(0x85EBCA6B)), (three[:1 << 20], np.uint32(0x9E3779B1))):
            mixed = codes * salt
            mixed ^= mixed >> np.uint32(15)
            counts += np.bincount((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(20), minlength=DIMENSIONS)
    return counts


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of relative frequencies: rows of length 1."""
    return np.sqrt(counts / np.maximum(counts.sum(-1, keepdims=True), 1)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 20.0, rounds: int = 120) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine for ``y`` of -1 and 1, by accelerated gradient steps on all rows."""
    weights = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum()).astype(np.float32)
    x1 = np.c_[x, np.ones(len(x), np.float32)]
    w = v = np.zeros(x1.shape[1], np.float32)
    step, momentum = 1.0 / (1.0 + 4.0 * c), 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        gradient = v - 2 * c * (x1.T @ (weights * y * slack))
        following, faster = v - step * gradient, (1 + (1 + 4 * momentum ** 2) ** 0.5) / 2
        v, w, momentum = following + (momentum - 1) / faster * (following - w), following, faster
    return w[:-1], float(w[-1])


class OneVersusOne:
    """A machine for each pair of classes; the class with most wins, then the largest margins, is taken."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        self.classes = sorted(set(labels))
        self.pairs = list(combinations(range(len(self.classes)), 2))
        number = np.array([self.classes.index(label) for label in labels])
        machines = []
        for a, b in self.pairs:
            rows = np.flatnonzero((number == a) | (number == b))
            machines.append(fit_svm(x[rows], np.where(number[rows] == a, 1, -1).astype(np.float32)))
        self.w = np.array([w for w, _ in machines], np.float32).reshape(len(machines), x.shape[1])
        self.b = np.array([b for _, b in machines], np.float32)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """The class and a score: the mean probability with which it wins its pairs."""
        if not self.pairs:
            return self.classes[0], 1.0
        wins, sums = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        for (a, b), margin in zip(self.pairs, (self.w @ x + self.b).tolist()):
            p = 1 / (1 + np.exp(-3 * margin))
            wins[a if margin >= 0 else b] += 1
            sums[a] += p
            sums[b] += 1 - p
        best = max(range(len(self.classes)), key=lambda k: (wins[k], sums[k]))
        return self.classes[best], float(sums[best] / (len(self.classes) - 1))


class Identifier:
    def __init__(self, counts: list[np.ndarray], langs: list[str]):
        x = features(np.array(counts))
        families = [FAMILY_OF.get(lang, lang) for lang in langs]
        self.families = OneVersusOne(x, families)
        self.languages = {}
        for family in set(families):
            rows = [i for i, f in enumerate(families) if f == family]
            self.languages[family] = OneVersusOne(x[rows], [langs[i] for i in rows])

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not LETTER.search(text):
            return "und", 0.0
        x = features(gram_counts(text))
        family, first = self.families.predict(x)
        lang, second = self.languages[family].predict(x)
        return lang, first * second


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1024):
        counts = [dump(gram_counts(t).astype(np.uint32)) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(counts, pa.binary())], ["lang", "counts"])


def training_sample(rows: DataFrame, bound: int = SAMPLE, languages: int = LANGUAGES) -> DataFrame:
    """``(lang, text)``: the ``bound`` distinct training texts of smallest hash of each of ``languages`` languages.

    Equal texts of a language count once, so neither repeated rows nor repeated ids exceed the bound. Hashes are merged in
    the tasks and shuffled first; the texts follow of those only that are drawn.
    """
    labelled = rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64("text", F.lit("language sample")).alias("draw"))
    draws = stage_table(labelled.select("lang", "draw").distinct(), "language_draws")
    largest = draws.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(languages)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    last = (draws.join(F.broadcast(largest.select("lang")), "lang").withColumn("place", place).where(F.col("place") <= bound)
            .groupBy("lang").agg(F.max("draw").alias("last")))  # at most ``languages`` rows
    return (labelled.join(F.broadcast(last), "lang").where(F.col("draw") <= F.col("last"))
            .groupBy("lang", "draw").agg(F.min("text").alias("text")).select("lang", "text"))


def fit(rows: DataFrame, bound: int = SAMPLE, languages: int = LANGUAGES) -> Identifier | None:
    # what reaches the driver is the bounded sample, as counts
    found = training_sample(rows, bound, languages).mapInArrow(mapped(_count), "lang string, counts binary").collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["counts"])))
    return Identifier([load(bytes(r["counts"]))[0] for r in found], [r["lang"] for r in found]) if found else None


def _predict(identifier: Identifier | None):
    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            found = [identifier.predict(t) if identifier else ("und", 0.0) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], schema=RESULT)
    return predict


def identify_language(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                      bound: int = SAMPLE, languages: int = LANGUAGES) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per row of ``documents``."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                            F.col(lang).alias("lang"), held_out(F.col(key)).alias("held_out"))
    identifier = fit(rows, bound, languages)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        mapped(_predict(identifier)), "doc_id bigint, held_out boolean, lang_pred string, score double")
