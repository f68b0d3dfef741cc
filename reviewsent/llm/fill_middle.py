"""Fill-in-middle transformation: a text is cut into prefix, middle and suffix at unit borders.

One match does the cutting: ``regex.fullmatch`` of ``(unit)*`` keeps every repetition of its group, so
``match.ends(1)`` holds the end of every unit; its length is n, and two of its entries are the cuts.

What is drawn per document depends on ``seed`` and ``doc_id`` alone: the first four groups of eight
digits of the hex sha256 of ``seed:doc_id`` are h1 to h4. The prefix ends after the smaller of h1 % (n+1)
and h2 % (n+1) units, the middle after the larger one. ``h3 % 100 < rate`` transforms the text, and
``h4 % 100 < spm`` puts the suffix first.

Defined results for odd input: a null text is empty; an empty text, a text that contains one of the three marks,
and a text that the unit cannot tile stay plain. A null ``doc_id`` is hashed as no digits. Rows with one
``doc_id`` are transformed alike and one by one; an empty table gives an empty one; other columns are not read.
"""

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from reviewsent.llm.chunks import mapped, slices

#: A line with its line break, or what follows the last one.
LINE = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = 7, 100, 50

OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                 ("middle_chars", pa.int64()), ("output", pa.string())])
OUT_SQL = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def transform(text: str, doc_id: int | None, units: "regex.Pattern", seed: int = SEED, rate: int = RATE,
              spm: int = SPM) -> tuple[int, str, int | None, int | None, str]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text; ``units`` is ``(unit)*``."""
    match = units.fullmatch(text)
    ends = match.ends(1) if match else []
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= rate or any(mark in text for mark in MARKS):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    low, high = ends[low - 1] if low else 0, ends[high - 1] if high else 0
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h4 % 100 < spm:
        return n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(documents: DataFrame, key: str = "doc_id", text: str = "text", unit: str = LINE, seed: int = SEED,
                   rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, one row per row. Nothing is shuffled."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*+")
        for batch in slices(batches, 256):
            rows = [(doc, *transform(t or "", doc, units, seed, rate, spm))
                    for doc, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, OUT)],
                                             schema=OUT)

    return documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(mapped(cut), OUT_SQL)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. A transformed text holds each mark once, as its parts hold none."""
    parts = F.split(output, "<[PSM]>", -1)  # nothing, then the three parts
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
