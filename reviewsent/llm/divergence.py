"""How the sources of each language differ in their use of words.

1. Document frequencies: each task counts the distinct terms of its documents before the shuffle. A language
   keeps the terms in at least ``min_docs`` of its documents.
2. Kept terms are range-sorted and numbered per language; runs of ``SHARD_TERMS`` of them become minimal acyclic
   transducers, whose ordinals are the places in that order.
3. Texts are streamed through the transducers of their language and recounted as (language, source, ordinal).
   Transducers reach the tasks as a broadcast of at most ``VOCABULARY_BYTES``; a larger vocabulary takes
   as many passes over the texts as it has such parts.
4. Smoothed shares p of each source and each language, in whole numbers, are compared: per term, and summed per pair
   of sources. Pairs are summed over blocks of ordinals, for tiles of sources, so no task holds a language.
   Ties go to the lower ordinal, which is the lower term in UTF-8.

Defined results for odd input: null text, language and source are empty strings, and these are a language
and a source like others. A group without terms has only its smoothing: the same p for each kept term. A language
without kept terms has pairs of value 0 and no terms. Repeated rows count as often as they are there. An empty
table gives an empty one; other columns are not read.
"""

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewsent.llm.chunks import dump, grouped, load, mapped, slices
from reviewsent.llm.transducer import Transducer, build, term_spans
from reviewsent.sources.shared import stage_table

MIN_DOCS, TOP = 30, 50
SCALE, SMOOTHING = 1_000_000_000, 5
SHARD_TERMS = 1 << 16
VOCABULARY_BYTES = 64 << 20
#: Text per numpy pass, entries that a task gathers before it hands them on, sources per tile, ordinals per block.
PASS_BYTES, GATHERED, TILE, BLOCK = 1 << 22, 1 << 18, 64, 4096

TERM = re.compile(rb"[a-z\x80-\xff]+")
FREQUENCY = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("df", pa.int64())])
COUNT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])


def lowered(text: str | None) -> bytes:
    return (text or "").encode().lower()  # bytes: A-Z only


def _rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Counter] = defaultdict(Counter)

    def handed_on() -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            yield _rows(FREQUENCY, [lang] * len(counts), list(counts), list(counts.values()))
        found.clear()

    for batch in slices(batches, 256):
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            found[lang].update(set(TERM.findall(lowered(text))))
        if sum(map(len, found.values())) > GATHERED:
            yield from handed_on()
    yield from handed_on()


def kept_terms(documents: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term, ordinal)``: terms in at least ``min_docs`` documents of a language, as bytes, numbered from 0
    in their order. ``documents`` is ``(lang, source, text)`` without nulls."""
    frequencies = documents.select("lang", "text").mapInArrow(mapped(_frequencies), "lang string, term binary, df bigint")
    kept = stage_table(frequencies.groupBy("lang", "term").agg(F.sum("df").alias("df")).where(F.col("df") >= min_docs)
                       .select("lang", "term"), "kept_terms")
    parts = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = kept.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    numbered = stage_table(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
                           "sorted_terms")
    firsts = numbered.groupBy("lang", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("lang").orderBy("part")) - F.col("n")
    firsts = firsts.select("lang", "part", "first", earlier.alias("earlier"))
    return numbered.join(firsts, ["lang", "part"]).select("lang", "term", (F.col("at") - F.col("first") + F.col("earlier")).alias("ordinal"))


def _build_shard(table: pa.Table) -> pa.Table:
    table = table.sort_by("ordinal")
    terms = table["term"].to_pylist()
    arrays = dump(*build(terms).arrays())
    return pa.table({"lang": table["lang"][:1], "base": table["ordinal"][:1], "first": pa.array([terms[0][:8]], pa.binary()),
                     "size": pa.array([sum(x.nbytes for x in load(arrays))], pa.int64()), "arrays": pa.array([arrays], pa.binary())})


def transducers(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``(lang, base, first, size, arrays)``: a transducer per ``shard_terms`` kept terms of a language, the ordinal and the
    first eight bytes of its first term, its size in memory and its packed arrays."""
    shards = kept.withColumn("shard", F.floor(F.col("ordinal") / shard_terms))
    return shards.groupBy("lang", "shard").applyInArrow(
        grouped(_build_shard), "lang string, base bigint, first binary, size bigint, arrays binary")


def leading(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of each span as one number in the order of the bytes, short ones filled with 0."""
    key = np.zeros(len(starts), np.uint64)
    for k in range(8):
        here = starts + k < ends
        key = (key << np.uint64(8)) | np.where(here, data[np.minimum(starts + k, len(data) - 1)], 0).astype(np.uint64)
    return key


class Vocabulary:
    """The transducers of one language that a pass has; a term is read by those it can be in."""

    def __init__(self, shards: list[tuple[int, bytes, bytes]]):
        shards = sorted(shards)
        self.bases = [base for base, _, _ in shards]
        self.firsts = np.array([int.from_bytes(first.ljust(8, b"\0")) for _, first, _ in shards], np.uint64)
        self.shards = [Transducer(*load(arrays)) for _, _, arrays in shards]

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.shards) == 1:
            found = self.shards[0].ordinals(data, starts, ends)
            return np.where(found >= 0, found + self.bases[0], -1)
        out = np.full(len(starts), -1, np.int64)
        key = leading(data, starts, ends)
        low = np.searchsorted(self.firsts, key, "left") - 1  # shards that begin with the same bytes are all tried
        high = np.searchsorted(self.firsts, key, "right") - 1
        for number, (base, shard) in enumerate(zip(self.bases, self.shards)):
            which = np.flatnonzero((low <= number) & (number <= high))
            found = shard.ordinals(data, starts[which], ends[which])
            out[which[found >= 0]] = found[found >= 0] + base
        return out


def stretches(texts: list[bytes], most: int = PASS_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(data, starts, ends, text number)`` of the terms of ``texts``, about ``most`` bytes at a time; terms are whole."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    bounds = np.cumsum([len(text) + 1 for text in texts])
    low = 0
    while low < len(data):
        high = min(low + most, len(data))
        while high < len(data):  # up to the end of the term, looked for piece by piece
            starts, ends = term_spans(np.r_[data[high - 1:high + 4096], np.uint8(10)])
            inside = len(starts) and starts[0] == 0
            if not inside or ends[0] <= 4096 and high + ends[0] - 1 < len(data):
                high += int(ends[0]) - 1 if inside else 0
                break
            high = min(high + 4096, len(data))
        starts, ends = term_spans(np.r_[data[low:high], np.uint8(10)])
        yield data[low:high], starts, ends, np.searchsorted(bounds, starts + low, "right")
        low = high


class Tally:
    """Counts of (language, source, ordinal), merged in numpy and handed on when there are many."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.keys, self.counts, self.size = [], [], 0

    def number(self, group: tuple[str, str]) -> int:
        return self.groups.setdefault(group, len(self.groups))

    def add(self, groups: np.ndarray, ordinals: np.ndarray) -> None:
        keys, counts = np.unique(groups.astype(np.int64) << 40 | ordinals, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)

    def merge(self) -> None:
        keys, back = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, back, np.concatenate(self.counts))
        self.keys, self.counts, self.size = [keys], [counts], len(keys)

    def full(self, most: int) -> bool:
        if self.size > 4 * most:
            self.merge()
        return self.size > 2 * most or len(self.groups) > 1 << 20

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self.merge()
            names = list(self.groups)
            langs = pa.array([lang for lang, _ in names], pa.string())
            sources = pa.array([source for _, source in names], pa.string())
            for at in range(0, self.size, 1 << 16):
                keys, counts = self.keys[0][at:at + (1 << 16)], self.counts[0][at:at + (1 << 16)]
                group = pa.array(keys >> 40)
                yield pa.RecordBatch.from_arrays([langs.take(group), sources.take(group), pa.array(keys & (1 << 40) - 1),
                                                  pa.array(counts)], schema=COUNT)
        self.__init__()


def _recount(vocabularies):
    opened: dict[str, Vocabulary] = {}

    def recount(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = vocabularies.value
        tally = Tally()
        for batch in slices(batches, 1024):
            langs, sources = batch["lang"].to_pylist(), batch["source"].to_pylist()
            by_lang = defaultdict(list)
            for row, lang in enumerate(langs):
                if lang in shards:
                    by_lang[lang].append(row)
            for lang, rows in by_lang.items():
                if lang not in opened:
                    opened[lang] = Vocabulary(shards[lang])
                groups = np.array([tally.number((lang, sources[row])) for row in rows])
                texts = [lowered(batch["text"][row].as_py()) for row in rows]
                for data, starts, ends, text in stretches(texts):
                    ordinals = opened[lang].ordinals(data, starts, ends)
                    known = ordinals >= 0
                    tally.add(groups[text[known]], ordinals[known])
            if tally.full(GATHERED):
                yield from tally.rows()
        yield from tally.rows()
    return recount


def recount(documents: DataFrame, shards: DataFrame, most: int = VOCABULARY_BYTES) -> DataFrame:
    """``(lang, source, ordinal, n)``: occurrences of kept terms. ``shards`` is a written table."""
    spark = documents.sparkSession
    sizes = shards.select("lang", "base", "size").orderBy("lang", "base").collect()  # a row per SHARD_TERMS terms
    passes, room = [], 0
    for row in sizes:
        if row["size"] > room:
            passes.append([])
            room = max(most, row["size"])
        passes[-1].append((row["lang"], row["base"]))
        room -= row["size"]
    counted = None
    for some in passes:
        (first_lang, first), (last_lang, last) = some[0], some[-1]
        after = (F.col("lang") > first_lang) | (F.col("lang") == first_lang) & (F.col("base") >= first)
        before = (F.col("lang") < last_lang) | (F.col("lang") == last_lang) & (F.col("base") <= last)
        by_lang = defaultdict(list)
        for row in shards.where(after & before).collect():  # at most ``most`` bytes in memory
            by_lang[row["lang"]].append((row["base"], bytes(row["first"]), bytes(row["arrays"])))
        counts = documents.mapInArrow(mapped(_recount(spark.sparkContext.broadcast(dict(by_lang)))),
                                      "lang string, source string, ordinal bigint, n bigint")
        counted = counts if counted is None else counted.unionByName(counts)
    if counted is None:
        return spark.createDataFrame([], "lang string, source string, ordinal bigint, n bigint")
    return counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def share(n: str, total: str, kept: str) -> Column:
    """``1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * kept))`` in whole numbers of 38 digits."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + {SMOOTHING} as decimal(19,0))) "
                  f"div (cast({total} as decimal(19,0)) + cast({SMOOTHING} * {kept} as decimal(19,0)))")


def _pair_block(table: pa.Table) -> pa.Table:
    """Sums of |p - q| over one block of ordinals for the sources of two tiles."""
    lang, a, b = (table[c][0].as_py() for c in ("lang", "tile_a", "tile_b"))
    frame = table.select(["number", "place", "p"]).to_pandas()
    seeds = frame[frame["place"] < 0].sort_values("number")
    numbers = seeds["number"].to_numpy()
    width = -int(seeds["place"].iloc[0])  # a seed row holds the width of the block and p of what did not occur
    shares = np.repeat(seeds["p"].to_numpy()[:, None], width, axis=1)
    entries = frame[frame["place"] >= 0]
    shares[np.searchsorted(numbers, entries["number"].to_numpy()), entries["place"].to_numpy()] = entries["p"].to_numpy()
    out = []
    for i, number in enumerate(numbers):
        if number // TILE == a:
            others = np.flatnonzero((numbers // TILE == b) & (numbers > number))
            sums = np.abs(shares[others] - shares[i]).sum(axis=1)
            out.append(pd.DataFrame({"lang": lang, "a": number, "b": numbers[others], "value": sums}))
    found = pd.concat(out) if out else pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})
    return pa.Table.from_pandas(found, pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())]),
                                preserve_index=False)


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` for source numbers a < b of a language that has kept terms.

    ``counts`` has ``(lang, number, ordinal, p)``, ``groups`` ``(lang, number, tiles, v, p0)``, p0 for no occurrence.
    """
    width = F.least(F.lit(BLOCK), F.col("v") - F.col("block") * BLOCK)
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("v") - 1) / BLOCK)))
    seeds = groups.where(F.col("v") > 0).withColumn("block", blocks).select(
        "lang", "number", "tiles", "block", (-width).alias("place"), F.col("p0").alias("p"))
    entries = counts.select("lang", "number", "tiles", F.floor(F.col("ordinal") / BLOCK).alias("block"),
                            (F.col("ordinal") % BLOCK).alias("place"), "p")
    tile = F.floor(F.col("number") / TILE)
    # a row goes to each tile that its own is compared with
    spread = seeds.unionByName(entries).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    spread = spread.select("lang", F.least(tile, "other").alias("tile_a"), F.greatest(tile, "other").alias("tile_b"), "block",
                           "number", "place", "p")
    return (spread.groupBy("lang", "tile_a", "tile_b", "block")
            .applyInArrow(grouped(_pair_block), "lang string, a bigint, b bigint, value bigint")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))


def audit_sources(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: parts ``pair`` (other sources of the language by the sum of the
    differences) and ``term`` (the ``top`` kept terms that the source uses more than its language)."""
    rows = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = stage_table(kept_terms(rows, min_docs), "vocabulary")
    counts = stage_table(recount(rows, stage_table(transducers(kept), "transducers")), "term_counts")

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = Window.partitionBy("lang")
    groups = (rows.select("lang", "source").distinct().join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
              .na.fill(0, ["v", "total"])
              .withColumn("number", F.row_number().over(of_lang.orderBy("source")).cast("long") - 1)
              .withColumn("tiles", F.floor((F.count(F.lit(1)).over(of_lang) - 1) / TILE) + 1)
              .withColumn("lang_total", F.sum("total").over(of_lang))
              .withColumn("p0", F.when(F.col("v") > 0, share("0", "total", "v"))))
    groups = stage_table(groups, "groups")
    used = (counts.join(groups, ["lang", "source"])
            .withColumn("p", share("n", "total", "v")))

    values = pair_values(used, groups)
    one = groups.select("lang", "source", "number")
    other = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("item_number"))
    pairs = one.join(other, "lang").where(F.col("number") != F.col("item_number"))
    pairs = (pairs.withColumn("a", F.least("number", "item_number")).withColumn("b", F.greatest("number", "item_number"))
             .join(values, ["lang", "a", "b"], "left").na.fill(0, ["value"]))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", place.alias("rank"))

    everywhere = F.sum("n").over(Window.partitionBy("lang", "ordinal"))
    more = (used.withColumn("lang_n", everywhere).withColumn("q", share("lang_n", "lang_total", "v"))
            .where(F.col("p") > F.col("q")).select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value")))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ordinal"))
    terms = (more.withColumn("rank", place).where(F.col("rank") <= top).join(kept, ["lang", "ordinal"])
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank"))
    return pairs.unionByName(terms)
