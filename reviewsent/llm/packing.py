"""Best-fit packing of documents into sequences of a fixed number of tokens.

1. Documents are turned into token ids plus a closing 0 and cut into pieces of at most ``capacity``
   tokens; the first piece takes what doesn't fill a whole one.
2. Pieces are range-sorted by length, and each learns its rank among the pieces of its length.
3. Bulk-synchronous best fit, longest first: all waiting pieces of a length look for their successor,
   the smallest gap that holds them, at the same time; conflicts go to the lower rank, the gaps that
   were taken shrink, and the losers look again. Where no gap is left, empty sequences are opened.
4. Each piece finds its sequence and offset by its rank.

Sorted lengths and sorted gaps are whole numbers up to ``capacity``: as runs of equal values both
have at most ``capacity`` entries however many documents there are. The sweeps of step 3 move
intervals of ranks between those runs, so only counts per length leave the executors, and the
placement of the pieces themselves is a join. Equal lengths, a third of all rows say, are one run
whose ranks are counted per sorted partition.

Defined results for odd input: a null text is empty, and an empty text is one piece with the single
id 0. Rows with the same ``doc_id`` are packed one by one. An empty table gives an empty one.
"""

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from reviewsent.llm.chunks import mapped, slices
from reviewsent.sources.shared import stage_table

CAPACITY = 2048
#: The vocabulary of ``byte_bpe_50k.json`` as ranks. ``tiktoken`` gives the ids that ``tokenizers`` gives
#: from the other file, four times as fast (tested on all of Unicode).
RANKS = "byte_bpe_50k.tiktoken"
END_OF_TEXT = {"<|endoftext|>": 50256}

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])
PIECE_SQL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"


def load_encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=END_OF_TEXT)


def _cut(capacity: int, file: str, with_ids: bool):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(public_tokenizers.path(file))  # each executor's own copy
        for batch in slices(batches, 1024):
            out = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = np.array([*encoder.encode(text or "", allowed_special="all"), 0], "<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[start:end]
                    out.append((doc, piece, start, end - start, zlib.crc32(part.tobytes()),
                                part if with_ids else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 6, PIECE)],
                                             schema=PIECE)
    return cut


def cut_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                  file: str = RANKS, with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids)``."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(mapped(_cut(capacity, file, with_ids)), PIECE_SQL)


def sweep(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Place ``counts[length]`` pieces: ``(length, first rank, rank after the last, first sequence, offset)``.

    ``gaps[g]`` holds the intervals of sequences that have ``g`` free places.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    placed, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:  # a round: every waiting piece of this length takes its successor, by rank
            fitting = sorted(g for g in gaps if g >= length)
            if not fitting:
                new = -(-(total - rank) // (capacity // length))
                gaps[capacity] = [(opened, opened + new)]
                opened, fitting = opened + new, [capacity]
            gap = fitting[0]
            taken = []
            while gaps[gap] and rank < total:
                start, end = gaps[gap].pop()
                n = min(end - start, total - rank)
                placed.append((length, rank, rank + n, start, capacity - gap))
                taken.append((start, start + n))
                if start + n < end:
                    gaps[gap].append((start + n, end))
                rank += n
            if not gaps[gap]:
                del gaps[gap]
            if gap > length:
                gaps.setdefault(gap - length, []).extend(taken)
    return placed


def ranked(pieces: DataFrame) -> DataFrame:
    """Add ``rank`` among the pieces of the same length, from 0: place in a sorted partition plus the
    pieces of that length in the partitions before."""
    order = ["length", "doc_id", "piece", "ids_crc32"]
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = stage_table(ordered.select("*", F.spark_partition_id().alias("part"),
                                          F.monotonically_increasing_id().alias("at")), "sorted_pieces")
    # one row per partition and length: a length is cut by few range bounds
    firsts = numbered.groupBy("length", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    firsts = firsts.select("length", "part", "first", earlier.alias("earlier"))
    return (numbered.join(F.broadcast(firsts), ["length", "part"])
            .withColumn("rank", F.col("at") - F.col("first") + F.col("earlier")).drop("part", "at", "first", "earlier"))


def pack_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   file: str = RANKS, with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset)``, one row per piece."""
    spark = documents.sparkSession
    pieces = stage_table(cut_documents(documents, key, text, capacity, file, with_ids), "pieces")
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(sweep(counts, capacity) or [(0, 0, 0, 0, 0)],
                                   "length bigint, low bigint, high bigint, first bigint, offset bigint")
    inside = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    return (ranked(pieces).join(F.broadcast(places), "length").where(inside)
            .withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("low"))
            .select(*PIECE.names, "sequence_id", "offset"))
