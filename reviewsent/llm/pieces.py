"""SentencePiece encoding and decoding as relations: a lattice of substrings joined with the piece table.

Texts are cut into *units*, stretches that no piece crosses: white space and the word after it, or
characters that are in no longer piece. Chunks of documents send each distinct unit once, so the
lattice is made per distinct unit of the corpus: its substrings up to the length of the longest
piece are exploded, joined with the piece table, grouped by unit, and folded by ``aggregate``.

The model at hand is a merge model (byte-pair), whose encoder merges neighbours by rank. A Viterbi
fold over its scores gives other pieces, so the fold takes the edges of the lattice in the order of
their ranks and merges where an edge spans exactly two current pieces; boundaries are the bits of a
long, and ids are read off between them. Units of more than :data:`SHORT` characters are merged by the same rule with a heap.
Characters without a piece become their UTF-8 bytes, as in the model.

Defined results for odd input: a null or empty text has no pieces. Repeated rows are encoded alike,
one row each. ``U+2581`` stands for a space in the model, so it is decoded as one. An empty table gives
an empty one.
"""

import hashlib
import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewsent.llm.chunks import cogrouped, count_chunks, dump, grouped, load, mapped, messages, slices
from reviewsent.llm.words import hash_spans

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
SHORT = 60
#: Text per chunk, text read at once, and text whose units share a bucket.
CHUNK_BYTES, PART_BYTES, BUCKET_BYTES = 8 << 20, 1 << 20, 8 << 20

WORDS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("message", pa.binary())])
WORDS_SQL = "bucket int, chunk bigint, message binary"
RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                    ("text_sha256", pa.string()), ("ids", pa.list_(pa.int32()))])
RESULT_SQL = "doc_id bigint, n_tokens bigint, ids_crc32 bigint, text_sha256 string, ids array<int>"


class Pieces:
    """The piece table of a model file."""

    def __init__(self, file: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(file))
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = {int(self.text[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        ordinary = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids = {self.text[i]: i for i in ordinary}
        self.rank = {self.text[i]: -model.get_score(i) for i in ordinary}
        self.longest = max(map(len, self.ids))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces of this model cross words")
        longer = {c for p in self.ids if len(p) > 1 for c in p}
        #: ASCII characters that are in no longer piece: units of their own. Spaces begin units.
        self.alone = np.array([b < 128 and b != 0x20 and chr(b) not in longer for b in range(256)])

    def table(self, spark: SparkSession) -> DataFrame:
        """``(piece, place)`` of the pieces that merges make, in the order of their ranks: as many rows as the model
        has longer pieces, about 30,000."""
        ordered = sorted((p for p in self.ids if len(p) > 1), key=lambda p: (self.rank[p], self.ids[p]))
        return spark.createDataFrame([(p, k) for k, p in enumerate(ordered)], "piece string, place bigint")

    def number(self, part: str) -> list[int]:
        """A piece's id, or those of the bytes of a character that is no piece."""
        return [self.ids[part]] if part in self.ids else [self.byte_ids[b] for b in part.encode()]

    def cut(self, unit: str, bounds: int) -> list[int]:
        """Ids of the parts of ``unit`` between the boundaries, the bits of ``bounds``."""
        ids, start = [], 0
        for end in range(1, len(unit)):
            if bounds >> end & 1:
                ids += self.number(unit[start:end])
                start = end
        return ids + self.number(unit[start:])

    def merge(self, unit: str) -> list[int]:
        """Ids of a unit of any length: the best-ranked pair of neighbours merges first, then the leftmost."""
        parts: list[str | None] = list(unit)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(a: int) -> None:
            b = after[a]
            if a >= 0 and b < len(parts) and (rank := self.rank.get(both := parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (rank, a, both))
        for a in range(len(parts) - 1):
            offer(a)
        while heap:
            _, a, both = heapq.heappop(heap)
            if parts[a] is None or after[a] >= len(parts) or parts[a] + parts[after[a]] != both:
                continue
            b = after[a]
            parts[a], parts[b], after[a] = both, None, after[b]
            if after[b] < len(parts):
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        ids: list[int] = []
        for part in parts:
            if part is not None:
                ids += self.number(part)
        return ids


# units of the documents

def find_units(texts: list[bytes], alone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts end to end, each after a space, and their units: ``(data, starts, ends, units per text)``."""
    data = np.frombuffer(b"".join(b" " + t if t else t for t in texts), np.uint8)
    bounds = np.cumsum([len(t) + 1 if t else 0 for t in texts]) if texts else np.zeros(0, np.int64)
    if not len(data):
        return data, bounds[:0], bounds[:0], np.zeros(len(texts), np.int64)
    space, single = data == 0x20, alone[data]
    cut = single.copy()
    cut[1:] |= single[:-1] | (space[1:] & ~space[:-1])
    cut[np.r_[0, bounds[:-1]][np.diff(np.r_[0, bounds]) > 0]] = True
    starts = np.flatnonzero(cut)
    return data, starts, np.r_[starts[1:], len(data)], np.diff(np.r_[0, np.searchsorted(starts, bounds)])


class Chunk:
    """Documents of a chunk as numbers of their distinct units. Frequent units have small numbers, so the
    sequences compress well. Texts are read a few megabytes at a time."""

    def __init__(self, alone: np.ndarray):
        self.alone = alone
        self.docs, self.digests, self.sizes, self.parts, self.hashes, self.units = [], [], [], [], [], []
        self.waiting, self.bytes, self.total = [], 0, 0

    def add(self, doc, text: str | None) -> None:
        raw = (text or "").encode("utf-8", "surrogatepass")
        self.docs.append(doc)
        self.digests.append(hashlib.sha256(raw).digest())
        self.waiting.append(raw)
        self.bytes += len(raw)
        self.total += len(raw)
        if self.bytes >= PART_BYTES:
            self._read()

    def _read(self) -> None:
        data, starts, ends, sizes = find_units(self.waiting, self.alone)
        hashes, first, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        self.units += [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        self.hashes.append(hashes)
        self.parts.append(which.astype(np.uint32))
        self.sizes.append(sizes)
        self.waiting, self.bytes = [], 0

    def finish(self) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Hashes and bytes of the distinct units, the most frequent first, and the sequence of their numbers."""
        self._read()
        hashes, first, which = np.unique(np.concatenate(self.hashes), return_index=True, return_inverse=True)
        counts, at, numbers = np.zeros(len(hashes), np.int64), 0, []
        for part, own in zip(self.parts, self.hashes):
            numbers.append(which[at:at + len(own)])
            counts += np.bincount(numbers[-1][part], minlength=len(hashes))
            at += len(own)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        sequence = np.concatenate([rank[n][part] for n, part in zip(numbers, self.parts)])
        return hashes[order], [self.units[k] for k in first[order].tolist()], sequence


def _chunks(batches: Iterable[pa.RecordBatch], file: str, chunk_bytes: int) -> Iterator[tuple[int, Chunk]]:
    alone = Pieces(file).alone
    number = TaskContext.get().partitionId() << 32  # the rows of a scan partition come in one order
    chunk = Chunk(alone)
    for batch in slices(batches):
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            chunk.add(doc, text)
            if chunk.total >= chunk_bytes:
                yield number, chunk
                number, chunk = number + 1, Chunk(alone)
    if chunk.docs:
        yield number, chunk


def _buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, WORDS)],
                                      schema=WORDS)


def _by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """Each bucket of a chunk's units: its number, the places of its units, and a check of their hashes and order."""
    bucket = _buckets_of(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True]).tolist() if len(order) else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield int(bucket[order[a]]), order[a:b], zlib.crc32(hashes[order[a:b]].tobytes())


def _send_units(file: str, buckets: int, chunk_bytes: int):
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One message per chunk and bucket: the distinct units."""
        for number, chunk in _chunks(batches, file, chunk_bytes):
            hashes, units, _ = chunk.finish()
            yield _batch((bucket, number, dump(check, [units[k].decode("utf-8", "replace").replace(" ", SPACE)
                                                       for k in places.tolist()]))
                         for bucket, places, check in _by_bucket(hashes, buckets))
    return send


def _send_documents(file: str, buckets: int, chunk_bytes: int):
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One message per chunk: its documents as numbers of units, and the buckets of these."""
        for number, chunk in _chunks(batches, file, chunk_bytes):
            hashes, _, sequence = chunk.finish()
            planes = np.ascontiguousarray(sequence.view(np.uint8).reshape(-1, 4).T).tobytes()
            checks = [check for _, _, check in _by_bucket(hashes, buckets)]
            yield _batch([(-1, number, dump(chunk.docs, chunk.digests, np.concatenate(chunk.sizes), planes,
                                            _buckets_of(hashes, buckets).astype(np.uint32), checks))])
    return send


def _distinct(table: pa.Table) -> pa.Table:
    units = sorted({u for m in table["message"].to_pylist() for u in load(m)[1]})
    bucket = table["bucket"][0].as_py()
    return pa.table({"number": pa.array(range(bucket << 32, (bucket << 32) + len(units)), pa.int64()),
                     "unit": pa.array(units, pa.string())})


# the lattice

def fold_units(units: DataFrame, pieces: Pieces, partitions: int) -> DataFrame:
    """``(number, bounds)`` of each distinct ``(number, unit)`` of at most :data:`SHORT` characters in which
    anything merges: bit ``k`` is set if a piece ends after ``k`` characters.

    An edge of the lattice is one long: rank, start, end. Units are dealt out before their edges
    arise, so the edges are grouped where they are.
    """
    starts = (units.repartition(partitions, "number")
              .select("number", "unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 2)).alias("i")))
    edges = (starts.select("number", "unit", "i", F.explode(F.sequence(
        F.col("i") + 2, F.least(F.length("unit"), F.col("i") + pieces.longest))).alias("j"))
        .select("number", "i", "j", F.substring("unit", F.col("i") + 1, F.col("j") - F.col("i")).alias("piece"))
        .join(F.broadcast(pieces.table(units.sparkSession)), "piece"))
    edge = F.col("place") * 4096 + F.col("i") * 64 + F.col("j")
    grouped = edges.select("number", edge.alias("edge")).groupBy("number").agg(
        F.sort_array(F.collect_list("edge")).alias("edges"))
    # an edge merges if both its ends are boundaries and just one boundary is inside
    start, end = "cast(shiftright(e, 6) & 63 AS int)", "cast(e & 63 AS int)"
    ends = f"(shiftleft(1L, {start}) | shiftleft(1L, {end}))"
    inside = f"(shiftleft(1L, {end}) - shiftleft(2L, {start}))"
    return grouped.select("number", F.expr(f"""aggregate(edges, shiftleft(1L, 62) - 1L, (b, e) ->
        CASE WHEN (b & {ends}) = {ends} AND bit_count(b & {inside}) = 1 THEN b & ~{inside} ELSE b END)""").alias("bounds"))


# and back to the documents

def _answer(file: str):
    def answer(sent: pa.Table, folded: pa.Table) -> pa.Table:
        """For each unit a chunk sent its ids, in the order it sent them."""
        pieces, asked = Pieces(file), [load(m) for m in sent["message"].to_pylist()]
        units = sorted({u for _, part in asked for u in part})
        bounds = np.full(len(units), -1, np.int64)
        bounds[folded["number"].to_numpy() & 0xFFFFFFFF] = folded["bounds"].to_numpy()
        ids = [pieces.cut(u, b) if len(u) <= SHORT else pieces.merge(u) for u, b in zip(units, bounds.tolist())]
        sizes = np.array([len(i) for i in ids], np.int64)
        flat = np.fromiter((x for i in ids for x in i), np.int32, sizes.sum())
        starts = np.cumsum(sizes) - sizes
        place = {u: k for k, u in enumerate(units)}
        narrow = np.uint16 if len(pieces.text) <= 1 << 16 else np.int32
        out = []
        for chunk, (check, part) in zip(sent["chunk"].to_pylist(), asked):
            k = np.array([place[u] for u in part])
            n = sizes[k]
            at = np.repeat(starts[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out.append((sent["bucket"][0].as_py(), chunk, dump(
                check, n.astype(np.uint8 if n.max() < 256 else np.int32), flat[at].astype(narrow))))
        return messages(WORDS, *zip(*out))
    return answer


def _join_ids(documents: pa.Table, answers: pa.Table) -> pa.Table:
    docs, digests, sizes, planes, bucket, checks = load(documents["message"][0].as_py())
    sequence = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    parts = [load(m) for _, m in sorted(zip(answers["bucket"].to_pylist(), answers["message"].to_pylist()))]
    if checks != [p[0] for p in parts]:
        raise ValueError("the documents came in another order when they were read again; write them as a table first")
    # answers are ordered by bucket, units by frequency
    order = np.argsort(bucket, kind="stable")
    counts = np.zeros(len(order), np.int64)
    counts[order] = np.concatenate([p[1] for p in parts]).astype(np.int64) if parts else 0
    flat = np.concatenate([p[2] for p in parts]).astype(np.int32) if parts else np.zeros(0, np.int32)
    starts = np.zeros(len(order), np.int64)
    starts[order] = np.cumsum(counts[order]) - counts[order]
    out, at = [], 0
    for doc, digest, size in zip(docs, digests, sizes.tolist()):
        k = sequence[at:at + size]
        at += size
        n = counts[k]
        ids = flat[np.repeat(starts[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        out.append((doc, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), digest.hex(), ids))
    return messages(RESULT, *zip(*out))


def encode_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", file: str = MODEL) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, text_sha256, ids)``, one row per row of ``documents``.

    Texts are read twice, for their units and for what the units make of them, and a chunk is what a task of the scan
    reads in a row. If a second reading gave other rows or another order, the checks of the units would differ and the job would fail.
    """
    pieces = Pieces(file)
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    buckets, _ = count_chunks(rows, chunk_bytes=BUCKET_BYTES)
    words = rows.mapInArrow(mapped(_send_units(file, buckets, CHUNK_BYTES)), WORDS_SQL)
    units = words.groupBy("bucket").applyInArrow(grouped(_distinct), "number bigint, unit string")
    folded = fold_units(units.where(F.length("unit").between(2, SHORT)), pieces, buckets)
    folded = folded.withColumn("bucket", F.shiftright("number", 32).cast("int"))
    answers = words.groupBy("bucket").cogroup(folded.groupBy("bucket")).applyInArrow(cogrouped(_answer(file)), WORDS_SQL)
    return (rows.mapInArrow(mapped(_send_documents(file, buckets, CHUNK_BYTES)), WORDS_SQL).groupBy("chunk")
            .cogroup(answers.groupBy("chunk")).applyInArrow(cogrouped(_join_ids), RESULT_SQL))


def decode_ids(ids: Column, pieces: Pieces) -> Column:
    """The text of an id array: pieces are looked up as bytes, so split characters come together again."""
    as_hex = [""] * len(pieces.text)  # control pieces are nothing
    for piece, i in pieces.ids.items():
        as_hex[i] = piece.replace(SPACE, " ").encode().hex()
    for byte, i in pieces.byte_ids.items():
        as_hex[i] = f"{byte:02x}"
    table = F.split(F.lit(",".join(as_hex)), ",")
    found = F.element_at(F.transform(F.array(table), lambda t: F.array_join(F.transform(ids, lambda i: F.get(t, i)), "")), 1)
    return F.decode(F.substring(F.unhex(found), 2, 1 << 30), "utf-8")  # without the space put before each text
