"""Token ids in files of fixed-width bit packing.

Every id takes the bits that the largest id of the vocabulary needs. A file is one shard: a sorted run of
documents, ids of one document after the other:

* blocks of ``block`` ids, the last one shorter, each packed from its first bit on, lowest bit first,
  and followed by one byte 0x0A;
* an index: byte offsets of the blocks, ``doc_id``, a null flag and the number of ids of each document;
* a tail of fixed size: shard, ids, documents, blocks, block size, width, magic; and one byte 0x0A.

So any range of ids is read by one numpy expression: block offset, bit position within the block, eight
bytes from there, shift, mask. The byte after each section is the line separator of Spark's ``text`` writer,
which writes the sections as rows and commits whole files; ``binaryFile`` reads them. That way the files can be in any
store that Spark reaches, and a task that is lost or run twice leaves nothing behind.

Texts are encoded by the ``tokenizers`` library, each distinct part once while a task remembers it. The vocabulary's
pre-tokenizer never joins a visible character to white space after it, nor a Latin letter to punctuation after it
other than an apostrophe, nor a lone line break to the Latin letter after it: there texts are cut, first at spaces, then
within what is new between them. A word goes straight to the library's merge model, all other parts through the whole library. The cuts use
characters only whose class is the same in every version of Unicode (tested against whole texts, and
around every code point).

Defined results for odd input: a null text is empty, and an empty text is the single id 0. Null ``doc_id`` come
first; rows with one ``doc_id`` stand in the order of the scan. An empty table gives no file and no row;
other columns are not read.
"""

import functools
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from reviewsent.llm.chunks import mapped, slices
from reviewsent.sources.shared import setting, stage_table

VOCABULARY = "byte_bpe_50k.json"
END = 0
BLOCK = 1 << 16
SHARD_BYTES = 32 << 20
MAGIC = b"BITIDS01"
TAIL = "<QQQQII8s"
#: Parts that a task remembers, some 200 bytes each, twice: the latest, and those before.
REMEMBERED = 1 << 18
#: Text that is cut and looked up in one go, which takes some 20 times its size.
STRETCH_BYTES = 4 << 20
#: Text that a Python worker is sent at a time: both it and the JVM hold some of these, outside of the heap.
BATCH_BYTES = 2 << 20

_space, _latin, _marks = r" \t\n\r\f\v", "A-Za-zÀ-ÖØ-öø-ſ", r"!-&(-/:-@\[-`{-~"
#: Lone line breaks, words, runs of punctuation, and anything else up to the next place where a cut is safe.
PARTS = re.compile(rf"\n(?=[{_latin}])|[{_space}]*[{_latin}]+(?=[{_space}{_marks}]|\Z)|[{_marks}]+(?=[{_space}]|\Z)"
                   rf"|(?s:.)+?(?<=[!-~{_latin}])(?=[{_space}])|(?s:.)+")
WORD = re.compile(rf" ?[{_latin}]+")
#: What most often stands between two spaces.
MARKED = re.compile(rf"([{_latin}]+)([{_marks}]*)")
#: A space before which a text may not be cut.
UNSAFE = rf"[^!-~{_latin}] "

DOCUMENT = pa.schema([("shard", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()),
                      ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int64()))])
DOCUMENT_SQL = "shard bigint, place bigint, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint, ids array<bigint>"


class Remembered(dict):
    """What ``make`` gives for a key, kept for the latest ``REMEMBERED`` new keys and those before."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


_packers = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _packed(ids: list[int]) -> bytes:
    return _packers[len(ids)](*ids) if len(ids) < len(_packers) else struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids of texts, each followed by ``END``."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.width = max(1, (self.library.get_vocab_size() - 1).bit_length())
        whole = ByteLevel(add_prefix_space=False, use_regex=False)  # as the library writes bytes, for one and two bytes
        self.letters = {byte: letter for c in map(chr, range(0x800))
                        for byte, letter in zip(c.encode(), whole.pre_tokenize_str(c)[0][0])}
        self.space = self.letters[ord(" ")]  # visible ASCII stands for itself
        self.tokenize = self.library.model.tokenize
        self.forget()

    def forget(self) -> None:
        self.parts = Remembered(self._part)
        self.after_space = Remembered(self._after_space)

    def _merged(self, word: str) -> bytes:
        return self._tokenized(word.encode().decode("latin-1").translate(self.letters))

    def _tokenized(self, letters: str) -> bytes:
        return _packed([token.id for token in self.tokenize(letters)])

    def _part(self, part: str) -> bytes:
        return self._merged(part) if WORD.fullmatch(part) else _packed(self.library.encode(part, add_special_tokens=False).ids)

    def _after_space(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            return self._tokenized(self.space + piece)
        found = MARKED.fullmatch(piece)
        if not found:
            return self._join(" " + piece)
        word, marks = found.groups()
        return self.after_space[word] + self.parts[marks] if marks else self._merged(" " + word)

    def _join(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, PARTS.findall(text)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, sizes)``: all ids, and how many each text has with its end. No text is null.

        Texts are cut at spaces by Arrow, and only distinct pieces are looked up. What stands before the first space
        is a piece of its own kind, and so is a text that may not be cut there.
        """
        whole = pc.match_substring_regex(texts, UNSAFE)
        cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        bounds = cut.offsets.to_numpy()
        pieces = cut.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        firsts = pc.if_else(whole, texts, cut.values.take(pa.array(cut.offsets[:-1]))).to_pylist()
        inner = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        table = [*map(self.after_space.__getitem__, inner), *map(self._join, firsts), struct.pack("<I", END)]
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(table), "<u4")
        chosen = pieces.indices.to_numpy().astype(np.int64)
        chosen[bounds[:-1]] = len(inner) + np.arange(len(texts))
        chosen = np.insert(chosen, bounds[1:], len(table) - 1)
        lengths = sizes[chosen]
        ends = np.cumsum(lengths)
        ids = flat[np.repeat(starts[chosen] - (ends - lengths), lengths) + np.arange(lengths.sum())]
        return ids, np.diff(np.r_[0, ends[bounds[1:] + np.arange(len(texts))]])


@functools.lru_cache(1)
def _encoder(path: str) -> Encoder:
    """Of a Python worker, which runs one task after the other."""
    return Encoder(path)


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in ``width`` bits each, lowest bit first: eight ids fill ``width`` whole bytes."""
    groups = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    groups.reshape(-1)[:len(ids)] = ids
    out = np.zeros((len(groups), width), np.uint8)
    for k in range(8):
        bit = k * width
        for byte in range(bit // 8, -(-(bit + width) // 8)):
            move = 8 * byte - bit
            part = groups[:, k] >> np.uint64(move) if move >= 0 else groups[:, k] << np.uint64(-move)
            out[:, byte] |= (part & np.uint64(255)).astype(np.uint8)
    return out.tobytes()[:-(-len(ids) * width // 8)]


class Shard:
    """One file, given as its bytes."""

    def __init__(self, content: bytes):
        self.content = content
        tail = len(content) - 1 - struct.calcsize(TAIL)
        self.shard, self.n_ids, n_docs, n_blocks, self.block, self.width, magic = struct.unpack_from(TAIL, content, tail)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        at = tail - 8 * (n_blocks + 2 * n_docs) - n_docs
        self.offsets = np.frombuffer(content, "<i8", n_blocks, at)
        self.doc_ids = np.frombuffer(content, "<i8", n_docs, at + 8 * n_blocks)
        self.sizes = np.frombuffer(content, "<i8", n_docs, at + 8 * (n_blocks + n_docs))
        self.nulls = np.frombuffer(content, bool, n_docs, tail - n_docs)
        # eight bytes from any byte on; the tail keeps the last ones inside the file
        self.windows = np.ndarray(max(0, len(content) - 7), "<u8", content, strides=(1,))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, wherever they lie."""
        place = np.arange(start, stop)
        bit = place % self.block * self.width
        found = self.windows[self.offsets[place // self.block] + (bit >> 3)] >> (bit & 7).astype(np.uint64)
        return (found & np.uint64((1 << self.width) - 1)).astype("<u4")


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, int]]:
    """``(doc_id, text, part)`` of about ``STRETCH_BYTES`` of text, null texts as empty ones."""
    waiting, size = [], 0
    for batch in slices(batches, 64):
        waiting.append(batch)
        size += pc.sum(pc.binary_length(batch["text"])).as_py() or 0
        if size > STRETCH_BYTES:
            yield _joined(waiting)
            waiting, size = [], 0
    if waiting:
        yield _joined(waiting)


def _joined(batches: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array, int]:
    table = pa.Table.from_batches(batches).combine_chunks()
    return (table["doc_id"].combine_chunks(), pc.fill_null(table["text"], "").combine_chunks(), table["part"][0].as_py())


def _write(file: str, block: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(public_tokenizers.path(file))  # each executor's own copy
        offsets, doc_ids, sizes, shard, offset = [], [], [], 0, 0
        waiting = np.zeros(0, "<u4")

        def sections(ids: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal offset
            for at in range(0, len(ids), block):
                offsets.append(offset)
                packed = pack_bits(ids[at:at + block], encoder.width)
                offset += len(packed) + 1
                yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["value"])

        for keys, texts, shard in _stretches(batches):
            ids, counts = encoder.encode(texts)
            doc_ids.append(keys)
            sizes.append(counts)
            ids = np.concatenate([waiting, ids])
            whole = len(ids) // block * block
            yield from sections(ids[:whole])
            waiting = ids[whole:].copy()
        encoder.forget()
        if doc_ids:
            yield from sections(waiting)
            keys, counts = pa.chunked_array(doc_ids).combine_chunks(), np.concatenate(sizes)
            index = [np.array(offsets, "<i8"), keys.fill_null(0).to_numpy().astype("<i8"), counts.astype("<i8"),
                     keys.is_null().to_numpy(zero_copy_only=False)]
            tail = struct.pack(TAIL, shard, counts.sum(), len(counts), len(offsets), block, encoder.width, MAGIC)
            yield pa.RecordBatch.from_arrays([pa.array([b"".join([*(x.tobytes() for x in index), tail])], pa.binary())], ["value"])
    return write


def write_ids(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", file: str = VOCABULARY,
              block: int = BLOCK, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the ids of ``documents`` to ``path``, in ascending order of ``key``: one shard per range of it.

    Equal keys may be cut between shards, so a key of a third of all rows is no larger shard than others.
    """
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                            F.monotonically_increasing_id().alias("at"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // shard_bytes))
    ordered = rows.repartitionByRange(parts, "doc_id", "at").sortWithinPartitions("doc_id", "at")
    packed = ordered.select("doc_id", "text", F.spark_partition_id().cast("long").alias("part")).mapInArrow(
        mapped(_write(file, block)), "value binary")
    with setting(documents.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        packed.select(F.col("value").cast("string")).write.option("lineSep", "\n").option("compression", "none").text(path)


def _read(with_ids: bool, most: int = 1 << 18):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            content = batch["content"][0].as_buffer().to_pybytes()
            if not content:
                continue
            shard = Shard(content)
            ends = np.cumsum(shard.sizes)
            low = 0
            while low < len(ends):  # documents of together about ``most`` ids at a time
                base = int(ends[low] - shard.sizes[low])
                high = max(low + 1, int(np.searchsorted(ends, base + most, side="right")))
                ids = shard.ids(base, int(ends[high - 1]))
                cuts = np.r_[base, ends[low:high]] - base
                each = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(high - low, shard.shard)).cast(pa.int64()), pa.array(np.arange(low, high)),
                    pa.array(shard.doc_ids[low:high], pa.int64(), mask=shard.nulls[low:high]),
                    pa.array(cuts[:-1] + base), pa.array(shard.sizes[low:high]),
                    pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()),
                    pa.array(each if with_ids else [None] * len(each), DOCUMENT.field("ids").type)], schema=DOCUMENT)
                low = high
    return read


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids)``, one row per document, from the files below ``path``.

    ``start`` counts the ids of all documents before: those of earlier shards, summed in two levels (thousands
    of shards, then their sums), and those before it in its own.
    """
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("content")
    found = stage_table(files.mapInArrow(mapped(_read(with_ids)), DOCUMENT_SQL), "token_documents")
    many = F.floor(F.col("shard") / 4096).alias("many")
    shards = found.groupBy("shard").agg(F.sum("n_tokens").alias("ids")).select("shard", many, "ids")
    inner = F.sum("ids").over(Window.partitionBy("many").orderBy("shard")) - F.col("ids")
    groups = shards.groupBy("many").agg(F.sum("ids").alias("ids"))  # a row per 4,096 shards
    outer = groups.select("many", (F.sum("ids").over(Window.orderBy("many")) - F.col("ids")).alias("outer"))
    before = shards.select("shard", "many", inner.alias("inner")).join(outer, "many").select(
        "shard", (F.col("inner") + F.col("outer")).alias("before"))
    return found.join(before, "shard").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens",
                                              "ids_crc32", "ids")
