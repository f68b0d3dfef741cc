"""Documents in chunks: groups of whole documents that Python code reads together.

A chunk is a hash group of the rows, a few megabytes of text, so it spreads every source and
every group of copies. Operators that must look something up in tables too large to broadcast
send one compact message per chunk and bucket instead of one row per word, and get one back.
"""

import contextlib
import ctypes
import functools
import pickle
import time
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

CHUNK_BYTES = 4 << 20
PACKED = "chunk int, packed binary"


def count_chunks(documents: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> tuple[int, int]:
    """``(chunks, bytes)``: as many chunks as the texts fill, at least one per shuffle partition."""
    size = documents.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    least = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // chunk_bytes)), size


def dump(*arrays) -> bytes:
    """Arrays, texts and numbers as one compressed message."""
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def load(message: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(message))


_released = [0.0]


def release_memory() -> None:
    """Give freed memory back to the system, at most twice a second. Python workers live on between tasks,
    and what their allocators keep would count against the executor."""
    if time.monotonic() - _released[0] > 0.5:
        _released[0] = time.monotonic()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries
            ctypes.CDLL(None).malloc_trim(0)


def grouped(function):
    """``function`` of a group, with its memory released after it."""
    def lean(table: pa.Table) -> pa.Table:
        result = function(table)
        release_memory()
        return result
    return lean


def cogrouped(function):
    """``function`` of two groups, with its memory released after it."""
    def lean(one: pa.Table, other: pa.Table) -> pa.Table:
        result = function(one, other)
        release_memory()
        return result
    return lean


def mapped(function):
    """``function`` of batches, with its memory released between its results and at the end."""
    def lean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for result in function(batches):
            yield result
            del result
            release_memory()
        _released[0] = 0.0
        release_memory()
    return lean


def slices(batches: Iterable[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: an Arrow batch of texts can hold tens of megabytes, and as many Python
    strings beside it would double that."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _pack(batches: Iterable[pa.RecordBatch], distinct: bool = False) -> Iterator[pa.RecordBatch]:
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if distinct:
            table = table.group_by(table.column_names).aggregate([]).select(table.column_names)
        table = table.take(pc.sort_indices(table["chunk"])).combine_chunks()
        numbers = table["chunk"].to_numpy()
        rows = table.drop_columns(["chunk"])
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        chunks, packed = [], []
        for start, end in zip(cuts, cuts[1:]):
            if start < end:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                    writer.write_table(rows.slice(start, end - start))
                chunks.append(int(numbers[start]))
                packed.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(packed, pa.binary())],
                                         ["chunk", "packed"])


def chunk_of(chunks: int, *columns: str):
    return F.pmod(F.xxhash64(*columns), F.lit(chunks)).cast("int")


def pack(documents: DataFrame, chunks: int, *columns: str, by: tuple[str, ...] = (), distinct: bool = False) -> DataFrame:
    """``(chunk, packed)``: rows of ``columns``, compressed before they are shuffled by chunk; ``by`` names the
    columns that decide the chunk, if not all. ``distinct`` merges equal rows of a batch, which all have one chunk."""
    number = chunk_of(chunks, *(by or columns))
    return documents.select(*columns, number.alias("chunk")).mapInArrow(
        mapped(functools.partial(_pack, distinct=distinct)), PACKED)


def unpack(packed: Iterable[bytes]) -> list[tuple]:
    """The rows of one chunk in an order that depends on their values alone, nulls last, first columns first."""
    rows = []
    for message in packed:
        table = pa.ipc.open_stream(message).read_all()
        rows.extend(zip(*(column.to_pylist() for column in table.columns)))
    rows.sort(key=lambda row: (*((value is None, 0 if value is None else value) for value in row[:2]), repr(row[2:])))
    return rows


def messages(schema: pa.Schema, *columns) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
