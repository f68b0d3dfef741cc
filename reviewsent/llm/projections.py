"""Embedding near-dedup by collision counting on many one-dimensional projections.

1. Equal vectors become one *class* with a size. Classes are kept as blobs of some thousand vectors.
2. Classes are dealt into cells, in several tables. A cell of a table is told by the farthest of up to 256
   projections and its side, for one or more sets of projections; how many, and so how small cells are, is chosen
   by the pairs counted in cells (:func:`choose_depth`), and the number of tables follows from it.
   A few classes need no cells: one table with a single one.
3. In a cell each vector is a query: a window is centred on it in each of :data:`PROJECTIONS` other projections, and the
   windows another vector falls into are counted, first on a few projections, then on all. Pairs with
   enough collisions are verified by their cosine in double precision. A pair that meets in several tables counts in
   the first of them.
4. A group of cells returns link counts per vector and a spanning forest of its links, never the
   links themselves, so a large group of similar vectors costs no more rows than others. Stars
   connect the forests.

A large cell is compared by blocks, each pair of them in a group of its own. Tables, or stripes of one with many such pairs,
are shuffled a few at a time and their shuffles deleted before the next, so disk does not grow with their number.

Tables, windows and counts are calibrated for a pair at the threshold: such a pair is missed with probability
below 1e-3, a closer one less often. This holds for any pair of vectors, whatever else the table holds. Work grows
with a power of some 1.15 for vectors without structure, and with the links of a vector where there are many.

Defined results for odd input: vectors that are null, empty, zero, or hold null or non-finite
components are linked with nothing. Vectors of different length are not compared. A vector without
``vec_id`` is linked with nothing and has no component. Rows with one ``vec_id`` are one node, and
each row counts as a vector. An empty table gives an empty one.
"""

import hashlib
import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType

from reviewsent.llm.chunks import CHUNK_BYTES, grouped, mapped, messages
from reviewsent.llm.components import components
from reviewsent.sources.shared import new_path, setting, stage_table

SIMILARITY = 0.9
PROJECTIONS, FIRST = 64, 16
#: A difference of unit vectors at the threshold has this length, so its projections have this deviation.
DEVIATION = (2 - 2 * SIMILARITY) ** 0.5
#: Half window: a pair at the threshold collides in a projection with probability 0.9, and 0.919 on the grid.
WINDOW = 1.645 * DEVIATION
#: Least collisions among the first and among all projections: on the grid below them lies 1 in 100,000.
LEAST_FIRST, LEAST_ALL = 9, 48
#: A pair at the threshold is farther apart in a projection once in 100,000.
CELL = 4.42 * DEVIATION
#: Classes in a block of a large cell, at least; a cell of :data:`LARGE` blocks is cut.
BLOCK, LARGE = 2048, 4
#: Projections in a set, whose farthest one and its side are a code of nine bits.
SET, BITS = 256, 9
#: By bits: how often a pair at the threshold has the same farthest one of 2 ** (bits - 1) projections, measured on a million pairs.
AGREE = (1.0, 0.8562, 0.7327, 0.6605, 0.6003, 0.5469, 0.5026, 0.4645, 0.4311, 0.3998)
#: Bits of a cell that may be chosen, and the probability that a pair at the threshold meets in no table.
DEPTHS, MISSED = (0, 4, 6, 8, 9, 11, 13, 15, 16, 17, 18, 20, 22, 24, 26, 27), 9e-4
#: What a table costs besides its rows, in rows, and as many pairs as cost a row.
TABLE_ROWS, ROW_PAIRS = 20_000, 200
#: Classes in a blob; bytes of vectors that a mapper gathers before it sends them, and that a reader of Arrow batches gets at once.
BLOB, GATHERED, BATCH_BYTES = 4096, 16 << 20, 8 << 20
#: Shuffled at once are so many times all vectors, or so many bytes if that is more.
SHARE, LEAST_BYTES = 2, 32 << 20
#: Entries of a table of collisions that is counted at once.
ENTRIES = 1 << 18

CLASS_SQL = "dimension int, n int, ids binary, sizes binary, digests binary, vectors binary"
CLASS = pa.schema([("dimension", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "sizes", "digests", "vectors"))])
CHUNK_SQL, CHUNK = f"chunk int, {CLASS_SQL}", pa.schema([("chunk", pa.int32()), *CLASS])
COPIES_SQL = "dimension int, level int, part int, side int, codes binary, ids binary, sizes binary, vectors binary"
COPIES = pa.schema([*((c, pa.int32()) for c in ("dimension", "level", "part", "side")),
                    *((c, pa.binary()) for c in ("codes", "ids", "sizes", "vectors"))])
MEMBER_SQL, MEMBER = "vec_id bigint, digest binary, size bigint", pa.schema([("vec_id", pa.int64()), ("digest", pa.binary()), ("size", pa.int64())])
PAIRS_SQL = "dimension int, depth int, possible double, met double, most double"
PAIRS = pa.schema([("dimension", pa.int32()), ("depth", pa.int32()), *((c, pa.float64()) for c in ("possible", "met", "most"))])
SEEN_SQL = "dimension int, level int, code bigint, seen bigint"
SEEN = pa.schema([("dimension", pa.int32()), ("level", pa.int32()), ("code", pa.int64()), ("seen", pa.int64())])
FOUND = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])
FOUND_SQL = "u bigint, v bigint, links bigint"


def directions(dimension: int) -> np.ndarray:
    return np.random.default_rng([20240601, dimension]).standard_normal((dimension, PROJECTIONS))


def _kind(vectors: DataFrame, embedding: str) -> str:
    """Components are kept as they come, as floats or else as doubles."""
    return "<f4" if isinstance(vectors.schema[embedding].dataType.elementType, FloatType) else "<f8"


def _linkable(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors the rows that may have links, and their components."""
    lists = batch["embedding"]
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().cast(pa.float32() if kind == "<f4" else pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    lengths[~batch["vec_id"].is_valid().to_numpy(zero_copy_only=False)] = 0
    for dimension in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dimension)
        found = values[starts[rows][:, None] + np.arange(dimension)]  # a null is NaN here
        good = np.isfinite(found).all(1) & (found != 0).any(1)
        if good.any():
            yield rows[good], found[good]


def _digests(vectors: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(row, digest_size=16).digest() for row in vectors.astype(np.float64)]


def _digest_rows(kind: str):
    def digest_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes = [None] * batch.num_rows, np.zeros(batch.num_rows, np.int64)
            for rows, vectors in _linkable(batch, kind):
                sizes[rows] = vectors.nbytes // len(rows)
                for row, digest in zip(rows.tolist(), _digests(vectors)):
                    digests[row] = digest
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(digests, pa.binary()), pa.array(sizes)], schema=MEMBER)
    return digest_rows


def _merged(ids: np.ndarray, sizes: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row of each digest, that with the smallest id, and its size."""
    order = np.lexsort((ids, digests[:, 1], digests[:, 0]))
    ordered = digests[order]
    starts = np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(1)])
    return order[starts], np.add.reduceat(sizes[order], starts)


def _cut(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``values`` between each two ``cuts``."""
    offsets = (cuts * (values.nbytes // max(1, len(values)))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _send_vectors(chunks: int, kind: str):
    def send(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for dimension, parts in held.items():
            ids, digests, vectors = (np.concatenate(x) for x in zip(*parts))
            rows, sizes = _merged(ids, np.ones(len(ids), np.int64), digests)
            chunk = (digests[rows, 0] % np.uint64(chunks)).astype(np.int32)
            order = np.argsort(chunk, kind="stable")
            rows, sizes, chunk = rows[order], sizes[order], chunk[order]
            cuts = np.r_[0, np.flatnonzero(np.diff(chunk)) + 1, len(rows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk[cuts[:-1]]), pa.array(np.full(len(cuts) - 1, dimension, np.int32)), pa.array(np.diff(cuts).astype(np.int32)),
                 *(_cut(x, cuts) for x in (ids[rows], sizes, digests[rows], vectors[rows]))], schema=CHUNK)

    def send_vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0
        for batch in batches:
            for rows, vectors in _linkable(batch, kind):
                held[vectors.shape[1]].append((batch["vec_id"].to_numpy(zero_copy_only=False)[rows].astype(np.int64),
                                               np.frombuffer(b"".join(_digests(vectors)), np.uint64).reshape(-1, 2), vectors))
                size += vectors.nbytes
            if size >= GATHERED:
                yield from send(held)
                held, size = defaultdict(list), 0
        yield from send(held)
    return send_vectors


def _merge_classes(kind: str):
    def merge(table: pa.Table) -> pa.Table:
        dimension = table["dimension"][0].as_py()
        ids, sizes = _joined(table["ids"], np.int64), _joined(table["sizes"], np.int64)
        digests = _joined(table["digests"], np.uint64).reshape(-1, 2)
        vectors = _joined(table["vectors"], kind).reshape(-1, dimension)
        rows, sizes = _merged(ids, sizes, digests)
        cuts = np.r_[np.arange(0, len(rows), BLOB), len(rows)]
        return pa.Table.from_arrays(
            [pa.array(np.full(len(cuts) - 1, dimension, np.int32)), pa.array(np.diff(cuts).astype(np.int32)),
             *(_cut(x, cuts) for x in (ids[rows], sizes, digests[rows], vectors[rows]))], schema=CLASS)
    return merge


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, sizes, digests in zip(*(batch[c].to_pylist() for c in ("ids", "sizes", "digests"))):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, np.int64)), pa.array([digests[k:k + 16] for k in range(0, len(digests), 16)], pa.binary()),
                                              pa.array(np.frombuffer(sizes, np.int64))], schema=MEMBER)


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    units = vectors.astype(np.float64)
    with np.errstate(over="ignore", under="ignore"):
        squares = np.einsum("ij,ij->i", units, units)
    odd = np.flatnonzero(~((squares > 1e-200) & (squares < 1e200)))
    if len(odd):  # squares too large or too small for a double
        units[odd] /= np.abs(units[odd]).max(1, keepdims=True)
        squares[odd] = np.einsum("ij,ij->i", units[odd], units[odd])
    units /= np.sqrt(squares)[:, None]
    return units


_axes: dict[tuple[int, int, int], np.ndarray] = {}


def _whole_axes(dimension: int, level: int, axes: int) -> np.ndarray:
    """Directions of a table in whole numbers, kept up to 32 MB."""
    if (dimension, level, axes) not in _axes:
        if sum(x.nbytes for x in _axes.values()) > 32 << 20:
            _axes.clear()
        step = min(64, 2 ** int(math.log2(max(1, 3000 / dimension ** 0.5))))
        drawn = np.random.default_rng([20240601, dimension, 1 + level]).standard_normal((axes, dimension), np.float32)
        _axes[dimension, level, axes] = np.ascontiguousarray(np.rint(drawn * step).T)
    return _axes[dimension, level, axes]


def _farthest(projected: np.ndarray) -> np.ndarray:
    """The number of the farthest projection of each row, twice, and one more on its negative side."""
    far = np.abs(projected).argmax(1)
    return 2 * far + (projected[np.arange(len(far)), far] < 0)


def depth_codes(units: np.ndarray, level: int, *depths: int) -> Iterator[np.ndarray]:
    """The cell of each vector in table ``level``, for each depth: codes of whole sets, then that of a smaller one. Vectors and
    directions are whole numbers whose products add up exactly, so a vector has the same cell wherever it is asked for."""
    sizes = [[SET] * (d // BITS) + [2 ** (d % BITS - 1)] * (d % BITS > 0) for d in depths]
    axes = _whole_axes(units.shape[1], level, max(map(sum, sizes)))
    codes = np.zeros((len(depths), len(units)), np.int64)
    for start in range(0, len(units), 512):
        part = slice(start, start + 512)
        whole = np.rint(units[part] * 4096).astype(np.float32)
        farthest: dict[tuple[int, int], np.ndarray] = {}
        for at in range(0, axes.shape[1], SET):
            projected = whole @ axes[:, at:at + SET]
            for size in {own[at // SET] for own in sizes if len(own) > at // SET}:
                farthest[at, size] = _farthest(projected[:, :size])
        for code, own in zip(codes, sizes):
            for k, size in enumerate(own):
                code[part] = code[part] * (2 * size) + farthest[k * SET, size]
    yield from codes


def cell_codes(units: np.ndarray, level: int, depth: int) -> np.ndarray:
    return next(depth_codes(units, level, depth))


def tables_of(depth: int) -> int:
    """As many tables as let a pair at the threshold meet in one of them."""
    sets, rest = divmod(depth, BITS)
    agree = AGREE[BITS] ** sets * AGREE[rest]
    return 1 if agree == 1 else math.ceil(math.log(MISSED) / math.log(1 - agree))


def _gathered(batches: Iterable[pa.RecordBatch], kind: str, *columns: str) -> Iterator[tuple]:
    """``(dimension, vectors, *columns)`` of some megabytes, for each dimension."""
    held, size = defaultdict(list), defaultdict(int)

    def taken(dimension: int) -> tuple:
        found = [b"".join(x) for x in zip(*held.pop(dimension))]
        size.pop(dimension)
        return dimension, np.frombuffer(found[0], kind).reshape(-1, dimension), *found[1:]

    for batch in batches:
        for dimension, *values in zip(*(batch[c].to_pylist() for c in ("dimension", "vectors", *columns))):
            held[dimension].append(values)
            size[dimension] += len(values[0])
            if size[dimension] >= GATHERED:
                yield taken(dimension)
    for dimension in list(held):
        yield taken(dimension)


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by code, and where each code starts and how many there are of it."""
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0][:len(codes)])
    return order, starts, np.diff(np.r_[starts, len(codes)])


def _count_pairs(kind: str):
    """Pairs that meet in a cell of the first table, by depth, among the vectors that a task reads."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dimension, vectors in _gathered(batches, kind):
            units, n = unit_vectors(vectors), len(vectors)
            out = []
            for depth, codes in zip(DEPTHS[1:], depth_codes(units, 0, *DEPTHS[1:])):
                lengths = _runs(codes)[2].astype(np.float64)
                out.append((dimension, depth, n * (n - 1.0), (lengths * (lengths - 1)).sum(), lengths.max() / n))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), PAIRS)], schema=PAIRS)
    return count


def choose_depth(n: int, share: dict[int, float]) -> int:
    """The depth whose tables cost least for ``n`` classes, of whose pairs ``share`` meet in a table, by depth."""
    return min(DEPTHS, key=lambda d: tables_of(d) * (n + TABLE_ROWS + share.get(d, 1.0) * n * (n - 1) / ROW_PAIRS))


class Plan(NamedTuple):
    """How the classes of one dimension are dealt: ``large[level]`` has ``(code, classes)`` of large cells."""
    classes: int
    depth: int
    parts: int
    large: dict[int, list[tuple[int, int]]]


class Deal(NamedTuple):
    """Table ``level`` of a plan: its large cells, their blocks and the number of the first pair of blocks of each. Pairs of
    blocks are dealt to ``stripes``, of which this is one; what is in no large cell goes with the first."""
    level: int
    depth: int
    parts: int
    codes: np.ndarray
    blocks: np.ndarray
    first: np.ndarray
    stripe: int = 0
    stripes: int = 1


def _count_large(kind: str, plans: dict[int, Plan]):
    """Cells that have the share of a large one among the vectors that a task reads, for all tables."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dimension, vectors in _gathered(batches, kind):
            plan, units = plans[dimension], unit_vectors(vectors)
            least = max(2, LARGE * BLOCK * len(vectors) / plan.classes / 2)
            for level in range(tables_of(plan.depth)):
                codes = cell_codes(units, level, plan.depth)
                order, starts, lengths = _runs(codes)
                some = lengths >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(some.sum(), x, np.int32)) for x in (dimension, level)]
                    + [pa.array(codes[order[starts[some]]]), pa.array(lengths[some].astype(np.int64))], schema=SEEN)
    return count


def _deal(plan: Plan, level: int, row_bytes: int, limit: float) -> tuple[Deal, int]:
    """Table ``level`` with blocks large enough that copies stay within ``limit`` bytes, and those bytes."""
    cells = sorted(plan.large.get(level, []))
    codes, counts = (np.array([c[k] for c in cells], np.int64) for k in (0, 1))
    block = BLOCK
    while True:
        blocks = -(-counts // block)
        size = (plan.classes + int(((blocks - 1) * counts).sum())) * row_bytes
        if size <= limit or block * row_bytes >= GATHERED:
            break
        block *= 2
    return Deal(level, plan.depth, plan.parts, codes, blocks, plan.parts + np.cumsum(blocks ** 2) - blocks ** 2), size


def _send_copies(kind: str, deals: dict[int, list[Deal]]):
    """Each vector to the group that has its cell, or to all pairs of blocks with its block of a large cell. ``side`` is 2 where all
    vectors of a cell are compared, else 0 or 1, and vectors of different sides are."""
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dimension, vectors, *rest in _gathered(batches, kind, "ids", "sizes", "digests"):
            ids, sizes, digests = (np.frombuffer(x, t) for x, t in zip(rest, (np.int64, np.int64, np.uint64)))
            units, spread = unit_vectors(vectors), digests[1::2]
            for level, depth, parts, large, blocks, first, stripe, stripes in deals[dimension]:
                codes = cell_codes(units, level, depth)
                mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
                part = (mixed % np.uint64(parts)).astype(np.int64)
                rows, side = np.arange(len(codes)), np.full(len(codes), 2, np.int32)
                if len(large):
                    at = np.minimum(np.searchsorted(large, codes), len(large) - 1)
                    cut = large[at] == codes
                    n = np.where(cut, blocks[at], 1)
                    own = (spread % n.astype(np.uint64)).astype(np.int64)
                    low = (stripe - own) % stripes  # the first block of the other side
                    times = np.maximum(0, -((low - n) // stripes))
                    rows = np.repeat(rows, times)
                    if not len(rows):
                        continue
                    other = low[rows] + stripes * (np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times))
                    own = own[rows]
                    pair = first[at][rows] + np.minimum(own, other) * n[rows] + np.maximum(own, other)
                    side = np.where(cut[rows] & (own != other), (own > other).astype(np.int32), np.int32(2))
                    part = np.where(cut[rows], pair, part[rows])
                key = part * 3 + side
                order = np.argsort(key, kind="stable")
                cuts = np.r_[0, np.flatnonzero(np.diff(key[order])) + 1, len(order)]
                at = order[cuts[:-1]]
                for k in range(0, len(cuts) - 1, 1024):  # copies of large cells a stretch at a time
                    some = cuts[k:k + 1025]
                    taken, m = rows[order[some[0]:some[-1]]], len(some) - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, dimension, np.int32)), pa.array(np.full(m, level, np.int32)),
                         pa.array(part[at[k:k + m]].astype(np.int32)), pa.array(side[at[k:k + m]].astype(np.int32)),
                         *(_cut(x[taken], some - some[0]) for x in (codes, ids, sizes, vectors))], schema=COPIES)
    return send


#: Projections are compared as whole numbers of this step, with windows one step wider on each side.
STEP = WINDOW / 20
HALF = int(WINDOW / STEP) + 1
#: Of no vector: outside all windows of projections on the grid, also where the difference of bytes wraps round.
NOWHERE = 127


def on_grid(projected: np.ndarray) -> np.ndarray:
    steps = projected / STEP
    return np.clip(np.rint(steps, out=steps), -100, 100, out=steps).astype(np.int8)


def _collide(first: np.ndarray, rest: np.ndarray, i: np.ndarray, j: np.ndarray, ordered: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a grid collide often enough: ``first`` has a row per projection, ``rest`` a column. Each number in ``i``
    is compared with those in ``j`` that it is broadcast to, where ``ordered`` only with larger ones."""
    shape = np.broadcast_shapes(i.shape, j.shape)
    apart, inside, count = np.empty(shape, np.int8), np.empty(shape, bool), np.zeros(shape, np.int8)
    for line in first:  # in the window if the distance from its lower end, as an unsigned number, is at most its width
        np.subtract(line[j], line[i] - np.int8(HALF), out=apart)
        np.less_equal(apart.view(np.uint8), np.uint8(2 * HALF), out=inside)
        np.add(count, inside.view(np.int8), out=count)
    hits = np.flatnonzero(count.ravel() >= LEAST_FIRST)
    one, other = (np.broadcast_to(x, shape).ravel()[hits] for x in (i, j))
    count = count.ravel()[hits]
    if ordered:
        some = one < other
        one, other, count = one[some], other[some], count[some]
    kept = [np.zeros(0, bool)]
    for k in range(0, len(one), 1 << 16):
        some = slice(k, k + (1 << 16))
        more = (rest[other[some]] - (rest[one[some]] - np.int8(HALF))).view(np.uint8) <= 2 * HALF
        bytewise = more.view(np.uint64)  # sums of up to six in each byte, and then of the bytes
        bytewise = sum(bytewise[:, c] for c in range(1, bytewise.shape[1])) + bytewise[:, 0]
        more = (bytewise * np.uint64(0x0101010101010101)) >> np.uint64(56)
        kept.append(count[some] + more.astype(np.int16) >= LEAST_ALL)
    kept = np.concatenate(kept)
    return one[kept], other[kept]


def _lines(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first projections by row and the rest by column, with a vector that is nowhere at the end."""
    grid = np.concatenate([grid, np.full((1, PROJECTIONS), NOWHERE, np.int8)])
    return np.ascontiguousarray(grid[:, :FIRST].T), np.ascontiguousarray(grid[:, FIRST:])


def count_collisions(queries: np.ndarray, others: np.ndarray) -> Iterator[np.ndarray]:
    """For each row of projections (:func:`on_grid`) in ``queries`` the rows of ``others`` that collide often enough."""
    lines, n = _lines(np.concatenate([queries, others])), len(queries)
    for i, j in _rectangles(np.arange(n), np.arange(n, n + len(others)), ordered=False):
        one, other = _collide(*lines, i, j, ordered=False)
        for k in i.ravel().tolist():
            yield np.sort(other[one == k]) - n


def _rectangles(rows: np.ndarray, columns: np.ndarray, ordered: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All of ``rows`` with all of ``columns``, where ``ordered`` from the same place on, in parts of limited size."""
    step = max(1, ENTRIES // max(1, len(columns)))
    for k in range(0, len(rows), step):
        yield rows[k:k + step, None], columns[None, k if ordered else 0:]


def _meetings(starts: np.ndarray, lengths: np.ndarray, nowhere: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All places of each run with one another; short runs of about the same length together."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    at, end = 0, int((lengths > 1).sum())
    while at < end:
        n = int(lengths[at])
        together = ENTRIES // (n * n)
        if together < 2:
            run = np.arange(starts[at], starts[at] + n)
            yield from _rectangles(run, run, ordered=True)
            at += 1
            continue
        high = min(end, at + together)
        places = np.arange(n)[:, None]
        runs = np.where(places < lengths[None, at:high], starts[None, at:high] + places, nowhere)
        yield (runs[:, None, :], runs[None, :, :]) if n < 48 else (runs.T[:, :, None], runs.T[:, None, :])
        at = high


def _cosines(units: np.ndarray, one: np.ndarray, other: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    if i.ndim == 2 and 8 * len(one) > i.size * j.size:  # most of a rectangle
        return (units[i.ravel()] @ units[j.ravel()].T)[one - i[0, 0], other - j[0, 0]]
    return np.concatenate([np.zeros(0)] + [np.einsum("ij,ij->i", units[one[k:k + 16384]], units[other[k:k + 16384]])
                                           for k in range(0, len(one), 16384)])


def _root_edges(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Join the trees in ``parent`` along edges, and tell the edges that join two."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        high, some = np.unique(np.maximum(a, b), return_index=True)
        parent[high] = np.minimum(a, b)[some]
        yield i[some], j[some]
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def _compare_copies(kind: str, depths: dict[int, int]):
    """Rows ``(u, null, links)`` that add up to the links of ``u``, and rows ``(u, v, null)`` of a spanning forest."""
    def compare(table: pa.Table) -> pa.Table:
        dimension, level = table["dimension"][0].as_py(), table["level"][0].as_py()
        codes, ids, sizes = (_joined(table[c], np.int64) for c in ("codes", "ids", "sizes"))
        side = np.repeat(table["side"].to_numpy(), [len(x) // 8 for x in table["codes"].to_pylist()])
        across = side[0] != 2
        order, starts, lengths = _runs(side if across else codes)
        ids, sizes = ids[order], sizes[order]
        units = unit_vectors(_joined(table["vectors"], kind).reshape(-1, dimension)[order])
        n = len(units)
        planes = directions(dimension).astype(np.float32)
        lines = _lines(np.concatenate([on_grid(units[k:k + 4096].astype(np.float32) @ planes) for k in range(0, n, 4096)]))
        if across:
            places = [np.arange(a, a + k) for a, k in zip(starts, lengths)]
            meetings = _rectangles(*places, ordered=False) if len(places) == 2 else ()
        else:
            meetings = _meetings(starts, lengths, n)
        parent, links, edges = np.arange(n), np.zeros(n), []
        for i, j in meetings:
            one, other = _collide(*lines, i, j, ordered=not across)
            if len(one):
                similar = _cosines(units, one, other, i, j) >= SIMILARITY
                one, other = one[similar], other[similar]
            for earlier in range(level):
                if not len(one):
                    break
                asked, places = np.unique(np.concatenate([one, other]), return_inverse=True)
                met = cell_codes(units[asked], earlier, depths[dimension])[places]
                new = met[:len(one)] != met[len(one):]
                one, other = one[new], other[new]
            if len(one):
                links += np.bincount(one, sizes[other], n) + np.bincount(other, sizes[one], n)
                edges.extend(_root_edges(parent, one, other))
        u, v = (np.concatenate([np.zeros(0, np.int64), *(ids[e[k]] for e in edges)]) for k in (0, 1))
        some = np.flatnonzero(links)
        nothing = [None] * len(some)
        return messages(FOUND, np.concatenate([u, ids[some]]), v.tolist() + nothing,
                        [None] * len(u) + np.rint(links[some]).astype(np.int64).tolist())
    return compare


def _plans(classes: DataFrame, kind: str) -> dict[int, Plan]:
    """Depth and large cells by dimension, from counts over all classes."""
    counted = {r["dimension"]: r["n"] for r in classes.groupBy("dimension").agg(F.sum("n").alias("n")).collect()}
    many = [d for d, n in counted.items() if n > BLOCK]
    share, most = defaultdict(dict), {}
    if many:
        rows = classes.where(F.col("dimension").isin(many)).select("dimension", "vectors")
        for r in rows.mapInArrow(mapped(_count_pairs(kind)), PAIRS_SQL).groupBy("dimension", "depth").agg(
                F.sum("met").alias("met"), F.sum("possible").alias("possible"), F.max("most").alias("most")).collect():
            share[r["dimension"]][r["depth"]] = r["met"] / max(1.0, r["possible"])
            most[r["dimension"], r["depth"]] = r["most"]
    least = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plans = {}
    for dimension, n in counted.items():
        depth = choose_depth(n, share[dimension])
        parts = max(least if depth else 1, -(-n * (np.dtype(kind).itemsize * dimension + 24) // CHUNK_BYTES))
        plans[dimension] = Plan(n, depth, parts, {} if depth else {0: [(0, n)]})
    crowded = {d: p for d, p in plans.items() if p.depth and p.classes * most[d, p.depth] > LARGE * BLOCK / 4}
    if crowded:
        rows = classes.where(F.col("dimension").isin(list(crowded))).select("dimension", "vectors")
        seen = rows.mapInArrow(mapped(_count_large(kind, crowded)), SEEN_SQL).groupBy("dimension", "level", "code").agg(F.sum("seen").alias("seen"))
        for r in seen.where(F.col("seen") >= LARGE * BLOCK // 2).collect():  # at most a cell for every two blocks of a table
            plans[r["dimension"]].large.setdefault(r["level"], []).append((r["code"], r["seen"]))
    return plans


def _rounds(plans: dict[int, Plan], kind: str) -> Iterator[dict[int, list[Deal]]]:
    """As many tables at a time as stay within :data:`SHARE` times all vectors, or a stripe of one that does not."""
    row_bytes = {d: np.dtype(kind).itemsize * d + 24 for d in plans}
    limit = max(LEAST_BYTES, SHARE * sum(p.classes * row_bytes[d] for d, p in plans.items()))
    deals, size = defaultdict(list), 0
    for dimension, plan in plans.items():
        for level in range(tables_of(plan.depth)):
            deal, more = _deal(plan, level, row_bytes[dimension], limit)
            stripes = math.ceil(more / limit)
            for stripe in range(stripes):
                if deals and size + more / stripes > limit:
                    yield dict(deals)
                    deals, size = defaultdict(list), 0
                deals[dimension].append(deal._replace(stripe=stripe, stripes=stripes))
                size += more / stripes
    if deals:
        yield dict(deals)


def group_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``."""
    spark = vectors.sparkSession
    # each step is written and run once, so nothing reads its shuffles again
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"), \
            setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        return _grouped(vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")),
                        _kind(vectors, embedding))


def _grouped(vectors: DataFrame, kind: str) -> DataFrame:
    spark = vectors.sparkSession
    rows = stage_table(vectors.mapInArrow(mapped(_digest_rows(kind)), MEMBER_SQL), "vector_digests")
    size = rows.agg(F.sum("size")).first()[0] or 0
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // CHUNK_BYTES))
    classes = stage_table(vectors.mapInArrow(mapped(_send_vectors(chunks, kind)), CHUNK_SQL).groupBy("chunk", "dimension")
                          .applyInArrow(grouped(_merge_classes(kind)), CLASS_SQL), "vector_classes")
    plans, path = _plans(classes, kind), new_path(spark, "links")
    depths = {d: p.depth for d, p in plans.items()}
    spark.createDataFrame([], FOUND_SQL).write.parquet(path)
    for deals in _rounds(plans, kind):
        copies = classes.where(F.col("dimension").isin(list(deals))).drop("n").mapInArrow(mapped(_send_copies(kind, deals)), COPIES_SQL)
        copies.groupBy("dimension", "level", "part").applyInArrow(grouped(_compare_copies(kind, depths)), FOUND_SQL).write.mode(
            "append").parquet(path)
    found = spark.read.schema(FOUND_SQL).parquet(path)
    members = stage_table(classes.select("ids", "sizes", "digests").mapInArrow(mapped(_members), MEMBER_SQL), "vector_members")
    # copies with different numbers of one node are connected through their class
    parts = components(found.where("v IS NOT NULL").select("u", "v").union(
        rows.where(F.col("digest").isNotNull()).join(members.select("digest", F.col("vec_id").alias("v")), "digest")
        .where("vec_id <> v").select(F.col("vec_id").alias("u"), "v")))
    links = found.where("links IS NOT NULL").groupBy("u").agg(F.sum("links").alias("links"))
    counted = (members.select("digest", "size", F.col("vec_id").alias("u")).join(links, "u", "left")
               .select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    result = (rows.select("vec_id", "digest").join(counted, "digest", "left")
              .join(parts.withColumnRenamed("node", "vec_id"), "vec_id", "left"))
    component = F.coalesce("component", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
