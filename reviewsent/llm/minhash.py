"""MinHash near-dedup: banded minima find candidates, full sets confirm, stars connect.

1. Each text becomes its set of five-word shingles (64-bit hashes). Texts with equal sets are one
   *class*, numbered when the classes are written and represented by the text of its smallest
   ``doc_id``; copies go no further.
2. Minima of :data:`HASHES` universal hashes are cut into bands. Classes with an equal band
   share a bucket.
3. First round: every member of a bucket is compared with the bucket's smallest, as a star. Pairs
   whose signatures agree well enough are confirmed on the full sets. Components follow.
4. Second round: only members of one bucket that are in different components are left. Blocks of
   them are compared by signature, and those with a partner again on their full sets, all pairs of a
   pair of blocks at once, as products of incidence matrices. So every pair that shares a band has
   been compared or is connected already, and no link between components is lost.

A bucket is never expanded into rows of pairs: the first round is linear, and in the second the
members of a bucket's largest component meet the others only, in blocks of bounded size, each pair of
which returns one link per two components at most.

Defined results for odd input: a null or blank text has an empty set, is linked with nothing and
kept. Rows with one ``doc_id`` are one document: each of its texts is compared for itself, and what is
linked with any of them is linked with the document. A row without ``doc_id`` is linked with nothing: its
``component_id`` is null and it is kept. An empty table gives an empty one.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewsent.llm.chunks import chunk_of, cogrouped, count_chunks, dump, grouped, load, mapped, messages, pack, unpack
from reviewsent.llm.components import components
from reviewsent.llm.words import hash_shingles, hash_words, lower_ascii
from reviewsent.sources.shared import stage_table

SHINGLE = 5
#: Percent of the union that two sets must share.
SIMILARITY = 75
#: At similarity 0.75 a pair misses all 28 bands of 4 minima with probability 2e-5.
BANDS, ROWS = 28, 4
HASHES = BANDS * ROWS
#: Equal minima from which a pair is confirmed: six standard deviations below 0.75.
LEAST_EQUAL = int(HASHES * 0.75 - 6 * (HASHES * 0.75 * 0.25) ** 0.5)
#: Members per block and documents per confirmation group; shingles per product of incidence matrices.
BLOCK, GROUP, COLUMNS = 512, 256, 4096

FEATURES = pa.schema([("doc_id", pa.int64()), ("text_key", pa.string()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                      ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])
FEATURES_SQL = "doc_id bigint, text_key string, n_shingles bigint, digest binary, bands array<bigint>, signature binary"
PAIR = pa.schema([("u", pa.int64()), ("v", pa.int64())])
PAIR_SQL = "u bigint, v bigint"


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    hashes, counts = hash_shingles(*hash_words([lower_ascii(t) for t in texts]), SHINGLE)
    return [np.unique(part) for part in np.split(hashes, np.cumsum(counts)[:-1])] if texts else []


def _universal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of ``n`` multiply-shift hashes."""
    draw = np.random.default_rng(20240601)
    a = draw.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 1 << 63, n, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of the universal hashes, one row per set that isn't empty."""
    a, b = _universal(HASHES)
    out, at = np.empty((len(sets), HASHES), np.uint32), 0
    while at < len(sets):  # about 32,000 shingles at a time stay in the cache
        end, total = at + 1, len(sets[at])
        while end < len(sets) and total + len(sets[end]) <= 32_768:
            total += len(sets[end])
            end += 1
        values = np.concatenate(sets[at:end])
        firsts = np.cumsum([0, *(len(s) for s in sets[at:end - 1])])
        for k in range(HASHES):
            out[at:end, k] = np.minimum.reduceat(((values * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32), firsts)
        at = end
    return out


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            sets = shingle_sets(batch["text"].to_pylist())
            full = [i for i, s in enumerate(sets) if len(s)]
            digest, bands, signature = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            minima = signatures([sets[i] for i in full])
            for row, i in enumerate(full):
                digest[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                bands[i] = [int.from_bytes(hashlib.blake2b(minima[row, k:k + ROWS].tobytes(), digest_size=8).digest(),
                                           "big", signed=True) for k in range(0, HASHES, ROWS)]
                signature[i] = (minima[row] & 255).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip((batch["doc_id"], batch["text_key"], [len(s) for s in sets], digest, bands,
                                                      signature), FEATURES)], schema=FEATURES)


def _agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, other = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("su", "sv"))
        keep = pa.array((one == other).sum(1) >= LEAST_EQUAL)
        yield batch.select(["u", "v"]).filter(keep)


BLOCKS = pa.schema([("band", pa.int32()), ("bucket", pa.int64()), ("low", pa.int32()), ("high", pa.int32()),
                    ("node", pa.int64()), ("component", pa.int64()), ("block", pa.int32())])
BLOCKS_SQL = "band int, bucket bigint, low int, high int, node bigint, component bigint, block int"


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the lower and of the higher block, all rows twice for a block with itself."""
    block, low, high = (table[c].to_numpy() for c in ("block", "low", "high"))
    return np.flatnonzero(block == low), np.flatnonzero(block == high)


def _compare_signatures(table: pa.Table) -> pa.Table:
    """The rows that agree with a row of another component."""
    comps = table["component"].to_numpy()
    rows = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, HASHES)
    one, other = _sides(table)
    found = np.zeros(len(rows), bool)
    for i in one.tolist():
        rest = other[comps[other] != comps[i]]
        hits = rest[(rows[rest] == rows[i]).sum(1) >= LEAST_EQUAL]
        found[hits] = True
        found[i] |= len(hits) > 0
    return table.select(BLOCKS.names).filter(pa.array(found))


def _shared_shingles(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets."""
    both, which = np.unique(np.concatenate([*one, *other]), return_inverse=True)
    del both
    row = np.repeat(np.arange(len(one) + len(other)), [len(s) for s in [*one, *other]])
    left = row < len(one)
    seen = np.bincount(which[left], minlength=which.max() + 1) * np.bincount(which[~left], minlength=which.max() + 1)
    column = np.cumsum(seen > 0) - 1  # of the shingles that both sides have
    some = seen[which] > 0
    which, row = column[which[some]], row[some]
    order = np.argsort(which, kind="stable")
    which, row = which[order], row[order]
    total = np.zeros((len(one), len(other)), np.float32)
    for at in range(0, int(column[-1]) + 1, COLUMNS):
        a, b = np.searchsorted(which, [at, at + COLUMNS])
        part = np.zeros((len(one) + len(other), COLUMNS), np.float32)
        part[row[a:b], which[a:b] - at] = 1
        total += part[:len(one)] @ part[len(one):].T
    return total


def _link_blocks(table: pa.Table) -> pa.Table:
    """For each two components that are linked in this pair of blocks one link."""
    nodes, comps = table["node"].to_numpy(), table["component"].to_numpy()
    sets = shingle_sets([load(m)[0] for m in table["message"].to_pylist()])
    one, other = _sides(table)
    if not len(one) or not len(other):
        return messages(PAIR, [], [])
    shared = _shared_shingles([sets[i] for i in one], [sets[i] for i in other])
    sizes = np.array([len(s) for s in sets], np.float32)
    union = sizes[one][:, None] + sizes[other][None, :] - shared
    linked = (100 * shared >= SIMILARITY * union) & (shared > 0) & (comps[one][:, None] != comps[other][None, :])
    i, j = np.nonzero(linked)
    _, first = np.unique(np.stack([comps[one[i]], comps[other[j]]]), axis=1, return_index=True)
    return messages(PAIR, nodes[one[i[first]]].tolist(), nodes[other[j[first]]].tolist())


def _send_texts(packed: pa.Table, wanted: pa.Table) -> pa.Table:
    """``wanted`` rows with the text of their class."""
    keys = list(zip(wanted["doc_id"].to_pylist(), wanted["text_key"].to_pylist()))
    asked = set(keys)
    texts = {row[:2]: row[2] for row in unpack(packed["packed"].to_pylist()) if row[:2] in asked} if asked else {}
    sent = {key: dump(texts.get(key)) for key in asked}
    return wanted.drop_columns(["chunk", "doc_id", "text_key"]).append_column(
        "message", pa.array([sent[key] for key in keys], pa.binary()))


def with_texts(wanted: DataFrame, classes: DataFrame, documents: DataFrame, chunks: int, schema: str) -> DataFrame:
    """``wanted`` rows (of ``schema``, with a ``node``) and the text of their class as a message."""
    packed = pack(documents, chunks, "doc_id", "text_key", "text", by=("doc_id", "text_key"), distinct=True)
    asked = (wanted.join(classes.select("node", "doc_id", "text_key"), "node")
             .select(*wanted.columns, "doc_id", "text_key", chunk_of(chunks, "doc_id", "text_key").alias("chunk")))
    return packed.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(cogrouped(_send_texts), schema + ", message binary")


def _confirm(table: pa.Table) -> pa.Table:
    """Classes whose full set is similar to the hub's."""
    hub, nodes = table["hub"][0].as_py(), table["node"].to_pylist()
    sets = shingle_sets([load(m)[0] for m in table["message"].to_pylist()])
    center, found = sets[nodes.index(hub)], []
    for node, own in zip(nodes, sets):
        shared = len(np.intersect1d(center, own, assume_unique=True))
        if node != hub and 100 * shared >= SIMILARITY * (len(center) + len(own) - shared) and shared:
            found.append(node)
    return messages(PAIR, found, [hub] * len(found))


def confirm_pairs(pairs: DataFrame, classes: DataFrame, documents: DataFrame, chunks: int) -> DataFrame:
    """The ``(u, v)`` of ``pairs`` whose full sets are similar. Pairs meet at ``v``, at most about
    :data:`GROUP` of them in one group, so a hub of very many pairs is split. Its text leaves its chunk
    once and is repeated per group after that, row by row."""
    pairs = pairs.select("u", "v").distinct()
    degree = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("groups"))
    salt = F.pmod(F.xxhash64("u"), F.col("groups")).cast("int")
    spokes = pairs.join(degree, "v").select(F.col("v").alias("hub"), salt.alias("first"), salt.alias("last"),
                                            F.col("u").alias("node"))
    hubs = degree.select(F.col("v").alias("hub"), F.lit(0).alias("first"), (F.col("groups") - 1).alias("last"),
                         F.col("v").alias("node"))
    sent = with_texts(spokes.union(hubs), classes, documents, chunks, "hub bigint, first int, last int, node bigint")
    salted = sent.select("hub", "node", "message", F.explode(F.sequence("first", "last")).alias("salt"))
    return salted.groupBy("hub", "salt").applyInArrow(grouped(_confirm), PAIR_SQL)


def crowded(classes: DataFrame) -> DataFrame:
    """``(band, bucket, node, v)`` of the buckets with two members or more; ``v`` is the smallest of them.

    Most buckets hold one text, so what follows reads a small part of the bands.
    """
    members = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    hubs = members.groupBy("band", "bucket").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return members.join(hubs.drop("n"), ["band", "bucket"])


def open_blocks(members: DataFrame, parts: DataFrame, signature: DataFrame) -> DataFrame:
    """Members of a bucket that agree in their signatures with one of another component, per pair of blocks."""
    placed = (members.join(parts, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    shares = placed.groupBy("band", "bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    split = shares.groupBy("band", "bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.max("n").alias("n_largest"),
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("component", "n")).alias("parts"),
    ).where("k > 1")
    # the same few classes share many bands: one bucket for each set of members is enough
    same = placed.join(split, ["band", "bucket"]).groupBy("band", "bucket").agg(
        F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("y"))
    one = same.groupBy("x", "y").agg(F.min(F.struct("band", "bucket")).alias("b")).select("b.band", "b.bucket")
    split = split.join(one, ["band", "bucket"])
    big = F.ceil(F.col("n_largest") / BLOCK).cast("int")       # blocks of the largest component: 0 .. big - 1
    rest = F.ceil((F.col("n") - F.col("n_largest")) / BLOCK).cast("int")  # then those of the others
    own = F.when(F.col("component") == F.col("largest"), F.pmod(F.xxhash64("node"), big)).otherwise(
        big + F.pmod(F.xxhash64("node"), rest)).cast("int")
    others = F.when(F.col("component") == F.col("largest"), F.sequence(big, big + rest - 1)).otherwise(
        F.sequence(F.lit(0), big + rest - 1))
    rows = (placed.join(split, ["band", "bucket"]).withColumn("block", own).withColumn("other", F.explode(others))
            .select("band", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                    "node", "component", "block"))
    return (rows.join(signature, "node").groupBy("band", "bucket", "low", "high")
            .applyInArrow(grouped(_compare_signatures), BLOCKS_SQL))


def _same_document(full: DataFrame, classes: DataFrame) -> DataFrame:
    """``(u, v)``: the classes of a document with several texts, as a star."""
    several = full.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least < most")
    links = full.join(several.drop("most"), "doc_id").where("digest > least").select("digest", "least").distinct()
    number = classes.select("digest", "node")
    return (links.join(number.withColumnRenamed("node", "u"), "digest")
            .join(number.select(F.col("digest").alias("least"), F.col("node").alias("v")), "least").select("u", "v"))


def group_copies(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``documents``."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                            F.sha2(F.col(text).cast("binary"), 256).alias("text_key"))
    chunks, _ = count_chunks(rows)
    features = stage_table(rows.mapInArrow(mapped(_features), FEATURES_SQL), "minhash")
    full = features.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = full.groupBy("digest").agg(F.min(F.struct("doc_id", "text_key")).alias("k"),
                                         F.min_by(F.struct("bands", "signature"), "doc_id").alias("f"))
    # numbers hold once they are written: a class is read by the number it was written with
    classes = stage_table(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "k.*", "f.*"), "minhash_classes")
    signature = classes.select("node", "signature")
    members = stage_table(crowded(classes), "buckets")
    stars = members.where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    agree = (stars.join(signature.select(F.col("node").alias("u"), F.col("signature").alias("su")), "u")
             .join(signature.select(F.col("node").alias("v"), F.col("signature").alias("sv")), "v")
             .mapInArrow(mapped(_agree), PAIR_SQL))
    links = stage_table(confirm_pairs(agree, classes, rows, chunks).union(_same_document(full, classes)), "links")
    parts = stage_table(components(links), "components")
    left = stage_table(open_blocks(members, parts, signature), "open_blocks")
    if not left.isEmpty():
        more = with_texts(left, classes, rows, chunks, BLOCKS_SQL).groupBy("band", "bucket", "low", "high").applyInArrow(
            grouped(_link_blocks), PAIR_SQL)
        parts = stage_table(components(links.union(stage_table(more.distinct(), "links"))), "components")
    placed = (classes.select("node", "digest", "doc_id").join(parts, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    least = parts.join(classes.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    labels = placed.join(least, "component", "left").select("digest", F.coalesce("smallest", "doc_id").alias("component_id"))
    found = features.select("doc_id", "n_shingles", "digest")
    # an empty text of a document that has others goes with them
    empty = found.where(F.col("digest").isNull())
    others = (full.join(empty.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id")
              .agg(F.min("digest").alias("digest")).join(labels, "digest").select("doc_id", "component_id"))
    found = (found.where(F.col("digest").isNotNull()).join(labels, "digest", "left").select("doc_id", "n_shingles", "component_id")
             .union(empty.join(others, "doc_id", "left").select("doc_id", "n_shingles", "component_id")))
    return (found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
                         .alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_copies(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one of each group. Of repeated rows with one ``key`` and text one stays, the
    first by its other columns; rows without a ``key`` all stay."""
    found = group_copies(documents, key, text).where(F.col("doc_id").isNotNull())
    marks = stage_table(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and("kept").alias("stays"))
                        .where("n > 1 OR NOT stays"), "marks")
    own = F.col("doc_id").cast(documents.schema[key].dataType).alias(key)
    once = documents.join(marks.select(own), key, "left_anti").select(documents.columns)
    others = [c for c in documents.columns if c not in (key, text)]
    repeated = (documents.join(marks.where("stays").select(own), key, "left_semi")
                .select(F.struct(*documents.columns).alias("row"))
                .groupBy(F.col("row")[key].alias("row_key"), F.col("row")[text].alias("row_text"))
                .agg(F.min_by("row", F.to_json(F.struct(*[F.col("row")[c].alias(c) for c in others], F.lit(1).alias("_")))).alias("row")))
    return once.union(repeated.select("row.*"))
