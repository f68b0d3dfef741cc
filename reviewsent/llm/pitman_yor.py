"""Language-model scores by a hierarchical Pitman-Yor process.

A restaurant stands for a context, its customers for the words seen there, and each table sends one
customer to the parent restaurant: two previous words -> one previous word -> no context -> uniform.
Contexts are the words themselves, so there is a restaurant for every word pair and word of the corpus.

1. Texts are hashed once into chunks of tokens. Each chunk sends the hashes of its distinct words to their buckets,
   once, and gets back a number and the training count of each; numbers are in the order of the hashes. Then each
   chunk counts its distinct (word, context) entries and sends them, with word numbers in place of hashes, to the
   bucket of the previous word. Entries after a frequent word are salted by the
   word before it, so they fill many buckets. A bucket holds whole restaurants of two previous words, and
   those of one previous word unless that is frequent: their totals are exact and local. Beside them it keeps the
   places of each chunk's entries, so that entries are sent once.
2. Seating is simulated forward: the customers of a word in a restaurant are seated anew, one after the
   other, by the Chinese-restaurant rule, given the parent's present probability. Buckets send the tables
   of their words up to the buckets of the words, which seat the restaurants of frequent words and the one
   without context, and send customers and tables back. Totals of these restaurants (at most
   :data:`FREQUENT` + 1 rows) are summed for the next pass.
3. In the last pass predictive probabilities are averaged over several samples and sent back to the
   chunks, which add up their logarithms.

A bucket merges the entries of :data:`GROUP` chunks at a time, then the results. All counts cover all rows.
Tokens and restaurants are written in buckets, so no pass shuffles them; the shuffle files of a step go when it is written.
Which words are frequent decides where entries go, not what is counted.

Defined results for odd input: a null or blank text has the end token alone. A row without ``doc_id``
counts as remainder 0 and is learned from. Repeated rows are learned and scored one by one. Without
training documents every probability is uniform. An empty table gives an empty one.
"""

import contextlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from reviewsent.llm.chunks import cogrouped, count_chunks, dump, grouped, load, mapped, messages, slices
from reviewsent.llm.suffix_dedup import mix
from reviewsent.llm.words import hash_words, lower_ascii
from reviewsent.sources.shared import bucketed_table, passing_table, setting, stage_table

#: Words of a bucket or chunk are numbered below it; two of them number a context.
CLASSES = 1 << 29
LEAVES = CLASSES * CLASSES
END, START = np.uint64(0x5D1E7F3A9B2C4D17), np.uint64(0xA3C59AC2F1B7E64D)
#: A word's number: its bucket, and below these bits its place there.
NUMBERED_IN = np.uint64(32)
#: Most words whose entries are salted.
FREQUENT = 1024
HELD_OUT = 2
#: Text per chunk, text hashed at once, and text whose words share a bucket.
CHUNK_BYTES, PART_BYTES, BUCKET_BYTES = 4 << 20, 1 << 20, 8 << 20
#: Chunks that are merged at once.
GROUP = 256
#: Passes that only settle the totals; sweeps per pass; sweeps before the samples that are averaged.
PASSES, SWEEPS, BURN_IN, SAMPLES = 2, 2, 2, 4
STRENGTH = 1.0

MESSAGE = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("message", pa.binary())])
MESSAGE_SQL = "bucket int, chunk bigint, message binary"
TOKENS = pa.schema([("chunk", pa.int64()), ("message", pa.binary()), ("n_tokens", pa.int64()),
                    ("frequent", pa.map_(pa.int64(), pa.int64()))])
TOKENS_SQL = "chunk bigint, message binary, n_tokens bigint, frequent map<bigint, bigint>"
NUMBERED_SQL = "chunk bigint, message binary, numbers binary, frequent map<bigint, bigint>"
NUMBERED = pa.schema([("chunk", pa.int64()), ("message", pa.binary()), ("numbers", pa.binary()),
                      ("frequent", pa.map_(pa.int64(), pa.int64()))])
STATE_SQL = "bucket int, message binary, places binary"
STATE = pa.schema([("bucket", pa.int32()), ("message", pa.binary()), ("places", pa.binary())])
TOTALS_SQL = "level int, context int, customers double, tables double"
RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
RESULT_SQL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7 == HELD_OUT


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, the high bytes, mostly equal, together."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def unplanes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


# chunks

@dataclass
class Tokens:
    """Tokens of a chunk as numbers of its sorted distinct words, and what they are sorted by."""

    words: np.ndarray
    sequence: np.ndarray
    sizes: np.ndarray


class Texts:
    """Documents of a chunk, of which only the hashes of their tokens are kept."""

    def __init__(self):
        self.docs, self.held, self.hashes, self.counts = [], [], [], []
        self.waiting, self.bytes, self.total = [], 0, 0

    def add(self, doc: int | None, held: bool, text: str | None) -> None:
        self.docs.append(doc)
        self.held.append(held)
        self.waiting.append(lower_ascii(text))
        self.bytes += len(self.waiting[-1])
        self.total += len(self.waiting[-1])
        if self.bytes >= PART_BYTES:
            self._read()

    def _read(self) -> None:
        hashes, counts = hash_words(self.waiting)
        self.hashes.append(np.insert(hashes, np.cumsum(counts), END))
        self.counts.append(counts + 1)
        self.waiting, self.bytes = [], 0

    def tokens(self) -> Tokens:
        self._read()
        words, sequence = np.unique(np.concatenate([[START], *self.hashes]), return_inverse=True)
        return Tokens(words, sequence[1:].astype(np.uint32), np.concatenate(self.counts))


@dataclass
class Frequent:
    """Frequent words, sorted, and the buckets over which the entries after each are spread."""

    words: np.ndarray
    salts: np.ndarray
    buckets: int

    def number(self, words: np.ndarray) -> np.ndarray:
        """From 1; 0 for other words."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at + 1, 0)

    def bucket(self, words: np.ndarray, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Of contexts of two of ``words``."""
        number = self.number(words)
        bucket = bucket_of(mix(words), self.buckets).astype(np.int64)[one]
        far = np.flatnonzero((number > 0)[one])
        one = one[far]
        salt = mix(words)[two[far]] % self.salts[number[one] - 1]
        bucket[far] = bucket_of(mix(words[one] + salt * np.uint64(0x9E3779B97F4A7C15)), self.buckets)
        return bucket


def distinct_entries(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two previous words, previous word and word of each distinct entry, sorted; and each token's entry."""
    n, own, first = len(tokens.words), tokens.sequence.astype(np.int64), np.cumsum(tokens.sizes) - tokens.sizes
    start = int(np.searchsorted(tokens.words, START))
    one, two = np.r_[start, own[:-1]], np.r_[start, start, own[:-2]][:len(own)]
    one[first] = start
    two[first] = start
    two[(first + 1)[tokens.sizes > 1]] = start
    if n < 1 << 20:
        distinct, which = np.unique((two * n + one) * n + own, return_inverse=True)
        context = distinct // n
    else:
        contexts, number = np.unique(two * n + one, return_inverse=True)
        distinct, which = np.unique(number * n + own, return_inverse=True)
        context = contexts[distinct // n]
    return context // n, context % n, distinct % n, which


def bucket_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def pack_entries(words: np.ndarray, two: np.ndarray, one: np.ndarray, word: np.ndarray) -> tuple[bytes, ...]:
    """Sorted entries: the numbers of the words they use, the contexts, words per context, words."""
    used = np.zeros(len(words), bool)
    for part in (two, one, word):
        used[part] = True
    used = np.flatnonzero(used)
    number = np.empty(len(words), np.uint32)
    number[used] = np.arange(len(used), dtype=np.uint32)
    at = np.flatnonzero(np.r_[True, (np.diff(two) != 0) | (np.diff(one) != 0)])
    return (planes(np.diff(words[used], prepend=np.uint64(0))), planes(np.diff(number[two[at]], prepend=np.uint32(0))),
            planes(number[one[at]]), planes(np.diff(np.r_[at, len(word)]).astype(np.uint32)), planes(number[word]))


def unpack_entries(words: bytes, two: bytes, one: bytes, sizes: bytes, word: bytes) -> tuple[np.ndarray, ...]:
    """Words; contexts as one number each; the number of each entry's context; its word."""
    two, one = np.cumsum(unplanes(two, np.uint32), dtype=np.int64), unplanes(one, np.uint32).astype(np.int64)
    return (np.cumsum(unplanes(words, np.uint64)), two * CLASSES + one, np.repeat(np.arange(len(two)), unplanes(sizes, np.uint32)),
            unplanes(word, np.uint32).astype(np.int64))


def _parts(tokens: Tokens, frequent: Frequent) -> tuple[np.ndarray, ...]:
    """Distinct entries by bucket: bucket, two, one, word, their places before; and each token's entry before."""
    two, one, word, which = distinct_entries(tokens)
    bucket = frequent.bucket(tokens.words, two, one)
    order = np.argsort(bucket.astype(np.min_scalar_type(frequent.buckets)), kind="stable")  # 16 bits are sorted digit by digit
    return bucket[order], two[order], one[order], word[order], order, which


def _count_messages(tokens: Tokens, numbers: np.ndarray, held: np.ndarray, frequent: Frequent, number: int) -> Iterator[tuple]:
    """Distinct entries of the chunk with their training counts, one message per bucket."""
    bucket, two, one, word, order, which = _parts(tokens, frequent)
    learned = np.bincount(which, np.repeat(~held, tokens.sizes), len(order)).astype(np.uint32)[order]
    for a, b in _runs(bucket):
        yield int(bucket[a]), number, dump(*pack_entries(numbers, two[a:b], one[a:b], word[a:b]), planes(learned[a:b]))


def _runs(bucket: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each run of equal values starts and ends."""
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True]).tolist()
    return zip(cuts[:-1], cuts[1:])


def _by_chunk(batches: Iterable[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[int, Texts]]:
    number = TaskContext.get().partitionId() << 32  # the rows of a scan partition come in one order
    texts = Texts()
    for batch in slices(batches):
        for row in zip(batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(), batch["text"].to_pylist()):
            texts.add(*row)
            if texts.total >= chunk_bytes:
                yield number, texts
                number, texts = number + 1, Texts()
    if texts.docs:
        yield number, texts


def _batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), MESSAGE)], schema=MESSAGE)


def _send_tokens(limit: int):
    """Tokens of every chunk, and its words that may be among the frequent."""
    def send(batches):
        for number, texts in _by_chunk(batches, CHUNK_BYTES):
            t = texts.tokens()
            count = np.bincount(t.sequence, minlength=len(t.words))
            often = np.flatnonzero((count * 4 * limit > len(t.sequence)) & (t.words != END))
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((
                number, dump(texts.docs, texts.held, planes(t.sizes), planes(t.sequence), planes(np.diff(t.words, prepend=np.uint64(0)))),
                len(t.sequence), list(zip(t.words[often].view(np.int64).tolist(), count[often].tolist()))), TOKENS)], schema=TOKENS)
    return send


def _read_tokens(message: bytes) -> tuple[list, list, Tokens]:
    docs, held, sizes, sequence, words = load(message)
    return docs, held, Tokens(np.cumsum(unplanes(words, np.uint64)), unplanes(sequence, np.uint32), unplanes(sizes, np.int64))


def _send_words(buckets: int):
    """The distinct words of every chunk with their training counts, one message per bucket of words."""
    def send(batches):
        for batch in slices(batches, 1):
            _, held, tokens = _read_tokens(batch["message"][0].as_py())
            learned = np.bincount(tokens.sequence, np.repeat(~np.array(held), tokens.sizes), len(tokens.words)).astype(np.uint32)
            bucket, number = bucket_of(tokens.words, buckets).astype(np.int64), batch["chunk"][0].as_py()
            yield _batch((int(bucket[a]), number, dump(planes(np.diff(tokens.words[a:b], prepend=np.uint64(0))), planes(learned[a:b])))
                         for a, b in _runs(bucket))
    return send


def _number_words(table: pa.Table) -> pa.Table:
    """For each chunk the places of its words among the sorted words of the bucket, and their counts over all chunks."""
    number, received = table["bucket"][0].as_py(), [load(m) for m in table["message"].to_pylist()]
    parts = [np.cumsum(unplanes(words, np.uint64)) for words, _ in received]
    distinct, which = np.unique(np.concatenate(parts), return_inverse=True)
    learned = np.bincount(which, np.concatenate([unplanes(n, np.uint32) for _, n in received]), len(distinct)).astype(np.int64)
    places = np.split(which, np.cumsum([len(p) for p in parts])[:-1])
    return messages(MESSAGE, [number] * len(parts), table["chunk"].to_pylist(), [
        dump(planes(np.diff(at, prepend=0).astype(np.uint32)), planes(learned[at])) for at in places])


def _keep_numbers(frequent: Frequent):
    def keep(texts: pa.Table, replies: pa.Table) -> pa.Table:
        """A chunk's tokens as they are, the numbers and training counts of its words, the numbers of the frequent ones."""
        message, numbers, counts = texts["message"][0].as_py(), [], []
        for bucket, reply in sorted(zip(replies["bucket"].to_pylist(), replies["message"].to_pylist())):
            places, learned = load(reply)
            numbers.append(np.cumsum(unplanes(places, np.uint32), dtype=np.uint64) + (np.uint64(bucket) << NUMBERED_IN))
            counts.append(unplanes(learned, np.int64))
        numbers, words = np.concatenate(numbers), _read_tokens(message)[2].words
        often = np.flatnonzero(frequent.number(words))
        return messages(NUMBERED, [texts["chunk"][0].as_py()], [message], [
            dump(planes(np.diff(numbers, prepend=np.uint64(0))), planes(np.concatenate(counts)))],
            [list(zip(words[often].view(np.int64).tolist(), numbers[often].view(np.int64).tolist()))])
    return keep


def _read_numbers(message: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers, counts = load(message)
    return np.cumsum(unplanes(numbers, np.uint64)), unplanes(counts, np.int64)


def _send_counts(frequent: Frequent):
    def send(batches):
        for batch in slices(batches, 1):
            _, held, tokens = _read_tokens(batch["message"][0].as_py())
            numbers, _ = _read_numbers(batch["numbers"][0].as_py())
            yield _batch(_count_messages(tokens, numbers, np.array(held), frequent, batch["chunk"][0].as_py()))
    return send


def numbered(frequent: Frequent, texts: DataFrame) -> Frequent:
    """The frequent words by their numbers, which have the order of the hashes."""
    found = texts.select(F.explode("frequent").alias("word", "number")).distinct().collect()  # at most FREQUENT rows
    return Frequent(np.array(sorted(r["number"] for r in found), np.uint64), frequent.salts, frequent.buckets)


def frequent_words(texts: DataFrame, buckets: int, limit: int) -> Frequent:
    """At most ``limit`` words, each more than a ``limit``-th of all tokens."""
    total = texts.agg(F.sum("n_tokens")).first()[0] or 0
    rows = texts.select(F.explode("frequent").alias("word", "count")).groupBy("word").agg(F.sum("count").alias("count"))
    found = sorted((r["word"] % (1 << 64), r["count"]) for r in rows.where(F.col("count") * limit > total).collect())
    return Frequent(np.array([w for w, _ in found], np.uint64),
                    np.array([-(-2 * n * buckets // total) for _, n in found], np.uint64), buckets)


# buckets

def merge_entries(parts: list[tuple]) -> tuple[tuple[np.ndarray, ...], list[np.ndarray]]:
    """Unpacked entries of several messages as one: words, contexts, context and word of each distinct entry, its count;
    and for each message the places of its entries, which rise."""
    if len(parts) > GROUP:
        groups = [merge_entries(parts[k:k + GROUP]) for k in range(0, len(parts), GROUP)]
        merged, places = merge_entries([m for m, _ in groups])
        return merged, [place[own] for place, (_, owns) in zip(places, groups) for own in owns]
    words, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    words_of = np.split(number, np.cumsum([len(p[0]) for p in parts])[:-1])
    contexts, number = np.unique(np.concatenate([w[p[1] // CLASSES] * CLASSES + w[p[1] % CLASSES]
                                                 for w, p in zip(words_of, parts)]), return_inverse=True)
    contexts_of = np.split(number, np.cumsum([len(p[1]) for p in parts])[:-1])
    n = len(words)
    distinct, which = np.unique(np.concatenate([c[p[2]] * n + w[p[3]] for w, c, p in zip(words_of, contexts_of, parts)]),
                                return_inverse=True)
    count = np.bincount(which, np.concatenate([p[4] for p in parts]), len(distinct))
    return ((words, contexts, distinct // n, distinct % n, count),
            np.split(which, np.cumsum([len(p[3]) for p in parts])[:-1]))


class Dishes:
    """Restaurants of one previous word, and the one without context: customers of pairs of a word and a context,
    and those that are sent to the root directly."""

    def __init__(self, received: list[tuple]):
        parts = [(np.cumsum(unplanes(w, np.uint64)), unplanes(k, np.uint16), unplanes(c, np.uint16), unplanes(n, np.uint32))
                 for w, k, c, n in received]
        self.words, word = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        words_of = np.split(word, np.cumsum([len(p[0]) for p in parts])[:-1])
        keys = np.concatenate([np.repeat(w, p[1]) * CLASSES + p[2] for w, p in zip(words_of, parts)])
        distinct, which = np.unique(keys, return_inverse=True)
        count = np.bincount(which, np.concatenate([p[3] for p in parts]), len(distinct)).astype(np.int64)
        direct = distinct % CLASSES == 0
        self.sent = np.bincount(distinct[direct] // CLASSES, count[direct], len(self.words)).astype(np.int64)
        self.pair_word, self.pair_class, self.pair_count = distinct[~direct] // CLASSES, distinct[~direct] % CLASSES, count[~direct]
        #: For each message its words, and its pairs with a context.
        place = np.cumsum(~direct) - 1
        self.asked = [(w, place[k][~direct[k]]) for w, k in zip(words_of, np.split(which, np.cumsum([len(p[2]) for p in parts])[:-1]))]

    def first_upper(self) -> None:
        self.pair_tables = (self.pair_count > 0).astype(np.int64)
        self._to_root()
        self.word_tables = (self.root_count > 0).astype(np.int64)

    def _to_root(self) -> None:
        self.root_count = self.sent + np.bincount(self.pair_word, self.pair_tables, len(self.words)).astype(np.int64)

    def root(self, model: "Totals") -> np.ndarray:
        return model.predict(0, 0, self.root_count, self.word_tables, model.uniform)

    def sweep_upper(self, model: "Totals", rng: np.random.Generator, root: np.ndarray) -> None:
        self.pair_tables = model.seat(1, self.pair_class, self.pair_count, root[self.pair_word], rng)
        self._to_root()
        self.word_tables = model.seat(0, 0, self.root_count, np.full(len(self.words), model.uniform), rng)

    def totals(self) -> Iterator[tuple[int, int, float, float]]:
        """``(level, context, customers, tables)``."""
        yield from _sums(1, self.pair_class, self.pair_count, self.pair_tables)
        yield from _sums(0, np.zeros(len(self.words), np.int64), self.root_count, self.word_tables)

    def counts_of_counts(self) -> Iterator[tuple[int, int, float, float]]:
        """Under levels 10 to 12: entries seen once and twice."""
        yield from (_seen(11, self.pair_count), _seen(10, self.root_count))


def _sums(level: int, context: np.ndarray, customers: np.ndarray, tables: np.ndarray) -> Iterator[tuple]:
    c, t = np.bincount(context, customers), np.bincount(context, tables)
    for k in np.flatnonzero(c).tolist():
        yield level, k, float(c[k]), float(t[k])


def _seen(level: int, customers: np.ndarray) -> tuple[int, int, float, float]:
    return level, 0, float((customers == 1).sum()), float((customers == 2).sum())


class Bucket(Dishes):
    """All entries (word, context) of the contexts of a bucket: sorted by context, then word."""

    def __init__(self, message: tuple, frequent: Frequent):
        self.words, contexts, context, word = unpack_entries(*message[:5])
        self.count = unplanes(message[5], np.int64)
        self._contexts(word, contexts, context)
        # what is asked of the words' buckets: the word with the frequent word before it, or with none
        self.frequent = frequent.number(self.words)
        above = self.frequent[self.pair_class]
        self.far = above > 0
        keys, self.key = np.unique(self.pair_word * CLASSES + above, return_inverse=True)
        self.key_word, self.key_above = keys // CLASSES, keys % CLASSES

    def _set(self, word: np.ndarray, leaf: np.ndarray) -> None:
        self._contexts(word, *np.unique(leaf, return_inverse=True))

    def _contexts(self, word: np.ndarray, contexts: np.ndarray, context: np.ndarray) -> None:
        self.word, self.contexts, self.leaf = word, contexts, context
        # pairs of a word and the word before it
        distinct, self.pair = np.unique(word * CLASSES + (contexts % CLASSES)[context], return_inverse=True)
        self.pair_word, self.pair_class = distinct // CLASSES, distinct % CLASSES
        self.sent = np.zeros(len(self.words), np.int64)

    def first_seating(self) -> None:
        """One table for each word in each restaurant."""
        self.tables = (self.count > 0).astype(np.int64)
        self._send_up()
        self.first_upper()

    def _send_up(self) -> None:
        """Tables are customers of the parent."""
        self.pair_count = np.bincount(self.pair, self.tables, len(self.pair_word)).astype(np.int64)

    def totals(self) -> Iterator[tuple[int, int, float, float]]:
        yield from _sums(2, self.leaf, self.count, self.tables)
        yield from super().totals()

    def counts_of_counts(self) -> Iterator[tuple[int, int, float, float]]:
        """Under level 20: tokens and distinct words."""
        yield _seen(12, self.count)
        yield from super().counts_of_counts()
        learned = np.bincount(self.word, self.count)
        yield 20, 0, float(self.count.sum()), float((learned > 0).sum())

    def followed(self) -> np.ndarray:
        """Training tokens after each word: as often as the word itself occurs, as the end token follows the last; the
        start is followed as often as the end token occurs."""
        return np.bincount((self.contexts % CLASSES)[self.leaf], self.count, len(self.words)).astype(np.int64)

    def probabilities(self, model: "Totals", above: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Predictive probabilities of all words, pairs and entries under the present seating; ``above`` has what the
        words' buckets know: the parent's probability of each pair, its own after a frequent word."""
        root, pair = self._parents(model, above)
        return root, pair, model.predict(2, self.leaf, self.count, self.tables, pair[self.pair])

    def _parents(self, model: "Totals", above: np.ndarray | None) -> tuple[np.ndarray | None, np.ndarray]:
        root = self.root(model) if above is None else None
        parent = root[self.pair_word] if above is None else above
        pair = model.predict(1, self.pair_class, self.pair_count, self.pair_tables, parent)
        return root, pair if above is None else np.where(self.far, above, pair)

    def sweep(self, model: "Totals", rng: np.random.Generator, above: np.ndarray | None = None) -> None:
        root, pair = self._parents(model, above)
        several = np.flatnonzero(self.count > 1)  # a lone customer has a table for itself
        self.tables = (self.count > 0).astype(np.int64)
        self.tables[several] = model.seat(2, self.leaf[several], self.count[several], pair[self.pair[several]], rng)
        self._send_up()
        if above is None:
            self.sweep_upper(model, rng, root)
        else:
            self.pair_tables = model.seat(1, self.pair_class, self.pair_count, above, rng)

    def own_model(self, model: "Totals") -> "Totals":
        """``model`` with the totals of the bucket's own restaurants."""
        made = model.with_seating([])
        for level, context, customers, tables in ((2, self.leaf, self.count, self.tables),
                                                  (1, self.pair_class, self.pair_count, self.pair_tables)):
            made.customers[level] = np.bincount(context, customers, len(self.contexts if level == 2 else self.words))
            made.tables[level] = np.bincount(context, tables, len(made.customers[level]))
        return made

    def ask(self, number: int) -> Iterator[tuple]:
        """Customers for the words' buckets: tables of pairs, and after a frequent word the pair's customers."""
        value = np.bincount(self.key, np.where(self.far, self.pair_count, self.pair_tables), len(self.key_word)).astype(np.uint32)
        words, at, sizes = np.unique(self.key_word, return_index=True, return_counts=True)
        numbers, at = self.words[words], np.r_[at, len(value)]
        bucket = (numbers >> NUMBERED_IN).astype(np.int64)
        for a, b in _runs(bucket):
            part = slice(at[a], at[b])
            yield int(bucket[a]), number, dump(planes(np.diff(numbers[a:b], prepend=np.uint64(0))), planes(sizes[a:b].astype(np.uint16)),
                                               planes(self.key_above[part].astype(np.uint16)), planes(value[part]))

    def answered(self, model: "Totals", replies: list[tuple]) -> np.ndarray:
        """The parent's probability of each pair from the replies of the words' buckets, in their order."""
        customers, tables, far_customers, far_tables = (np.concatenate([unplanes(r[k], np.float32) for r in replies]).astype(float)
                                                        for k in range(4))
        words, word = np.unique(self.key_word, return_inverse=True)
        found = model.predict(0, 0, customers, tables, model.uniform)[word]
        far = self.key_above > 0
        found[far] = model.predict(1, self.key_above[far], far_customers, far_tables, found[far])
        return found[self.key]


class Totals:
    """Customers and tables of every restaurant, and the discounts: what a bucket must know of the others."""

    def __init__(self, rows: Iterable[tuple[int, int, float, float]]):
        rows = list(rows)
        sizes = {level: 1 + max((r[1] for r in rows if r[0] == level), default=0) for level in range(3)}
        sizes[1] = max(sizes[1], FREQUENT + 1)
        self.customers = {level: np.zeros(n) for level, n in sizes.items()}
        self.tables = {level: np.zeros(n) for level, n in sizes.items()}
        self.frequent = np.zeros(FREQUENT + 1, np.int64)
        self.discount = {0: 0.5, 1: 0.5, 2: 0.5}
        self.tokens = self.words = 0
        for level, context, customers, tables in rows:
            if level in sizes:
                self.customers[level][context], self.tables[level][context] = customers, tables
            elif level == 20:
                self.tokens, self.words = int(customers), int(tables)
            elif level == 30:
                self.frequent[context] = int(customers)
            elif customers:
                self.discount[level - 10] = min(0.95, max(0.05, customers / (customers + 2 * tables)))
        self.uniform = 1 / (self.words + 1)

    def with_seating(self, rows: Iterable[tuple[int, int, float, float]]) -> "Totals":
        made = Totals(rows)
        made.discount, made.tokens, made.words, made.uniform = self.discount, self.tokens, self.words, self.uniform
        made.frequent = self.frequent
        return made

    def predict(self, level: int, context, customers, tables, parent):
        d = self.discount[level]
        opened = STRENGTH + d * self.tables[level][context]
        return (customers - d * tables + opened * parent) / (STRENGTH + self.customers[level][context])

    def seat(self, level: int, context, customers: np.ndarray, parent: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Tables after all customers of each word are seated anew. One customer at a time up to 32, then in
        groups of a sixteenth of those seated, whose chance of a new table hardly differs."""
        d = self.discount[level]
        tables = (customers > 0).astype(np.int64)
        active, seated = np.flatnonzero(customers > 1), 1
        left, now = customers[active], tables[active]
        new = (STRENGTH + d * self.tables[level][context if np.isscalar(context) else context[active]]) * parent[active]
        while len(active):
            chance = new / (new + seated - d * now)
            now += ((rng.random(len(active)) < chance) if seated < 32
                    else rng.binomial(np.minimum(seated // 16, left - seated), chance))
            seated += 1 if seated < 32 else seated // 16
            more = left > seated
            tables[active[~more]] = now[~more]
            active, left, now, new = active[more], left[more], now[more], new[more]
        return tables


def _merge(table: pa.Table) -> pa.Table:
    """The restaurants of a bucket, and for each chunk the places of its entries among theirs."""
    received = [load(m) for m in table["message"].to_pylist()]
    (words, contexts, context, word, count), places = merge_entries(
        [(*unpack_entries(*p[:5]), unplanes(p[5], np.uint32)) for p in received])
    entries = pack_entries(words, (contexts // CLASSES)[context], (contexts % CLASSES)[context], word)
    kept = [planes(np.diff(at, prepend=0).astype(np.uint32)) for at in places]
    return messages(STATE, [table["bucket"][0].as_py()], [dump(*entries, planes(count.astype(np.int64)))],
                    [dump(table["chunk"].to_pylist(), kept)])


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals over the messages of a task."""
    sums: dict[tuple[int, int], list[float]] = {}
    for batch in slices(batches, 1):
        for level, context, customers, tables in load(batch["message"][0].as_py())[0]:
            total = sums.setdefault((level, context), [0.0, 0.0])
            total[0] += customers
            total[1] += tables
    rows = [(*key, *value) for key, value in sums.items()]
    types = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, types)],
                                     ["level", "context", "customers", "tables"])


def _first_counts(bucket: Bucket) -> Iterator[tuple]:
    """What only the contexts' buckets know: counts of counts, tokens, words and how often each frequent word occurs."""
    followed, own = bucket.followed(), bucket.frequent
    yield _seen(12, bucket.count)
    yield _seen(11, bucket.pair_count[~bucket.far])
    yield 20, 0, float(bucket.count.sum()), float(((followed > 0) & (own == 0)).sum())
    for word in np.flatnonzero(own).tolist():
        yield 30, int(own[word]), float(followed[word]), 0.0


def _collect_totals(rows: DataFrame) -> list[tuple]:
    """Sums of the totals that are for no one: at most :data:`FREQUENT` rows and some, whatever the corpus."""
    rows = rows.where("bucket = -1").mapInArrow(mapped(_totals), TOTALS_SQL).groupBy("level", "context").agg(
        F.sum("customers").alias("customers"), F.sum("tables").alias("tables"))
    return [tuple(r) for r in rows.collect()]


def _ask_first(frequent: Frequent):
    """The first customers for the words' buckets; and, for no one, the first counts."""
    def ask(batches):
        for batch in slices(batches, 1):
            bucket = Bucket(load(batch["message"][0].as_py()), frequent)
            bucket.first_seating()
            number = batch["bucket"][0].as_py()
            yield _batch([*bucket.ask(number), (-1, number, dump(list(_first_counts(bucket))))])
    return ask


def _replies(table: pa.Table) -> list[tuple]:
    return [load(m) for _, m in sorted(zip(table["chunk"].to_pylist(), table["message"].to_pylist()))]


def _ask(model: Totals, frequent: Frequent, turn: int):
    """A pass over the restaurants of a bucket, from the leaves up."""
    def ask(state: pa.Table, replies: pa.Table) -> pa.Table:
        number, bucket = state["bucket"][0].as_py(), Bucket(load(state["message"][0].as_py()), frequent)
        rng, above = np.random.default_rng([turn, number]), bucket.answered(model, _replies(replies))
        bucket.first_seating()
        for _ in range(SWEEPS):
            bucket.sweep(bucket.own_model(model), rng, above)
        return messages(MESSAGE, *zip(*bucket.ask(number)))
    return ask


def _reply(model: Totals | None, turn: int):
    """Customers and tables of the words of a bucket for all that asked, averaged over samples; and, for no one, totals.
    Without a model, one table for each word in each restaurant."""
    def reply(table: pa.Table) -> pa.Table:
        number = table["bucket"][0].as_py()
        asked = sorted(zip(table["chunk"].to_pylist(), table["message"].to_pylist()))
        dishes = Dishes([load(m) for _, m in asked])
        dishes.first_upper()
        samples = [[dishes.root_count, dishes.word_tables, dishes.pair_tables]]
        if model is not None:
            rng = np.random.default_rng([turn, number, 1])
            for _ in range(BURN_IN + SAMPLES):
                dishes.sweep_upper(model, rng, dishes.root(model))
                samples.append([dishes.root_count, dishes.word_tables, dishes.pair_tables])
            samples = samples[-SAMPLES:]
        dishes.root_count, dishes.word_tables, dishes.pair_tables = (
            (sum(s[k] for s in samples) / len(samples)).astype(np.float32) for k in range(3))
        rows = [(chunk, number, dump(planes(dishes.root_count[w]), planes(dishes.word_tables[w]),
                                     planes(dishes.pair_count[k].astype(np.float32)), planes(dishes.pair_tables[k])))
                for (chunk, _), (w, k) in zip(asked, dishes.asked)]
        totals = list(dishes.totals()) + (list(dishes.counts_of_counts()) if model is None else [])
        return messages(MESSAGE, *zip(*rows, (-1, number, dump(totals))))
    return reply


def _answer(model: Totals, frequent: Frequent):
    """For each entry of each chunk its averaged probability."""
    def answer(state: pa.Table, replies: pa.Table) -> pa.Table:
        number, bucket = state["bucket"][0].as_py(), Bucket(load(state["message"][0].as_py()), frequent)
        above = bucket.answered(model, _replies(replies))
        rng = np.random.default_rng([PASSES, number])
        bucket.first_seating()
        mean, own = np.zeros(len(bucket.count)), bucket.own_model(model)
        for turn in range(BURN_IN + SAMPLES):
            bucket.sweep(own, rng, above)
            own = bucket.own_model(model)
            if turn >= BURN_IN:
                mean += bucket.probabilities(own, above)[2] / SAMPLES
        mean = mean.astype(np.float32)
        chunks, places = load(state["places"][0].as_py())
        return messages(MESSAGE, [number] * len(chunks), chunks, [
            dump(planes(mean[np.cumsum(unplanes(at, np.uint32), dtype=np.int64)])) for at in places])
    return answer


def _score(model: Totals, frequent: Frequent):
    def score(documents: pa.Table, answers: pa.Table) -> pa.Table:
        docs, held, tokens = _read_tokens(documents["message"][0].as_py())
        parts = [load(m) for _, m in sorted(zip(answers["bucket"].to_pylist(), answers["message"].to_pylist()))]
        _, _, _, _, order, which = _parts(tokens, frequent)
        probability = np.empty(len(order))
        probability[order] = np.concatenate([unplanes(p[0], np.float32) for p in parts])
        _, count = _read_numbers(documents["numbers"][0].as_py())
        first, own = np.cumsum(tokens.sizes) - tokens.sizes, count[tokens.sequence]
        base = np.log10((own + 1) / (model.tokens + model.words + 1))
        known = np.add.reduceat((own > 0).astype(np.int64), first)
        base, full = np.add.reduceat(base, first), np.add.reduceat(np.log10(probability)[which], first)
        return messages(RESULT, docs, held, tokens.sizes.tolist(), known.tolist(), [model.tokens] * len(docs), base.tolist(),
                        full.tolist())
    return score


def score_documents(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per row of
    ``documents``; ``10 ** (-score / n_tokens)`` is a text's perplexity."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), held_out(F.col(key)).alias("held_out"),
                            F.col(text).alias("text"))
    spark = documents.sparkSession
    # each step is written and run once, so nothing reads its shuffles again
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"), contextlib.ExitStack() as steps:
        return _scores(rows, steps)


def _scores(rows: DataFrame, steps: contextlib.ExitStack) -> DataFrame:
    buckets, _ = count_chunks(rows, chunk_bytes=BUCKET_BYTES)
    limit = min(FREQUENT, 2 * buckets)
    with passing_table(rows.mapInArrow(mapped(_send_tokens(limit)), TOKENS_SQL), "tokens") as texts:
        frequent = frequent_words(texts, buckets, limit)
        asked = texts.select("chunk", "message").mapInArrow(mapped(_send_words(buckets)), MESSAGE_SQL)
        replies = asked.groupBy("bucket").applyInArrow(grouped(_number_words), MESSAGE_SQL)
        texts = steps.enter_context(bucketed_table(texts.select("chunk", "message").groupBy("chunk").cogroup(
            replies.groupBy("chunk")).applyInArrow(cogrouped(_keep_numbers(frequent)), NUMBERED_SQL), "numbered_tokens", "chunk"))
    own = numbered(frequent, texts)
    counts = texts.select("chunk", "message", "numbers").mapInArrow(mapped(_send_counts(frequent)), MESSAGE_SQL)
    state = steps.enter_context(bucketed_table(
        counts.groupBy("bucket").applyInArrow(grouped(_merge), STATE_SQL), "restaurants", "bucket"))
    seated, model, written = state.select("bucket", "message"), None, steps.enter_context(contextlib.ExitStack())
    asked = written.enter_context(passing_table(seated.mapInArrow(mapped(_ask_first(own)), MESSAGE_SQL), "first_customers"))
    seen, asked = _collect_totals(asked), asked.where("bucket >= 0")
    for turn in range(PASSES + 1):
        read, written = written, steps.enter_context(contextlib.ExitStack())
        replies = written.enter_context(passing_table(
            asked.groupBy("bucket").applyInArrow(grouped(_reply(model, turn)), MESSAGE_SQL), "replies"))
        read.close()  # what this pass has read
        totals = _collect_totals(replies)
        model = model.with_seating(totals) if model else Totals(_added(seen, totals))
        replies = replies.where("bucket >= 0")
        if turn < PASSES:
            asked = seated.groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(
                cogrouped(_ask(model, own, turn)), MESSAGE_SQL)
    answers = state.groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(cogrouped(_answer(model, own)), MESSAGE_SQL)
    return stage_table(texts.select("chunk", "message", "numbers").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        cogrouped(_score(model, frequent)), RESULT_SQL), "scores")


def _added(rows: list[tuple], more: list[tuple]) -> list[tuple]:
    """Sums of both; of words, each frequent one that is learned counts once."""
    sums: dict[tuple[int, int], tuple[float, float]] = {}
    for level, context, customers, tables in [*rows, *more]:
        c, t = sums.get((level, context), (0.0, 0.0))
        sums[level, context] = c + customers, t + tables
    if (20, 0) in sums:
        learned = sum(c > 0 for (level, _), (c, _) in sums.items() if level == 30)
        sums[20, 0] = sums[20, 0][0], sums[20, 0][1] + learned
    return [(*key, *value) for key, value in sums.items()]
