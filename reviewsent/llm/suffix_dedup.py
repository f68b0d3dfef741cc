"""Suffix-array dedup: remove every byte of a 50-byte string that also starts in an earlier document.

1. *Anchors.* Each 50-byte window is routed by the smallest hash of its 26-byte strings. Equal
   windows have equal anchors, neighbouring windows mostly share one, so a text falls into runs
   of about 13 windows. Chunks send their distinct anchors, buckets answer which of them occur
   in two documents or more. Nothing else can repeat, so only those runs go on.
2. *Suffix array.* The bytes of the remaining runs meet by anchor. Each bucket sorts the suffixes
   of its text in two stages: suffixes smaller than their successors are sorted directly, the
   others are induced by scans of the first-byte buckets. Adjacent common prefixes of 50 bytes or
   more join equal windows, and each group learns its smallest ``doc_id``.
3. *Removal.* Chunks get that number back for each of their windows and cut their texts.

A chunk sends each run once, however many of its documents share it, and a bucket holds one entry
per chunk, so a passage of a third of all documents does not gather in one task. Anchors of more
than :data:`HOT_RUNS` runs are dealt out again, window by window.

Defined results for odd input: a null text is empty; a text under 50 bytes is kept whole; rows with
the same ``doc_id`` don't remove from each other; a row without ``doc_id`` is kept whole and removes
nothing. Every row gives one result row. An empty table gives an empty one.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewsent.llm.chunks import cogrouped, count_chunks, dump, grouped, load, messages, pack, unpack

LENGTH = 50
GRAM = 26
#: Windows per block of a hash pass, runs per suffix array, windows per run at most.
BLOCK, BUCKET_ANCHORS, MAX_RUN = 1 << 16, 250_000, 4096
#: Runs from which an anchor's windows are dealt out by their own bytes.
HOT_RUNS = 16_384

MESSAGE = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("message", pa.binary())])
MESSAGE_SQL = "bucket int, chunk int, kind int, message binary"
VERDICT, RUNS = 0, 1
RESULT_SQL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _window_minima(data: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """For each window of ``LENGTH`` bytes the smallest hash of the ``GRAM``-byte strings in it."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(data * down[:n], out=sums[1:])
    low = mix((sums[GRAM:] - sums[:-GRAM]) * up[:n - GRAM + 1])
    width, wanted = 1, LENGTH - GRAM + 1
    while width * 2 <= wanted:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:-(wanted - width)], low[wanted - width:]) if wanted > width else low


def find_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor, none across the document ends: ``(anchor, start, windows)``."""
    up, down = powers(min(len(data), BLOCK + LENGTH) + 1)
    inside = np.ones(max(0, len(data) - LENGTH + 1), bool)  # the window ends before its document does
    for end in ends[:-1].tolist():
        inside[max(0, end - LENGTH + 1):end] = False
    anchors, starts, sizes = [], [], []
    for at in range(0, len(inside), BLOCK):
        keep = inside[at:at + BLOCK]
        low = _window_minima(data[at:at + len(keep) + LENGTH - 1], up, down)
        new = np.r_[True, (low[1:] != low[:-1]) | (keep[1:] != keep[:-1])]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(keep)])
        good = keep[first]
        first, size = first[good], size[good]
        if len(size) and size.max() > MAX_RUN:  # one byte repeated: cut, any cut is right
            parts = -(-size // MAX_RUN)
            number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            size = np.minimum(np.repeat(size, parts) - number * MAX_RUN, MAX_RUN)
            first = np.repeat(first, parts) + number * MAX_RUN
        anchors.append(mix(low[first]) >> np.uint64(16))
        starts.append(first + at)
        sizes.append(size)
    if not anchors:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(anchors), np.concatenate(starts), np.concatenate(sizes)


class Chunk:
    """The texts of a chunk end to end, and their runs. Rows without ``doc_id`` come last and have no runs.
    Columns after ``doc_id`` and ``text`` are carried along."""

    def __init__(self, packed):
        self.rows = unpack(packed)
        self.texts = [(row[1] or "").encode("utf-8", "surrogatepass") for row in self.rows]
        known = [row[0] for row in self.rows if row[0] is not None]
        self.bytes = b"".join(self.texts)
        self.ends = np.cumsum([len(t) for t in self.texts]) if self.texts else np.zeros(0, np.int64)
        self.doc_ids = np.array(known, np.int64)
        size = int(self.ends[len(known) - 1]) if known else 0
        data = np.frombuffer(self.bytes, np.uint8)[:size]
        self.anchor, self.start, self.windows = find_runs(data, self.ends[:len(known)])
        self.doc = self.doc_ids[np.searchsorted(self.ends, self.start, side="right")] if known else self.start

    def segments(self, verdicts: np.ndarray, buckets: int):
        """Distinct runs that may repeat, per bucket: ``{bucket: {bytes: [runs]}}`` with ``(start, windows, doc)``."""
        distinct, which = np.unique(self.anchor, return_inverse=True)
        found: dict[int, dict[bytes, list]] = {}
        if not len(distinct):
            return found
        verdict = verdicts[which]
        bucket = bucket_of(self.anchor, buckets)
        whole = verdict == 1
        for b, s, n, d in zip(bucket[whole].tolist(), self.start[whole].tolist(), self.windows[whole].tolist(),
                              self.doc[whole].tolist()):
            found.setdefault(b, {}).setdefault(self.bytes[s:s + n + LENGTH - 1], []).append((s, n, d))
        hot = verdict == 2
        for s, n, d in zip(self.start[hot].tolist(), self.windows[hot].tolist(), self.doc[hot].tolist()):
            for i in range(s, s + n):
                window = self.bytes[i:i + LENGTH]
                b = int.from_bytes(hashlib.blake2b(window, digest_size=4).digest(), "big") * buckets >> 32
                found.setdefault(b, {}).setdefault(window, []).append((i, 1, d))
        return found


def bucket_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the (48-bit) anchors."""
    return ((anchor >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)


def _send_anchors(buckets: int):
    def send(table: pa.Table) -> pa.Table:
        chunk = Chunk(table["packed"].to_pylist())
        distinct, which, runs = np.unique(chunk.anchor, return_inverse=True, return_counts=True)
        several = np.zeros(len(distinct), bool)
        first = np.zeros(len(distinct), np.int64)
        first[which] = chunk.doc
        several[which[first[which] != chunk.doc]] = True
        bucket = bucket_of(distinct, buckets)
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True]) if len(distinct) else np.zeros(1, int)
        out, number = [], table["chunk"][0].as_py()
        for a, e in zip(cuts[:-1], cuts[1:]):
            steps = np.diff(distinct[a:e], prepend=np.uint64(0))
            planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes()  # high bytes are zeros, and compress
            few = np.minimum(runs[a:e], 255).astype(np.uint8)
            out.append((int(bucket[a]), number, VERDICT, dump(planes, several[a:e], few)))
        return messages(MESSAGE, *(zip(*out) if out else [[]] * 4))
    return send


def _read_anchors(message: bytes):
    planes, several, runs = load(message)
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps), several, runs


def _answer_anchors(table: pa.Table) -> pa.Table:
    """For each anchor of each chunk: 0 in one document, 1 in several, 2 in very many runs."""
    parts = [_read_anchors(m) for m in table["message"].to_pylist()]
    anchors = np.concatenate([p[0] for p in parts])
    distinct, which, chunks = np.unique(anchors, return_inverse=True, return_counts=True)
    several = np.bincount(which, np.concatenate([p[1] for p in parts]), len(distinct)) > 0
    runs = np.bincount(which, np.concatenate([p[2] for p in parts]), len(distinct))
    verdict = ((several | (chunks > 1)).astype(np.uint8) * (1 + (runs > HOT_RUNS)).astype(np.uint8))[which]
    out = np.split(verdict, np.cumsum([len(p[0]) for p in parts])[:-1])
    return messages(MESSAGE, table["bucket"].to_pylist(), table["chunk"].to_pylist(), table["kind"].to_pylist(),
                    [dump(v) for v in out])


def _verdicts(rows: pa.Table) -> np.ndarray:
    answers = sorted(zip(rows["bucket"].to_pylist(), rows["message"].to_pylist()))
    return np.concatenate([load(m)[0] for _, m in answers]) if answers else np.zeros(0, np.uint8)


def _send_runs(buckets: int):
    def send(packed: pa.Table, answers: pa.Table) -> pa.Table:
        """Bytes of the runs that may repeat, each once, with the smallest document that has it. The
        verdicts travel along, as the chunk needs them again to read the answer."""
        number = packed["chunk"][0].as_py()
        verdicts = _verdicts(answers)
        out = [(number % buckets, number, VERDICT, dump(verdicts))]
        for bucket, runs in Chunk(packed["packed"].to_pylist()).segments(verdicts, buckets).items():
            sizes = np.array([len(text) for text in runs], np.int32)
            docs = np.array([min(d for _, _, d in places) for places in runs.values()], np.int64)
            out.append((bucket, number, RUNS, dump(sizes, docs, b"".join(runs))))
        return messages(MESSAGE, *zip(*out))
    return send


def _sort_directly(position: np.ndarray, words: np.ndarray) -> np.ndarray:
    """``position`` ordered by the first 56 bytes of the suffixes; eight bytes a round, ties only."""
    position = position[np.argsort(words[position], kind="stable")]
    key = words[position]
    group = np.cumsum(np.r_[False, key[1:] != key[:-1]])
    for offset in range(8, LENGTH, 8):
        same = np.r_[False, group[1:] == group[:-1]]
        tied = np.flatnonzero(same | np.r_[same[1:], False])
        if not len(tied):
            break
        key, own = words[position[tied] + offset], group[tied]
        order = np.lexsort((key, own))
        position[tied] = position[tied][order]
        key = key[order]
        step = np.r_[False, (key[1:] != key[:-1]) & (own[1:] == own[:-1])]
        more = np.zeros(len(position), np.int64)
        more[tied] = step
        group = np.cumsum(np.r_[False, group[1:] != group[:-1]] | (more > 0))
    return position


def sort_suffixes(text: bytes, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``wanted`` positions ordered by the first ``LENGTH`` bytes of their suffixes, and the eight-byte words."""
    n = len(text)
    padded = np.frombuffer(text + bytes(64), np.uint8)
    words = np.zeros(n + 56, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k:k + n + 56]
    byte = np.r_[padded[:n].astype(np.int16), np.int16(-1)]  # the end is smaller than any byte

    # a suffix is smaller than its successor if the next different byte is larger
    run = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]])
    rising = np.r_[byte[run[1:]] > byte[run[:-1]], False]
    rising = np.repeat(rising, np.diff(np.r_[run, n + 1]))[:n]

    # what the wanted suffixes are induced from: the falling positions after them, and the rising one that ends these
    chosen = np.zeros(n, bool)
    chosen[wanted] = True
    before = np.r_[-1, np.maximum.accumulate(np.where(rising, np.arange(n), -1))[:-1]]
    seen = np.r_[0, np.cumsum(chosen)]
    needed = seen[1:] - seen[before + 1] > 0

    direct = _sort_directly(np.flatnonzero(needed & rising), words)
    induced = np.flatnonzero(needed & ~rising)
    counts = np.zeros((256, 2), np.int64)
    counts[:, 0] = np.bincount(byte[induced], minlength=256)
    counts[:, 1] = np.bincount(byte[direct], minlength=256)
    place = (np.cumsum(counts.ravel()) - counts.ravel()).reshape(256, 2)  # per first byte: induced, then direct
    order = np.empty(counts.sum(), np.int64)
    rank = np.full(n + 1, -1, np.int64)
    at = place[byte[direct], 1] + np.arange(len(direct)) - (np.cumsum(counts[:, 1]) - counts[:, 1])[byte[direct]]
    order[at], rank[direct] = direct, at
    by_byte = induced[np.argsort(byte[induced], kind="stable")]
    for c, part in enumerate(np.split(by_byte, np.cumsum(counts[:, 0])[:-1])):
        level = part[byte[part + 1] < c]
        level = level[np.argsort(rank[level + 1], kind="stable")]
        start = place[c, 0]
        while len(level):  # then those one equal byte further to the left, in the same order
            order[start:start + len(level)] = level
            rank[level] = np.arange(start, start + len(level))
            start += len(level)
            level = level[level > 0] - 1
            level = level[needed[level] & ~rising[level] & (byte[level] == c)]
    return order[chosen[order]], words


def repeats_of(order: np.ndarray, words: np.ndarray) -> np.ndarray:
    """True where a suffix shares its first ``LENGTH`` bytes with the one before it in the order."""
    same = np.ones(max(0, len(order) - 1), bool)
    for offset in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
        key = words[order + offset]
        same &= key[1:] == key[:-1]
    return np.r_[False, same] if len(order) else same


def _answer_runs(table: pa.Table) -> pa.Table:
    """For each window of each run a chunk sent: the smallest document that has these bytes."""
    numbers, kinds, sent = table["chunk"].to_pylist(), table["kind"].to_pylist(), table["message"].to_pylist()
    index: dict[bytes, int] = {}
    docs, parts = [], []
    for number, kind, message in zip(numbers, kinds, sent):
        if kind == RUNS:
            sizes, mine, text = load(message)
            ends = np.cumsum(sizes).tolist()
            which = np.array([index.setdefault(text[e - n:e], len(index)) for e, n in zip(ends, sizes.tolist())])
            parts.append((number, which))
            docs.append(mine)
    out = [(0, n, VERDICT, m) for n, k, m in zip(numbers, kinds, sent) if k == VERDICT]
    if parts:
        sizes = np.array([len(t) for t in index], np.int64)
        smallest = np.full(len(index), np.iinfo(np.int64).max)
        np.minimum.at(smallest, np.concatenate([w for _, w in parts]), np.concatenate(docs))
        windows = sizes - LENGTH + 1
        first = np.cumsum(windows) - windows  # of each run in the list of all windows
        inside = np.arange(windows.sum()) - np.repeat(first, windows)
        wanted = np.repeat(np.cumsum(sizes) - sizes, windows) + inside
        order, words = sort_suffixes(b"".join(index), wanted)
        number_of = np.full(sizes.sum(), -1, np.int64)
        number_of[wanted] = np.arange(len(wanted))
        sorted_windows = number_of[order]
        starts = np.flatnonzero(~repeats_of(order, words))
        least = np.minimum.reduceat(np.repeat(smallest, windows)[sorted_windows], starts)
        least_of = np.empty(len(wanted), np.int64)
        least_of[sorted_windows] = np.repeat(least, np.diff(np.r_[starts, len(order)]))
        for number, which in parts:
            n = windows[which]
            at = np.repeat(first[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            values = least_of[at]
            change = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
            out.append((table["bucket"][0].as_py(), number, RUNS,
                        dump(np.diff(np.r_[change, len(values)]).astype(np.int32), values[change])))
    return messages(MESSAGE, *zip(*out))


def _removed(chunk: Chunk, answers: pa.Table, buckets: int) -> np.ndarray:
    """True for each byte of the chunk that goes."""
    kinds, messages_ = answers["kind"].to_pylist(), answers["message"].to_pylist()
    verdicts = [load(m)[0] for k, m in zip(kinds, messages_) if k == VERDICT]
    least = {b: load(m) for k, b, m in zip(kinds, answers["bucket"].to_pylist(), messages_) if k == RUNS}
    flagged = np.zeros(len(chunk.bytes) + 1, bool)
    for bucket, runs in chunk.segments(verdicts[0] if verdicts else np.zeros(0, np.uint8), buckets).items():
        lengths, values = least[bucket]
        documents = np.repeat(values, lengths)
        at = 0
        for text, places in runs.items():
            n = len(text) - LENGTH + 1
            own = documents[at:at + n]
            low, high = int(own.min()), int(own.max())
            for start, _, doc in places:
                if high < doc:
                    flagged[start:start + n] = True
                elif low < doc:
                    flagged[start:start + n] = own < doc
            at += n
    if not flagged.any():
        return flagged[:-1]
    total = np.cumsum(flagged[:-1], dtype=np.int32)
    recent = total.copy()
    recent[LENGTH:] -= total[:-LENGTH]
    return recent > 0


def _rests(chunk: Chunk, removed: np.ndarray):
    """Row, text bytes, which of them go, and the rest, for each document."""
    data = np.frombuffer(chunk.bytes, np.uint8)
    for row, text, end in zip(chunk.rows, chunk.texts, chunk.ends.tolist()):
        gone = removed[end - len(text):end]
        yield row, text, gone, data[end - len(text):end][~gone].tobytes() if gone.any() else text


def _report(buckets: int, keep_text: bool):
    def report(packed: pa.Table, answers: pa.Table) -> pa.Table:
        chunk, out = Chunk(packed["packed"].to_pylist()), []
        for row, text, gone, rest in _rests(chunk, _removed(chunk, answers, buckets)):
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            out.append((row[0], len(text), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(),
                        rest.decode("utf-8", "ignore") if keep_text else None))
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                            ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])
        return messages(schema, *(zip(*out) if out else [[]] * 6))
    return report


def _rewrite(buckets: int, names: list[str], place: int):
    """Rows with the columns ``names``, the text being the one at ``place``."""
    def rewrite(packed: pa.Table, answers: pa.Table) -> pa.Table:
        sent = packed["packed"].to_pylist()
        chunk, out = Chunk(sent), []
        for row, text, gone, rest in _rests(chunk, _removed(chunk, answers, buckets)):
            kept = rest.decode("utf-8", "ignore") if gone.any() else row[1]
            out.append((*row[2:2 + place], kept, *row[2 + place:]))
        fields = list(pa.ipc.open_stream(sent[0]).schema)
        fields = [*fields[2:2 + place], fields[1], *fields[2 + place:]]
        schema = pa.schema([pa.field(name, f.type) for name, f in zip(names, fields)])
        return messages(schema, *zip(*out))
    return rewrite


def _with_answers(rows: DataFrame, finish, schema: str, *carried: str) -> DataFrame:
    """``finish(buckets)`` of each chunk of ``(doc_id, text, carried)`` rows with its answers."""
    chunks, size = count_chunks(rows)
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                  -(-size // (BUCKET_ANCHORS * (LENGTH - GRAM + 2) // 2)))
    by_chunk = pack(rows, chunks, "doc_id", "text", *carried, by=("doc_id", "text")).groupBy("chunk")
    asked = by_chunk.applyInArrow(grouped(_send_anchors(buckets)), MESSAGE_SQL)
    verdicts = asked.groupBy("bucket").applyInArrow(grouped(_answer_anchors), MESSAGE_SQL)
    sent = by_chunk.cogroup(verdicts.groupBy("chunk")).applyInArrow(cogrouped(_send_runs(buckets)), MESSAGE_SQL)
    answers = sent.groupBy("bucket").applyInArrow(grouped(_answer_runs), MESSAGE_SQL)
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(cogrouped(finish(buckets)), schema)


def remove_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text",
                   keep_text: bool = True) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)``; ``kept`` is the rest of the text, without
    bytes of characters that a removal cut in two (null if not ``keep_text``)."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _with_answers(rows, lambda buckets: _report(buckets, keep_text), RESULT_SQL)


def cut_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with the repeats removed from ``text``; all else stays."""
    others = [c for c in documents.columns if c != text]
    carried = [f"carried_{i}" for i in range(len(others))]
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                            *(F.col(c).alias(n) for c, n in zip(others, carried)))
    place = documents.columns.index(text)
    return _with_answers(rows, lambda buckets: _rewrite(buckets, documents.columns, place), documents.schema, *carried)
