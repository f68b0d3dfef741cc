"""Personal data: patterns find the plain forms, a semi-Markov conditional random field the others.

The field scores whole spans, not tokens: how many digits and groups a span has, its separators,
check digits, what stands around it. A dynamic program over the tokens of a region, with spans of at
most :data:`MAX_TOKENS` tokens, chooses boundaries and kinds together. It is trained here, by
gradient ascent on the likelihood of generated regions, and adds spans only where its posterior
probability is at least :data:`SURE` and no pattern has matched.

A region is what lies within :data:`MARGIN` characters of a digit or ``@``; no span can start
elsewhere. All work is linear in the length of a text.

Defined results for odd input: a null text is empty and has no spans. Repeated rows are searched
alike, one row each. An empty table gives an empty one.
"""

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewsent.llm.chunks import mapped, slices

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS, MAX_CHARS, MARGIN = 24, 64, 32
SURE = 0.9

# The patterns of the task, possessive where backtracking can't help, so that they are linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
TRIGGER = re.compile(r"[0-9@]")
DIGITS = frozenset("0123456789")


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def find_emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``LOCAL+ @ DOMAIN``; each ``@`` is visited once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the plain forms, by kind, then start."""
    found = [("email", *span) for span in find_emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m.group()) if m.end() - m.start() <= 37 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return found


# regions, tokens and candidate spans

def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and ``@``, joined where they touch."""
    found: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        start, end = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], end)
        else:
            found.append((start, end))
    return found


WORDS_BEFORE = {"tel", "phone", "call", "fax", "mobile", "telefon", "card", "visa", "mastercard", "karte", "carte",
                "tarjeta", "ip", "server", "host", "address", "mail", "email", "contact", "isbn", "order", "version", "id"}


def candidates(tokens: list[tuple[int, int]], text: str) -> Iterator[tuple[int, int]]:
    """Token spans ``(i, j)`` that could be an entity: bounded, not starting or ending in white space, with an
    ``@`` or 7 to 19 digits."""
    for i, (start, _) in enumerate(tokens):
        first = text[start]
        if not (first in DIGITS or first in "+(" or first.isalpha()):
            continue
        digits, ats = 0, 0
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            a, b = tokens[j]
            if b - start > MAX_CHARS:
                break
            last = text[b - 1]
            digits += b - a if last in DIGITS else 0
            ats += last == "@"
            if digits > 19 or ats > 1 or (first.isalpha() and j - i > 8 and not ats):
                break
            if (ats or digits >= 7 and not first.isalpha()) and (last in DIGITS or last.isalpha()) and j > i:
                yield i, j + 1


def span_features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole span and its surroundings."""
    span = text[start:end]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    around = re.sub(r"[0-9]+", "", span)
    before, after = text[start - 1:start], text[end:end + 1]
    kind_of = lambda c: "end" if not c else "word" if c.isalnum() else "space" if c.isspace() else c
    word = re.findall(r"[^\W\d_]+", text[max(0, start - 20):start])
    out = ["one", f"digits {min(len(digits), 20)}", f"groups {min(len(groups), 7)}", f"before {kind_of(before)}",
           f"after {kind_of(after)}", f"first {span[0] if not span[0].isalnum() else 'digit' if span[0] in DIGITS else 'letter'}",
           "lengths " + "-".join(str(min(len(g), 9)) for g in groups[:6]),
           "marks " + "".join(sorted({c for c in around if not c.isalpha()}))[:6]]
    out.append("form " + re.sub(r"[0-9]", "0", span) if not any(c.isalpha() for c in around) and len(span) < 24 else "long")
    if "@" in span:
        local, _, domain = span.partition("@")
        sides = local.rstrip(" ([") + "@" + domain.lstrip(" )]")
        out += [f"spaces {min(sides.count(' '), 3)}", "line" if "\n" in span else "no line",
                "plain sides" if DOMAIN.fullmatch(sides.partition("@")[2]) and set(sides.partition("@")[0]) <= LOCAL else "odd sides"]
        out += ["at", f"dots after at {min(domain.count('.'), 3)}", "space by at" if " " in span else "no space by at",
                "top letters" if re.search(r"\.[A-Za-z]{2,}$", domain) else "no top letters",
                "local" if re.search(r"[A-Za-z0-9]", local) else "no local"]
    elif any(c.isalpha() for c in around):
        out.append("letters without at")
    if 13 <= len(digits) <= 19:
        out.append("luhn" if luhn(digits) else "no luhn")
    if len(groups) == 4 and around == "...":
        out.append("ip parts" if all(int(g[:4]) <= 255 and len(g) < 4 for g in groups) else "no ip parts")
    if re.search(r"[^0-9A-Za-z@]{3,}", span):
        out.append("wide gap")
    if word and word[-1].lower() in WORDS_BEFORE:
        out.append(f"word {word[-1].lower()}")
    return out


class Region:
    """Tokens and candidate spans of a stretch of text, with their features as numbers."""

    def __init__(self, text: str, start: int, end: int, numbers: dict[str, int], learn: bool = False):
        self.tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]
        self.spans = list(candidates(self.tokens, text))
        rows = []
        for i, j in self.spans:
            names = span_features(text, self.tokens[i][0], self.tokens[j - 1][1])
            rows.append([numbers.setdefault(n, len(numbers)) if learn else numbers.get(n, 0) for n in names])
        width = max(map(len, rows), default=1)
        self.rows = np.array([r + [0] * (width - len(r)) for r in rows], np.int64).reshape(len(rows), width)
        self.ending: dict[int, list[int]] = {}
        for k, (_, j) in enumerate(self.spans):
            self.ending.setdefault(j, []).append(k)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return weights[self.rows].sum(1)

    def forward(self, scores: np.ndarray) -> np.ndarray:
        """Log sums over all segmentations of the first ``j`` tokens; a token outside entities scores 0."""
        total = np.zeros(len(self.tokens) + 1)
        for j in range(1, len(total)):
            total[j] = total[j - 1]
            for k in self.ending.get(j, ()):
                total[j] = np.logaddexp(total[j], total[self.spans[k][0]] + np.logaddexp.reduce(scores[k]))
        return total

    def posteriors(self, scores: np.ndarray) -> tuple[np.ndarray, float]:
        """Probability of each span and kind over all segmentations."""
        ahead = self.forward(scores)
        back = np.zeros(len(ahead))
        starting: dict[int, list[int]] = {}
        for k, (i, _) in enumerate(self.spans):
            starting.setdefault(i, []).append(k)
        for i in range(len(back) - 2, -1, -1):
            back[i] = back[i + 1]
            for k in starting.get(i, ()):
                back[i] = np.logaddexp(back[i], back[self.spans[k][1]] + np.logaddexp.reduce(scores[k]))
        edges = np.array([ahead[i] + back[j] for i, j in self.spans]) - ahead[-1]
        return np.exp(scores + edges[:, None]), float(ahead[-1])

    def best(self, scores: np.ndarray) -> list[tuple[int, int]]:
        """``(span, kind)`` of the best segmentation."""
        total, choice = np.zeros(len(self.tokens) + 1), [-1] * (len(self.tokens) + 1)
        for j in range(1, len(total)):
            total[j] = total[j - 1]
            for k in self.ending.get(j, ()):
                value = total[self.spans[k][0]] + scores[k].max()
                if value > total[j]:
                    total[j], choice[j] = value, k
        found, j = [], len(self.tokens)
        while j > 0:
            k = choice[j]
            if k >= 0:
                found.append((k, int(scores[k].argmax())))
                j = self.spans[k][0]
            else:
                j -= 1
        return found[::-1]


# training regions: forms of the four kinds, and numbers that are none of them

def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random, valid: bool = True) -> str:
    body = rng.choice("345") + _digits(rng, 14)
    good = next(c for c in "0123456789" if luhn(body + c))
    return body + (good if valid else str((int(good) + rng.randint(1, 9)) % 10))


def _name(rng: random.Random, low: int = 3, high: int = 9) -> str:
    return "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(low, high)))


def _entity(rng: random.Random, kind: str) -> str:
    if kind == "email":
        user = rng.choice([_name(rng), f"{_name(rng)}.{_digits(rng, 2)}", f"{_name(rng)}_{_name(rng)}"])
        at = rng.choice(["@", "@", " @ ", "(@)", "[@]"])
        host = rng.choice([f"{_name(rng)}.com", f"mail{rng.randint(0, 9)}.{_name(rng)}.org", f"{_name(rng)}.co.uk"])
        return user + at + host
    if kind == "ip":
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        number = _card(rng)
        mark = rng.choice(["", " ", "-", ".", "/", " - "])
        return mark.join(number[i:i + 4] for i in range(0, 16, 4))
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}",
                       f"+49 {a} {b}{c}", f"0{a}/{b}{c}", f"00{rng.randint(30, 49)} {a} {b}{c}", f"+44/{a}/{b}{c}"])


def _other(rng: random.Random) -> str:
    n = rng.randint
    return rng.choice([
        str(n(1, 2100)), f"{n(1900, 2030)}-{n(10, 12)}-{n(10, 31)}", f"{n(1, 31)}.{n(1, 12)}.{n(1900, 2030)}",
        f"{n(1900, 2030)}-{n(1900, 2030)}", f"{n(10, 23)}:{n(10, 59)}:{n(10, 59)}", f"{n(1, 9)}.{n(0, 9)}.{n(0, 20)}",
        f"{n(1, 9)}.0.", f"${n(1, 999)},{n(100, 999)}.{n(10, 99)}", _digits(rng, n(5, 12)), _card(rng, False),
        "".join(rng.choice("0123456789abcdef") for _ in range(n(16, 40))), f"978-3-{n(10, 99)}-{_digits(rng, 6)}-{n(0, 9)}",
        "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), f"@{_name(rng)}",
        f"{_digits(rng, 3)} {_digits(rng, 3)} {_digits(rng, 3)} {_digits(rng, 3)}", f"{n(1, 99)} @ {n(1, 99)}",
        f"{_digits(rng, 4)} {_digits(rng, 4)} {_digits(rng, 4)}", f"{_digits(rng, 6)}-{_digits(rng, 4)}",
        " ".join(str(n(1, 40)) for _ in range(n(4, 9))), ", ".join(str(n(1, 3000)) for _ in range(n(4, 9))),
        f"{n(1, 300)}.{n(1, 900)},{n(10, 99)}", f"{n(2, 9)}.{n(300, 999)}.{n(256, 999)}.{n(256, 999)}"])


def training_texts(n: int = 900, seed: int = 7) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    rng = random.Random(seed)
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            lead = rng.choice([_name(rng), _name(rng), "", rng.choice(sorted(WORDS_BEFORE)) + rng.choice(["", ":"])])
            text += lead + rng.choice([" ", " ", "\n", " (" if lead else " "])
            if rng.random() < 0.55:
                kind = rng.choice(KINDS)
                entity = _entity(rng, kind)
                spans.append((kind, len(text), len(text) + len(entity)))
                text += entity
            else:
                text += _other(rng)
            text += rng.choice([" ", ", ", ". ", "\n", ") "]) + _name(rng) + " "
        yield text, spans


class Model:
    """Weights by feature and kind; feature 0 is padding and weighs nothing."""

    def __init__(self, rounds: int = 12, rate: float = 0.5, decay: float = 1e-3):
        self.numbers: dict[str, int] = {"": 0}
        examples = []
        for text, spans in training_texts():
            region = Region(text, 0, len(text), self.numbers, learn=True)
            places = {(region.tokens[i][0], region.tokens[j - 1][1]): k for k, (i, j) in enumerate(region.spans)}
            gold = np.zeros((len(region.spans), len(KINDS)))
            for kind, start, end in spans:
                if (start, end) in places:
                    gold[places[start, end], KINDS.index(kind)] = 1
            if region.spans:
                examples.append((region, gold))
        self.weights = np.zeros((len(self.numbers), len(KINDS)))
        square = np.full_like(self.weights, 1e-6)
        for _ in range(rounds):
            for region, gold in examples:
                expected, _ = region.posteriors(region.scores(self.weights))
                step = np.zeros_like(self.weights)
                np.add.at(step, region.rows, (gold - expected)[:, None, :])
                step -= decay * self.weights
                step[0] = 0
                square += step ** 2
                self.weights += rate * step / np.sqrt(square)

    def spans(self, text: str) -> Iterator[tuple[str, int, int]]:
        for start, end in regions(text):
            region = Region(text, start, end, self.numbers)
            if region.spans:
                scores = region.scores(self.weights)
                sure, _ = region.posteriors(scores)
                for k, kind in region.best(scores):
                    if sure[k, kind] >= SURE:
                        i, j = region.spans[k]
                        yield KINDS[kind], region.tokens[i][0], region.tokens[j - 1][1]


def all_spans(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The plain forms, and all spans: those of the model are added where they touch no plain form."""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken], np.int64)
    reach = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    added = []
    for kind, start, end in model.spans(text):
        k = int(np.searchsorted(starts, end))
        if k == 0 or reach[k - 1] <= start:
            added.append((kind, start, end))
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``<email>`` and so on in place of each span; of spans that overlap, the first names the place."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


RESULT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
                    ("spans", pa.string())])


def _find(model: Model):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            out = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                base, spans = all_spans(text or "", model)
                kinds = [k for k, _, _ in base]
                out.append((doc, *(kinds.count(k) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(),
                            joined(spans)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 7, RESULT)],
                                             schema=RESULT)
    return find


def find_personal_data(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one row per row; the counts are of the
    plain forms."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(mapped(_find(Model())), "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                                           "base_sha256 string, spans string")


def redact_personal_data(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with every span in ``text`` replaced by the name of its kind; all else stays."""
    model = Model()

    def redacted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            texts = [t if t is None else redact(t, all_spans(t, model)[1]) for t in batch[text].to_pylist()]
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
    return documents.mapInArrow(mapped(redacted), documents.schema)
