"""Personal data: fixed rules, and a linear-chain conditional random field that adds to them.

The rules find e-mail addresses, IP addresses, payment cards and phone numbers; they always stand.
The field labels tokens (B-kind, I-kind or O) by their shape and their neighbours' and adds spans
where no rule matched. It is trained on a small labelled table, here tokens of a bounded sample of
texts labelled by the rules, by the gradient of its log-likelihood. That table, and runs of it beyond ``LONGEST_RUN`` tokens, are
bounded for fitting only; every text is decoded whole.

A token without a digit and without ``@`` is O by definition. Such tokens cut a text into short
runs, and the best labelling of a whole text is that of each run; so only runs are decoded, by
Viterbi over all runs of a batch at once.

Defined results: null and empty texts have no spans; repeated rows are separate documents; a sample
without any run gives a field that adds nothing; of equally good labellings the one with the smaller
labels stands; texts of any length are looked at whole, in linear time; an empty table gives an empty
one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.llm.arrays import release

# The kinds in order, and what their texts look like.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
CARD_DIGITS, PHONE_DIGITS, IP_PART = (12, 19), (9, 15), 255

Span = tuple[int, int, int]  # start, kind, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each ``@``: what the pattern finds from the left, in linear time."""
    low, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, sign + 1) if start < sign else None
        if found:
            yield start, found.end()
        low = found.end() if found else sign + 1
        sign = text.find("@", low)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


_ANY = re.compile(r"[0-9@]")


def base_spans(text: str) -> list[Span]:
    """All matches of the rules, by start and kind."""
    if not _ANY.search(text):
        return []
    spans = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= IP_PART for p in (part.lstrip("0") for part in m.group().split("."))):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0] and CARD_DIGITS[0] <= len(d := _digits(m.group())) <= CARD_DIGITS[1] and luhn(d):
            spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if PHONE_DIGITS[0] <= len(_digits(m.group())) <= PHONE_DIGITS[1]:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# The field.

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
FEATURES = 1 << 13
# Rows of the labelled table, and tokens of a run that training looks at.
SAMPLE, LONGEST_RUN = 4000, 40
STEPS, RATE, PULL = 120, 0.1, 1e-3
# Characters of texts that are decoded at once: bounds a worker's memory, not what is looked at.
TOGETHER = 1 << 19

_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_GAP = re.compile(r"\s+")
_RUNS_OF_SHAPE = re.compile(r"(.)\1+")
_SHAPE = re.compile(r"[0-9]|[A-Z]|[^\x00-\x40\x5b-\x60\x7b-\x7f]")
# O to I, and B or I of one kind to I of another, cannot follow each other.
ALLOWED = np.array([[not b.startswith("I") or a[2:] == b[2:] for b in LABELS] for a in LABELS])

Token = tuple[int, int]


def runs(text: str) -> list[list[Token]]:
    """Tokens that may be personal data, those next to each other together."""
    made: list[list[Token]] = []
    for m in _TOKEN.finditer(text):
        if made and _GAP.fullmatch(text, made[-1][-1][1], m.start()):
            made[-1].append(m.span())
        else:
            made.append([m.span()])
    return made


def _shape(token: str) -> str:
    return _SHAPE.sub(lambda m: "9" if m.group() <= "9" else "A" if "A" <= m.group() <= "Z" else "a", token)


def token_features(token: str, before: str, after: str) -> list[int]:
    """Hashed features of a token and its neighbours in the run (empty: a plain word)."""
    shape = _shape(token)
    short = lambda t: _RUNS_OF_SHAPE.sub(r"\1", _shape(t))
    own = short(token)
    n = sum("0" <= c <= "9" for c in token)
    names = [
        "bias", f"shape {shape}", f"short {own}", f"digits {min(n, 20)}", f"parts {own.count('9')} {own.count('.')}",
        f"at {token.count('@')} {'.' in token.rpartition('@')[2]}", f"plus {token[:1] == '+'}",
        f"before {short(before)}", f"after {short(after)}", f"both {short(before)} {own} {short(after)}",
    ]
    return [zlib.crc32(name.encode()) % FEATURES for name in names]


N_FEATURES = 10


def run_features(text: str, run: list[Token]) -> np.ndarray:
    words = ["", *(text[s:e] for s, e in run), ""]
    return np.array([token_features(words[i], words[i - 1], words[i + 1]) for i in range(1, len(words) - 1)])


def _first_over(spans: list[Span]) -> Callable[[int, int], Span | None]:
    """Finds the first of ``spans`` (by start) that a range overlaps; ranges are asked for in ascending order."""
    low = 0

    def first(start: int, end: int) -> Span | None:
        nonlocal low
        while low < len(spans) and spans[low][2] <= start:
            low += 1
        at = low
        while at < len(spans) and spans[at][0] < end:
            if start < spans[at][2]:
                return spans[at]
            at += 1
        return None

    return first


def run_labels(run: list[Token], spans: list[Span]) -> list[int]:
    """Labels of a run by the spans that its tokens overlap."""
    labels, last, first = [], None, _first_over(spans)
    for start, end in run:
        span = first(start, end)
        labels.append(0 if span is None else 1 + 2 * span[1] + (span == last))
        last = span
    return labels


@dataclass
class Field:
    emission: np.ndarray  # features x labels
    transition: np.ndarray  # labels x labels


def _by_length(lengths: list[int]) -> Iterator[tuple[int, list[int]]]:
    """Indexes of the runs of each length, so that a step of all runs is one array operation."""
    groups: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        groups.setdefault(n, []).append(i)
    yield from groups.items()


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train_field(features: list[np.ndarray], labels: list[list[int]]) -> Field:
    """Maximise the labelled runs' log-likelihood (forward-backward, Adam steps)."""
    n = len(LABELS)
    field = Field(np.zeros((FEATURES, n)), np.zeros((n, n)))
    if not features:
        return field
    blocked = np.where(ALLOWED, 0.0, -1e4)
    groups = [(np.stack([features[i] for i in g]), np.array([labels[i] for i in g])) for _, g in _by_length([len(x) for x in labels])]
    moments = [np.zeros_like(w) for w in (field.emission, field.transition) for _ in range(2)]
    scale = 1 / len(features)
    for step in range(1, STEPS + 1):
        up_e, up_t = np.zeros_like(field.emission), np.zeros_like(field.transition)
        move = field.transition + blocked
        for f, y in groups:
            runs_, length = y.shape
            emit = field.emission[f].sum(axis=2)  # runs x tokens x labels
            ahead, back = np.zeros_like(emit), np.zeros_like(emit)
            ahead[:, 0] = emit[:, 0] + move[0]
            for t in range(1, length):
                ahead[:, t] = emit[:, t] + _log_sum(ahead[:, t - 1, :, None] + move, 1)
            back[:, -1] = move[:, 0]
            for t in range(length - 2, -1, -1):
                back[:, t] = _log_sum(move + (emit[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            whole = _log_sum(ahead[:, -1] + back[:, -1], 1)
            # Expected minus observed, per token and per step between tokens (O before and after).
            p = np.exp(ahead + back - whole[:, None, None])
            p[np.arange(runs_)[:, None], np.arange(length), y] -= 1
            np.add.at(up_e, f, np.broadcast_to(p[:, :, None, :], (*f.shape, n)))
            for t in range(1, length):
                both = ahead[:, t - 1, :, None] + move + (emit[:, t] + back[:, t])[:, None, :] - whole[:, None, None]
                up_t += np.exp(both).sum(axis=0)
                np.subtract.at(up_t, (y[:, t - 1], y[:, t]), 1)
            up_t[0] += p[:, 0].sum(axis=0)
            up_t[:, 0] += p[:, -1].sum(axis=0)
        for k, (w, up) in enumerate(((field.emission, up_e), (field.transition, up_t))):
            up = up * scale + PULL * w
            m, v = moments[2 * k], moments[2 * k + 1]
            m *= 0.9
            m += 0.1 * up
            v *= 0.99
            v += 0.01 * up * up
            w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


def decode(field: Field, features: list[np.ndarray]) -> list[np.ndarray]:
    """The best labels of each run (Viterbi), all runs of a length at once."""
    best: list[np.ndarray] = [np.zeros(0, int)] * len(features)
    move = np.where(ALLOWED, field.transition, -1e4)
    for length, group in _by_length([len(f) for f in features]):
        emit = field.emission[np.stack([features[i] for i in group])].sum(axis=2)
        score, came = emit[:, 0] + move[0], []
        for t in range(1, length):
            way = score[:, :, None] + move
            came.append(way.argmax(axis=1))
            score = emit[:, t] + way.max(axis=1)
        label = (score + move[:, 0]).argmax(axis=1)
        path = [label]
        for step in reversed(came):
            label = step[np.arange(len(group)), label]
            path.append(label)
        for i, labels in zip(group, np.stack(path[::-1], axis=1)):
            best[i] = labels
    return best


_EDGE = re.compile(r"[A-Za-z0-9+](?:.*[A-Za-z0-9])?", re.S)


def added_spans(text: str, found: list[list[Token]], labels: list[np.ndarray], base: list[Span]) -> list[Span]:
    """Spans of labelled tokens, without the signs at their edges, that overlap no rule's span."""
    made: list[Span] = []
    first = _first_over(base)
    for run, best in zip(found, labels):
        spans: list[list[int]] = []
        for (start, end), label in zip(run, best):
            if label and label % 2:
                spans.append([start, (int(label) - 1) // 2, end])
            elif label:
                spans[-1][2] = end
        for start, kind, end in spans:
            core = _EDGE.search(text, start, end)
            if core and first(*core.span()) is None:
                made.append((core.start(), kind, core.end()))
    return made


def find_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Per text: the rules' spans, and all spans; some ``TOGETHER`` characters are looked at together."""
    made, held, size = [], [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= TOGETHER:
            made += _find_spans(held, field)
            held, size = [], 0
            release()
    return made + _find_spans(held, field)


def _find_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    base = [base_spans(t) for t in texts]
    found = [runs(t) for t in texts]
    labels = iter(decode(field, [run_features(t, r) for t, rs in zip(texts, found) for r in rs]))
    made = []
    for text, rules, rs in zip(texts, base, found):
        more = added_spans(text, rs, [next(labels) for _ in rs], rules)
        made.append((rules, sorted(rules + more)))
    return made


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Field:
    """A field trained on at most ``sample`` rows, chosen by the hash of their texts and labelled by the rules."""
    n = docs.count()
    part = docs.select(F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    if n > sample:
        part = part.where(F.pmod("h", F.lit(1 << 30)) < int(2 * sample / n * (1 << 30)))

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for h, text in zip(batch.column(1).to_pylist(), batch.column(0)):
                text = text.as_py() or ""
                spans = base_spans(text)
                own = [r[:LONGEST_RUN] for r in runs(text)]
                rows = [{"h": h, "features": run_features(text, r).ravel().tolist(), "labels": run_labels(r, spans)} for r in own]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_LABELLED)

    rows = part.select("text", "h").mapInArrow(labelled, "h long, features array<int>, labels array<int>")
    rows = rows.orderBy("h", "features").limit(sample).collect()
    return train_field([np.array(r["features"]).reshape(-1, N_FEATURES) for r in rows], [r["labels"] for r in rows])


_LABELLED = pa.schema([("h", pa.int64()), ("features", pa.list_(pa.int32())), ("labels", pa.list_(pa.int32()))])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (of the rules), ``base_sha256, spans, n_added``."""
    field = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))
    counts = [f"n_{k}" for k in KINDS]

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find_spans([t.as_py() or "" for t in batch.column(1)], field.value)
            columns = [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            digest = pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found])
            spans, added = pa.array([written(s) for _, s in found]), pa.array([len(s) - len(b) for b, s in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, digest, spans, added], names=schema.fieldNames())

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col))
    schema = rows.select("doc_id").schema
    for name in counts:
        schema = schema.add(name, "long")
    schema = schema.add("base_sha256", "string").add("spans", "string").add("n_added", "long")
    return rows.mapInArrow(marked, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping ones the first, as far as they reach."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in its texts replaced, and ``n_chars``, if there, counted anew."""
    field = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))

    @F.pandas_udf("string")
    def clean(texts):
        release()
        found = find_spans([t or "" for t in texts], field.value)
        return texts.where(texts.isna(), [redacted(t or "", s) for t, (_, s) in zip(texts, found)])

    made = docs.withColumn(text_col, clean(text_col))
    if "n_chars" in docs.columns:
        count = F.length(text_col).cast(docs.schema["n_chars"].dataType)
        made = made.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(count))
    return made
