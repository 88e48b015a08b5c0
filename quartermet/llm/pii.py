"""Personal data by rules and a skip-chain conditional random field.

Rules find emails, IP addresses, card and phone numbers.  The field's variables
are a document's tokens that hold a digit or an ``@``; its labels are the four
kinds and none.  A token's own potential comes from its shape (how often tokens of
that shape were of each kind, counted over the whole corpus), neighbours share
transition potentials, and distant tokens that repeat each other - the same
digits or the same tail of them, the same address up to case, the same name before
the ``@`` - share a potential for equal labels.  Loopy belief propagation then
carries a kind from where a rule found it to where the same entity is written
in a way the rules miss.  Tokens of rule spans keep their kinds.  On its own a
token is no personal data: some repeat has to speak for it.

NULL and empty texts have no spans.  Offsets count code points.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_of, kept, map_rows, small, with_text

KINDS = ("email", "ip", "card", "phone")
#: Label of tokens that are no personal data.
NONE = len(KINDS)
#: Shapes are counted in so many buckets.
SHAPES = 4096
#: Log potential of equal labels of repeats, and most that a shape speaks for a kind.
SKIP, SHAPE_MOST = 3.0, -1.0
#: Marginal probability from which a token is taken.
SURE = 0.8
ROUNDS = 15

# The patterns of the rules; each can only start where a run of its first characters starts.
LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL_AT = re.compile(rf"{LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL = re.compile(rf"(?<!{LOCAL}){LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TOKEN = re.compile(r"\S+")
_HINT = re.compile(rb"[0-9@]")
MADE = (
    T.StructType()
    .add("counts", T.ArrayType(T.LongType()))
    .add("base_sha256", "string")
    .add("base", "string")
    .add("spans", "string")
)
Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the rules, by kind and start."""
    out: list[Span] = []
    at = 0
    while "@" in text:
        # A match may start amid a run of name characters only where the last one ended.
        m = EMAIL_AT.match(text, at) or EMAIL.search(text, at)
        if not m:
            break
        out.append((0, m.start(), m.end()))
        at = m.end()
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


@dataclass
class Token:
    text: str
    start: int
    end: int
    label: int  # of a rule, or -1


def tokens(text: str, spans: list[Span]) -> list[Token]:
    """Tokens with a digit or ``@``, without marks around them."""
    found = []
    by_start = sorted((a, b, k) for k, a, b in spans)
    at = 0
    for m in TOKEN.finditer(text):
        raw = m[0]
        if not ("@" in raw or any(c.isdigit() for c in raw)):
            continue
        left = len(raw) - len(raw.lstrip("([{<\"'.,;:!?"))
        right = len(raw.rstrip(")]}>\"'.,;:!?"))
        if left >= right:
            continue
        start, end = m.start() + left, m.start() + right
        while at < len(by_start) and by_start[at][1] <= start:
            at += 1
        label = by_start[at][2] if at < len(by_start) and by_start[at][0] < end else -1
        found.append(Token(raw[left:right], start, end, label))
    return found


def shape(token: str) -> int:
    """Bucket of a token's shape: runs of digits by length, runs of letters as one, marks as they are."""
    runs = re.sub(r"[^\W\d_]+", "a", token)
    runs = re.sub(r"\d+", lambda m: f"{min(len(m[0]), 20)}#", runs)
    return zlib.crc32(runs[:40].encode()) % SHAPES


def entity_keys(token: str) -> list[str]:
    """What repeats of one entity have in common."""
    keys = []
    digits = "".join(c for c in token if c.isdigit())
    if len(digits) >= 7:
        keys.append("d" + digits[-7:])
    if "@" in token:
        name, _, domain = token.lower().partition("@")
        keys += ["m" + token.lower(), "n" + name] if name and domain else []
    elif len(token) >= 6 and not token.isdigit():
        keys.append("n" + token.lower())
    return keys


@dataclass(frozen=True)
class Field:
    """Log potentials: by shape and label, and by neighbouring labels."""

    shapes: np.ndarray
    steps: np.ndarray

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Spans that the field adds to those of the rules."""
        if not base:
            return []
        found = tokens(text, base)
        if all(t.label >= 0 for t in found):
            return []
        groups: dict[str, list[int]] = defaultdict(list)
        for i, t in enumerate(found):
            for key in entity_keys(t.text):
                groups[key].append(i)
        # Each repeat is tied to the one before and to the group's first: linear in the tokens.
        ties = set()
        for members in groups.values():
            ties.update(zip(members[:-1], members[1:], strict=True))
            ties.update((members[0], m) for m in members[1:])
        if not ties:
            return []
        own = np.array([self.shapes[shape(t.text)] for t in found])
        for i, t in enumerate(found):
            if t.label >= 0:
                own[i] = -20.0
                own[i, t.label] = 0.0
        belief = propagate(own, self.steps, sorted(ties))
        added = []
        for i, t in enumerate(found):
            kind = int(belief[i].argmax())
            if t.label < 0 and kind != NONE and belief[i, kind] >= SURE:
                added.append((kind, t.start, t.end))
        return added


def propagate(own: np.ndarray, steps: np.ndarray, ties: list[tuple[int, int]]) -> np.ndarray:
    """Marginals by loopy sum-product over the chain and the ties; messages in both directions, damped."""
    n, labels = own.shape
    chain = [(i, i + 1) for i in range(n - 1)]
    same = np.eye(labels) * SKIP
    pair = np.concatenate([np.repeat(steps[None], len(chain), 0), np.repeat(same[None], len(ties), 0)])
    edges = np.array(chain + ties, np.int64).reshape(-1, 2)
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    potential = np.exp(np.concatenate([pair, pair.transpose(0, 2, 1)]))
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    message = np.zeros((len(source), labels))
    for _ in range(ROUNDS):
        total = own.copy()
        np.add.at(total, target, message)
        sent = total[source] - message[back]
        sent = np.exp(sent - sent.max(1, keepdims=True))
        new = np.log(np.einsum("es,est->et", sent, potential) + 1e-300)
        new -= new.max(1, keepdims=True)
        if np.abs(new - message).max(initial=0.0) < 1e-4:
            break
        message = 0.5 * message + 0.5 * new
    total = own.copy()
    np.add.at(total, target, message)
    total = np.exp(total - total.max(1, keepdims=True))
    return total / total.sum(1, keepdims=True)


def fit(docs: DataFrame) -> Field:
    """Potentials from all documents, labelled by the rules: a row for each shape and label at most."""
    schema = "a int, b int, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("pii")
        shapes, steps = np.zeros((SHAPES, NONE + 1), np.int64), np.zeros((NONE + 1, NONE + 1), np.int64)
        for batch in small(batches, "t"):
            for raw in batch.column(0).to_pylist():
                if not _HINT.search(raw):
                    continue
                text = raw.decode()
                before = -1
                for t in tokens(text, base_spans(text)):
                    label = NONE if t.label < 0 else t.label
                    shapes[shape(t.text), label] += 1
                    if before >= 0:
                        steps[before, label] += 1
                    before = label
        a, b = np.nonzero(shapes)
        yield batch_of(schema, [a, b, shapes[a, b]])
        a, b = np.nonzero(steps)
        yield batch_of(schema, [-1 - a, b, steps[a, b]])

    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("t"))
    found = texts.mapInArrow(count, schema).groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    shapes, steps = np.full((SHAPES, NONE + 1), 0.1), np.full((NONE + 1, NONE + 1), 1.0)
    for a, b, n in found:
        if a >= 0:
            shapes[a, b] += n
        else:
            steps[-1 - a, b] += n
    odds = np.minimum(np.log(shapes / shapes[:, NONE:]), SHAPE_MOST)
    odds[:, NONE] = 0.0
    # How much likelier than by chance labels follow each other, half as strong: neighbours are no proof.
    share = steps / steps.sum()
    return Field(odds, 0.5 * np.log(share / (share.sum(1, keepdims=True) * share.sum(0, keepdims=True))))


def find(docs: DataFrame, field: Field | None = None, keep: bool = True) -> DataFrame:
    """Rows of ``docs`` as ``row`` with counts (rule spans by kind), base_sha256, base and spans.

    Spans are written ``kind:start:end``, by kind and start, joined by commas.
    """
    model = fit(docs) if field is None else field
    empty = ([0] * NONE, hashlib.sha256(b"").hexdigest(), "", "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = []
            for raw in batch.column("text").to_pylist():
                base = base_spans(raw.decode()) if _HINT.search(raw) else []
                if not base:
                    rows.append(empty)
                    continue
                said = written(base)
                more = model.spans(raw.decode(), base)
                counts = [sum(k == kind for k, _, _ in base) for kind in range(NONE)]
                rows.append((counts, hashlib.sha256(said.encode()).hexdigest(), said, written(base + more)))
            kinds = [pa.list_(pa.int64()), pa.string(), pa.string(), pa.string()]
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *made], names=["row", *MADE.names])

    return map_rows(docs, work, MADE, keep=keep)


@F.pandas_udf(T.StringType())
def _masked(texts, spans):
    import pandas as pd

    out = []
    for text, said in zip(texts, spans, strict=True):
        if not text or not said:
            out.append(text)
            continue
        cuts = sorted((int(a), int(b), kind) for kind, a, b in (x.split(":") for x in said.split(",")))
        at, parts = 0, []
        for a, b, kind in cuts:
            if b <= at:
                continue
            if a >= at:
                parts += [text[at:a], f"<{kind.upper()}>"]
            at = b
        out.append("".join([*parts, text[at:]]))
    return pd.Series(out, dtype=object)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind, as in ``<EMAIL>``."""
    found = find(docs)
    some = F.col("spans") != ""
    text = F.when(some, _masked(F.when(some, F.col("row.text")), F.col("spans"))).otherwise(F.col("row.text"))
    return with_text(found, docs.columns, "text", text)
