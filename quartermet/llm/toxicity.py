"""Toxicity by compression distance.

Two zstandard dictionaries share a base of what is common in ordinary text; one
goes on with segments that toxic texts have far more often than ordinary ones, the
other with the opposite.  A text is cut into windows of some 40 bytes at spaces;
the bytes that a window saves with the toxic dictionary against the ordinary one
are its gain.  A logistic regression over a text's gains (largest ones, counts
above limits, mean) gives the calibrated score.

Everything is learned from a bounded sample of labelled rows (``SAMPLE``
documents of each class, the first in the order of a hash of their ids, none of
more than ``SAMPLE_BYTES``); then each whole text is scored.  NULL and empty
texts have one window without gain.  Rows with a NULL label teach nothing;
without both classes every score is the share of toxic labels (0 if there are none).
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, map_rows, small

SAMPLE = 2400
SAMPLE_BYTES = 1 << 18
#: Bytes that a window has at least, but for the last.
WINDOW = 36
#: Lengths in bytes of the substrings whose frequencies are compared.
PARTS = (5, 7)
BASE_BYTES, OWN_BYTES = 8000, 600
#: How many times as often a class must have a substring as the other one.
RATIO = 4.0
#: After each window: zstandard finds no matches in the last bytes of its input.
TAIL = b" " + b"\n" * 8
MADE = T.StructType().add("score", "double").add("top_gain", "integer")


def windows(text: bytes) -> list[bytes]:
    out, start, size = [], 0, len(text)
    while start < size:
        end = text.find(b" ", start + WINDOW)
        if end < 0:
            end = size
        out.append(text[start:end] + TAIL)
        start = end
    return out


def _parts(text: bytes) -> set[bytes]:
    return {text[i : i + n] for n in PARTS for i in range(len(text) - n + 1)}


def part_counts(texts: list[bytes]) -> Counter:
    """In how many texts each substring is."""
    found: Counter = Counter()
    for text in texts:
        found.update(_parts(b" " + text.replace(b"\n", b" ") + b" "))
    return found


def contrast(own: Counter, n_own: int, other: Counter, n_other: int) -> dict[bytes, float]:
    """Substrings that one class has much more often, with how much more."""
    weights = {}
    for part, count in own.items():
        share = (other.get(part, 0) + 0.5) / (n_other + 1)
        expected = n_own * share
        if count < max(5, 0.004 * n_own) or count < RATIO * expected or (count - expected) ** 2 < 16 * (expected + 1):
            continue
        weights[part] = count - expected
    return weights


def cover(texts: list[bytes], weights: dict[bytes, float], size: int) -> bytes:
    """Dictionary content: segments that cover the most weight, the heaviest last.

    Segments are the stretches of words that weighted substrings cover.
    A substring counts once, for the first segment that holds it.
    """
    segments = set()
    for word in {w for t in texts for w in t.split()}:
        spaced = b" " + word + b" "
        end = 0  # of the stretch that began at start
        start = 0
        for i in range(len(spaced)):
            reach = max((i + n for n in PARTS if spaced[i : i + n] in weights), default=0)
            if i >= end:
                if end > start:
                    segments.add(spaced[start:end])
                start = end = i
            end = max(end, min(reach, len(spaced)))
        if end > start:
            segments.add(spaced[start:end])
    left = dict(weights)

    def worth(segment: bytes) -> float:
        return sum(left.get(p, 0.0) for p in _parts(segment))

    heap = [(-worth(s), s) for s in segments]
    heapq.heapify(heap)
    chosen: list[bytes] = []
    total = 0
    while heap and total < size:
        before, segment = heapq.heappop(heap)
        now = worth(segment)
        if now <= 0:
            continue
        if now < -before - 1e-9:
            heapq.heappush(heap, (-now, segment))
            continue
        chosen.append(segment)
        total += len(segment)
        for part in _parts(segment):
            left.pop(part, None)
    return b"".join(reversed(chosen))[-size:]


def compressor(content: bytes):
    import zstandard

    parameters = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False,
        write_dict_id=False, window_log=16, hash_log=14, chain_log=14, search_log=5, min_match=4,
        target_length=16, strategy=zstandard.STRATEGY_LAZY2,
    )
    made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=made, compression_params=parameters)


def sizes(content: bytes, pieces: list[bytes]) -> np.ndarray:
    compressors = kept("toxicity")
    if content not in compressors:
        if len(compressors) > 8:
            compressors.clear()
        compressors[content] = compressor(content)
    compress = compressors[content].compress
    return np.fromiter((len(compress(x)) for x in pieces), np.int64, len(pieces))


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    constant: float | None = None

    def gains(self, text: bytes) -> np.ndarray:
        pieces = windows(text)
        return sizes(self.ordinary, pieces) - sizes(self.toxic, pieces) if pieces else np.zeros(1, np.int64)

    def score(self, gains: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        z = self.weights[0] + ((features(gains) - self.mean) / self.spread) @ self.weights[1:]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def features(gains: np.ndarray) -> np.ndarray:
    top = np.zeros(4)
    largest = np.sort(gains)[::-1][:4]
    top[: len(largest)] = largest
    above = [(gains >= k).sum() for k in (3, 4, 5)]
    return np.array([*top, *above, (gains >= 4).mean(), np.log1p(len(gains)), gains.mean()], float)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps: means, spreads, weights (constant first)."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    ridge = np.eye(z.shape[1])
    ridge[0, 0] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge, z.T @ (y - p) - ridge @ w)
    return mean, spread, w


def train(toxic: list[bytes], ordinary: list[bytes], share: float) -> Model:
    """A model from texts of either class; ``share`` is that of toxic labels.

    With enough texts a third of them calibrates and does not enter the dictionaries.
    """
    if not toxic or not ordinary:
        return Model(b"", b"", np.zeros(10), np.ones(10), np.zeros(11), share)
    toxic, ordinary = sorted(set(toxic)), sorted(set(ordinary))
    held = len(toxic) >= 300 and len(ordinary) >= 300
    t, o = (toxic[len(toxic) // 3 :], ordinary[len(ordinary) // 3 :]) if held else (toxic, ordinary)
    of_t, of_o = part_counts(t), part_counts(o)
    common = cover(o, {p: float(n) for p, n in of_o.items() if n > 0.02 * len(o)}, BASE_BYTES)
    own = [
        cover(t, contrast(of_t, len(t), of_o, len(o)), OWN_BYTES),
        cover(o, contrast(of_o, len(o), of_t, len(t)), OWN_BYTES),
    ]
    # As long as each other: then the base is as far away in both.
    contents = [common + x.rjust(OWN_BYTES, b" ") for x in own]
    draft = Model(*contents, np.zeros(10), np.ones(10), np.zeros(11))
    rest = [(x, 1.0) for x in (toxic[: len(toxic) // 3] if held else toxic)]
    rest += [(x, 0.0) for x in (ordinary[: len(ordinary) // 3] if held else ordinary)]
    x = np.array([features(draft.gains(text)) for text, _ in rest])
    y = np.array([label for _, label in rest])
    mean, spread, weights = logistic(x, y)
    # The sample holds more toxic texts than there are; take that back.
    sampled = y.mean()
    share = min(max(share, 1e-6), 1 - 1e-6)
    weights[0] += np.log(share / (1 - share)) - np.log(sampled / (1 - sampled))
    return Model(*contents, mean, spread, weights)


def held_out(doc_id: Column) -> Column:
    """Rows from whose labels nothing is learned; a NULL id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a bounded sample of labelled documents; labels with the columns doc_id, toxic."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, share = usable.agg(F.count(F.lit(1)), F.avg("toxic")).first()
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    small = docs.select("doc_id", F.col("text").cast("binary").alias("text")).where(
        F.octet_length("text").between(1, SAMPLE_BYTES)
    )
    for label, found in texts.items():
        # At most SAMPLE ids: a join that may be broadcast.
        ids = usable.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id")).limit(SAMPLE).select("doc_id")
        sampled = small.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
        found += [bytes(r["text"]) for r in sampled.orderBy("doc_id").collect()]
    return train(texts[1], texts[0], float(share or 0.0) if n else 0.0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` as ``row`` (without the text) with score (0 to 1) and top_gain, the largest gain of a window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            gains = [model.gains(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([model.score(g) for g in gains], pa.float64()),
                 pa.array([int(g.max()) for g in gains], pa.int32())],
                names=["row", *MADE.names],
            )

    return map_rows(docs, work, MADE, keep=False)


def scores(text: Column, model: Model) -> Column:
    """The score of a text; only texts go to Python, and only numbers come back."""

    @F.arrow_udf(T.DoubleType())
    def score_of(texts: pa.Array) -> pa.Array:
        kept("toxicity")  # before any text becomes Python's
        found: list[float] = []
        for part in small([pa.RecordBatch.from_arrays([texts], names=["text"])]):
            found += [model.score(model.gains(x)) for x in part.column(0).to_pylist()]
        return pa.array(found, pa.float64())

    return score_of(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """``docs`` without those that score ``limit`` or more."""
    return docs.where(scores(F.col("`text`"), fit(docs, labels)) < limit)
