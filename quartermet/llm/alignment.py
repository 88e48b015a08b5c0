"""Two tokenizers' tokens of the same texts, aligned, and how often their ids meet.

A is a byte-level vocabulary of the tokenizers library and encodes a space and the
text; B is a sentencepiece model, which puts that space there itself.  Byte offsets
where tokens of both end cut the tokens into groups; all A and B tokens of a group
are linked.  The count of a pair of ids is the number of documents that link it.

Fragments are an associative monoid: a byte range of a document gives the tokens
up to its first common end (open prefix), closed groups, and the tokens behind its
last common end (open suffix).  Two neighbours compose by joining suffix and
prefix; a range without a common end is all prefix.  Documents of more than
``LONG`` bytes are cut where both tokenizers surely end a token, encoded by any
tasks, dealt into ranges of ``RANGE`` bytes, and their fragments composed by a tree
of tasks, ``FAN`` at a time.  (A stretch without a space cannot be cut for
encoding and is one task's.)

Both tokenizers end a token before a single space between other characters, so
texts are cut there and each different piece is encoded and aligned once.  Ids,
links and offsets are those of encoding the whole text.

Pairs are counted in chunks of some ``CHUNK`` bytes of text: each sends its
distinct pairs once, and gets their counts back.  Texts that are NULL, empty, no
UTF-8, or whose tokens do not spell the space and the text have no tokens: all
numbers 0, no groups.  NULL ids stay NULL, repeated rows are documents of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, kept, small, stored
from .tokens import gathered

LONG = 64 << 10
#: Bytes that a stretch of a long text has at least, and that a range has.
STRETCH = 48 << 10
RANGE = 16 << 10
FAN = 16
#: Bytes of text whose distinct pairs are sent together.
CHUNK = 4 << 20
#: Characters of texts that are put together at once.
STEP = 1 << 19
#: Pieces remembered by one worker; beyond, those used least are forgotten.
REMEMBER = 160_000
#: Links of one group that are written out one by one.
SMALL_GROUP = 4096

_UNSAFE = re.compile(r"^\s|\s$|\s | \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")

ROWS = (
    "chunk long, doc_id long, is_doc boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "at binary, times binary, codes binary, docs binary"
)
STRETCHES = "uid long, doc_id long, start long, text binary"
FRAGMENTS = (
    "uid long, doc_id long, seq long, start long, spelled boolean, cut boolean, head_a binary, head_b binary, "
    "n_a long, n_b long, n_groups long, n_links long, groups string, codes binary, times binary, tail_a binary, tail_b binary"
)
FOUND = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def distinct(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes in order, each once, with the sum of its times."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1)) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(times[order], first) if len(codes) else times


@dataclass
class Aligned:
    """Groups of a run of tokens: where they start among the tokens of either side."""

    a: np.ndarray
    b: np.ndarray
    from_a: np.ndarray  # one more than there are groups
    from_b: np.ndarray

    def texts(self) -> list[str]:
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        cuts_a, cuts_b = self.from_a.tolist(), self.from_b.tolist()
        return [
            ",".join(a[i:j]) + "|" + ",".join(b[k:m])
            for i, j, k, m in zip(cuts_a[:-1], cuts_a[1:], cuts_b[:-1], cuts_b[1:], strict=True)
        ]

    def links(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code, times and group of the linked pairs of ids."""
        n_a, n_b = np.diff(self.from_a), np.diff(self.from_b)
        size = n_a * n_b
        light = np.where(size <= SMALL_GROUP, size, 0)
        group = np.repeat(np.arange(len(size)), light)
        k = np.arange(len(group)) - np.repeat(np.cumsum(light) - light, light)
        wide = n_b[group]
        codes = self.a[self.from_a[group] + k // wide] * width + self.b[self.from_b[group] + k % wide]
        parts = [(codes, np.ones(len(codes), np.int64), group)]
        for g in np.flatnonzero(size > SMALL_GROUP).tolist():
            a, of_a = np.unique(self.a[self.from_a[g] : self.from_a[g + 1]], return_counts=True)
            b, of_b = np.unique(self.b[self.from_b[g] : self.from_b[g + 1]], return_counts=True)
            codes = (a[:, None] * width + b).ravel()
            parts.append((codes, (of_a[:, None] * of_b).ravel(), np.full(len(codes), g)))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))  # type: ignore[return-value]


class Pair:
    """The two tokenizers, and what their tokens spell."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        stands = byte_level()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, number in self.a.get_vocab().items():
            self.bytes_a[number] = bytes(stands[c] for c in token if c in stands)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        #: A pair's code is the id of A times this, plus the id of B.
        self.width = len(pieces)

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B, if they spell a space and the text."""
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        whole = b" " + text.encode()
        if b"".join([self.bytes_a[i] for i in a]) != whole or b"".join([self.bytes_b[i] for i in b]) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[Aligned, np.ndarray]:
        """The groups of tokens that spell the same, and the common ends."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        starts = [np.concatenate([[0], np.searchsorted(ends, common) + 1]) for ends in (ends_a, ends_b)]
        return Aligned(a, b, *starts), common


def pair(path_a: str, path_b: str) -> Pair:
    """Both tokenizers, once for each worker process."""
    pairs, key = kept("alignment"), (path_a, path_b)
    if key not in pairs:
        pairs[key] = Pair(path_a, path_b)
    return pairs[key]


# -------------------------------------------------------------- documents


class _Numbers(dict):
    """Numbers pieces in the order in which they are first asked for."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


@dataclass
class Pieces:
    """Pieces met so far, with their numbers of tokens, groups and links, and their pairs."""

    pair: Pair
    number: _Numbers = field(default_factory=_Numbers)
    texts: list[str] = field(default_factory=list)
    #: n_a, n_b, n_groups, n_links; -1 tokens: the tokens spell something else.
    counts: np.ndarray = field(default_factory=lambda: np.zeros((0, 4), np.int64))
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    begin: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    size: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    uses: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def forget(self) -> None:
        """Keep the pieces used most, at most half of ``REMEMBER``."""
        least = 2
        while (often := self.uses >= least).sum() > REMEMBER // 2:
            least *= 2
        number = _Numbers()
        for piece, yes in zip(self.number, often.tolist(), strict=True):
            if yes:
                number[piece] = len(number)
        begin, size = self.begin[often], self.size[often]
        self.texts = [t for t, yes in zip(self.texts, often.tolist(), strict=True) if yes]
        self.codes, ends = gathered(self.codes, begin, size)
        self.times, _ = gathered(self.times, begin, size)
        self.number, self.counts, self.begin, self.size = number, self.counts[often], ends[:-1].astype(np.int64), size
        self.uses = np.zeros(len(number), np.int64)

    def learn(self) -> None:
        """Align the pieces numbered since the last time."""
        known = len(self.texts)
        new = list(self.number)[known:] if known else list(self.number)
        codes, times, sizes, counts = [self.codes], [self.times], [], []
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            # Pieces that begin or end with white space stand at an end of their text, and are read alone.
            alone = any(p[0].isspace() or p[-1].isspace() or "▁" in p for p in part)
            batches = [[p] for p in part] if alone else [part]
            read = [self.pair.tokens(" ".join(batch)) for batch in batches]
            if not alone and read == [None]:
                batches = [[p] for p in part]
                read = [self.pair.tokens(p) for p in part]
            for batch, found in zip(batches, read, strict=True):
                if found is None:
                    sizes.append(np.zeros(len(batch), np.int64))
                    counts.append(np.full((len(batch), 4), -1))
                    self.texts += [""] * len(batch)
                    continue
                groups, common = self.pair.aligned(*found)
                ends = np.cumsum([len(p.encode()) + 1 for p in batch])
                cut = np.concatenate([[0], np.searchsorted(common, ends) + 1])  # groups of each piece
                made, n, group = groups.links(self.pair.width)
                order = np.argsort(group, kind="stable")
                of_piece = np.searchsorted(cut, group[order], side="right") - 1
                codes.append(made[order])
                times.append(n[order])
                sizes.append(np.bincount(of_piece, minlength=len(batch)))
                n_a, n_b = np.diff(groups.from_a[cut]), np.diff(groups.from_b[cut])
                links = np.concatenate([[0], np.cumsum(np.diff(groups.from_a) * np.diff(groups.from_b))])
                counts.append(np.column_stack([n_a, n_b, np.diff(cut), np.diff(links[cut])]))
                texts = groups.texts()
                self.texts += [";".join(texts[i:j]) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        if new:
            size = np.concatenate(sizes)
            self.begin = np.concatenate([self.begin, len(self.codes) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.codes, self.times = np.concatenate(codes), np.concatenate(times)
            self.counts = np.concatenate([self.counts, *counts])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])

    def read(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text its four counts and its groups; document, code and times of the distinct pairs."""
        if len(self.number) > REMEMBER:
            self.forget()
        pieces, sizes = [], []
        for text in texts:
            cut = (_CUT.split(text) if _UNSAFE.search(text) else text.split(" ")) if text else []
            sizes.append(len(cut))
            pieces += cut
        at = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        self.learn()
        self.uses += np.bincount(at, minlength=len(self.uses))
        document = np.repeat(np.arange(len(texts)), sizes)
        ends = np.cumsum(sizes)
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.counts[at], axis=0)])
        counts = np.diff(sums[np.concatenate([[0], ends])], axis=0)
        broken = np.unique(document[self.counts[at, 0] < 0])
        counts[broken] = 0
        numbers = at.tolist()
        groups = [";".join([self.texts[k] for k in numbers[end - n : end]]) for n, end in zip(sizes, ends.tolist(), strict=True)]
        for i in broken.tolist():
            groups[i] = ""
        whole = ~np.isin(document, broken)
        here, n = distinct(document[whole] << 32 | at[whole], np.ones(int(whole.sum()), np.int64))
        piece = here & 0xFFFFFFFF
        codes, _ = gathered(self.codes, self.begin[piece], self.size[piece])
        times, _ = gathered(self.times, self.begin[piece], self.size[piece])
        # Documents above, codes below: a step has few documents, and codes are below 2 ** 40.
        made, n = distinct(np.repeat((here >> 32) << 40, self.size[piece]) | codes, times * np.repeat(n, self.size[piece]))
        return counts, groups, made >> 40, made & ((1 << 40) - 1), n


def _digest(groups: str, tokens: int) -> str:
    return sha256(groups.encode()).hexdigest() if tokens else ""


def _chunk_rows(chunk: int, ids: list, counts: np.ndarray, digests: list[str], docs: np.ndarray, codes: np.ndarray, times: np.ndarray):
    """A row for each document, pairs as places among the chunk's, and one for the chunk."""
    distinct_codes, at, several = np.unique(codes, return_inverse=True, return_counts=True)
    ends = np.searchsorted(docs, np.arange(len(ids) + 1)).tolist()
    at, times, n = at.astype("<i4"), times.astype("<i8"), len(ids)
    spans = list(zip(ends[:-1], ends[1:], strict=True))
    yield batch_of(ROWS, [
        [chunk] * n, ids, [True] * n, *counts.T, digests, [at[i:j].tobytes() for i, j in spans],
        [times[i:j].tobytes() for i, j in spans], [None] * n, [None] * n,
    ])
    own = [distinct_codes.astype("<i8").tobytes(), several.astype("<i8").tobytes()]
    yield batch_of(ROWS, [[chunk], [None], [False], *[[None]] * 7, *([x] for x in own)])


def _strings(raws: Iterable[bytes]) -> list[str]:
    """The texts; those that are no UTF-8 as empty ones."""
    out = []
    for raw in raws:
        try:
            out.append(raw.decode())
        except UnicodeDecodeError:
            out.append("")
    return out


def _short(path_a: str, path_b: str, chunk_bytes: int):
    """Rows of documents encoded whole, chunk by chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b)
        pieces = kept("alignment").setdefault(id(both), Pieces(both))
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        ids: list = []
        parts: list[tuple] = []
        digests: list[str] = []
        size = 0

        def flush():
            if ids:
                counts, docs, codes, times = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield from _chunk_rows(number, ids, counts, digests, docs, codes, times)
                ids.clear(), parts.clear(), digests.clear()

        for batch in small(batches, most=STEP):
            texts = _strings(batch.column("text").to_pylist())
            counts, groups, docs, codes, times = pieces.read(texts)
            parts.append((counts, docs + len(ids), codes, times))
            ids += batch.column("doc_id").to_pylist()
            digests += [_digest(g, n) for g, n in zip(groups, counts[:, 0].tolist(), strict=True)]
            size += sum(map(len, texts))
            if size >= chunk_bytes:
                yield from flush()
                number, size = number + 1, 0
        yield from flush()

    return work


# ---------------------------------------------------------- long documents


@dataclass
class Fragment:
    """Tokens of a byte range.  Without a common end (``cut`` is false) all are in the head."""

    cut: bool
    head_a: np.ndarray
    head_b: np.ndarray
    tail_a: np.ndarray
    tail_b: np.ndarray
    counts: np.ndarray  # n_a, n_b, n_groups, n_links of the closed groups
    groups: list[str]
    codes: np.ndarray
    times: np.ndarray


_NO = np.zeros(0, np.int64)


def fragment(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray, width: int) -> Fragment:
    """Of the tokens of a range, told by the offsets of their ends."""
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(common):
        return Fragment(False, a, b, _NO, _NO, np.zeros(4, np.int64), [], _NO, _NO)
    from_a, from_b = np.searchsorted(ends_a, common) + 1, np.searchsorted(ends_b, common) + 1
    closed = Aligned(a, b, from_a, from_b)
    codes, times, _ = closed.links(width)
    n_a, n_b = np.diff(from_a), np.diff(from_b)
    counts = np.array([n_a.sum(), n_b.sum(), len(n_a), (n_a * n_b).sum()], np.int64)
    return Fragment(
        True, a[: from_a[0]], b[: from_b[0]], a[from_a[-1] :], b[from_b[-1] :], counts, closed.texts(), *distinct(codes, times)
    )


def closed_group(a: np.ndarray, b: np.ndarray, width: int) -> Fragment:
    """One closed group."""
    group = Aligned(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    codes, times, _ = group.links(width)
    counts = np.array([len(a), len(b), 1, len(a) * len(b)], np.int64)
    return Fragment(True, _NO, _NO, _NO, _NO, counts, group.texts(), *distinct(codes, times))


def compose(parts: list[Fragment], width: int) -> Fragment:
    """Neighbours from left to right as one fragment."""
    head: list[Fragment] = []
    closed: list[Fragment] = []
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    for part in parts:
        a.append(part.head_a)
        b.append(part.head_b)
        if part.cut:
            if head:
                closed.append(closed_group(np.concatenate(a), np.concatenate(b), width))
            else:
                head = [Fragment(True, np.concatenate(a), np.concatenate(b), _NO, _NO, _NO, [], _NO, _NO)]
            closed.append(part)
            a, b = [part.tail_a], [part.tail_b]
    rest_a, rest_b = np.concatenate([_NO, *a]), np.concatenate([_NO, *b])
    if not head:
        return Fragment(False, rest_a, rest_b, _NO, _NO, np.zeros(4, np.int64), [], _NO, _NO)
    codes, times = distinct(np.concatenate([x.codes for x in closed]), np.concatenate([x.times for x in closed]))
    counts = np.sum([x.counts for x in closed], axis=0)
    groups = [g for x in closed for g in x.groups]
    return Fragment(True, head[0].head_a, head[0].head_b, rest_a, rest_b, counts, groups, codes, times)


def _blob(x: np.ndarray) -> bytes:
    return x.astype("<i8").tobytes()


def _array(x: bytes) -> np.ndarray:
    return np.frombuffer(x, "<i8").astype(np.int64)


def _row(uid, doc_id, seq, start, spelled: bool, f: Fragment) -> list:
    return [
        uid, doc_id, seq, start, spelled, f.cut, _blob(f.head_a), _blob(f.head_b), *f.counts.tolist(), ";".join(f.groups),
        _blob(f.codes), _blob(f.times), _blob(f.tail_a), _blob(f.tail_b),
    ]


def _of_row(r: dict) -> Fragment:
    counts = np.array([r["n_a"], r["n_b"], r["n_groups"], r["n_links"]], np.int64)
    return Fragment(
        r["cut"], _array(r["head_a"]), _array(r["head_b"]), _array(r["tail_a"]), _array(r["tail_b"]), counts,
        [r["groups"]] if r["groups"] else [], _array(r["codes"]), _array(r["times"]),
    )


def stretches(text: str, least: int) -> Iterator[tuple[int, str]]:
    """Byte offset and text of stretches of at least ``least`` characters, cut at single spaces."""
    start = offset = 0
    while start < len(text):
        found = _CUT.search(text, min(start + least, len(text)))
        end = found.start() if found else len(text)
        yield offset, text[start:end]
        offset += len(text[start:end].encode()) + 1
        start = end + 1


def _cut_up(least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for uid, doc_id, raw in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "text")), strict=True):
                rows = [(at, s.encode()) for at, s in stretches(_strings([raw])[0], least)] or [(0, b"")]
                yield batch_of(STRETCHES, [[uid] * len(rows), [doc_id] * len(rows), *map(list, zip(*rows, strict=True))])

    return work


def _ranges(path_a: str, path_b: str, size: int):
    """Fragments of the byte ranges that a stretch has tokens in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b)
        for batch in batches:
            for r in batch.to_pylist():
                text = r["text"].decode()
                found = both.tokens(text) if text else None
                if found is None:
                    rows = [_row(r["uid"], r["doc_id"], 0, r["start"], False, compose([], both.width))]
                else:
                    ends = [np.cumsum(s[x]) + r["start"] for s, x in zip((both.size_a, both.size_b), found, strict=True)]
                    rows = []
                    for seq in np.unique((ends[0] - 1) // size).tolist():
                        (a, x), (b, y) = ((t[m], e[m]) for t, e in zip(found, ends, strict=True) for m in [(e - 1) // size == seq])
                        rows.append(_row(r["uid"], r["doc_id"], seq, r["start"], True, fragment(a, x, b, y, both.width)))
                    # Ranges within one token of A may still hold ends of B.
                    missing = np.setdiff1d((ends[1] - 1) // size, (ends[0] - 1) // size)
                    for seq in missing.tolist():
                        m = (ends[1] - 1) // size == seq
                        f = fragment(_NO, _NO, found[1][m], ends[1][m], both.width)
                        rows.append(_row(r["uid"], r["doc_id"], seq, r["start"], True, f))
                yield batch_of(FRAGMENTS, list(map(list, zip(*rows, strict=True))))

    return work


def _composed(rows: pa.Table, fan: int, width: int) -> pa.Table:
    """Neighbouring fragments of one document as one."""
    every = sorted(rows.to_pylist(), key=lambda r: (r["seq"], r["start"]))
    first, spelled = every[0], all(r["spelled"] for r in every)
    made = compose([_of_row(r) for r in every] if spelled else [], width)
    row = _row(first["uid"], first["doc_id"], first["seq"] // fan, first["start"], spelled, made)
    return pa.Table.from_batches([batch_of(FRAGMENTS, [[x] for x in row])])


def _whole(width: int):
    """Rows of documents whose fragments are composed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                f = _of_row(r)
                if r["spelled"] and f.cut:  # the end of a text is a common end: nothing is behind the last one
                    first = closed_group(f.head_a, f.head_b, width)
                    f = compose([first, f], width) if not len(f.head_a) else Fragment(
                        True, _NO, _NO, _NO, _NO, first.counts + f.counts, first.groups + f.groups,
                        *distinct(np.concatenate([first.codes, f.codes]), np.concatenate([first.times, f.times])),
                    )
                digest = _digest(";".join(f.groups), int(f.counts[0]))
                docs = np.zeros(len(f.codes), np.int64)
                yield from _chunk_rows(-1 - r["uid"], [r["doc_id"]], f.counts[None], [digest], docs, f.codes, f.times)

    return work


def long_rows(docs: DataFrame, path_a: str, path_b: str, stretch: int = STRETCH, size: int = RANGE, fan: int = FAN) -> DataFrame:
    """``ROWS`` of ``docs`` (doc_id, text in bytes), each encoded and aligned by several tasks."""
    with_uid = docs.withColumn("uid", F.monotonically_increasing_id())
    cut = stored(with_uid.mapInArrow(_cut_up(stretch), STRETCHES), "stretches")
    last = cut.agg(F.max(F.col("start") + F.octet_length("text"))).first()[0] or 0
    width = pair(path_a, path_b).width
    found = cut.repartition("uid", "start").mapInArrow(_ranges(path_a, path_b, size), FRAGMENTS)
    while True:
        by = F.floor(F.col("seq") / fan).alias("by")
        found = found.groupBy("uid", by).applyInArrow(lambda key, rows: _composed(rows, fan, width), FRAGMENTS)
        last //= size * fan if last // size else 1
        size = 1
        if not last:
            break
    return found.mapInArrow(_whole(width), ROWS)


# ------------------------------------------------------------------ counts


def _pairs_sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, codes, docs in zip(*(batch.column(c).to_pylist() for c in ("chunk", "codes", "docs")), strict=True):
            sent = np.frombuffer(codes, "<i8")
            yield batch_of("chunk long, code long, n long", [np.full(len(sent), chunk), sent, np.frombuffer(docs, "<i8")])


def _summed(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Documents of a chunk with the sums over their links."""
    order = np.argsort(answers["code"].to_numpy())
    counts, best = answers["n"].to_numpy()[order], answers["best"].to_numpy()[order]
    n_best, sums = [], []
    for at, times in zip(docs["at"].to_pylist(), docs["times"].to_pylist(), strict=True):
        places, several = np.frombuffer(at, "<i4"), np.frombuffer(times, "<i8")
        n_best.append(int(several[best[places]].sum()))
        sums.append(int((several * counts[places]).sum()))
    kept = [docs[c].combine_chunks() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    return pa.Table.from_batches([batch_of(FOUND, [*kept, n_best, sums, docs["groups_sha256"].combine_chunks()])])


def align(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", long: int = LONG,
    chunk_bytes: int = CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``FOUND``, one for each of ``docs``; and the pairs: a, b, n (documents), best (highest of its a)."""
    rows = id_and_text(docs, key, text)
    size = F.octet_length("text")
    width = pair(path_a, path_b).width
    whole = rows.where(size <= long).mapInArrow(_short(path_a, path_b, chunk_bytes), ROWS)
    made = stored(whole.unionByName(long_rows(rows.where(size > long), path_a, path_b)), "aligned")
    sent = made.where("NOT is_doc").select("chunk", "codes", "docs").mapInArrow(_pairs_sent, "chunk long, code long, n long")
    totals = sent.groupBy("code").agg(F.sum("n").alias("n"))
    totals = stored(totals.select(F.floor(F.col("code") / width).alias("a"), "code", "n"), "pairs")
    highest = totals.groupBy("a").agg(F.max("n").alias("highest"))
    counts = totals.join(highest, "a").select("a", "code", "n", (F.col("n") == F.col("highest")).alias("best"))
    answers = sent.select("chunk", "code").join(counts.select("code", "n", "best"), "code")
    own = made.where("is_doc").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "at", "times", "groups_sha256")
    found = own.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_summed, FOUND)
    return found, counts.select("a", F.pmod("code", F.lit(width)).alias("b"), "n", "best")
