"""Secrets in texts: rules, and strings that a tokenizer finds hard to say.

The rules find assignments to names such as ``password``, access key ids and long
hexadecimal numbers.  Beside them, a run of at least ``LEAST`` characters of keys
(letters, digits, ``+ / _ -``) is random if a byte-pair vocabulary needs many
tokens for it: fewer than ``RATIO`` characters a token.  Words of any language and
names made of words take fewer tokens, since vocabularies are made of what is
written often.  Left out are runs that are known digests (hexadecimal numbers of
the lengths of MD5 to SHA-512, the ``sha256-`` form of web pages), UUIDs, data
written into an address, numbers, letters in one case, and identifiers: words and
trailing numbers, joined by signs or capitals.  Runs that a rule's span covers are
not named again.

Spans are in code points, the end is exclusive.  NULL and empty texts have none.
Whole texts are read, whatever their length: a run of many characters is counted
in parts of ``PART``.  A NULL id stays NULL; repeated rows are found alike.
Bytes that are no UTF-8 count as one code point each.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, kept, small

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I
)
#: Part of any name that ``ASSIGN`` begins with, in small letters.
NAMES = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
LEAST = 20
RATIO = 2.0
PART = 256
RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}")
# Hexadecimal digits of common digests, and the form of a UUID.
DIGESTS = (32, 40, 48, 56, 64, 96, 128)
KNOWN = re.compile(
    rf"(?:{'|'.join(f'[0-9a-fA-F]{{{n}}}' for n in DIGESTS)})|sha(?:256|384|512)-.*|"
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}|[0-9+/_-]+|[a-z]+|[A-Z]+|[A-Z][a-z]+"
)
IDENTIFIER = re.compile(
    r"(?:(?:[a-z]++(?![A-Z])|(?:[A-Z]?[a-z]{2,}+|(?>[A-Z]{2,}(?![a-z])))*+)[0-9]{0,8}+(?:[+/_=-]++|$))++"
)
FOUND = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"

Span = tuple[int, int, str]  # start, end, kind


class Vocabulary:
    """Counts tokens by a file of ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def count(self, run: str) -> int:
        return sum(len(self.encoding.encode_ordinary(run[i : i + PART])) for i in range(0, len(run), PART))


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each worker process and file."""
    vocabularies = kept("secret_scan")
    if path not in vocabularies:
        import public_tokenizers

        vocabularies[path] = Vocabulary(path, public_tokenizers.PATTERN)
    return vocabularies[path]


def rules(text: str, raw: bytes) -> list[Span]:
    """What the rules find, by start, then kind; ``raw`` is the text's bytes."""
    found = []
    low = raw.lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if b"AKIA" in raw:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def hard(run: str, words: Vocabulary, ratio: float = RATIO) -> bool:
    """Whether a run is no known form and takes many tokens."""
    bare = run.rstrip("=")
    return not KNOWN.fullmatch(bare) and not IDENTIFIER.fullmatch(bare) and len(run) < ratio * words.count(run)


def random_runs(text: str, taken: list[Span], words: Vocabulary, ratio: float = RATIO) -> list[Span]:
    """Runs that are hard to say and not within one of the spans ``taken``."""
    found = []
    for m in RUN.finditer(text):
        start, end = m.span()
        if any(a <= start and end <= b for a, b, _ in taken):
            continue
        if text[max(start - 7, 0) : start] != "base64," and hard(m[0], words, ratio):
            found.append((start, end, "random"))
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find(docs: DataFrame, path: str, ratio: float = RATIO, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each of ``docs``: doc_id, spans by kind, the digest of the rules' spans, and all spans."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in small(batches):
            base, every = [], []
            for raw in batch.column("text").to_pylist():
                whole = raw.decode("utf-8", "replace")
                base.append(rules(whole, raw))
                more = random_runs(whole, base[-1], words, ratio)
                every.append(sorted(base[-1] + more, key=lambda s: (s[0], KINDS.index(s[2]))))
            counts = [[sum(s[2] == kind for s in spans) for spans in every] for kind in KINDS]
            digests = [sha256(written(spans).encode()).hexdigest() for spans in base]
            yield batch_of(FOUND, [batch.column("doc_id"), *counts, digests, [written(s) for s in every]])

    return id_and_text(docs, key, text).mapInArrow(work, FOUND)


def masked(docs: DataFrame, path: str, ratio: float = RATIO, text: str = "text") -> DataFrame:
    """``docs`` with each secret replaced by its kind in brackets; NULL texts stay."""

    @F.pandas_udf("string")  # type: ignore[call-overload]
    def mask(texts):
        words = vocabulary(path)

        def one(whole: str | None) -> str | None:
            if not whole:
                return whole
            base = rules(whole, whole.encode())
            out, at = [], 0
            for start, end, kind in sorted(base + random_runs(whole, base, words, ratio)):
                if end > at:
                    out += [whole[at : max(start, at)], f"[{kind}]" if start >= at else ""]
                    at = end
            return "".join([*out, whole[at:]])

        return texts.map(one)

    new = mask(F.col(f"`{text}`"))
    return docs.select(*(new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
