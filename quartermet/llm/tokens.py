"""Token ids of whole texts, by a tokenizer file of the tokenizers library."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from .common import _VALUES, kept, mix, steps, trim

#: Pieces remembered by one worker; beyond, those used least are forgotten.
REMEMBER = 800_000
#: Characters of texts that are put together from pieces at once.
STEP = 2_000_000
#: Characters that the library gets at once.
LIBRARY = 100_000
#: Bytes of pieces that are joined for the library.
JOINED = 600

# ---------------------------------------------------------------- where texts are cut

#: Kinds of bytes: part of a letter or digit, mark, space, other white space; neither white space nor surely
#: one of the first two; maybe white space.
_WORD, _MARK, _BLANK, _BREAK, _OTHER, _MAYBE = range(6)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    for code in range(0x21, 0x7F):
        kinds[code] = _WORD if chr(code).isalnum() else _MARK
    kinds[[0x20, *b"\t\n\f\r"]] = [_BLANK, *[_BREAK] * 4]
    # Vertical tab, the separators, and the first bytes of characters of which some are white space.
    kinds[[0x0B, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = _MAYBE
    kinds[[*range(0xC3, 0xCA), 0xD0, 0xD1]] = _WORD  # U+00C0 to U+024F, U+0400 to U+047F
    return kinds


def _borders() -> np.ndarray:
    """By the kinds of two neighbours (times 8): 1 a piece begins at the second, 2 it does if no white space follows."""
    borders = np.zeros(64, np.uint8)
    for white in (_BLANK, _BREAK):
        for before in range(6):
            borders[before * 8 + white] = 1 if before in (_WORD, _MARK, _OTHER) else 2
    for after in (_WORD, _MARK, _OTHER):
        borders[_BREAK * 8 + after] = 1
    borders[[_WORD * 8 + _MARK, _MARK * 8 + _WORD]] = 1
    return borders


_KINDS, _BORDERS = _kinds(), _borders()
_SOLID = np.isin(np.arange(8), (_WORD, _MARK, _OTHER))
_LETTER_LEADS = np.isin(np.arange(256), (*range(0xC3, 0xCA), 0xD0, 0xD1))
_WHITE_LEADS = np.isin(np.arange(256), (0xC2, 0xE1, 0xE2, 0xE3))
_FACTORS = np.random.default_rng(64).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_CONTRACTED = np.isin(np.arange(256), list(b"strvmld"))


def kinds_of(blob: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8."""
    kinds = _KINDS[blob]
    if len(blob) and blob.max() >= 0x80:
        at = np.flatnonzero(_LETTER_LEADS[blob])
        sign = (blob[at] == 0xC3) & (blob[at + 1] & 0xDF == 0x97)  # the signs of multiplication and division
        kinds[at + 1] = np.where(sign, _OTHER, _WORD)
        kinds[at[sign]] = _OTHER
        at = np.flatnonzero(_WHITE_LEADS[blob])
        a, b, c = blob[at], blob[at + 1], blob[np.minimum(at + 2, len(blob) - 1)]
        white = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        white |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c >= 0xA8) & (c <= 0xAF)) | (b == 0x81) & (c == 0x9F))
        kinds[at[~white]] = _OTHER
        kinds[at[white] + 1] = _MAYBE
        long = at[white & (a != 0xC2)]
        kinds[long + 2] = _MAYBE
    return kinds


def cut(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Pieces of all texts and the place of the one that stands behind each text, which belongs to none.

    Texts are cut where the pattern of byte-level vocabularies surely begins a
    match: before a run of white space; before its last character, if the text goes on,
    and behind it, unless it is a space; between marks and letters or digits, but not
    behind an apostrophe that may contract.
    """
    joined = b"\0".join(texts) + b"\0"
    blob = np.frombuffer(joined, np.uint8)
    between = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kinds = kinds_of(blob)
    kinds[between] = _MAYBE  # nothing is known of what stands there: no text goes on
    begins = np.zeros(len(blob) + 1, bool)
    found = _BORDERS[kinds[:-1] << 3 | kinds[1:]]
    begins[1:-1] = found == 1
    # A border is never found at the last byte: that one stands behind a text.
    last = np.flatnonzero(found == 2) + 1
    begins[last] = _SOLID[kinds[last + 1]]
    apostrophe = np.flatnonzero(blob[:-1] == 0x27) + 1
    begins[apostrophe[_CONTRACTED[blob[apostrophe]]]] = False
    begins[0] = True
    begins[between] = begins[between + 1] = True
    starts = np.flatnonzero(begins)
    pieces = pa.Array.from_buffers(
        pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(joined)]
    )
    return pieces, np.searchsorted(starts, between)


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of ``flat`` laid after each other, and where each starts; last the end."""
    ends = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=ends[1:])
    return flat[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1], dtype=np.int32)], ends


def fingerprints(blob: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each piece of ``blob``, none empty; beyond ``len(_FACTORS)`` bytes order no longer counts."""
    place = np.arange(len(blob), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    factors = _FACTORS[np.minimum(place, len(_FACTORS) - 1)]
    return mix(np.add.reduceat(_VALUES[False][blob] * factors, starts) + lengths.astype(np.uint64))


class Encoder:
    """Ids of texts as the tokenizers library gives them, special tokens left out.

    Byte-level pair encoding never merges across the matches of its pattern.  So
    texts are cut where one surely begins (``cut``), each different piece is encoded by
    the library once, and its ids are reused.
    """

    def __init__(self, path: str):
        # A task has one core; the library's threads would each hold memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Each piece is asked once: the library's own cache would only cost.
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)
        # A byte-level token is written with one character for each byte.
        sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int32)
        for token, number in self.tokenizer.get_vocab().items():
            sizes[number] = len(token)
        self.bytes = sizes
        #: Hashes of the pieces in ascending order, and the pieces' numbers.
        self.hashes, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.keep(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int32))
        trim()  # what reading the vocabulary took

    def keep(self, blob: np.ndarray, lengths: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        """Remember these pieces alone: their bytes and ids, each laid after each other."""
        self.blob, self.lengths, self.start = blob, lengths, np.cumsum(lengths) - lengths
        self.flat, self.size, self.begin = flat, size, (np.cumsum(size) - size).astype(np.int32)
        self.uses = np.zeros(len(size), np.int32)

    def forget(self) -> None:
        """Keep the pieces used most, at most half of ``REMEMBER``."""
        least = 2
        while (often := self.uses >= least).sum() > REMEMBER // 2:
            least *= 2
        known = often[self.order]
        self.hashes = self.hashes[known]
        self.order = (np.cumsum(often) - 1)[self.order[known]].astype(np.int32)
        blob, _ = gathered(self.blob, self.start[often], self.lengths[often])
        flat, _ = gathered(self.flat, self.begin[often], self.size[often])
        self.keep(blob, self.lengths[often], flat, self.size[often])

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """The number of each of different pieces; those met for the first time are encoded."""
        bounds = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        blob = np.frombuffer(pieces.buffers()[2], np.uint8)
        # A long text is taken whole, its pieces are not: working arrays take some 50 bytes for one.
        first = [*np.flatnonzero(np.diff(bounds[1:] // STEP, prepend=-1)).tolist(), len(pieces)]
        found = [self.numbers_of(blob[bounds[a] : bounds[b]], np.diff(bounds[a : b + 1])) for a, b in zip(first[:-1], first[1:], strict=True)]
        return np.concatenate(found)

    def numbers_of(self, blob: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``numbers`` of pieces laid after each other."""
        starts = np.cumsum(lengths) - lengths
        hashes = fingerprints(blob, starts, lengths)
        rank = np.argsort(hashes)
        hashes, starts, lengths = hashes[rank], starts[rank], lengths[rank]
        place = np.searchsorted(self.hashes, hashes)
        found = np.full(len(lengths), -1, np.int32)
        maybe = np.flatnonzero(np.append(self.hashes, np.uint64(0))[place] == hashes)
        maybe = maybe[place[maybe] < len(self.hashes)]
        number = self.order[place[maybe]]
        same = self.lengths[number] == lengths[maybe]
        maybe, number = maybe[same], number[same]
        if len(maybe):
            # Equal hashes are not enough: the bytes decide.
            here, ends = gathered(blob, starts[maybe], lengths[maybe])
            there, _ = gathered(self.blob, self.start[number], lengths[maybe])
            same = ~np.logical_or.reduceat(here != there, ends[:-1])
            found[maybe[same]] = number[same]
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = np.arange(len(self.size), len(self.size) + len(new))
            self.hashes = np.insert(self.hashes, place[new], hashes[new])
            self.order = np.insert(self.order, place[new], found[new])
            self.learn(gathered(blob, starts[new], lengths[new])[0], lengths[new])
        out = np.empty_like(found)
        out[rank] = found
        return out

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The library's ids of each text; it holds some 100 bytes for an id, so few texts at a time."""
        found = []
        for a, b in steps(texts, LIBRARY):
            made = self.tokenizer.encode_batch_fast(texts[a:b], add_special_tokens=False)
            found += [np.array(x.ids, np.uint32) for x in made]
        return found

    def library(self, blob: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces laid after each other, which the library parts by itself, and how many each has."""
        ends = np.cumsum(lengths)
        first = np.flatnonzero(np.diff(ends // min(JOINED, LIBRARY // 2), prepend=-1))
        bounds = [*(ends - lengths)[first].tolist(), len(blob)]
        raw = blob.tobytes()
        ids = np.concatenate(self.ids([raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]))
        at = np.searchsorted(np.cumsum(self.bytes[ids], dtype=np.int64), ends) + 1
        return ids, np.diff(at, prepend=0).astype(np.int32)

    def learn(self, blob: np.ndarray, lengths: np.ndarray) -> None:
        """Encode pieces met for the first time, laid after each other in ``blob``."""
        n, starts = len(lengths), np.cumsum(lengths) - lengths
        kinds = kinds_of(blob)
        spaced = (kinds[starts] == _BLANK) & (lengths > 1)
        solid = _SOLID[kinds]
        solid[starts[spaced]] = True
        # Without white space, but for a space in front: such pieces can stand side by side.
        plain = np.logical_and.reduceat(solid, starts)
        begin, size = np.zeros(n, np.int32), np.zeros(n, np.int32)
        flat, total = [self.flat], len(self.flat)
        for those, how in ((plain & spaced, "side by side"), (plain & ~spaced, "by line"), (~plain, "alone")):
            if not those.any():
                continue
            mine, ends = gathered(blob, starts[those], lengths[those])
            if how == "alone":
                raw = mine.tobytes()
                each = self.ids([raw[a:b].decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)])
                ids, sizes = np.concatenate(each), np.fromiter(map(len, each), np.int32, len(each))
            elif how == "by line":
                ids, sizes = self.library(np.insert(mine, ends[1:], 0x0A), lengths[those] + 1)
                ids, sizes = np.delete(ids, np.cumsum(sizes) - 1), sizes - np.int32(1)
            else:
                ids, sizes = self.library(mine, lengths[those])
            size[those], begin[those] = sizes, total + np.cumsum(sizes) - sizes
            flat.append(ids)
            total += len(ids)
        self.start = np.concatenate([self.start, len(self.blob) + starts])
        self.blob, self.lengths = np.concatenate([self.blob, blob]), np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate(flat)
        self.begin, self.size = np.concatenate([self.begin, begin]), np.concatenate([self.size, size])
        self.uses = np.concatenate([self.uses, np.zeros(n, np.int32)])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= STEP or i + 1 == len(texts):
                yield from self.step(texts[start : i + 1])
                start, size = i + 1, 0

    def step(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.size) > REMEMBER:
            self.forget()
        # Arrow tells pieces apart; they never become Python objects.
        pieces, between = cut([text.encode() for text in texts])
        pieces = pieces.dictionary_encode()
        at = self.numbers(pieces.dictionary)[pieces.indices.to_numpy()]
        del pieces
        self.uses += np.bincount(at, minlength=len(self.uses)).astype(np.int32)
        size = self.size[at]
        size[between] = 0
        ids, ends = gathered(self.flat, self.begin[at], size)
        ends = ends[between]
        trim()  # what this step took and let go, several times what is remembered
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    encoders = kept("tokens")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]
