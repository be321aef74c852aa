"""Byte-level BPE, encoded by batched numpy merge rounds, and decoded.

All words of a block that were not met before lie in one flat symbol array. A round looks up every
adjacent pair by binary search over the sorted pair keys, merges in each word the pair of lowest rank
at all its places, and takes out the words that have none left. Ids equal those of the `tokenizers`
library for a byte-level file without normalizer, dropout or prefix space.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from specloom.llm.batches import text_batches, trimmed

# Characters of text that are split into words at a time; bounds the memory of a task.
BLOCK = 1_000_000
# Rows of a batch that are worked on, and sent on, at a time.
ROWS = 500
# Words whose ids a worker remembers; beyond it the memory starts afresh.
KNOWN_WORDS = 250_000

# The pattern of byte-level pre-tokenization, with {L} letters, {N} numbers, {S} white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
SPACES = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
# Letters and numbers of Unicode 16, which the library knows and Python 3.13 does not.
LETTERS_16 = "1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b-1138b 1138e-1138e 11390-113b5 113b7-113b7 113d1-113d1 113d3-113d3 11bc0-11be0 13460-143fa 16100-1611d 16d40-16d6c 18cff-18cff 1e5d0-1e5ed 1e5f0-1e5f0"
NUMBERS_16 = "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa"
# Below U+0500 every Unicode version in use has the same letters and numbers; no UTF-8 byte from here on occurs there.
FIRST_LEAD = 0xD4


@lru_cache(maxsize=1)
def _newest_split():
    """The pattern over explicit ranges, for texts with characters whose class depends on the Unicode version."""
    import re
    import unicodedata

    ranges: dict[str, list[str]] = {"L": [], "N": []}
    for kind, newer in (("L", LETTERS_16), ("N", NUMBERS_16)):
        member = np.fromiter((unicodedata.category(chr(i))[0] == kind for i in range(0x110000)), dtype=bool, count=0x110000)
        for r in newer.split():
            a, b = (int(x, 16) for x in r.split("-"))
            member[a : b + 1] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], member, [False]]).astype(np.int8)))
        ranges[kind] = [f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return re.compile(PATTERN.format(L="".join(ranges["L"]), N="".join(ranges["N"]), S=SPACES)).findall


_split = regex.compile(PATTERN.format(L=r"\p{L}", N=r"\p{N}", S=SPACES)).findall


def split_words(text: str, raw: bytes) -> list[str]:
    """Pre-tokens of a text; `raw` is the text in UTF-8."""
    if raw and int(np.frombuffer(raw, dtype=np.uint8).max()) >= FIRST_LEAD:
        return _newest_split()(text)
    return _split(text)


def byte_chars() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the other bytes for the characters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def flat_places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start .. start + size - 1 of all runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if ends.size else 0)


class Vocabulary:
    """Tokens as bytes, merges as sorted pair keys, and special tokens of a tokenizer file."""

    def __init__(self, tokenizer: str):
        spec = json.loads(tokenizer)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"] or model.get("dropout"):
            raise ValueError("only byte-level BPE files without prefix space, normalizer and dropout are read")
        as_byte = {c: b for b, c in enumerate(byte_chars())}
        ids = model["vocab"]
        self.size = max([*ids.values(), *(a["id"] for a in spec["added_tokens"])]) + 1
        self.bytes: list[bytes | None] = [None] * self.size
        for token, i in ids.items():
            self.bytes[i] = bytes(as_byte[c] for c in token)
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.byte_id = np.array([ids[c] for c in byte_chars()], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        self.beside = np.zeros((256, 256), dtype=bool)
        for t in self.bytes:
            for a, b in pairwise(t or b""):
                self.beside[a, b] = True
        for content, i in self.special.items():
            self.bytes[i] = content.encode()
        self.lengths = np.array([len(t or b"") for t in self.bytes], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(t or b"" for t in self.bytes), dtype=np.uint8)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, or the number of merges where there is none."""
        want = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, want), self.keys.size - 1)
        return np.where(self.keys[at] == want, self.rank[at], self.keys.size)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        if not raw.size:
            return np.zeros(0, dtype=np.int32), sizes
        word = np.repeat(np.arange(sizes.size), sizes)
        # No token reaches over a byte pair that no token holds, so a word falls apart there.
        cut = np.ones(raw.size, dtype=bool)
        cut[1:] = (word[1:] != word[:-1]) | ~self.beside[raw[:-1], raw[1:]]
        place, symbol, piece = np.arange(raw.size), self.byte_id[raw], np.cumsum(cut) - 1
        none = self.keys.size
        rank = np.full(symbol.size, none, dtype=np.int64)
        look = np.flatnonzero(~cut[1:])
        done_place, done_symbol = [], []
        while symbol.size:
            rank[look] = self.ranks(symbol[look], symbol[look + 1])
            first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            lowest = np.repeat(lowest, np.diff(np.append(first, symbol.size)))
            open_ = lowest < none
            if not open_.all():
                done_place.append(place[~open_])
                done_symbol.append(symbol[~open_])
                place, symbol, piece, rank, lowest = place[open_], symbol[open_], piece[open_], rank[open_], lowest[open_]
                if not symbol.size:
                    break
            hit = rank == lowest
            # Of overlapping places of one pair (a a a) every second one counts, from the left.
            at = np.flatnonzero(hit)
            run = np.append(True, np.diff(at) != 1)
            begin = at[np.flatnonzero(run)][np.cumsum(run) - 1]
            at = at[(at - begin) % 2 == 0]
            symbol[at] = self.merged[rank[at]]
            keep = np.ones(symbol.size, dtype=bool)
            keep[at + 1] = False
            place, symbol, piece, rank = place[keep], symbol[keep], piece[keep], rank[keep]
            # Only the pairs on either side of a merged symbol have changed.
            at = at - np.arange(at.size)
            rank[at] = none
            look = np.unique(np.concatenate([at, at[at > 0] - 1]))
            look = look[look + 1 < symbol.size]
            look = look[piece[look] == piece[look + 1]]
        place = np.concatenate(done_place)
        order = np.argsort(place, kind="stable")
        return np.concatenate(done_symbol)[order].astype(np.int32), np.bincount(word[place], minlength=sizes.size)

    def decode_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in one array, and the number of bytes of each id; unknown ids give none."""
        known = (ids >= 0) & (ids < self.size)
        ids = np.where(known, ids, 0)
        lengths = np.where(known, self.lengths[ids], 0)
        return self.flat[flat_places(self.starts[ids], lengths)], lengths


class Encoder:
    """Ids of texts, with a bounded memory of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(0, dtype=np.int64)

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.append(self.starts, self.ids.size + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.ids = np.append(self.ids, ids)

    def words_of(self, text: str) -> list[str]:
        """Pre-tokens of a text; a special token is one of its own, marked by a leading NUL NUL."""
        raw = text.encode("utf-8", "surrogatepass")
        if not self.vocabulary.special or not self.vocabulary.specials.search(text):
            return split_words(text, raw)
        out, at = [], 0
        for m in self.vocabulary.specials.finditer(text):
            part = text[at : m.start()]
            out += split_words(part, part.encode("utf-8", "surrogatepass"))
            out.append(SPECIAL_MARK + m.group())
            at = m.end()
        part = text[at:]
        return out + split_words(part, part.encode("utf-8", "surrogatepass"))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text; null counts as empty."""
        found, counts = [np.zeros(0, dtype=np.int32)], np.zeros(len(texts), dtype=np.int64)
        words: list[str] = []
        many: list[tuple[int, int]] = []

        def flush() -> None:
            ids, sizes = self._lookup(words)
            found.append(ids)
            total = np.append(0, np.cumsum(sizes))
            begin = 0
            for row, n in many:
                counts[row] += total[begin + n] - total[begin]
                begin += n
            words.clear()
            many.clear()

        held = 0
        for row, text in enumerate(texts):
            if not text:
                continue
            own = self.words_of(text)
            words += own
            many.append((row, len(own)))
            held += len(text)
            if held >= BLOCK:
                flush()
                held = 0
        flush()
        return np.concatenate(found), counts

    def _lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > KNOWN_WORDS:
            self._forget()
        fresh = [w for w in set(words) if w not in self.index]
        if fresh:
            special = [w for w in fresh if w.startswith(SPECIAL_MARK) and w[len(SPECIAL_MARK) :] in self.vocabulary.special]
            plain = fresh if not special else [w for w in fresh if w not in set(special)]
            for w in (*plain, *special):
                self.index[w] = len(self.index)
            self._add(*self.vocabulary.encode_words([w.encode("utf-8", "surrogatepass") for w in plain]))
            self._add(np.array([self.vocabulary.special[w[len(SPECIAL_MARK) :]] for w in special], dtype=np.int32), np.ones(len(special), dtype=np.int64))
        at = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        sizes = self.sizes[at]
        return self.ids[flat_places(self.starts[at], sizes)], sizes


# A lone surrogate cannot stand in a Spark string, so no word of a text begins like this.
SPECIAL_MARK = "\udc00"


@lru_cache(maxsize=2)
def vocabulary_of(tokenizer: str) -> Vocabulary:
    return Vocabulary(tokenizer)


@lru_cache(maxsize=2)
def _encoder(tokenizer: str) -> Encoder:
    return Encoder(vocabulary_of(tokenizer))


def read_tokenizer(path: str) -> str:
    """Text of a tokenizer file, read once on the driver and sent along with the job (about 2 MB)."""
    return Path(path).read_text(encoding="utf-8")


def _parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Batches of ROWS rows at most, so that results are sent on as they are made."""
    for batch in trimmed(batches):
        for at in range(0, max(1, len(batch)), ROWS):
            yield batch.slice(at, ROWS)


def encode(session, path: str, text: Column) -> Column:
    """array<int> of the token ids of a text column; null and empty texts give an empty array."""
    text_batches()
    tokenizer = session.sparkContext.broadcast(read_tokenizer(path))

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(tokenizer.value)
        for part in _parts(batches):
            ids, counts = encoder.encode(part.to_pylist())
            offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
            yield pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))

    return ids_of(text)


def _texts(vocabulary: Vocabulary, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Texts of runs of ids, so many runs at a time that their ids stay within a block."""
    ends = np.cumsum(sizes)
    texts: list[str] = []
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK // 2, side="right")))
        low = int(ends[at] - sizes[at])
        raw, lengths = vocabulary.decode_bytes(ids[low : int(ends[to - 1])])
        data, total = raw.tobytes(), np.append(0, np.cumsum(lengths))
        bounds = total[np.append(ends[at:to] - sizes[at:to], ends[to - 1]) - low]
        texts += [data[a:b].decode("utf-8", "replace") for a, b in pairwise(bounds.tolist())]
        at = to
    return texts


def decode(session, path: str, ids: Column) -> Column:
    """Text of an array<int> column of token ids, special tokens included. Unknown and null ids give
    nothing, bytes that are no UTF-8 the replacement character, null an empty text."""
    text_batches()
    tokenizer = session.sparkContext.broadcast(read_tokenizer(path))

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = vocabulary_of(tokenizer.value)
        for batch in _parts(batches):
            sizes = np.array(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            flat = batch.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            yield pa.array(_texts(vocabulary, flat, sizes), pa.string())

    return text_of(ids)


def encode_decode(session, path: str, text: Column) -> Column:
    """struct<ids: array<int>, decoded: string>: `encode`, and `decode` of its ids, in one Python worker
    instead of two for each task."""
    text_batches()
    tokenizer = session.sparkContext.broadcast(read_tokenizer(path))

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(tokenizer.value)
        for part in _parts(batches):
            ids, counts = encoder.encode(part.to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.StructArray.from_arrays([lists, pa.array(_texts(encoder.vocabulary, ids, counts), pa.string())], ["ids", "decoded"])

    return both(text)
