"""Exact token counts of every prefix by dynamic programming over prefixes.

The BPE encoding of a prefix ends in exactly one token, and that token follows the encoding of the
prefix before it. So the last token and the count of every prefix of a word come from those of shorter
prefixes: of the tokens that end there, the one that stands beside the last token before it without a
merge across the border. Words are visited in sorted order and share the states of common beginnings.
Counts of a text add up over its words, so the count at any prefix, or the longest prefix within a
budget, needs no new encoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from specloom.llm.batches import text_batches, trimmed
from specloom.llm.bpe import BLOCK, KNOWN_WORDS, SPECIAL_MARK, Encoder, Vocabulary, read_tokenizer, split_words, vocabulary_of

# Token pairs whose compatibility a worker remembers.
KNOWN_PAIRS = 600_000


class PrefixCounts:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.never = vocabulary.keys.size
        self.ranks = dict(zip(vocabulary.keys.tolist(), vocabulary.rank.tolist(), strict=True))
        parts = {int(vocabulary.merged[r]): (k // vocabulary.size, k % vocabulary.size, r) for k, r in sorted(self.ranks.items(), key=lambda x: -x[1])}
        self.parts = parts
        tokens = {i: t for i, t in enumerate(vocabulary.bytes) if t and i not in vocabulary.special.values()}
        _, sizes = vocabulary.encode_words(list(tokens.values()))
        # Tokens by their bytes read from the end; one that merges never build is left out.
        self.back: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        for (i, t), n in zip(tokens.items(), sizes.tolist(), strict=True):
            if n != 1:
                continue
            node = 0
            for b in reversed(t):
                node = self.back.setdefault(node << 8 | b, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = i
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, int] = {}
        self.encoder = Encoder(vocabulary)

    def _edge(self, token: int, side: int, memo: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
        """Symbols at one edge of a token from its byte up to itself, each with the rank that ends it."""
        found = memo.get(token)
        if found is None:
            found, symbol, ends = [], token, self.never
            while symbol in self.parts:
                found.append((symbol, ends))
                ends = self.parts[symbol][2]
                symbol = self.parts[symbol][side]
            found.append((symbol, ends))
            found.reverse()
            memo[token] = found
        return found

    def beside(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b encode to these two tokens: no pair of symbols that meet at
        the border merges before one of them is merged inward. Of equal pairs the left one goes first."""
        key = a * self.vocabulary.size + b
        known = self.pairs.get(key)
        if known is not None:
            return known
        ends, starts = self._edge(a, 1, self.right), self._edge(b, 0, self.left)
        i = j = 0
        good = True
        while True:
            (x, until), (y, till) = ends[i], starts[j]
            rank = self.ranks.get(x * self.vocabulary.size + y)
            if rank is not None and rank < until and rank <= till:
                good = False
                break
            if until <= till:
                if until == self.never:
                    break
                i += 1
            else:
                j += 1
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        self.pairs[key] = good
        return good

    def extend(self, word: bytes, last: list[int], counts: list[int]) -> None:
        """Carries the states of a prefix (last token and count at 0 .. len(last) - 1) to the whole word."""
        back, token_at, pairs, size = self.back, self.token_at, self.pairs, self.vocabulary.size
        for end in range(len(last), len(word) + 1):
            node, at, ending = 0, end, []
            while at:
                node = back.get(node << 8 | word[at - 1])
                if node is None:
                    break
                at -= 1
                if token_at[node] >= 0:
                    ending.append((at, token_at[node]))
            for at, token in reversed(ending):
                if not at:
                    break
                ok = pairs.get(last[at] * size + token)
                if ok or (ok is None and self.beside(last[at], token)):
                    break
            last.append(token)
            counts.append(counts[at] + 1)

    def prefixes(self, word: bytes) -> list[int]:
        """Token counts of word[:0], word[:1], ..., word."""
        last, counts = [-1], [0]
        self.extend(word, last, counts)
        return counts

    def _learn(self, words: list[str]) -> None:
        before = b""
        last, counts = [-1], [0]
        for raw, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            if word.startswith(SPECIAL_MARK) and word[len(SPECIAL_MARK) :] in self.vocabulary.special:
                self.words[word] = 1
                continue
            common, most = 0, min(len(before), len(raw))
            while common < most and before[common] == raw[common]:
                common += 1
            del last[common + 1 :], counts[common + 1 :]
            self.extend(raw, last, counts)
            self.words[word] = counts[-1]
            before = raw

    def counts_of(self, words: list[str]) -> np.ndarray:
        """Token count of each word."""
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        if fresh := [w for w in set(words) if w not in self.words]:
            self._learn(fresh)
        return np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words))

    def totals(self, texts: list[str | None]) -> np.ndarray:
        """Token count of each whole text; null counts as empty."""
        out = np.zeros(len(texts), dtype=np.int64)
        words: list[str] = []
        owners: list[tuple[int, int]] = []
        held = 0

        def flush() -> None:
            total = np.append(0, np.cumsum(self.counts_of(words)))
            begin = 0
            for row, n in owners:
                out[row] += total[begin + n] - total[begin]
                begin += n
            words.clear()
            owners.clear()

        for row, text in enumerate(texts):
            if text:
                own = self.encoder.words_of(text)
                words += own
                owners.append((row, len(own)))
                held += len(text)
            if held >= BLOCK:
                flush()
                held = 0
        flush()
        return out

    def _pieces(self, piece: str) -> int:
        """Count of a text without special tokens."""
        return int(self.counts_of(split_words(piece, piece.encode("utf-8", "surrogatepass"))).sum())

    def at_prefixes(self, text: str) -> np.ndarray:
        """Exact token count of text[:0], text[:1], ..., text, each as if it stood alone."""
        out = [0]
        base = 0
        special = self.vocabulary.special
        words = self.encoder.words_of(text)
        before = ""  # the ordinary text since the last special token
        blank, blank_base = "", 0  # the run of white space that ends here, and the count before it
        for word in words:
            if word.startswith(SPECIAL_MARK) and word[len(SPECIAL_MARK) :] in special:
                name = word[len(SPECIAL_MARK) :]
                start = base - (self._pieces(before) if before else 0)
                out += [start + self._pieces(before + name[:n]) for n in range(1, len(name))]
                base += 1
                out.append(base)
                before, blank = "", ""
                continue
            ends = list(accumulate(len(c.encode("utf-8", "surrogatepass")) for c in word))
            counts = self.prefixes(word.encode("utf-8", "surrogatepass"))
            alone = [base + counts[e] for e in ends]
            # A run of white space is one word as long as nothing follows it.
            spaces = len(word) - len(word.lstrip(WHITE))
            if spaces:
                if not blank:
                    blank_base = base
                run = self.prefixes((blank + word[:spaces]).encode())
                done = len(blank.encode())
                alone[:spaces] = [blank_base + run[done + e] for e in ends[:spaces]]
            # Only a contraction falls apart when it is cut.
            if word[0] == "'" and len(word) > 1:
                alone[:-1] = [base + self._pieces(word[:n]) for n in range(1, len(word))]
            blank = blank + word if spaces == len(word) else ""
            base += counts[-1]
            before += word
            out += alone
        if words:
            out[-1] = base
        return np.array(out, dtype=np.int32)

    def fitting(self, text: str, budget: int) -> int:
        """Length in characters of the longest prefix of at most `budget` tokens."""
        return int(np.flatnonzero(self.at_prefixes(text) <= budget)[-1])


# White space of the pre-tokenization.
WHITE = "\t\n\x0b\x0c\r \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"


@lru_cache(maxsize=2)
def _counter(tokenizer: str) -> PrefixCounts:
    return PrefixCounts(vocabulary_of(tokenizer))


def count_tokens(session, path: str, text: Column) -> Column:
    """bigint token count of a text column; null and empty texts count 0."""
    text_batches()
    tokenizer = session.sparkContext.broadcast(read_tokenizer(path))

    @F.arrow_udf("bigint")
    def total(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(tokenizer.value)
        for batch in trimmed(batches):
            yield pa.array(counter.totals(batch.to_pylist()), pa.int64())

    return total(text)


def prefix_counts(session, path: str, text: Column) -> Column:
    """array<int>: element i is the token count of the first i characters; null for a null text."""
    text_batches()
    tokenizer = session.sparkContext.broadcast(read_tokenizer(path))

    @F.arrow_udf("array<int>")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(tokenizer.value)
        for batch in trimmed(batches):
            yield pa.array([None if t is None else counter.at_prefixes(t) for t in batch.to_pylist()], pa.list_(pa.int32()))

    return counts(text)


def fit_budget(session, path: str, text: Column, budget: int) -> Column:
    """int: length of the longest prefix of at most `budget` tokens; null for a null text."""
    if budget < 0:
        raise ValueError("budget must not be negative")
    text_batches()
    tokenizer = session.sparkContext.broadcast(read_tokenizer(path))

    @F.arrow_udf("int")
    def fitting(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(tokenizer.value)
        for batch in trimmed(batches):
            yield pa.array([None if t is None else counter.fitting(t, budget) for t in batch.to_pylist()], pa.int32())

    return fitting(text)
