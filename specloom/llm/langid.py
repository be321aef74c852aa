"""Language identification by cross-parsing entropy.

A suffix automaton over labelled text of each language knows every substring of that text. A document
is parsed greedily into phrases, each the longest match from where the last one ended; the language
whose text explains it with the fewest phrases a letter wins. The parse runs over the whole text, in
blocks of `LANE` characters that numpy steps through side by side.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm.batches import text_batches, trimmed

# The learned sample is bounded in rows: whole texts of at most CHARS_PER_DOC characters, at most
# DOCS_PER_LANG different ones of each language, and no further one after CHARS_PER_LANG characters. A
# language that has only longer texts is learned from its shortest.
DOCS_PER_LANG = 64
CHARS_PER_DOC = 10_000
CHARS_PER_LANG = 40_000
SALTS = 64
# The commonest letters of all samples get a symbol of their own, the others share one.
SYMBOLS = 62
LANE = 256
# Characters parsed at a time; bounds the memory of a task.
BLOCK = 2_000_000
UNKNOWN = "und"

_DEAD = np.int32(-(2**31))
_CLEAR = np.int32(2**31 - 1)


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a code sequence; state 0 is the start."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nexts


class Parser:
    """Phrase counts of texts against every learned language."""

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        letters = Counter(c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha())
        common = sorted(sorted(letters), key=lambda c: -letters[c])[:SYMBOLS]
        # 0 stands for everything that is no letter, the last class for letters that are not in the table.
        self.width = len(common) + 2
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        self.classes = np.where(self.letter, np.uint8(self.width - 1), np.uint8(0)).astype(np.uint8)
        for i, c in enumerate(common):
            self.classes[ord(c)] = i + 1
        self.tables = [self._table(samples[x]) for x in self.langs]

    def _table(self, texts: list[str]) -> np.ndarray:
        """Flat next-state table; entries are state * width, and a negative one ends a phrase. The last
        state follows a symbol that the sample lacks: a phrase of its own."""
        codes: list[int] = []
        for t in texts:
            codes += [*self.fold(t)[0].tolist(), 0]
        nexts = automaton(codes)
        table = np.empty((len(nexts) + 1, self.width), dtype=np.int32)
        start = np.full(self.width, len(nexts) * self.width, dtype=np.int32)
        for c, to in nexts[0].items():
            start[c] = to * self.width
        table[:] = start | _DEAD
        table[0] = start
        for s, row in enumerate(nexts):
            for c, to in row.items():
                table[s, c] = to * self.width
        return table.ravel()

    def fold(self, text: str) -> tuple[np.ndarray, int]:
        """Symbol classes with runs of non-letters as one, and the number of letters."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = self.classes[points]
        letters = int(np.count_nonzero(codes))
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0
        return codes[keep], letters

    def phrases(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Phrases of each piece in each language, [piece, language]."""
        sizes = np.array([p.size for p in pieces], dtype=np.int64)
        lanes = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(pieces)), lanes)
        out = np.zeros((len(pieces), len(self.langs)), dtype=np.int64)
        if not owner.size:
            return out
        offset = np.arange(owner.size) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = np.repeat(np.cumsum(sizes) - sizes, lanes) + offset * LANE
        length = np.minimum(LANE, sizes[owner] - offset * LANE)
        order = np.argsort(-length, kind="stable")
        begin, length, owner = begin[order], length[order], owner[order]
        flat = np.concatenate([*pieces, np.zeros(LANE, dtype=np.uint8)])
        columns = np.ascontiguousarray(flat[begin[:, None] + np.arange(LANE)].T)
        active = np.searchsorted(-length, -np.arange(LANE), side="left")
        for k, table in enumerate(self.tables):
            state = np.zeros(owner.size, dtype=np.int32)
            count = np.ones(owner.size, dtype=np.int32)
            for t in range(LANE):
                n = int(active[t])
                if not n:
                    break
                to = table[state[:n] + columns[t, :n]]
                count[:n] += to < 0
                state[:n] = to & _CLEAR
            out[:, k] = np.bincount(owner, weights=count, minlength=len(pieces)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text. The score is how much fewer phrases the best language
        needs than the second, as a share of the second's; 1 where there is no second."""
        langs = [UNKNOWN] * len(texts)
        scores = np.zeros(len(texts))
        total = np.zeros((len(texts), len(self.langs)), dtype=np.int64)
        letters = np.zeros(len(texts), dtype=np.int64)
        rows: list[int] = []
        pieces: list[np.ndarray] = []
        held = 0

        def flush() -> None:
            nonlocal held
            np.add.at(total, rows, self.phrases(pieces))
            rows.clear()
            pieces.clear()
            held = 0

        for i, text in enumerate(texts):
            for at in range(0, len(text or ""), BLOCK):
                codes, n = self.fold(text[at : at + BLOCK])
                letters[i] += n
                rows.append(i)
                pieces.append(codes)
                held += codes.size
                if held >= BLOCK:
                    flush()
        flush()
        if self.langs:
            ranked = np.sort(total, axis=1)
            best = total.argmin(axis=1)
            for i in np.flatnonzero(letters):
                langs[i] = self.langs[best[i]]
                scores[i] = 1 - ranked[i, 0] / ranked[i, 1] if len(self.langs) > 1 else 1.0
        return langs, scores


@lru_cache(maxsize=2)
def _parser(samples: str) -> Parser:
    return Parser(json.loads(samples))


def learn(labelled: DataFrame) -> dict[str, list[str]]:
    """A bounded sample of the rows of a frame (lang, text), see the constants above. Rows with a null are
    left out. Texts are drawn by their hash, so copies of one text count once; every language is learned,
    at about 20 MB of tables for each in a worker."""
    rows = labelled.select(F.col("lang").alias("lang"), F.col("text").alias("text")).where("lang is not null and text is not null")
    hashed = rows.select("lang", F.xxhash64("text").alias("h"), "text")
    size = F.min(F.char_length("text")).alias("size")
    distinct = hashed.groupBy("lang", "h").agg(size)
    # Short texts first, by hash, then long ones by length: of each of SALTS parts of a language, then of it.
    over = F.greatest(F.col("size") - CHARS_PER_DOC, F.lit(0))
    part = F.pmod(F.xxhash64("h"), F.lit(SALTS))
    drawn = distinct
    for keys in (["lang", part], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(over, "h")
        drawn = drawn.withColumn("r", F.row_number().over(order)).where(F.col("r") <= DOCS_PER_LANG)
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("r")) - F.col("size")
    kept = drawn.withColumn("before", before).where((F.col("r") == 1) | ((F.col("before") < CHARS_PER_LANG) & (F.col("size") <= CHARS_PER_DOC))).select("lang", "h")
    texts = hashed.join(F.broadcast(kept), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    out: dict[str, list[str]] = {}
    for r in texts.orderBy("lang", "h").collect():
        out.setdefault(r.lang, []).append(r.text)
    return out


def identify(samples: dict[str, list[str]], text: Column) -> Column:
    """Struct (lang, score) of a text column; `und` and 0 where it is null, has no letter, or nothing
    was learned."""
    text_batches()
    packed = json.dumps(samples, sort_keys=True)

    @F.arrow_udf("struct<lang:string,score:double>")
    def lang_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = _parser(packed)
        for batch in trimmed(batches):
            langs, scores = parser.predict(batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    # A filter on the result would otherwise run it once more, in a worker of its own.
    return lang_of.asNondeterministic()(text)
