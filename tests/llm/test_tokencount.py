from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_bpe import odd_texts
from tokenizers import Tokenizer

from specloom.llm import bpe, tokencount
from specloom.llm.queries import QUERIES, TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return tokencount.PrefixCounts(bpe.vocabulary_of(bpe.read_tokenizer(PATH)))


def test_white_space_is_that_of_the_pattern():
    import re

    assert sorted(tokencount.WHITE) == [c for c in map(chr, range(0x110000)) if re.match(f"[{bpe.SPACES}]", c)]


def test_totals(library, counter):
    texts = odd_texts()
    assert counter.totals(texts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_pairs_against_the_encoding(counter):
    v = counter.vocabulary
    rng = random.Random(4)
    usable = [i for i in range(v.size - 1) if v.encode_words([v.bytes[i]])[1][0] == 1]
    pairs = [(rng.choice(usable), rng.choice(usable)) for _ in range(3000)] + [(t, t) for t in rng.sample(usable, 500)]
    ids, sizes = v.encode_words([v.bytes[a] + v.bytes[b] for a, b in pairs])
    at = 0
    for (a, b), n in zip(pairs, sizes.tolist(), strict=True):
        assert counter.beside(a, b) == (ids[at : at + n].tolist() == [a, b])
        at += n


def test_every_prefix(library, counter):
    own = ["I'll say we've 're''d don't", "a \n\n  b\t\tc  ", "x<|endoftext|> y  <|endoftext|>", "  lead", "trail   ", "été 12,5 % der größte 　x", ""]
    for t in own + [x[:60] for x in odd_texts()[:150]]:
        want = [len(library.encode(t[:n], add_special_tokens=False).ids) for n in range(len(t) + 1)]
        assert counter.at_prefixes(t).tolist() == want, repr(t)
        for budget in (0, 1, 3, 10**6):
            assert counter.fitting(t, budget) == max(n for n, k in enumerate(want) if k <= budget)


def test_columns(spark, library):
    texts = ["", None, "Hello world  again", "Hello world  again", "y" * 200_000]
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, n_tokens int")
    got = df.select(
        tokencount.count_tokens(spark, PATH, F.col("text")).alias("n"), tokencount.prefix_counts(spark, PATH, F.col("text")).alias("p"), tokencount.fit_budget(spark, PATH, F.col("text"), 3).alias("f")
    ).collect()
    for t, r in zip(texts, got, strict=True):
        assert r.n == len(library.encode(t or "", add_special_tokens=False).ids)
        if t is None:
            assert r.p is None and r.f is None
        else:
            assert len(r.p) == len(t) + 1 and r.p[-1] == r.n and r.p[r.f] <= 3
    assert df.where("false").select(tokencount.count_tokens(spark, PATH, F.col("text"))).count() == 0
    with pytest.raises(ValueError):
        tokencount.fit_budget(spark, PATH, F.col("text"), -1)


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_tokens"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids)
        assert tuple(r) == (r.doc_id, len((docs[r.doc_id] or "").encode()), n, n > 512)
