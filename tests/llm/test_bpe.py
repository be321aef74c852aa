from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from specloom.llm import bpe
from specloom.llm.queries import QUERIES, TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.vocabulary_of(bpe.read_tokenizer(PATH)))


def odd_texts() -> list[str]:
    rng = random.Random(3)
    some = "aaaabcdefgh  \n\t'<|endoftext|>stréß12９٣Ᲊ՘😀　\x85\x1c\x00"
    texts = ["".join(rng.choices(some, k=rng.randint(0, 80))) for _ in range(800)]
    wide = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(map(chr, rng.choices(wide, k=50))) for _ in range(300)]
    return [*texts, "", "a" * 5000, "ab" * 3000, "<|endoftext|>" * 3 + " x<|endoftext|>y", "I'll we've 'S 're''d", " \n \n  x  ", "=-" * 400]


def test_same_ids_as_the_library(library, encoder):
    texts = odd_texts()
    ids, counts = encoder.encode(texts)
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends, strict=True):
        assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_every_character_is_split_as_the_library_does(library):
    split = library.pre_tokenizer.pre_tokenize_str
    for c in (chr(i) for i in range(0, 0x30000) if not 0xD800 <= i < 0xE000):
        s = f"a{c}1{c} {c}!{c}b"
        assert bpe.split_words(s, s.encode()) == [s[a:b] for _, (a, b) in split(s)], hex(ord(c))


def test_blocks_and_forgetting_do_not_change_ids(encoder, monkeypatch):
    texts = odd_texts()[:300]
    whole = encoder.encode(texts)
    monkeypatch.setattr(bpe, "BLOCK", 100)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    parts = bpe.Encoder(encoder.vocabulary).encode(texts)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_columns(spark, library):
    texts = [*odd_texts()[:60], None, None, "x " * 300_000]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "i int, text string, ids int")
    both = df.select("i", "text", bpe.encode(spark, PATH, F.col("text")).alias("e"), bpe.encode_decode(spark, PATH, F.col("text")).alias("b")).withColumn("back", bpe.decode(spark, PATH, F.col("e")))
    for r in both.collect():
        assert (r.b.ids, r.b.decoded) == (r.e, r.back)
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.e == want
        assert r.back == library.decode(want, skip_special_tokens=False) == (r.text or "")
    odd = spark.createDataFrame([([50256, 10**6, -5, 220, None, 128, 199, 200],), (None,), ([],)], "e array<int>")
    got = [r[0] for r in odd.select(bpe.decode(spark, PATH, F.col("e"))).collect()]
    assert got == [library.decode([50256, 220, 128, 199, 200], skip_special_tokens=False), "", ""]
    empty = df.where("false").select(bpe.encode(spark, PATH, F.col("text")).alias("e"))
    assert empty.count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op6_bpe"](spark, SF)
    rows = got.collect()
    assert len(rows) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
