from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from specloom.llm import langid
from specloom.llm.langid import LANE, Parser, automaton, identify, learn
from specloom.llm.queries import QUERIES

WORDS = {"aa": "river stone walking under bright evening tower glass", "bb": "fenêtre écrire toujours maison lumière garçon", "cc": "schöne häuser über straße größer müssen"}


def texts(lang: str, n: int, seed: int) -> list[str]:
    rng = random.Random(f"{lang}{seed}")
    return [" ".join(rng.choices(WORDS[lang].split(), k=rng.randint(5, 60))) + "." for _ in range(n)]


def plain_phrases(sample: str, piece: str) -> int:
    """Greedy longest matches by plain substring search."""
    count, at = 0, 0
    while at < len(piece):
        n = 1
        while at + n < len(piece) and piece[at : at + n] in sample and piece[at : at + n + 1] in sample:
            n += 1
        at += n
        count += 1
    return count


def test_automaton_knows_all_substrings():
    s = [1, 2, 1, 1, 2, 0, 2, 1, 2, 1, 1]
    nexts = automaton(s)

    def known(x):
        state = 0
        for c in x:
            if c not in nexts[state]:
                return False
            state = nexts[state][c]
        return True

    all_of = {tuple(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)}
    rng = random.Random(1)
    for _ in range(3000):
        x = tuple(rng.randrange(3) for _ in range(rng.randrange(6)))
        assert known(x) == (x in all_of)


def test_phrases_equal_plain_search():
    samples = {k: texts(k, 8, 0) for k in WORDS}
    p = Parser(samples)
    tests = [t * 9 for k in WORDS for t in texts(k, 3, 7)] + ["x", "ab", "qqq zz", "river  ...  écrire"]
    pieces = [p.fold(t)[0] for t in tests]
    got = p.phrases(pieces)
    for k, lang in enumerate(p.langs):
        codes: list[int] = []
        for t in samples[lang]:
            codes += [*p.fold(t)[0].tolist(), 0]
        sample = "".join(map(chr, codes))
        for i, piece in enumerate(pieces):
            s = "".join(map(chr, piece.tolist()))
            assert got[i, k] == sum(plain_phrases(sample, s[a : a + LANE]) for a in range(0, len(s), LANE))


def test_blocks_do_not_change_results(monkeypatch):
    p = Parser({k: texts(k, 8, 0) for k in WORDS})
    tests = [t * 40 for k in WORDS for t in texts(k, 3, 5)]
    whole = p.predict(tests)
    monkeypatch.setattr(langid, "BLOCK", LANE * 2)
    parts = p.predict(tests)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1], atol=0.1)


def test_edge_texts(spark):
    docs = [(i, k, t) for k in WORDS for i, t in enumerate(texts(k, 20, 0))] + [(99, None, "river stone"), (98, "aa", None)] * 2
    samples = learn(spark.createDataFrame(docs, "id int, lang string, text string"))
    assert set(samples) == set(WORDS)
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "123 !!", 5), (4, "bright river tower", 5), (5, "fenêtre écrire " * 100_000, 5), (4, "bright river tower", 5)], "i int, text string, score int")
    got = [tuple(r) for r in df.select("i", identify(samples, F.col("text")).alias("x")).select("i", "x.lang", "x.score").collect()]
    assert [g[1] for g in got] == ["und", "und", "und", "aa", "bb", "aa"]
    assert all(0 <= g[2] <= 1 for g in got) and got[3] == got[5]
    none = df.select(identify({}, F.col("text")).alias("x")).select("x.*").collect()
    assert {tuple(r) for r in none} == {("und", 0.0)}
    one = df.select(identify({"aa": samples["aa"]}, F.col("text")).alias("x")).select("x.*").collect()
    assert one[3].lang == "aa" and one[3].score == 1.0
    empty = spark.createDataFrame([], "lang string, text string")
    assert learn(empty) == {}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op2_langid"](spark, "/root/testdata/sf0.01")
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_sample_holds_whole_texts_of_every_language(spark):
    rng = random.Random(3)
    rows = [("aa", "long " * 3000), ("aa", "short one"), ("bb", "x" * 30_000), ("bb", "y" * 20_000)]
    rows += [("cc", " ".join(str(rng.random()) for _ in range(300))) for _ in range(40)] * 2
    rows += [(f"lang{i}", f"text number {i}") for i in range(300)]
    got = learn(spark.createDataFrame(rows, "lang string, text string"))
    assert got["aa"] == ["short one"] and got["bb"] == ["y" * 20_000] and len(got) == 303
    known = {t for _, t in rows}
    assert all(t in known for texts in got.values() for t in texts)
    assert len(set(got["cc"])) == len(got["cc"]) and langid.CHARS_PER_LANG <= sum(map(len, got["cc"])) < langid.CHARS_PER_LANG + langid.CHARS_PER_DOC
