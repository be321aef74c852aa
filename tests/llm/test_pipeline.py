from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F
from test_decontam import best_window
from test_jaccard import plain_groups
from test_linededup import plain as plain_lines
from tokenizers import Tokenizer

import corpus_pipeline
from specloom.llm.langid import Parser, learn
from specloom.llm.queries import TOKENIZER

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages_against_plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = Parser(learn(docs.select("lang", "text")))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    langs, _ = model.predict([r[1] for r in rows])
    rows = [r for r, lang in zip(rows, langs, strict=True) if lang != "und"]
    lines = plain_lines([(r[0], r[1], r[3]) for r in rows], 5)
    rows = [(r[0], x[1], r[2], r[3]) for r, x in zip(rows, lines, strict=True) if x[3] < x[2] or not x[2]]
    groups = plain_groups([r[:2] for r in rows])
    rows = [r for r, g in zip(rows, groups, strict=True) if g[0] == g[2]]
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(set(w for w in i) & set(words) and best_window(words, i)[0] >= 0.8 for words in [r[1].lower().split()] for i in items if len({*i} & {*words}) > len({*i}) // 2)]
    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    want = sorted((r[0], r[2], r[3], library.encode(r[1], add_special_tokens=False).ids) for r in rows)
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.lang, r.source, r.ids) for r in got.collect()) == want
    assert got.where("not round_trip or n_tokens <> size(ids)").count() == 0
    assert 0 < len(want) < docs.count()


def test_stage_columns_and_odd_rows(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    text = " ".join(words * 3)
    rows = [(1, text, "en", "s1", 5), (2, text + " more", None, "s2", 5), (2, text + " more", None, "s2", 5), (None, text, "en", None, None), (3, None, "en", "s", 0), (4, "12 !!", "en", "s", 0), (5, "", None, None, None)]
    rows += [(10 + i, f"shared boilerplate line\nown line number {i} " + " ".join(words[i:] + [f"x{i}{w}" for w in words]), "en", f"site{i}", 9) for i in range(7)]
    rows += [(30, "shared boilerplate line", "en", "other", 3), (40, "lonely row kept twice", "en", "s", 3), (40, "lonely row kept twice", "en", "s", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    seen = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes
            assert stage(spark, seen.where("false"), SF).count() == 0
        seen = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = sorted((r.doc_id for r in seen.select("doc_id").collect()), key=str)
    assert set(kept["language_id"]) == {1, 2, None, *range(10, 17), 30, 40}
    assert set(kept["line_dedup"]) == set(kept["language_id"]) - {30}
    assert kept["jaccard_dedup"] == sorted([1, *range(10, 17), 40], key=str)
    assert kept["decontamination"] == kept["bpe_tokens"] == kept["jaccard_dedup"]
    assert seen.select(F.min("lang")).first()[0] == "en"


def test_rows_without_an_id_or_with_a_repeated_one(spark, tmp_path):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    near = [(None, text(1)), (None, text(1) + " more"), (None, text(2)), (None, text(2)), (None, text(2) + " more"), (5, text(3)), (5, text(3) + " more"), (5, text(3)), (6, text(3))]
    rows = near + [(None, text(4)), (5, text(5)), (None, None), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    got = [(r.doc_id, r.text and r.text.split("x")[0]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    want = [(None, "w1"), (None, "w2"), (5, "w3"), (None, "w4"), (5, "w5"), (None, None), (None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)

    spark.createDataFrame([(None, text(6)), (1, text(7)), (1, text(8))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "before " + text(7)), (3, text(6)), (3, text(9)), (4, text(8)), (None, text(9)), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    kept = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, text(9)), (None, text(9)), (None, None)], key=str)


def test_any_column_name_and_the_survivor(spark):
    text = "one two three four five six seven eight nine ten " * 3
    names = ["_found", "found", "row", "row_key", "id", "no_id", "k1", "k2", "label"]
    rows = [(5, text, "en", "b", 1, *[f"x{n}" for n in names]), (5, text, "en", "a", 1, *[f"y{n}" for n in names]), (6, text + "end", None, "c", 1, *names), (None, "alone here", "en", "d", 1, *names)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    for stage in (corpus_pipeline.language, corpus_pipeline.near_duplicates, corpus_pipeline.decontaminate):
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
    got = {r.doc_id: r for r in docs.collect()}
    assert set(got) == {5, None} and got[5].source == "a" and got[5].row_key == "yrow_key" and got[None].id == "id"
