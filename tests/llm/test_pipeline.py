"""The pipeline's stages keep their columns, take effect, and leave clean documents alone."""

import re

import public_tokenizers
import sentencepiece

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries

PROSE = {
    "en": "the {} of the river and the {} that was in the house with the old {} by the road to the town where they all lived",
    "de": "der {} und die {} in dem haus mit dem alten {} an der strasse zu der stadt in der sie alle lange gewohnt haben",
}
ITEM = "a passage of the benchmark that nobody should ever train on as it would spoil the test for all of us"


def tables(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def prose(i):
    lang = "de" if i % 2 else "en"
    return "\n".join(PROSE[lang].format(f"a{i}x{k}", f"b{i}y{k}", f"c{i}z{k}") + f" d{i}w{k} e{i}v{k}" for k in range(4)), lang


def test_stages(spark, tmp_path):
    rows = [(i, *prose(i), "s", 0) for i in range(30)]
    copy = rows[4][1]
    line = rows[6][1].split("\n")[2]
    near = rows[8][1].replace("\n", " ").replace("house", "barn", 1)
    rows += [
        (100, "123 456", "en", "s", 7), (101, None, "en", "s", None), (102, "", "en", "s", 0), (103, copy, "en", "s", 0),
        (104, f"own words of a new text that are not in any other one here\n{line}", "en", "s", 0), (105, near, "en", "s", 0),
        (106, f"before it {ITEM} after it", "en", "s", 0), (None, "a text without an id but with words of its own in it", "en", "s", 0),
    ]
    tables(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = f"{tmp_path}/{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        assert name == "sentencepiece" or docs.columns == corpus_pipeline.COLUMNS
        kept.append({r.doc_id: r for r in docs.collect()})
    language, line_dedup, near_copies, decontaminated, last = kept
    clean = set(range(30)) | {104, None}
    assert set(language) == clean | {103, 105, 106}
    assert set(line_dedup) == clean | {105, 106}
    assert line_dedup[104].text == "own words of a new text that are not in any other one here" and line_dedup[104].n_chars == len(line_dedup[104].text)
    assert set(near_copies) == clean | {106} and set(decontaminated) == set(last) == clean
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(list(r.ids) == sp.encode(r.text) and r.decoded == sp.decode(list(r.ids)) for r in last.values())


def test_empty_tables(spark, tmp_path):
    tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()
    numbers = sorted(int(q[2:].split("_")[0]) for q in queries() if q.startswith("op") and q[2].isdigit())
    assert numbers == list(range(1, 14))


def test_decontamination_explodes_no_whole_texts(spark, tmp_path, monkeypatch):
    from millstream.llm import decontaminate

    item = "A train leaves the old station at 40 km and then Anna walks 12 km more before she meets Paul at the gate."
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"{item} " * 30, "en", "x", 1), (2, "nothing of the kind is in here", "en", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plans, plain = {}, decontaminate.stored

    def stored(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, label)

    monkeypatch.setattr(decontaminate, "stored", stored)
    assert [r.doc_id for r in corpus_pipeline.drop_benchmark(spark, docs, str(tmp_path)).collect()] == [2]
    beside = re.findall(r"Generate explode\(.*\), \[([^\]]*)\], true", plans["benchmark-near"])
    assert [re.findall(r"(\w+)#", x) for x in beside] == [["id", "doc"]]
