"""Ids and texts equal the library's, on whole texts of every kind."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece

from millstream.llm import pieces
from millstream.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
TEXTS = [
    "", None, " ", "  ", "a", "  a  b ", "a▁b", "▁", "▁▁ ▁a", "x\x00y", "ﬁ", "\n\n a", "é" * 5, " " * 50, "same text", "same text",
    "😀 <s> </s>" + " " * 17 + "w", "a" * 3000, "long words and spaces " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def coded(df):
    return pieces.decode(pieces.encode(df, MODEL), MODEL)


def test_equals_library(spark, library):
    rows = coded(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert list(r.ids) == library.encode(r.text or "")
        assert r.decoded == library.decode(list(r.ids))


def test_clashing_columns_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b", "mine", 7)], "doc_id long, text string, ids string, _in0 int")
    (row,) = coded(df).collect()
    assert (row.doc_id, row["_in0"], row.decoded) == (None, 7, "a b") and isinstance(row.ids, list)
    assert coded(df.limit(0)).count() == 0


def test_table_starts_afresh(library):
    table = pieces.ChunkTable(library, limit=2)
    for text in ("one two three", "four one two", "two two five"):
        ids, counts = pieces._encode_slice(table, [text, "", text])
        assert ids.tolist() == library.encode(text) * 2 and counts.tolist()[1] == 0


def test_models_that_cross_markers_are_told(library):
    class Crossing:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    assert not pieces.crosses_markers(library) and pieces.crosses_markers(Crossing())


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op1_pieces"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
