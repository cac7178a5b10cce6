import random

import pytest
import sentencepiece

from martforge.llm import sentencepiece as SP
from martforge.llm.common import table
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def fst():
    return SP.Transducer(SP.read_model())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=SP.MODEL_PATH)


def test_random_texts_like_the_library(fst, library):
    rng = random.Random(1)
    letters = [list("abc ▁\nthe"), list("  ▁x"), list("etaoinshrdlu ETAOIN.,'-\n\t0123456789 é日本語🙂ßñ \x00")]
    for alphabet in letters:
        for _ in range(2000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            ids = fst.encode(text)
            assert ids == library.encode(text)
            assert fst.decode(ids) == text.replace("▁", " ")


def test_whole_table_like_the_library(spark, library):
    docs = table(spark, SF_CHECK, "documents")
    got = {r.doc_id: r for r in SP.tokenised(docs).collect()}
    for row in docs.collect():
        assert got[row.doc_id].ids == library.encode(row.text)
        assert got[row.doc_id].round_trip and got[row.doc_id].n_tokens == len(got[row.doc_id].ids)


def test_edge_rows(spark, documents, library):
    docs = documents.withColumn("ids", documents["lang"])
    rows = SP.tokenised(docs).collect()
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    assert [r.ids for r in rows if r.doc_id == 3] == [[]]
    assert SP.tokenised(docs.limit(0)).count() == 0
    long = next(r for r in rows if r.doc_id == 7)
    assert long.ids == library.encode("x" * 300_000)
    back = SP.decode(SP.encode(documents.select("doc_id", "text")))
    assert all(r.decoded == r.text for r in back.collect())


def test_unigram_models_take_the_cheapest_path():
    def field(number, raw):
        return bytes([number << 3 | 2, len(raw)]) + raw

    def piece(text, score, kind=1):
        import struct
        return field(1, field(1, text.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + bytes([3 << 3, kind]))
    model = piece("<unk>", 0.0, 2) + b"".join(piece(t, s) for t, s in [
        ("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -3.0), ("▁a", -2.5), ("ba", -1.0)])
    model += field(2, bytes([3 << 3, 1])) + field(3, bytes([3 << 3, 1, 4 << 3, 0]))
    fst = SP.Transducer(model)
    # ▁a + ba = 3.5 is cheaper than ▁ + ab + a = 6 and ▁ + a + ba = 4
    assert [fst.pieces[i] for i in fst.encode("aba")] == ["▁a", "ba"]
    assert fst.encode("z") == [1, 0]
