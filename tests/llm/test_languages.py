import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from martforge.llm import languages as L
from martforge.llm.common import table

SF_TENTH = "/root/testdata/sf0.1"


def test_codewords_lie_apart():
    for k in range(2, 40):
        code = L.codewords(k)
        assert code.shape[0] == k and set(np.unique(code)) <= {-1, 1}
        assert not (np.abs(code.sum(0, dtype=int)) == k).any()
        distances = [int((code[i] != code[j]).sum()) for i in range(k) for j in range(i)]
        assert min(distances) == L.least_distance(code) >= (2 ** (k - 2) if k <= L.EXHAUSTIVE else 8)


def plain_letters(text):
    words = regex.sub(r"[^\pL\pM]+", " ", (text or "").lower()).strip(" ")
    return f" {words} ".encode()


def plain_grams(data):
    """Bucket of every n-gram, byte by byte."""
    for n in L.LENGTHS:
        for i in range(len(data) - n + 1):
            h = 0
            for b in data[i:i + n]:
                h = (h * 0x01000193 + b + 1) % 2 ** 32
            yield ((h + n) * 0x9E3779B1 % 2 ** 32) >> 16


def plain_model(rows):
    """The classifiers from the definition: rows are (text, lang)."""
    names = sorted({g for _, g in rows})
    code = L.codewords(len(names))
    counts = np.zeros((len(names), L.BUCKETS))
    for text, lang in rows:
        for b in plain_grams(plain_letters(text)):
            counts[names.index(lang), b] += 1
    rate = (counts + L.SMOOTHING) / (counts.sum(1, keepdims=True) + L.SMOOTHING * L.BUCKETS)
    weights = np.stack([np.log(rate[code[:, b] > 0].mean(0)) - np.log(rate[code[:, b] < 0].mean(0))
                        for b in range(code.shape[1])], axis=1)
    return names, code, weights


def learnable(rows):
    return [(t, g) for i, t, g in rows if i is not None and g is not None and t and regex.search(r"\pL", t)
            and zlib.crc32(str(i).encode()) % 4 != 2]


def test_model_and_predictions_equal_brute_force(spark, documents):
    docs = documents.select("doc_id", F.col("text").substr(1, 3000).alias("text"), "lang", "source")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    model = L.learn(docs)
    names, code, weights = plain_model(learnable(rows))
    assert model.languages == names and (model.code == code).all()
    np.testing.assert_allclose(model.weights, weights, rtol=1e-5, atol=1e-6)
    out = sorted(map(tuple, L.identify(docs).select("doc_id", "held_out", "lang_pred", "score").collect()), key=str)
    want = []
    for i, text, _ in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        if not regex.search(r"\pL", text or ""):
            want.append((i, held, "und", 0.0))
            continue
        grams = list(plain_grams(plain_letters(text)))
        z = np.mean([weights[g] for g in grams], axis=0) * model.slope + model.shift
        loss = [sum(float(np.logaddexp(0, -v * c)) * w for v, c, w in zip(z, code[j], model.trust[j])) for j in range(len(names))]
        best = loss.index(min(loss))
        want.append((i, held, names[best], 1 / sum(math.exp(min(loss) - x) for x in loss)))
    want.sort(key=str)
    assert [w[:3] for w in want] == [o[:3] for o in out]
    np.testing.assert_allclose([w[3] for w in want], [o[3] for o in out], rtol=1e-3, atol=1e-3)


def test_portions_do_not_change_the_grams():
    texts = L.letters_of(pa.array(["Ein Haus, 3 Häuser!", None, "", "日本語 と", "x" * 50]))
    want = [sorted(plain_grams(t.encode())) for t in texts.to_pylist()]
    for cells in (1, 7, 1 << 20):
        got = [[] for _ in want]
        for bucket, row in L.gram_buckets(texts, cells):
            for b, r in zip(bucket.tolist(), row.tolist()):
                got[r].append(b)
        assert [sorted(g) for g in got] == want


def test_held_out_accuracy(spark):
    docs = table(spark, SF_TENTH, "documents")
    out = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    rows = out.groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a")).collect()
    assert len(rows) == 4 and min(r.a for r in rows) >= 0.99


def test_short_and_wrong_bits_are_decoded():
    """The code corrects a wrong bit; a text between two languages is flagged."""
    code = L.codewords(4)
    model = L.Model(["a", "b", "c", "d"], code, np.zeros((L.BUCKETS, 7), np.float32), np.ones(7), np.zeros(7), np.ones((4, 7)))
    margins = code.astype(float) * 9
    margins[:, 2] *= -0.1
    best, score, ambiguous = model.decode(margins)
    assert best.tolist() == [0, 1, 2, 3] and not ambiguous.any() and (score > 0.99).all()
    best, score, ambiguous = model.decode((code[:1] + code[1:2]) / 2.0)
    assert ambiguous.all() and (score < 0.9).all()


@pytest.mark.parametrize("rows", [[], [(1, "some words", None)], [(1, None, "en"), (2, "12 34", "en")]])
def test_nothing_to_learn(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in L.identify(docs).collect()} <= {"und"}
    assert L.identify(docs).columns == ["doc_id", "held_out", "lang_pred", "score", "ambiguous"]


def test_one_language_and_many(spark):
    docs = spark.createDataFrame([(1, "some words", "en", 1, 2), (3, "!!", "en", 1, 2)],
                                 "doc_id bigint, text string, lang string, half int, bucket int")
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in L.identify(docs).collect()) == [(1, "en", 1.0), (3, "und", 0.0)]
    many = [(i, f"{chr(97 + g)}{chr(98 + g)} {chr(97 + g) * 3} q" * 6, f"l{g:02d}") for i, g in enumerate(list(range(12)) * 12)]
    out = L.identify(spark.createDataFrame(many, "doc_id bigint, text string, lang string"))
    assert all(r.lang_pred == many[r.doc_id][2] for r in out.collect())
