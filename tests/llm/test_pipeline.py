from collections import Counter

import sentencepiece

import corpus_pipeline as P
from martforge.llm import mixing, toxicity
from martforge.llm.common import table
from tests.conftest import SF_CHECK
from tests.llm.test_exact_dedup import expected as exact_expected
from tests.llm.test_simhash import kept_by_hand

NAMES = ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "sentencepiece"]


def test_every_stage_against_brute_force(spark):
    assert [n for n, _ in P.STAGES] == NAMES
    docs = table(spark, SF_CHECK, "documents")
    columns, stage = docs.columns, dict(P.STAGES)

    def step(name, frame):
        return P.materialize(stage[name](spark, frame, SF_CHECK), "test-stage")
    clean = step("toxicity", docs)
    judged = toxicity.toxicity(docs, table(spark, SF_CHECK, "labels")).filter("predicted = 0")
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r.doc_id for r in judged.collect())
    unique = step("exact_dedup", clean)
    want = [d for d, _, _, kept, _ in exact_expected([(r.doc_id, r.text) for r in clean.collect()]) if kept]
    assert sorted(r.doc_id for r in unique.collect()) == sorted(want)
    near = step("simhash_dedup", unique)
    want = kept_by_hand([(r.doc_id, r.text) for r in unique.collect()])
    assert sorted((r.doc_id, r.text) for r in near.collect()) == sorted(want)
    mixed = step("mixing", near)
    want = {r.doc_id: r.copies for r in mixing.mix(near).collect() if r.copies}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(want)
    for frame in (clean, unique, near, mixed):
        assert frame.columns == columns
    library = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    texts = {r.doc_id: r.text for r in mixed.collect()}
    ids = {d: library.encode(t) for d, t in texts.items()}
    rows = step("sentencepiece", mixed).collect()
    assert len(rows) == mixed.count() and all(r.round_trip and r.ids == ids[r.doc_id] for r in rows)
    # run() is the same chain
    assert Counter(r.doc_id for r in P.run(spark, SF_CHECK).collect()) == Counter(r.doc_id for r in rows)


def test_edge_rows(spark, documents, tmp_path):
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, 1), (2, 1, 0)], "doc_id bigint, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() > 0
    for name, stage in P.STAGES:
        assert stage(spark, documents.limit(0), str(tmp_path)).count() == 0


def internal_names():
    """Every quoted word in the sources of the package that could name a column."""
    import glob
    import os
    import re

    import martforge.llm
    found = set()
    for path in [*glob.glob(os.path.dirname(martforge.llm.__file__) + "/*.py")]:
        with open(path) as f:
            source = f.read()
        found |= set(re.findall(r'"([a-z_][a-z_0-9]{0,20})"', source)) | set(re.findall(r"\b(_[a-z][a-z_0-9]*)=", source))
    return sorted(found - {"doc_id", "text", "lang", "source", "n_chars", "toxic_", "quality_"})


def test_no_stage_touches_or_trips_over_extra_columns(spark, tmp_path):
    docs = table(spark, SF_CHECK, "documents").where("doc_id < 120").unionByName(
        spark.createDataFrame([(None, "no id at all", "en", "src1", 3)] * 7 + [(5, "again number five", "en", "src1", 9)],
                              "doc_id bigint, text string, lang string, source string, n_chars bigint")
        .select(*table(spark, SF_CHECK, "documents").columns))
    names = internal_names()
    assert {"_row", "_own", "_id", "_copies", "_text", "fp", "ids", "kept"} <= set(names)
    extra = docs.select("*", *[P.table.__globals__["F"].lit(f"value of {n}").alias(n) for n in names])
    for name, stage in P.STAGES[:-1]:
        want = Counter(map(tuple, stage(spark, docs, SF_CHECK).collect()))
        out = stage(spark, extra, SF_CHECK)
        assert out.columns == extra.columns, name
        rows = out.collect()
        assert Counter(tuple(r)[:5] for r in rows) == want, name
        assert all(tuple(r)[5:] == tuple(f"value of {n}" for n in names) for r in rows), name
    assert P.STAGES[-1][1](spark, extra, SF_CHECK).count() == extra.count()
