import re
from collections import Counter

from martforge.llm import quality as Q
from martforge.llm.common import table
from tests.conftest import SF_CHECK

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(doc_id, text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    covered = {i + o for i, g in enumerate(grams) if count[g] > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (doc_id, len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)),
            len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_measurements(spark, documents):
    for docs in (documents.withColumnRenamed("n_chars", "fail_bits"), table(spark, SF_CHECK, "documents")):
        want = sorted((expected(r.doc_id, r.text) for r in docs.collect()), key=repr)
        got = Q.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert Q.judged(documents.limit(0)).count() == 0


def test_policies_and_ablations(spark):
    rows = Q.ledger(table(spark, SF_CHECK, "documents"))
    bits = [r.fail_bits for r in rows.select("fail_bits").collect()]
    for policy, rules in Q.POLICIES.items():
        mask = Q.rule_mask(rules)
        kept = [r.kept for r in Q.apply_policy(rows, policy).collect()]
        assert sum(kept) == sum(b & mask == 0 for b in bits)
        for r in Q.ablations(rows, policy).collect():
            bit = Q.rule_mask([r.rule])
            assert r.failed == sum(b & bit != 0 for b in bits)
            assert r.only_rule == sum(b & mask == bit for b in bits)
            assert r.kept_without == sum(b & mask & ~bit == 0 for b in bits)


def test_policy_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.1"
    rows = Q.judged(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id").filter("not base_failed")
    good = rows.filter("quality = 1")
    assert good.filter("kept").count() / good.count() > 0.97


def test_plan_is_native(spark):
    rows = Q.measure(table(spark, SF_CHECK, "documents")).withColumn("fail_bits", Q.failure_bits())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_no_filter_evaluates_a_rule_again(spark):
    rows = Q.judged(table(spark, SF_CHECK, "documents"))
    for out in (rows, rows.filter("kept"), rows.filter("not base_failed").filter("kept"), Q.ablations(Q.ledger(rows.sparkSession.createDataFrame(
            [(1, "a b c")], "doc_id bigint, text string")))):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "sort_array" not in plan and "text" not in plan
