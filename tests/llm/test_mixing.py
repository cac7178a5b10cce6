from collections import defaultdict

from martforge.llm import mixing
from martforge.llm.common import table
from tests.conftest import SF_CHECK


def by_source(rows):
    out = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        out[r.source][0] += r.size
        out[r.source][1] += r.taken
        out[r.source][2] = r.target
    return out


def level_by_halving(sizes, weights):
    lo, hi = 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(3 * s, mid * w) for s, w in zip(sizes, weights)) < sum(sizes):
            lo = mid
        else:
            hi = mid
    return lo


def test_targets_and_taken(spark):
    docs = table(spark, SF_CHECK, "documents")
    rows = mixing.mix(docs).collect()
    sources = by_source(rows)
    names = sorted(sources)
    weights = [(5, 2, 1)[i % 3] for i in range(len(names))]
    level = level_by_halving([sources[n][0] for n in names], weights)
    largest = max(r.size for r in rows)
    for name, weight in zip(names, weights):
        size, taken, target = sources[name]
        assert abs(target - min(3 * size, level * weight)) < 1e-3
        assert abs(taken - target) <= largest + 1
    assert all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in rows)
    assert abs(sum(r.taken for r in rows) - sum(r.size for r in rows)) <= largest
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_edge_rows(spark, documents):
    docs = documents.withColumnRenamed("n_chars", "size")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and sum(r.size == 0 for r in rows) == 4
    assert all(r.taken <= 3 * r.size for r in rows) and mixing.mix(docs.limit(0)).count() == 0
    # sources in order a, b, c, null weigh 5, 2, 1, 5
    weight = {"a": 5, "b": 2, "c": 1, None: 5}
    sources = by_source(rows)
    free = {s: v[2] / weight[s] for s, v in sources.items() if 0 < v[2] < 3 * v[0]}
    assert len({round(x, 6) for x in free.values()}) <= 1
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    from collections import Counter
    want = Counter({r.doc_id: 0 for r in rows})
    for r in rows:
        want[r.doc_id] += r.copies
    got = Counter(r.doc_id for r in mixed.collect())
    assert got == +want


def test_repeated_rows_share_their_copies(spark):
    rows = [(1, "a b c", "x")] * 5 + [(2, "d e f", "x"), (3, "g", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = sum(r.copies for r in mixing.mix(docs).collect())
    assert mixing.mixed_documents(docs).count() == taken


def test_texts_of_the_mix_stay_where_they_are(spark):
    """Also where a row of a repeated key ties with the last one taken."""
    from collections import Counter
    rows = [(i if i % 9 else None, "w " * (i % 7), f"s{i % 3}" if i % 4 else None) for i in range(90)]
    single = spark.createDataFrame([r for r in rows if r[0]], "doc_id bigint, text string, source string")
    mixed = mixing.mixed_documents(single)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "hashpartitioning" in x and "_row" in x]
    assert Counter(r.doc_id for r in mixed.collect()) == +Counter({r.doc_id: r.copies for r in mixing.mix(single).collect()})
    docs = spark.createDataFrame(rows + rows[:30], "doc_id bigint, text string, source string")
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    assert Counter((r.doc_id, r.source, len(r.text.split())) for r in mixing.mixed_documents(docs).collect()) == +want
