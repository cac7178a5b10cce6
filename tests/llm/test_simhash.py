import itertools

import xxhash

from martforge.llm import simhash
from martforge.llm.common import table
from tests.conftest import SF_CHECK


def slow_fingerprint(text, k):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) > len(h) / 2)


def slow_components(prints, radius):
    """{row: smallest id} of rows [(id, fp)] by comparing every pair."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(prints)), 2):
        if bin(prints[i][1] ^ prints[j][1]).count("1") <= radius:
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(prints))]


def expected(rows):
    prints = [(d, slow_fingerprint(t, 3)) for d, t in rows]
    comps = slow_components(prints, 2)
    return sorted(((d, format(f, "016x"), c) for (d, f), c in zip(prints, comps)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_whole_table_against_all_pairs(spark):
    docs = table(spark, SF_CHECK, "documents")
    assert result(simhash.simhash_groups(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows(spark, documents):
    assert result(simhash.simhash_groups(documents)) == expected([(r.doc_id, r.text) for r in documents.collect()])
    assert simhash.simhash_groups(documents.limit(0)).count() == 0


def test_every_pair_within_the_radius_meets():
    for radius in (1, 2):
        masks = simhash.covering_masks(radius)
        for bits in itertools.combinations(range(64), radius):
            hidden = sum(1 << b for b in bits)
            assert any(m & hidden == 0 for m in masks)
        assert all(m for m in masks)


def test_links_of_planted_fingerprints(spark):
    base = 0x0123456789ABCDEF
    near = [base, base ^ 1, base ^ 3, base ^ (1 << 63), base ^ 0xFF, base ^ (0xFF << 8) ^ 1, base ^ (7 << 30)]
    chain = [0, 3, 15, 63, 255, 1023, 4095]  # a path of links two bits long
    values = near + chain
    rows = [(i, simhash._signed(v)) for i, v in enumerate(values)]
    links = simhash.link_fingerprints(spark.createDataFrame(rows, "id bigint, fp bigint").select("fp"), 2)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    got = [roots.get(fp, fp) for _, fp in rows]
    want = slow_components([(i, v) for i, v in enumerate(values)], 2)
    assert [[a == b for b in got] for a in got] == [[a == b for b in want] for a in want]


def kept_by_hand(rows):
    """Of each component, the smallest (doc_id, text) with its smallest id."""
    prints = [(d, slow_fingerprint(t, 3)) for d, t in rows]
    root = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if bin(prints[i][1] ^ prints[j][1]).count("1") <= 2:
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    out = []
    for r in set(root):
        own = [rows[i] for i in range(len(rows)) if root[i] == r]
        out.append(min(own, key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")))
    return sorted(((d, t or "") for d, t in out), key=repr)


def test_kept_documents(spark, documents):
    # a repeated doc_id with texts of two groups, one of which has a smaller id
    extra = spark.createDataFrame([(9, "the cat sat on the mat and the cat sat on the mat again", "", "", 1),
                                   (9, "another text, same id", "", "", 2), (None, None, "", "", 3),
                                   (None, "only a row without an id", "", "", 3)], documents.schema)
    docs = documents.unionByName(extra).withColumnRenamed("n_chars", "component_id")
    kept = simhash.keep_first_of_groups(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=repr)
    assert got == kept_by_hand([(r.doc_id, r.text) for r in docs.collect()])
