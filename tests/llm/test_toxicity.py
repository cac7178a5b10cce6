from martforge.llm import toxicity as T
from martforge.llm.common import table

SF_LARGE = "/root/testdata/sf0.1"
TERMS = [("idiot", False), ("worthless", False), ("schmuta", True)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_against_edit_distance():
    import itertools
    terms = [("worthless", False), ("stupid", False), ("schmuta", True), ("idiot", False)]
    trie = T.Trie(terms)
    words = {"idiot", "idiots", "schmutaxyz", "schmuta", "smutaxyz", "clean"}
    for term in ("worthless", "stupid", "schmuta"):
        for i, c in itertools.product(range(len(term) + 1), "xe"):
            words |= {term[:i] + c + term[i:], term[:i] + c + term[i + 1:], term[:i] + term[i + 1:],
                      term[:i] + c + "q" + term[i + 1:]}
    for word in words:
        exact = any(word == t or stem and word.startswith(t) for t, stem in terms)
        near = any(len(t) >= T.FUZZY_LENGTH and (distance(word, t) <= 1 or stem and any(
            distance(word[:n], t) <= 1 for n in range(len(word) + 1))) for t, stem in terms)
        assert trie.look_up(word) == (2 if exact else 1 if near else 0), word


def test_context_separates_quotation():
    hits = {"idiot": 2}
    assert [c[2] for c in T.hit_contexts('you idiot', hits)] == [False]
    assert [c[2] for c in T.hit_contexts('he said "idiot" to them', hits)] == [True]
    assert [c[2] for c in T.hit_contexts('"a" idiot and no more', hits)] == [False]


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_LARGE, "documents"), table(spark, SF_LARGE, "labels")
    rows = T.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(not r.toxic for r in rows)
    assert caught > 0.8 and wrong < 0.01
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_are_never_read(spark):
    from pyspark.sql import functions as F
    docs, labels = table(spark, SF_LARGE, "documents"), table(spark, SF_LARGE, "labels")
    turned = labels.withColumn("toxic", F.when(T.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.learn(docs, labels) == T.learn(docs, turned)


def test_edge_rows(spark, documents):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (None, 1, 1), (7, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    docs = documents.withColumnRenamed("n_chars", "score")
    rows = T.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.predicted == (r.score >= 0.7) for r in rows)
    assert T.toxicity(docs, labels.limit(0)).agg({"score": "max"}).first()[0] == 0.0
    assert T.toxicity(docs.limit(0), labels).count() == 0
    kept = T.keep_clean(docs, labels)
    assert kept.columns == docs.columns


def test_short_and_disguised_terms_hit():
    trie = T.Trie([(t, False) for t in ("trash", "idiot", "loser", "moron", "scum", "stupid", "pathetic", "worthless")])
    scorer = T.Scorer(trie.terms, None, ["oron"])
    for word, kind in {"idiott": 1, "morron": 1, "l0ser": 1, "scumm": 1, "w0rthless": 1, "path3tic": 1, "st*pid": 1,
                       "$tupid": 1, "idiot": 2, "oron": 0, "clean": 0}.items():
        contexts, _ = scorer.contexts(f"and you {word} there")
        assert [c[1] for c in contexts] == [kind] * (kind > 0), word
    # A word with digits or symbols still hits by its letters.
    assert [c[1] for c in scorer.contexts("idiot123 it.moron x1y2")[0]] == [2, 2]


def test_misspelled_abuse_is_caught(spark):
    docs, labels = table(spark, SF_LARGE, "documents"), table(spark, SF_LARGE, "labels")
    model = T.learn(docs, labels)
    assert len(model[2]) > 0 and not set(model[2]) & {t for t, stem in model[0] if not stem}
    scorer = T.Scorer(*model)
    filler = "the report of the town was read and then it was put on the table by them "
    assert scorer.score(filler * 6) < T.THRESHOLD
    for words in ("idiott morron l0ser", "w0rthless path3tic st*pid", "scumm tr4sh clownn"):
        a, b, c = words.split()
        assert scorer.score(f"{filler}you {a} {filler}{b} and {c} you {filler}") >= T.THRESHOLD, words


def test_apostrophes_are_not_quotation_marks():
    hits = {"idiot": 2, "trash": 2}

    def quoted(text):
        return [c[2] for c in T.hit_contexts(text.lower(), hits)]
    assert quoted("You’re an idiot and you’re trash") == [False, False]
    assert quoted("l’ami d’un idiot, c’est l’autre") == [False]
    assert quoted("they said you’re an idiot and it’s so") == [False]
    assert quoted("the dogs’ idiot and the cats’ food") == [False]
    assert quoted("he “calls me» an idiot” and “you’re trash") == [True, False]
    for text in ("the ‘idiot’ here", "a ‘you’re an idiot’ there", "a “idiot” b", "a „idiot“ b", "a «idiot» b", "a »idiot« b",
                 "a ”idiot” b", "a 'b' \"idiot\" c"):
        assert quoted(text) == [True], text
    assert quoted("an open “idiot\nand trash” closed") == [False, False]
