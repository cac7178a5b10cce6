"""The corpus pipeline over ``documents``: toxicity filter, exact dedup, near
dedup, mixing of sources, tokenisation.

Every stage takes (spark, docs, sf_dir), works on all rows that its
predecessor kept and, but for the last, returns the columns of ``documents``.
Results between stages are written to the shared folder and read again.

Defined results, all stages: an empty table gives no rows; texts of any length
are read whole; columns beside those of ``documents`` stay as they are, whatever
their names. Per stage, see below for nulls, ties and repeated rows.
"""

from __future__ import annotations

from martforge.llm import exact_dedup, mixing, sentencepiece, simhash, toxicity
from martforge.llm.common import materialize, table


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity model does not reject. A null text counts as
    empty; equal texts are judged alike, repeated rows and null ids stay."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark, docs, sf_dir):
    """Of documents with equal texts, the one with the largest doc_id. A null
    text is empty, a null doc_id is the smallest; of rows that repeat both, one."""
    return exact_dedup.keep_exact_unique(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of documents whose SimHash fingerprints are linked, the one with the
    smallest doc_id. Texts without words are linked like others; a null doc_id is
    the largest; of rows that repeat the doc_id, that with the smallest text."""
    return simhash.keep_first_of_groups(docs, shingle=3, radius=2)


def mix_sources(spark, docs, sf_dir):
    """The mix of all sources: a document as often as it is taken. Texts without
    words are not taken; a null source is the last; rows that tie in doc_id,
    source and size share their copies in order of text."""
    return mixing.mixed_documents(docs)


def tokenise(spark, docs, sf_dir):
    """Token ids of every row of the mix, checked by decoding them. Repeated rows
    and null ids each get their row; an empty text has no ids."""
    return sentencepiece.tokenised(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", tokenise),
]

# Learned scores, hashes and the tokeniser are beyond SQL; the stages are
# tested one by one against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
