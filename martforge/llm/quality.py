"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measured
values and one bit per failed rule. A policy is a named, versioned set of
rules: applying it, comparing versions and ablating single rules are bitwise
operations on the ledger and never read a text again.

Only DataFrame expressions are used. Repeated word triples are found inside
the row: triples are sorted by hash and words, equal neighbours are marked,
and the marked positions are counted with their overlaps removed.

Defined results: a null text has no words, all measurements 0; rows with a
null doc_id and repeated rows each get their row; texts of any length are
measured whole; no measurement has ties; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, materialize, text_or_empty

SYMBOLS = "#*$%&|<>"

#: Rule names in bit order; a bit is set when the rule fails.
RULES = {
    "too_few_words": "n_words < 50",
    "repeated_triples": "100 * n_repeat_words > 50 * n_words",
    "symbol_heavy": "4 * n_symbols > n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
}
#: Policies by version: the rules that reject a document.
POLICIES = {
    "base-1": ["too_few_words", "repeated_triples"],
    "full-1": ["too_few_words", "repeated_triples", "symbol_heavy", "repeated_lines"],
    "full-2": list(RULES),
}
CURRENT = "full-2"


def rule_mask(names: list[str]) -> int:
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text."""
    text = F.col("_text")
    base = docs.select("doc_id", text_or_empty().alias("_text"))
    words = base.select(
        "doc_id", "_text",
        F.expr(r"filter(split(_text, '[\\x20\\x09-\\x0D]+'), w -> w != '')").alias("_words"),
        F.expr(f"filter(split(_text, '\n'), l -> translate(l, '{SPACE_CHARS}', '') != '')").alias("_lines"))
    triples = words.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        # (hash, three words, position) of every window, in the order of the first four
        F.expr("""CASE WHEN size(_words) < 3 THEN array() ELSE
            sort_array(transform(
              arrays_zip(slice(_words, 1, size(_words) - 2), slice(_words, 2, size(_words) - 2),
                         slice(_words, 3, size(_words) - 2)),
              (z, i) -> struct(xxhash64(z.`0`, z.`1`, z.`2`) AS h, z.`0` AS a, z.`1` AS b, z.`2` AS c, i AS i))) END""")
        .alias("_sorted"))
    same = "(x.h = y.h AND x.a = y.a AND x.b = y.b AND x.c = y.c)"
    # Whether each window equals the one after it; the window before closes the pair.
    marked = triples.withColumn("_next", F.expr(
        f"zip_with(_sorted, slice(_sorted, 2, greatest(size(_sorted) - 1, 0)), (x, y) -> y IS NOT NULL AND {same})"))
    repeated = marked.withColumn("_at", F.expr(
        """array_sort(transform(filter(
             zip_with(_sorted, zip_with(_next, concat(array(false), _next),
                      (n, p) -> coalesce(n, false) OR coalesce(p, false)),
                      (x, r) -> struct(x.i AS i, coalesce(r, false) AS r)), y -> y.r), y -> y.i))"""))
    covered = F.expr("""aggregate(zip_with(_at, slice(_at, 2, greatest(size(_at) - 1, 0)),
                          (x, y) -> CASE WHEN x IS NULL THEN 0 WHEN y IS NULL THEN 3 ELSE least(3, y - x) END),
                        0L, (s, v) -> s + v)""")
    return repeated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                           covered.alias("n_repeat_words"))


def failure_bits() -> Column:
    return F.expr(" + ".join(f"CASE WHEN {rule} THEN {1 << i}L ELSE 0L END" for i, rule in enumerate(RULES.values())))


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``fail_bits`` of every document, each rule once: a
    written table in the shared folder. Policies, filters and ablations read
    its few numbers; none of them evaluates a rule again."""
    return materialize(measure(docs).withColumn("fail_bits", failure_bits()), "quality-ledger")


def apply_policy(rows: DataFrame, policy: str = CURRENT, out: str = "kept") -> DataFrame:
    """Add ``out``: whether the policy keeps the row of a ledger."""
    return rows.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(rule_mask(POLICIES[policy]))) == 0)


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of the policy: documents that fail it, that only it
    rejects, and the documents kept without it. One aggregate over the bits:
    rows are first counted by bit pattern (at most 2^rules of them)."""
    mask = rule_mask(POLICIES[policy])
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(rule_mask([n])).alias("bit"))
                      for n in POLICIES[policy]])
    each = patterns.select("bits", "n", F.explode(rules).alias("r"))
    rest = F.col("bits").bitwiseAND(F.lit(mask).bitwiseXOR(F.col("r.bit")))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_rule"),
        F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("kept_without"))


def judged(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The contract's digest of the ledger."""
    base = rule_mask(POLICIES["base-1"])
    rows = apply_policy(ledger(docs), policy)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (F.col("fail_bits").bitwiseAND(F.lit(base)) != 0).alias("base_failed"), "kept",
                       "n_lines", "fail_bits")
