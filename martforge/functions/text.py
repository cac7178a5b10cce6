"""Text functions: blank stripping, title case, zero filling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) makes \s match every Unicode blank; with the four ASCII separator
# controls added it is the set Python's str.strip() removes. Spark's trim()
# removes only the ASCII space.
_EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# A title-case word is a run of cased letters (upper, lower, title case);
# everything between runs (digits, marks, blanks, uncased scripts) is kept.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_LETTER_RUNS = rf"([{_CASED}]+|[^{_CASED}]+)"


def strip_blanks(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(c, _EDGE_BLANKS, "")


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of cased letters, lower-case
    the rest (P2), as Python's ``str.title``: ``d'oeste`` -> ``D'Oeste``,
    ``mogi-mirim`` -> ``Mogi-Mirim``, ``1st`` -> ``1St``.

    ``initcap`` splits on spaces only and would give ``D'oeste``.
    """
    pieces = F.regexp_extract_all(c, F.lit(_LETTER_RUNS), 1)
    cased = F.transform(
        pieces,
        lambda t: F.when(
            t.rlike(rf"^[{_CASED}]"),
            F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30))),
        ).otherwise(t),
    )
    return F.when(c.isNotNull(), F.array_join(cased, ""))


def zero_fill(c: Column, width: int) -> Column:
    """Left-pad text with zeros to ``width``; never truncates (P3). A leading
    sign stays in front, as with Python's ``str.zfill``.

    ``lpad`` alone would cut longer values, so it only applies to short ones.
    """
    s = c.cast("string")
    signed = s.startswith("-") | s.startswith("+")
    return (F.when(F.length(s) >= width, s)
            .when(signed, F.concat(F.substring(s, 1, 1), F.lpad(F.substring(s, 2, 1 << 30), width - 1, "0")))
            .otherwise(F.lpad(s, width, "0")))
