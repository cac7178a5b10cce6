"""Column -> Column scalar functions built from Spark's JVM expressions.

No Python UDFs: every function here stays inside whole-stage codegen or,
for the higher-order title case, inside the JVM expression evaluator.
"""

from .text import strip_blanks, title_case, zero_fill  # noqa: F401
from .temporal import parse_timestamp, date_key, date_parts  # noqa: F401
from .numeric import (  # noqa: F401
    nan_to_null, repair_decimal_comma, to_stage_decimal, to_money, numeric_to_int,
    text_to_int, exact_revenue,
)
from .nulls import fill_default, normalise_missing  # noqa: F401
