"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py sf_dir name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martforge.plans.registry import QUERIES  # noqa: E402
from martforge.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session()
    for n in names:
        print(f"===== {n}")
        QUERIES[n](spark, sf_dir).explain(mode=os.environ.get("MODE", "formatted"))
