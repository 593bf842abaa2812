"""Print the formatted physical plan of catalogue queries.

Usage: python tools/explain.py [sf_dir] [name ...]   (default: the bench headline set)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    from bench import HEADLINE
    from emporia.plans import QUERIES
    from emporia.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", app="emporia-explain", shuffle_partitions=16)
    for name in argv[2:] or HEADLINE:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain(mode="formatted")


if __name__ == "__main__":
    main(sys.argv)
