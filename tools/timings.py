"""Time every catalogue query (full execution, ``noop`` sink) and count its shuffles.

Usage: python tools/timings.py sf_dir [sf_dir ...] > table.md
Prints a markdown table: query, seconds per scale factor, hash exchanges in the plan.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(dirs: list[str]) -> None:
    from emporia.plans import QUERIES
    from emporia.session import get_session
    spark = get_session("local[8]", app="emporia-timings", shuffle_partitions=16)
    QUERIES["traffic_vc_ch_ar_isnew"](spark, dirs[0]).write.format("noop").mode("overwrite").save()
    rows = {}
    for d in dirs:
        for name in sorted(QUERIES):
            t0 = time.perf_counter()
            df = QUERIES[name](spark, d)
            df.write.format("noop").mode("overwrite").save()
            rows.setdefault(name, {})[d] = time.perf_counter() - t0
            if "shuffles" not in rows[name]:
                buf = io.StringIO()
                with contextlib.redirect_stdout(buf):
                    df.explain(mode="formatted")
                rows[name]["shuffles"] = len(re.findall(r"Arguments: hashpartitioning", buf.getvalue()))
            print(f"{name} {d} {rows[name][d]:.2f}", file=sys.stderr, flush=True)
    head = "| query | " + " | ".join(os.path.basename(d.rstrip("/")) + " s" for d in dirs) + " | shuffles |"
    print(head)
    print("|" + "---|" * (len(dirs) + 2))
    for name in sorted(rows):
        cells = " | ".join(f"{rows[name][d]:.2f}" for d in dirs)
        print(f"| {name} | {cells} | {rows[name]['shuffles']} |")


if __name__ == "__main__":
    main(sys.argv[1:] or ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
