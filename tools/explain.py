"""Print the formatted physical plan of registered plans.

    python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    from tessera.plans import load_all
    from tessera.session import build_session
    spark = build_session()
    plans = load_all()
    for n in names:
        print(f"===== {n}")
        plans[n][0](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
