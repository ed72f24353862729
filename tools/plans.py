"""Print the formatted physical plan of registered queries.

Usage: python tools/plans.py [sf_dir] [name ...]   (default: the bench's headline queries)

The plan review checklist: filters in ``PushedFilters``/``DataFilters``, a
``ReadSchema`` with only the needed columns, no ``Window`` without partition
keys over unbounded data, broadcasts only where the planner measured a small
side, no Python operator outside the page parser.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tidewater.plans.registry import runner  # noqa: E402
from tidewater.session import local_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.1"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = local_session()
    for name in args or HEADLINE:
        print(f"===== {name}")
        runner(name)(spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
