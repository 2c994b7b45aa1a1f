"""Print the formatted physical plan of registered reports.

Usage: python scripts/show_plans.py [sf_dir] name [name ...]
(Fits run eagerly, so model reports show only their scoring plan.)
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import REPORTS  # noqa: E402
from tessera.session import get_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = get_session()
    for name in args or list(REPORTS):
        print("=" * 20, name)
        REPORTS[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
