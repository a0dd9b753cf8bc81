"""Print the formatted physical plan of registered queries.

usage: python explain_plans.py [sf_dir] [name ...]   (default: the bench reports at sf0.01)
"""

import sys

import bench
from clinicflow.registry import QUERIES
from clinicflow.session import local_session


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or bench.HEADLINE
    spark = local_session()
    for name in names:
        print(f"==================== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
