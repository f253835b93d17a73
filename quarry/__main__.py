"""Run a registered query as a batch job and write its result.

    spark-submit --py-files quarry.zip -m quarry <key> <input_dir> <output_path> [--format parquet]
    python -m quarry <key> <input_dir> <output_path>

On a cluster the master and resources come from the launcher; locally the
session defaults to local[*]. The result is written by the executors, never
collected to the driver.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    from quarry.plans.registry import QUERIES, load_all
    from quarry.session import build_session

    load_all()
    p = argparse.ArgumentParser(prog="quarry")
    p.add_argument("key", choices=sorted(QUERIES))
    p.add_argument("input_dir")
    p.add_argument("output")
    p.add_argument("--format", default="parquet")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=200)
    a = p.parse_args(argv)
    spark = build_session(master=a.master or "", shuffle_partitions=a.shuffle_partitions)
    df = QUERIES[a.key](spark, a.input_dir)
    writer = df.write.mode("overwrite")
    if a.format == "csv":
        writer = writer.option("header", True)
    writer.format(a.format).save(a.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
