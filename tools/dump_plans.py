"""Write the physical plan of every query of the library to PLANS.md.

Usage: python tools/dump_plans.py [sf_dir]
Storage queries run their layer/table writes while being built; the plan
shown is the one of the returned frame (what the final read does).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from strata.plans.queries import QUERIES  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/dump_plans.py` on `{os.path.basename(sf)}`, local[8], AQE on "
           "(plans before execution). Scratch paths are shortened to `<scratch>`.", ""]
    for name, fn in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf).explain()
        plan = re.sub(r"file:[^\s,\]]*/strata/", "<scratch>/", buf.getvalue())
        plan = re.sub(r"#\d+L?", "", plan)
        plan = re.sub(r", \[plan_id=\d+\]", "", plan)  # keep the file stable between runs
        plan = re.sub(r"-[0-9a-f]{12}/", "-<id>/", plan)
        out += [f"## {name}", "", "```", plan.strip(), "```", ""]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
