"""Writes the final adaptive physical plan of every batch query to PLANS.md.

    python tools/explain_all.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierline.queries import BATCH_QUERIES  # noqa: E402
from tierline.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    out = [f"# Final physical plans ({os.path.basename(sf)}, local[8], 8 shuffle partitions)\n",
           "Generated by `tools/explain_all.py` after running each query once; AQE's final "
           "plan (broadcasts chosen from runtime sizes at this scale).\n"]
    for name, fn in BATCH_QUERIES.items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0].rstrip().removesuffix("+-").rstrip()
        lines = [ln if len(ln) <= 180 else ln[:177] + "..." for ln in plan.splitlines()]
        out.append(f"\n## {name}\n\n```\n" + "\n".join(lines) + "\n```\n")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
