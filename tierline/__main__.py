"""Command-line runner for the pipelines.

    python -m tierline sales     --sf /root/testdata/sf0.01
    python -m tierline fraud     --sf ... --pct 3 --files 5
    python -m tierline medallion --sf ... [--continuous 5 [--rounds 12]] [--source rate]
    python -m tierline ingest    --sf ...
    python -m tierline seed      --sf ... --pct 3 --files 5

Output goes below --root, default a fresh folder in the session's
spark.checkpoint.dir. Prints the published datasets' row counts.
"""

from __future__ import annotations

import argparse
import json

from tierline import tables
from tierline.session import build_session, work_root


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tierline")
    ap.add_argument("pipeline", choices=["sales", "fraud", "medallion", "ingest", "seed"])
    ap.add_argument("--sf", default="/root/testdata/sf0.01", help="folder of the input tables")
    ap.add_argument("--root", default=None, help="output folder (shared storage on a cluster)")
    ap.add_argument("--master", default="local[8]")
    ap.add_argument("--pct", type=float, default=3.0)
    ap.add_argument("--files", type=int, default=5)
    ap.add_argument("--source", choices=["events", "rate"], default="events")
    ap.add_argument("--continuous", type=float, default=0.0,
                    help="seconds between refreshes; 0 = one triggered update")
    ap.add_argument("--rounds", type=int, default=0, help="refreshes before stopping; 0 = never stop")
    ap.add_argument("--register", default=None, metavar="PREFIX",
                    help="name the published views in the catalog, with this prefix")
    a = ap.parse_args(argv)

    from tierline.streaming import pipelines as P
    spark = build_session(a.master)
    root = a.root or work_root(spark, a.pipeline)
    out = {}
    if a.pipeline == "sales":
        if a.continuous > 0:
            P.sales_continuous(spark, a.sf, root, a.continuous, rounds=a.rounds or None)
        else:
            P.sales_pipeline(spark, a.sf, root)
        out = {n: tables.read_latest(spark, root, n).count()
               for n in ("sales_stats", "sales_stats_expectations")}
    elif a.pipeline == "fraud":
        if a.continuous > 0:
            P.fraud_continuous(spark, a.sf, root, a.continuous, rounds=a.rounds or None)
        else:
            P.fraud_pipeline(spark, a.sf, root, a.pct, a.files)
        out = {n: tables.read_latest(spark, root, n).count()
               for n in ("bookings_with_fraud", "fraud_by_party_and_method")}
    elif a.pipeline == "medallion":
        m = P.Medallion(spark, root)
        if a.continuous > 0:
            m.start(*P.medallion_feeds(spark, a.sf, a.source), trigger=f"{a.continuous} seconds")
            m.run_continuous(a.continuous, a.rounds or None)
        else:
            m.start(*P.medallion_feeds(spark, a.sf, a.source))
            m.run_triggered()
        out = {"zone_stats_gold": tables.read_latest(spark, root, "zone_stats_gold").count(),
               "sensor_state_silver": m.state.read(spark).count()}
    elif a.pipeline == "ingest":
        P.measurements_pipeline(spark, a.sf, root)
        out = {"measurements": P.read_table(spark, root, "measurements").count()}
    elif a.pipeline == "seed":
        from tierline.plans import seed
        from tierline.sources import testdata as td
        path = f"{root}/landing/booking_fraud_flags"
        out = {"markers": seed.seed_fraud_markers(spark, td.booking_updates(spark, a.sf), path,
                                                  a.pct, a.files).count(), "path": path}
    if a.register is not None:
        out["registered"] = P.register_published(spark, root, a.register)
    print(json.dumps({"pipeline": a.pipeline, "root": root, **out}))
    spark.stop()


if __name__ == "__main__":
    main()
