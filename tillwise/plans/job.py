"""The daily job: every report for one delivered snapshot, published together.

    python -m tillwise.plans.job --root <landing> --date 2001-08-01 --out <dir>

Reads the eight datasets of the dated snapshot (declared schemas), cleans them
once into the shared checkpoint folder (lineage cut), and counts the violations
of every rule in one job.  If a gated rule is violated the run stops before any
report is written (``--no-gates`` goes on).  The validation summary and the
reports are written to a folder of their own, ``<out>/runs/<id>/<key>``; when
all of them are complete, one atomic rename makes that run the current one.  A
run that is killed half-way leaves the one before readable.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from ..operators import validate
from ..session import apply_scale_conf, build_session
from ..sources.publish import Publication
from ..sources.scan import landing_violations, snapshot_dir
from .catalog import REPORTS, summary
from .retail import Retail

# Rules that stop the run (negative stock is reported only).
GATED_RULES = ("orphan_items", "inventory_store", "promo_product")


def run_reports(retail: Retail, out: str, keys: list[str] | None = None,
                gates: bool = True, materialize: bool = True,
                fmt: str = "parquet", landing: DataFrame | None = None) -> dict[str, str]:
    """Write the summary and the reports, publish them, return ``{key: path}``.

    Every rule is evaluated once: its count decides the gate and is the row of
    the summary.  ``landing`` are counts of the delivered files' own faults
    (``sources.scan.landing_violations``), reported with the others."""
    r = retail.materialize() if materialize else retail
    found = summary(r) if landing is None else summary(r).unionByName(landing)
    counts = {row["rule"]: row["violations"] for row in found.collect()}  # a row per rule
    if gates:
        validate.require_none(counts, GATED_RULES)
    run = Publication(r.spark, out)
    frames = {"validate_summary": r.spark.createDataFrame(sorted(counts.items()), "rule string, violations long")}
    for key in keys or list(REPORTS):
        if key != "validate_summary":
            frames[key] = REPORTS[key](r)
    for key, df in frames.items():
        df.write.format(fmt).option("header", "true").save(run.path(key))
    run.publish()
    return {key: run.path(key) for key in frames}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--root", required=True, help="landing folder with <yyyy-MM-dd>/<file>")
    ap.add_argument("--date", required=True, help="snapshot (ingest) date")
    ap.add_argument("--out", required=True, help="output folder for the report tables")
    ap.add_argument("--as-of", help="reference day for 'recent' windows (default: --date)")
    ap.add_argument("--input-format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--output-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--reports", default="", help="comma-separated keys (default: all)")
    ap.add_argument("--no-gates", action="store_true", help="go on when a gated rule is violated")
    args = ap.parse_args(argv)
    spark = build_session(app="tillwise-daily")
    # shuffle partitions sized from the snapshot's bytes (AQE coalesces down)
    apply_scale_conf(spark, snapshot_dir(args.root, args.date))
    retail = Retail.from_landing(spark, args.root, args.date, args.as_of or args.date, args.input_format)
    keys = [k for k in args.reports.split(",") if k] or None
    faults = landing_violations(spark, args.root, args.date) if args.input_format == "csv" else None
    for key, path in run_reports(retail, args.out, keys, not args.no_gates,
                                 fmt=args.output_format, landing=faults).items():
        print(f"{key}\t{path}")


if __name__ == "__main__":
    main()
