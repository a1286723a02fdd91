"""Command line: run the pipeline, or single steps of it.

    python -m lakeforge --root <shared folder> --listings-csv <path> --reviews-csv <path> \\
        [--steps ingest,land,silver,staging,gold,test] [--kafka host:port] [--silver-ns silver --gold-ns gold]

``--root`` defaults to a fresh folder under the session's shared root. With the
root of an earlier run, any step runs alone on what is there. The session comes from ``spark-submit`` / the environment; when run directly it
is a local session.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from lakeforge.operators.quality import QualityError
from lakeforge.plans import pipeline as P


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="lakeforge")
    ap.add_argument("--root")
    ap.add_argument("--listings-csv")
    ap.add_argument("--reviews-csv")
    ap.add_argument("--kafka", dest="kafka_servers")
    ap.add_argument("--silver-ns", dest="silver_namespace")
    ap.add_argument("--gold-ns", dest="gold_namespace")
    ap.add_argument("--min-year", type=int, default=P.marts.REVIEW_YEAR_FLOOR)
    ap.add_argument("--median", choices=("approx", "sketch", "exact"), default="approx")
    ap.add_argument("--steps", default=",".join(P.STEPS))
    ap.add_argument("--dead-letters", action="store_true", help="read CSV files as byte ranges; records that can't be read go to the topics' errors")
    ap.add_argument("--flush-records", type=int, help="land one bronze file for every so many records")
    ap.add_argument("--no-gate", action="store_true", help="report quality failures without failing")
    a = ap.parse_args(argv)
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName("lakeforge").getOrCreate()
    cfg = P.PipelineConfig(root=a.root or P.new_run_root(spark), listings_csv=a.listings_csv,
                           reviews_csv=a.reviews_csv, kafka_servers=a.kafka_servers, min_year=a.min_year,
                           median=a.median, silver_namespace=a.silver_namespace,
                           gold_namespace=a.gold_namespace, fail_on_quality=not a.no_gate,
                           dead_letters=a.dead_letters, flush_records=a.flush_records)
    steps = [s for s in a.steps.split(",") if s]
    report: dict = {"root": cfg.root}
    status = 0
    for step in steps:
        try:
            done = P.STEPS[step](spark, cfg)
        except QualityError as e:
            report["quality_error"], done = str(e), e.rows
            status = 0 if a.no_gate else 1
        if step in ("ingest", "land"):
            report[{"ingest": "published", "land": "landed"}[step]] = [asdict(r) for r in done]
        elif step in ("silver", "test"):
            report[{"silver": "counts", "test": "quality"}[step]] = done
    print(json.dumps(report, default=str))
    return status


if __name__ == "__main__":
    raise SystemExit(main())
