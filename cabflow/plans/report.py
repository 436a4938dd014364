"""The two batch runs of the workload, as compositions of the operators.

* ``run_analysis``: coverage and quality over the raw relation, the dashboard
  indicators (monthly, yearly, payment, hourly) and exact quantiles, all from one
  scan (see ``operators/onepass.py``); each result is exported as CSV with a header.
* ``run_validation``: the per-file manifest (JSON lines), then the gate, which
  fails the run on an invalid or empty lake naming the files, then file row
  counts by path (CSV) — data is only read once every file passed the gate.

Every export is written by the tasks; only the output paths return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cabflow.operators import cube as cb
from cabflow.operators import onepass
from cabflow.operators import quality as qual
from cabflow.operators.quantiles import quantiles_of
from cabflow.plans import ingest as ing
from cabflow.plans.sinks import export_csv, export_json
from cabflow.session import work_dir
from cabflow.sources.footers import manifest
from cabflow.sources.lake import read_all, read_trips


def run_analysis(spark: SparkSession, root: str, out_dir: str, years: tuple[int, ...] | None = None) -> dict[str, str]:
    work_dir(spark)  # sets the checkpoint folder where the session has none
    groups = onepass.analysis_groups(read_trips(spark, root, years)).checkpoint(eager=True)  # the only scan of the trips
    audit = onepass.audit_of(groups)
    dash = cb.dashboard_of(onepass.cube_of(groups))
    results: dict[str, DataFrame] = {
        "coverage": qual.coverage_of(audit),
        "quality": qual.quality_of(audit),
        "monthly_indicators": dash["monthly_indicators"],
        "yearly_indicators": dash["yearly_indicators_raw"],
        "payment_mix": dash["payment_mix"],
        "pickup_hour": dash["pickup_hour"],
        "quantiles": quantiles_of(onepass.value_counts_of(groups)),
    }
    base = out_dir.rstrip("/")
    return {name: export_csv(df, f"{base}/{name}.csv") for name, df in results.items()}


def run_validation(spark: SparkSession, root: str, out_dir: str) -> dict[str, str]:
    base = out_dir.rstrip("/")
    m = manifest(spark, root).drop("signature", "path")
    paths = {"manifest": export_json(m, f"{base}/manifest.json")}
    ing.gate(spark.read.schema(m.schema).json(paths["manifest"]), f"{base}/invalid_files.json")  # the export, not a second footer pass
    paths["file_row_counts"] = export_csv(qual.file_row_counts(read_all(spark, root)), f"{base}/file_row_counts.csv")
    return paths
