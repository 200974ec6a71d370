"""Commands over Parquet folders: python -m quaver.cli <command> --input ... --output ...

Acquisition and deletion are not commands here: files are landed by other means, and nothing is
ever deleted from a store.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaver.operators import canonical, controls, dedupe, inventory, projection, registry, summary, sweep
from quaver.plans import snapshot
from quaver.session import ship
from quaver.sources import sinks, tables
from quaver.streaming import durable


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


#: command: (inputs, what it computes)
COMMANDS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "preflight": (("sources",), registry.preflight),
    "status": (("items",), registry.progress),
    "classify-sources": (("sources", "completed"), registry.classify_sources),
    "sample-audit": (("items",), registry.sample_audit),
    "reason-counts": (("items",), registry.reason_counts),
    "canonical-notes": (("notes",), canonical.canonical_notes),
    "canonical-bars": (("notes",), canonical.canonical_bars),
    "extract-features": (("notes",), sweep.primitive_features),
    "project": (("notes",), projection.live_bars),
    "segments": (("notes",), projection.live_segments),
    "controls": (("notes",), controls.bar_controls),
    "characterize": (("rows",), summary.characterize),
    "control-status": (("rows",), summary.control_status),
    "lifecycle": (("rows",), summary.lifecycle_crosstab),
    "reconcile": (("items",), dedupe.reconciliation_counts),
    "consolidate": (("items",), dedupe.first_owner),
    "families": (("items",), dedupe.family_split),
    "inventory-canonicalize": (("records",), inventory.canonicalize),
    "inventory-totals": (("records",), inventory.bucket_totals),
    "inventory-compare": (("old", "new"), inventory.compare_report),
    "coverage": (("expected", "covered"), inventory.coverage_report),
    "package-overlap": (("packages",), inventory.package_overlap),
    "completed-shards": (("receipts",), tables.completed_shards),
    "verify-view": ((), None),
}


def _consolidate(spark: SparkSession, args: argparse.Namespace) -> None:
    items = _rows(spark, args.items)
    ledger = _rows(spark, args.ledger)
    shards = [r[0] for r in items.select("shard_id").distinct().orderBy("shard_id").collect()]
    durable.Run(spark, args.output).run(shards, lambda s: items, lambda s: ledger.where(F.col("shard_id") == s))


#: command: (inputs, what it writes); its output is a folder of its own making
ACTIONS: dict[str, tuple[tuple[str, ...], Callable[[SparkSession, argparse.Namespace], object]]] = {
    "snapshot-preview": (("items", "bars"), lambda spark, a: snapshot.write(_rows(spark, a.items), _rows(spark, a.bars), a.output, {"name": a.output.rstrip("/").rpartition("/")[2]})),
    "export-tensors": (("snapshot",), lambda spark, a: snapshot.export_tensors(spark, a.snapshot, a.output)),
    "build-sidecar": (("notes", "base"), lambda spark, a: snapshot.sidecar(_rows(spark, a.notes), a.base, a.output)),
    "consolidate-run": (("items", "ledger"), _consolidate),
}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quaver", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (inputs, _) in (COMMANDS | ACTIONS).items():
        sub = commands.add_parser(name)
        for x in inputs:
            sub.add_argument(f"--{x}", required=True, help="a Parquet folder")
        sub.add_argument("--output", required=True, help="a new Parquet folder" if inputs else "the view's folder")
    args = parser.parse_args(arguments)
    spark = ship(spark or SparkSession.builder.appName(f"quaver {args.command}").getOrCreate())
    if args.command in ACTIONS:
        ACTIONS[args.command][1](spark, args)
        return 0
    inputs, compute = COMMANDS[args.command]
    if compute is None:
        return int(not sinks.verify_view(spark, args.output).isEmpty())
    compute(*[_rows(spark, getattr(args, x)) for x in inputs]).write.mode("errorifexists").parquet(args.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
