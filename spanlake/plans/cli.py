"""Command line: preflight, export, load, run, resources, apply-scores, status, verify, settings. Exit codes: 0 done, 1 refused or failed, 2 bad settings, 130 interrupted."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from spanlake.operators import resources
from spanlake.plans import migrate, run, settings
from spanlake.sources import readers
from spanlake.sources.senders import Folder

#: Commands, and the folders that each needs.
COMMANDS = {
    "preflight": ("folder",), "export": ("folder", "target"), "load": ("target", "destination"), "run": ("folder", "target", "destination"), "resources": ("folder", "target"),
    "apply-scores": ("target", "destination"), "status": ("target",), "verify": ("target",), "settings": (),
}


def _parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--settings", default=argparse.SUPPRESS, help="file of KEY=value lines")
    common.add_argument("--folder", default=argparse.SUPPRESS, help="folder of the source")
    common.add_argument("--target", default=argparse.SUPPRESS, help="folder that is written")
    common.add_argument("--destination", default=argparse.SUPPRESS, help="folder that batches go to")
    common.add_argument("--dry", action="store_true", default=argparse.SUPPRESS, help="write no resources")
    common.add_argument("--rebuild", action="store_true", default=argparse.SUPPRESS, help="make deferred scores anew where they are missing")
    parser = argparse.ArgumentParser(prog="spanlake", parents=[common])
    commands = parser.add_subparsers(dest="command", required=True)
    for name in COMMANDS:
        commands.add_parser(name, parents=[common])
    return parser


def _rows(df) -> list[dict]:
    return [r.asDict() for r in df.orderBy(df.columns[0]).collect()]  # a row a day or resource


def _do(command: str, spark: SparkSession, conf: settings.Settings, at: dict[str, str], args: dict) -> tuple[object, bool]:
    """What a command reports, and whether all is well."""
    now, bulk = datetime.now(UTC), conf.get("SPANLAKE_PATH") != "quick"
    source = readers.source(conf.get("SPANLAKE_SOURCE"), spark, at["folder"], conf.get("SPANLAKE_SOURCE_FORM")) if at["folder"] else None
    sink = Folder(spark, at["destination"]) if at["destination"] else None
    options = {"years": conf.get("SPANLAKE_YEARS"), "most_days": conf.get("SPANLAKE_MAX_DAYS"), "overwrite": conf.get("SPANLAKE_OVERWRITE"), "reattach_orphans": conf.get("SPANLAKE_REATTACH_ORPHANS"), "batch_rows": conf.get("SPANLAKE_BATCH_ROWS")}
    if command == "preflight":
        checks = run.preflight(source)
        return checks, not any(c["fatal"] and not c["ok"] for c in checks)
    if command == "export":
        done = run.export(source, at["target"], now, bulk=bulk, **options)
        return {k: v.count() for k, v in done.items()}, True
    if command == "load":
        sent = run.load(spark, at["target"], sink.send, bulk)
        return sent, not (sent["rejected"] or sent["uncertain"])
    if command == "run":
        report = run.run(source, at["target"], now, sink.send, sink.readable, sink.annotate, sink.update, name=at["folder"], project=conf.get("SPANLAKE_PROJECT") or "default", bulk=bulk, patience=conf.get("SPANLAKE_VERIFY_SECONDS"), **options)
        return report, report["ok"]
    if command == "resources":
        done = migrate.migrate(spark, source, at["target"], migrate.Options.of(conf), dry=args.get("dry", False))
        counts = _rows(resources.report(done))
        return {"counts": counts, "failed": _rows(done.where("outcome = 'failed'"))}, not any(r["outcome"] == "failed" for r in counts)
    if command == "apply-scores":
        if args.get("rebuild") and source is not None:
            run.rebuild_frames(source, at["target"], bulk)
        done = run.apply_scores(spark, at["target"], sink.annotate, sink.update, sink.readable(), now)
        return done, not done["problems"]
    if command == "status":
        return _rows(run.status(spark, at["target"])), True
    short = _rows(run.verify(spark, at["target"], sink.readable() if sink else spark.read.parquet(f"{at['target']}/spans")))
    return short, not short


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Runs a command; a JSON report goes to standard output. Options stand before or after the command and beat the settings."""
    args = vars(_parser().parse_args(argv))
    command = args["command"]
    try:
        conf = settings.load(args.get("settings"))
        if command == "settings":
            print(settings.template())
            return 0
        at = {k: args.get(k) or conf.get(v) for k, v in (("folder", "SPANLAKE_SOURCE_FOLDER"), ("target", "SPANLAKE_TARGET"), ("destination", "SPANLAKE_DESTINATION"))}
        if missing := [k for k in COMMANDS[command] if not at[k]]:
            raise settings.SettingsError(f"missing: {', '.join(missing)}")
    except (settings.SettingsError, OSError) as bad:
        print(bad, file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.appName("spanlake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        report, well = _do(command, spark, conf, at, args)
        print(json.dumps(report, default=str))
        return int(not well)
    except KeyboardInterrupt:
        return 130
    except (run.RunError, ValueError) as failed:
        print(failed, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
