"""Command line: python -m citeweave.cli pipeline|validate."""

from __future__ import annotations

import argparse
import logging
import sys
import time

from citeweave.functions.elapsed import format_elapsed
from citeweave.plans.pipeline import SOURCES, PipelineArgs, run_pipeline, run_validate

# Accepted log levels and what they mean here.
LEVELS = {"OFF": logging.CRITICAL + 1, "DEBUG": logging.DEBUG, "INFO": logging.INFO, "WARN": logging.WARNING, "WARNING": logging.WARNING, "ERROR": logging.ERROR}


def log_level(name: str) -> int:
    if name.upper() not in LEVELS:
        print(f"unknown log level {name}, using INFO", file=sys.stderr)
    return LEVELS.get(name.upper(), logging.INFO)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="citeweave")
    commands = top.add_subparsers(dest="command", required=True)
    p = commands.add_parser("pipeline", help="extract, invert and validate an archive of works")
    v = commands.add_parser("validate", help="validate a citations file")
    for c in (p, v):
        c.add_argument("-i", "--input", required=True)
        c.add_argument("--datacite-records")
        c.add_argument("--source", type=str.lower, choices=SOURCES, default="all", required=c is v)
        c.add_argument("-l", "--log-level", default="INFO")
        c.add_argument("-c", "--concurrency", type=int, default=50)
        c.add_argument("--single-file", action="store_true")
        c.add_argument("--resolved-table", help="folder of remembered answers of the HTTP fallback")
        c.add_argument("--retries", type=int, default=0, help="how often passing errors of the HTTP fallback are asked again")
    for s in SOURCES[1:]:
        p.add_argument(f"--output-{s}")
        p.add_argument(f"--output-{s}-failed")
    for s in ("crossref", "datacite"):
        p.add_argument(f"--load-{s}-index")
        p.add_argument(f"--save-{s}-index")
    p.add_argument("--http-fallback", default="")
    p.add_argument("--timeout", type=float, default=5)
    p.add_argument("--keep-intermediates", action="store_true")
    p.add_argument("--temp-dir")
    p.add_argument("--run-id", help="a run of this name goes on where it ended; use it with --temp-dir")
    p.add_argument("--ranges", type=int, default=64, help="key ranges that a named run commits one by one")
    p.add_argument("--batch-size", type=int, default=5_000_000, help="accepted for compatibility; Spark sizes its own batches")
    v.add_argument("--crossref-index")
    v.add_argument("--output-valid", required=True)
    v.add_argument("--output-failed", required=True)
    v.add_argument("--http-fallback", action="store_true")
    v.add_argument("-t", "--timeout", type=float, default=5)
    return top


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=log_level(args.log_level))
    from citeweave.session import get_session

    began = time.time()
    try:
        if args.command == "pipeline":
            options = vars(args)
            plan = PipelineArgs(
                input=args.input,
                source=args.source,
                datacite_records=args.datacite_records,
                outputs={s: o for s in SOURCES[1:] if (o := options[f"output_{s}"])},
                failed={s: o for s in SOURCES[1:] if (o := options[f"output_{s}_failed"])},
                http_fallback=tuple(s.strip().lower() for s in args.http_fallback.split(",") if s.strip()),
                load_index={s: o for s in ("crossref", "datacite") if (o := options[f"load_{s}_index"])},
                save_index={s: o for s in ("crossref", "datacite") if (o := options[f"save_{s}_index"])},
                concurrency=args.concurrency,
                timeout=args.timeout,
                keep_intermediates=args.keep_intermediates,
                temp_dir=args.temp_dir,
                single_file=args.single_file,
                run_id=args.run_id,
                ranges=args.ranges,
                resolved_table=args.resolved_table,
                retries=args.retries,
            )
            plan.check()
            for name, n in run_pipeline(spark or get_session(), plan)["stats"].items():
                logging.getLogger("citeweave").info("%s: %d", name, n)
        else:
            run_validate(
                spark or get_session(), args.input, args.source, args.output_valid, args.output_failed, args.datacite_records,
                args.crossref_index, args.http_fallback, args.concurrency, args.timeout, single_file=args.single_file,
                resolved_table=args.resolved_table, retries=args.retries,
            )
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    logging.getLogger("citeweave").info("done in %s", format_elapsed(time.time() - began))
    return 0


if __name__ == "__main__":
    sys.exit(main())
