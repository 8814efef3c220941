"""Run one of the reference's jobs from the command line.

    python -m eventide.cli login_fail /data/LoginLog.csv
    python -m eventide.cli tx_match /data/OrderLog.csv /data/ReceiptLog.csv --show 50
    python -m eventide.cli hot_items /data/UserBehavior/ --stream --out /shared/hot_items

Batch runs print the result (or write it as parquet with ``--out``). Stream
runs read the input folder as a file stream with the job's watermark and
append results to ``--out`` (parquet) or the console, with a checkpoint
under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import inspect
import sys

from .plans import jobs
from .session import checkpoint_location, get_session

JOBS = {name: fn for name, fn in vars(jobs).items()
        if inspect.isfunction(fn) and fn.__module__ == jobs.__name__ and not name.startswith("_")}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="eventide.cli", description=__doc__.split("\n\n")[0])
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("inputs", nargs="+", help="input file(s) or folder(s), in the job's order")
    ap.add_argument("--stream", action="store_true", help="read the inputs as file streams")
    ap.add_argument("--out", help="parquet output folder (default: print)")
    ap.add_argument("--show", type=int, default=20, help="rows to print in batch mode")
    ap.add_argument("--master", help="Spark master (default: from the launcher)")
    args = ap.parse_args(argv)

    spark = get_session(args.master, app_name=f"eventide-{args.job}")
    fn = JOBS[args.job]
    kwargs = {"live": True} if args.stream else {}
    if args.stream and "live" not in inspect.signature(fn).parameters:
        ap.error(f"{args.job} has no live form")
    result = fn(spark, *args.inputs, **kwargs)
    frames = result if isinstance(result, tuple) else (result,)
    for i, df in enumerate(frames):
        suffix = f"/part{i}" if len(frames) > 1 else ""
        if args.stream:
            w = df.writeStream.option("checkpointLocation", checkpoint_location(spark, f"{args.job}{i}"))
            w = w.format("parquet").option("path", args.out + suffix) if args.out else w.format("console")
            w.outputMode("update" if args.job == "word_count" else "append").start()
        elif args.out:
            df.write.mode("overwrite").parquet(args.out + suffix)
        else:
            df.show(args.show, truncate=False)
    if args.stream:
        spark.streams.awaitAnyTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
