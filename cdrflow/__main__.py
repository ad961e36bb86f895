"""Command line for spark-submit.

    spark-submit --py-files cdrflow.zip submit.py batch  --landing /landing --warehouse /wh --batch-id 20240101
    spark-submit --py-files cdrflow.zip submit.py stream --landing /landing --warehouse /wh --checkpoint /shared/ckpt \
        [--every "1 minute"] [--max-files 10]

(``cdrflow.zip`` is the zipped package; locally ``python -m cdrflow ...``). Master, memory and
``spark.checkpoint.dir`` come from spark-submit.
"""

from __future__ import annotations

import argparse
import json
import time

from .session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cdrflow")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("batch", help="process the landing files as one batch")
    b.add_argument("--landing", required=True)
    b.add_argument("--warehouse", required=True)
    b.add_argument("--batch-id", type=int, default=None, help="default: current time in ms")
    b.add_argument("--no-text", action="store_true", help="skip the ';'-joined text export")
    b.add_argument("--partitioned", action="store_true", help="landing has dc=/datatype=/op= folders")
    b.add_argument("--descriptors", default=None, help="descriptor root (default: the landing)")
    b.add_argument("--cluster-output", action="store_true",
                   help="range-partition enriched rows by dc/datatype before writing (fewer files)")
    s = sub.add_parser("stream", help="process files as they arrive")
    s.add_argument("--landing", required=True)
    s.add_argument("--warehouse", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--every", default=None, help="processing-time trigger; default: available now")
    s.add_argument("--max-files", type=int, default=10)
    s.add_argument("--descriptors", default=None, help="descriptor root (default: the landing)")
    m = sub.add_parser("import-dims", help="append old text dictionaries <root>/<dc>/{user,page}/*")
    m.add_argument("--legacy", required=True)
    m.add_argument("--warehouse", required=True)
    args = parser.parse_args(argv)

    spark = build_session()
    if args.command == "batch":
        from .plans.batch import run_batch
        batch_id = args.batch_id if args.batch_id is not None else int(time.time() * 1000)
        res = run_batch(spark, args.landing, args.warehouse, batch_id, text=not args.no_text,
                        partitioned=args.partitioned, descriptor_root=args.descriptors,
                        cluster_output=args.cluster_output)
        print(json.dumps(res.__dict__))
    elif args.command == "import-dims":
        from .plans.batch import import_legacy_dims
        print(json.dumps(import_legacy_dims(spark, args.legacy, args.warehouse).__dict__))
    else:
        from .streaming.arrival import start
        q = start(spark, args.landing, args.warehouse, args.checkpoint,
                  available_now=args.every is None, processing_time=args.every,
                  max_files=args.max_files, descriptor_root=args.descriptors)
        q.awaitTermination()


if __name__ == "__main__":
    main()
