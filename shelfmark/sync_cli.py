"""python -m shelfmark.sync_cli RECEIVER CATALOG [--parser-name NAME] [--batch-size N] [--max-batches N] [--backfill]: one sync run."""

from __future__ import annotations

import argparse
import json

from shelfmark.functions.values import safe_reference
from shelfmark.operators.store import Store
from shelfmark.session import session
from shelfmark.sinks.database import mirror
from shelfmark.streaming.sync import SyncJob, run


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("receiver")
    p.add_argument("catalog")
    p.add_argument("--parser-name")
    p.add_argument("--batch-size", type=int, default=2000)
    p.add_argument("--max-batches", type=int, default=0)
    p.add_argument("--backfill", action="store_true")
    return p


def main() -> None:
    p = arguments()
    p.add_argument("--mirror", help="a SQLite file that gets the catalogue's tables afterwards")
    a, spark = p.parse_args(), session()
    out = run(spark, SyncJob(a.receiver, a.catalog, a.parser_name, a.batch_size, a.max_batches, a.backfill), lambda e: print(json.dumps(e, default=str), flush=True))
    if a.mirror:
        out["mirrored"] = mirror(Store(spark, a.catalog), a.mirror)
    print(json.dumps({"receiver": safe_reference(a.receiver), **out}))


if __name__ == "__main__":
    main()
