"""python -m shelfmark.daemon_cli RECEIVER CATALOG [--parser-name NAME|all] [--poll-interval S] [--cycles N]: polls until stopped.

A cycle that fails is counted and the next one tries again; with "all" the parsers take turns. After each cycle that
succeeds a bounded part of the delete outbox is drained, if the environment describes a storage (operators/outbox.py).
"""

from __future__ import annotations

import itertools
import json
import signal
import threading
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from shelfmark.operators.outbox import StorageClient
from shelfmark.operators.store import Store
from shelfmark.plans.titles import default_registry
from shelfmark.session import session
from shelfmark.streaming.sync import SyncJob, drain_outbox, run
from shelfmark.sync_cli import arguments


def clock() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


@dataclass
class Metrics:
    running: bool = False
    started_at: str | None = None
    poll_interval: float = 5.0
    parsers: list = field(default_factory=list)
    cycles: int = 0
    succeeded: int = 0
    failed: int = 0
    batches: int = 0
    records: int = 0
    outbox_processed: int = 0
    outbox_deleted: int = 0
    outbox_failed: int = 0
    last_cycle_at: str | None = None
    last_success_at: str | None = None
    last_error: str | None = None
    last_seconds: float = 0.0
    by_parser: dict = field(default_factory=dict)


def poll(work: Callable[[str | None], dict], parsers: list[str | None], interval: float = 5.0, cycles: int = 0, after: Callable[[], dict | None] | None = None, stop: threading.Event | None = None, metrics: Metrics | None = None, sleep: Callable[[float], object] | None = None) -> Metrics:
    """Runs work(parser) in turn until `cycles` are done or `stop` is set; after() follows each cycle that succeeds (the outbox drain),
    and its failure is not the cycle's."""
    m, stop = metrics or Metrics(), stop or threading.Event()
    m.running, m.started_at, m.poll_interval, m.parsers = True, clock(), max(0.1, interval), list(parsers)
    while not stop.is_set() and (not cycles or m.cycles < cycles):
        parser, began = parsers[m.cycles % len(parsers)], time.monotonic()
        m.cycles, m.last_cycle_at = m.cycles + 1, clock()
        try:
            out = work(parser)
            m.succeeded, m.batches, m.records, m.last_success_at = m.succeeded + 1, m.batches + out.get("batches", 0), m.records + out.get("records", 0), clock()
            m.by_parser[parser or "*"] = m.by_parser.get(parser or "*", 0) + out.get("records", 0)
        except Exception as e:  # noqa: BLE001  a cycle's failure must not end the daemon
            m.failed, m.last_error = m.failed + 1, f"{type(e).__name__}: {e}"
        else:
            try:
                done = (after() if after else None) or {}
                m.outbox_processed, m.outbox_deleted, m.outbox_failed = m.outbox_processed + done.get("processed", 0), m.outbox_deleted + done.get("deleted", 0), m.outbox_failed + done.get("failed", 0)
            except Exception as e:  # noqa: BLE001
                m.last_error = f"outbox: {type(e).__name__}: {e}"
        m.last_seconds = time.monotonic() - began
        (sleep or stop.wait)(m.poll_interval)
    m.running = False
    return m


class Daemon:
    """poll() in a thread of its own."""

    def __init__(self, work: Callable[[str | None], dict], parsers: list[str | None], interval: float = 5.0, after: Callable[[], dict | None] | None = None):
        self.metrics, self._stop = Metrics(), threading.Event()
        self._thread = threading.Thread(target=poll, args=(work, parsers, interval, 0, after, self._stop, self.metrics), daemon=True)

    def start(self) -> None:
        self._thread.start()

    def stop(self, timeout: float = 10.0) -> None:
        self._stop.set()
        self._thread.join(timeout)

    def snapshot(self) -> dict:
        return asdict(self.metrics)


def upkeep(drain: Callable[[], dict] | None, store: Store, every: int) -> Callable[[], dict]:
    """What follows a cycle: the outbox drain, and after each `every` cycles a sweep of the store. No commit is under way then."""
    cycles = itertools.count(1)

    def after() -> dict:
        done = drain() if drain else {}
        if every and next(cycles) % every == 0:
            store.vacuum()
        return done

    return after


def main() -> None:
    p = arguments()
    p.add_argument("--poll-interval", type=float, default=5.0)
    p.add_argument("--cycles", type=int, default=0)
    p.add_argument("--outbox-limit", type=int, default=200)
    p.add_argument("--vacuum-every", type=int, default=100, help="cycles between two sweeps of replaced files; 0: never")
    a = p.parse_args()
    spark, stop = session(), threading.Event()
    for name in (signal.SIGINT, signal.SIGTERM):
        signal.signal(name, lambda *_: stop.set())
    parsers = default_registry().names() if a.parser_name == "all" else [a.parser_name]
    client = StorageClient.from_env()
    drain = (lambda: drain_outbox(Store(spark, a.catalog), client, client.base, a.outbox_limit)) if client else None
    work = upkeep(drain, Store(spark, a.catalog), a.vacuum_every)
    m = poll(lambda parser: run(spark, SyncJob(a.receiver, a.catalog, parser, a.batch_size, a.max_batches, a.backfill)), parsers, a.poll_interval, a.cycles, work, stop)
    print(json.dumps(asdict(m)))


if __name__ == "__main__":
    main()
