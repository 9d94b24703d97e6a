"""From a listing as it comes to requests that a pass can take, with what is rejected on record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.checkpoints import written
from grantline.operators.requests import flatten
from grantline.settings import Settings
from grantline.sources import requests as source
from grantline.state.store import StateStore


def quarantine_rejected(
    store: StateStore, rejected: DataFrame, run_id: str, step: str, dry_run: bool = False
) -> None:
    """Store rejected rows that no earlier run has stored; those without a URN go by their text."""
    stored = store.earlier("quarantine", run_id, dry_run)
    names = ["urn", "reason", "detail"]
    known = stored.select(*[F.col(n).alias(f"known_{n}") for n in names])
    # An equality that Spark can join on, then the texts themselves.
    same = F.xxhash64(*names) == F.xxhash64(*[f"known_{n}" for n in names])
    for name in names:
        same &= F.col(name).eqNullSafe(F.col(f"known_{name}"))
    fresh = rejected.select(*names).distinct().join(known, same, "left_anti")
    store.write("quarantine", fresh, run_id, step, dry_run)


def json_listing(store: StateStore, path: str, settings: Settings, run_id: str) -> DataFrame:
    """Flat requests of a folder of JSON lines, in listing order; the lines that break a rule
    are quarantined one by one and take no other line along."""
    lines = source.read_json_lines(store.spark, path)
    checked = written(source.checked(lines), "checked")
    quarantine_rejected(store, source.bad_rows(checked), run_id, "listing", settings.dry_run)
    return flatten(source.good_rows(checked), settings)
