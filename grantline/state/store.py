"""State and outbox tables under one root folder.

An outbox is a folder of ``run_id=.../step=...`` folders, which passes write and do not read. A
step writes its folder in overwrite mode, so a repeated run replaces what an interrupted
one left behind. Keyed tables, which later passes look into, are :class:`KeySet` tiers.
A run never reads its own rows of an earlier attempt. Runs follow one another: one writer
at a time.

Rows of dry runs are marked in every table and count as state only where that is asked for.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantline import schemas
from grantline.operators.sequence import KEY
from grantline.settings import HOUR_MS, Settings
from grantline.state import journal as j
from grantline.state.tiers import KEYS_A_BLOCK, Carried, KeySet, maybe_in, sketch

_URNS = T.StructType(
    [T.StructField("urn", T.StringType()), T.StructField("dry_run", T.BooleanType())]
)
#: ``newest_ms`` is the latest clock in a snapshot; null where it was written without a calendar.
_SNAPSHOTS = T.StructType(
    [
        T.StructField("gen", T.IntegerType()),
        T.StructField("blocks", T.LongType()),
        T.StructField("newest_ms", T.LongType()),
    ]
)
#: Active grants with an end, by the hour of it; ``last`` if dry runs changed nothing since.
_CALENDAR = T.StructType(
    [
        *schemas.JOURNAL.fields,
        T.StructField("last", T.BooleanType()),
        T.StructField("due_hour", T.LongType()),
    ]
)
_DRY_RUN = T.StructField("dry_run", T.BooleanType())
#: What every file system takes as a folder name.
_RUN_ID = "[A-Za-z0-9_.-]+"
_RUN = [T.StructField("run_id", T.StringType()), T.StructField("step", T.StringType())]


def _marked(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, _DRY_RUN])


TABLES: dict[str, T.StructType] = {
    "statements": schemas.STATEMENTS,
    "notifications": _marked(schemas.NOTIFICATIONS),
    "metrics": schemas.METRICS,
    "snapshots": _SNAPSHOTS,
}
#: Tables that later passes look into: their columns and their key.
KEYED: dict[str, tuple[T.StructType, list[str]]] = {
    "sla_notifications": (
        _marked(schemas.SLA_NOTIFICATIONS), ["action_request_urn", "notification_type"]
    ),
    "provisioning_errors": (_marked(schemas.PROVISIONING_ERRORS), ["action_request_urn"]),
    "quarantine": (_marked(schemas.QUARANTINE), ["urn", "reason", "detail"]),
    "denials": (_marked(schemas.DENIALS), ["urn"]),
}


@dataclass(frozen=True)
class State:
    """What earlier runs left: the input of every pass."""

    journal: DataFrame
    granted_urns: DataFrame
    sla_notifications: DataFrame
    provisioning_errors: DataFrame

    @property
    def grants(self) -> DataFrame:
        return j.current_grants(self.journal)


class StateStore:
    """Tables of one deployment.

    The journal has a further level ``gen=N``: compaction folds generation N into a
    snapshot and later runs write to N + 1, so a reader takes one snapshot and the
    journal folders of one generation, however long the history is. A snapshot has a calendar:
    its active grants in folders by the hour they end, so that an expiry pass opens what is over.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.open_units = Carried(spark, self.path("open_units"), schemas.OPEN_UNITS)
        self._key_sets: dict[str, KeySet] = {}
        self._ready = False
        self._generation: int | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def ensure(self) -> StateStore:
        """Create the tables that do not exist yet, empty."""
        if self._ready:
            return self
        folders = {self.path(table): schema for table, schema in TABLES.items()}
        folders[f"{self.path('journal')}/gen=0"] = schemas.JOURNAL
        for folder, schema in folders.items():
            rows = self.spark.createDataFrame([], schema)
            rows = rows.drop("run_id") if "run_id" in rows.columns else rows
            rows.write.mode("ignore").parquet(f"{folder}/run_id=none/step=none")
        self._ready = True
        return self

    def generation(self) -> int:
        """Number of snapshots taken; one row is read."""
        row = self.read("snapshots").agg(F.max("gen").alias("gen")).first()
        return (row and row["gen"]) or 0

    def _key_set(self, table: str) -> KeySet:
        if table not in self._key_sets:
            self._key_sets[table] = KeySet(self.spark, self.path(table), *KEYED[table])
        return self._key_sets[table]

    def write(
        self, table: str, rows: DataFrame, run_id: str, step: str, dry_run: bool = False
    ) -> DataFrame:
        """Write one step of a run and return it as read back, its lineage cut."""
        if not re.fullmatch(_RUN_ID, run_id):
            raise ValueError(f"a run id is a folder name of {_RUN_ID}, not {run_id!r}")
        schema = KEYED[table][0] if table in KEYED else TABLES.get(table)
        if schema and "dry_run" in schema.names and "dry_run" not in rows.columns:
            rows = rows.withColumn("dry_run", F.lit(dry_run))
        if table in KEYED:
            added = self._key_set(table).add(rows, run_id, step)
            return added.select(*KEYED[table][0].names)
        folder = self.path(table)
        if table == "journal":
            if self._generation is None:
                self._generation = self.generation()
            folder = f"{folder}/gen={self._generation}"
        target = f"{folder}/run_id={run_id}/step={step}"
        kept = rows.drop("run_id") if "run_id" in rows.columns else rows
        kept.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(kept.schema).parquet(target)

    def read(self, table: str) -> DataFrame:
        """All rows of a table, those of dry runs too, with ``run_id`` and ``step``."""
        if table in KEYED:
            return self._key_set(table).read()
        schema = T.StructType([*TABLES[table].fields, *_RUN])
        return self.spark.read.schema(schema).parquet(self.path(table))

    def fold(self, run_id: str | None = None) -> None:
        """Fold the keyed tables where a tier is full; reads a manifest each otherwise."""
        for table in KEYED:
            self._key_set(table).fold(run_id)

    def import_state(
        self,
        grants: DataFrame,
        sla_notifications: DataFrame,
        provisioning_errors: DataFrame,
        run_id: str = "import",
    ) -> None:
        """Take over existing state tables as the state before the first run."""
        self.write("journal", j.journal_of(grants, run_id), run_id, "import")
        self.write("sla_notifications", sla_notifications, run_id, "import")
        self.write("provisioning_errors", provisioning_errors, run_id, "import")

    def _journal(self, run_id: str | None, gen: int) -> DataFrame:
        fields = [f for f in schemas.JOURNAL.fields if f.name != "run_id"]
        schema = T.StructType([*fields, *_RUN])
        # By path, not by a filter: older generations are not even listed.
        rows = self.spark.read.schema(schema).parquet(f"{self.path('journal')}/gen={gen}")
        return _others(rows, run_id).select(*schemas.JOURNAL.names)

    def _snapshot(self, part: str, gen: int, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path(part)}/gen={gen}")

    def _all_changes(self, run_id: str | None, gen: int) -> tuple[DataFrame, DataFrame]:
        """Journal rows and granted URNs, each a snapshot plus what came since."""
        journal = self._journal(run_id, gen)
        urns = journal.select("urn", "dry_run")
        if gen:
            rows = self._snapshot("snapshot_rows", gen, schemas.JOURNAL)
            journal = rows.unionByName(journal)
            urns = self._snapshot("snapshot_urns", gen, _URNS).unionByName(urns)
        return journal, urns

    def state(self, run_id: str | None = None, include_dry: bool = False) -> State:
        """State as ``run_id`` finds it: nothing of its own earlier attempts."""
        self._generation = self.generation()
        journal, urns = self._all_changes(run_id, self._generation)
        return State(
            journal=j.in_force(journal, include_dry),
            granted_urns=j.in_force(urns, include_dry).select("urn"),
            sla_notifications=self.earlier("sla_notifications", run_id, include_dry),
            provisioning_errors=self.earlier("provisioning_errors", run_id, include_dry),
        )

    def due_rows(self, settings: Settings, run_id: str | None, *fresh: DataFrame) -> DataFrame:
        """Journal rows that tell which grants are over at the clock: the hours of the calendar up
        to it, and what changed since the snapshot. ``fresh`` are journal rows of this run.

        A change recorded after the snapshot may have been planned before it; for the keys of
        such changes the snapshot is read as well.
        """
        include_dry = settings.count_dry_runs
        row = self.read("snapshots").agg(F.max_by(F.struct("gen", "newest_ms"), "gen").alias("s")).first()
        gen, newest = (row["s"]["gen"], row["s"]["newest_ms"]) if row["s"] else (0, None)
        earlier = j.in_force(self._journal(run_id, gen), include_dry)
        since = reduce(DataFrame.unionByName, fresh, earlier)
        if not gen:
            return since
        folded = j.in_force(self._snapshot("snapshot_rows", gen, schemas.JOURNAL), include_dry)
        if newest is None:
            return folded.unionByName(since)
        calendar = self._snapshot("calendar", gen, _CALENDAR)
        over = calendar.where(F.col("due_hour") <= settings.as_of_ms // HOUR_MS)
        over = over.where("last") if include_dry else j.in_force(over)
        rows = over.select(*schemas.JOURNAL.names).unionByName(since)
        behind = since.where(F.unix_millis("at") <= newest).select(*KEY).distinct()
        if behind.isEmpty():
            return rows
        same = reduce(Column.__and__, [folded[c].eqNullSafe(behind[c]) for c in KEY])
        return rows.unionByName(folded.join(behind, same, "left_semi"))

    def earlier(self, table: str, run_id: str | None, include_dry: bool = False) -> DataFrame:
        """Rows of a keyed table that other runs wrote."""
        return _counted(self._key_set(table).read(run_id), include_dry)

    def matching(
        self,
        table: str,
        wanted: DataFrame,
        key: str,
        run_id: str | None,
        include_dry: bool = False,
    ) -> DataFrame:
        """The same for the keys of a small batch; parts that a sketch rules out are not opened."""
        return _counted(self._key_set(table).matching(wanted, key, run_id), include_dry)

    def granted_among(
        self, wanted: DataFrame, run_id: str | None, include_dry: bool = False
    ) -> DataFrame:
        """Those URNs of a small batch that were granted before; the snapshot is opened only if its
        sketch lets one through."""
        asked = wanted.select("urn").distinct()
        row = self.read("snapshots").agg(F.max_by(F.struct("gen", "blocks"), "gen").alias("s")).first()
        gen, blocks = (row["s"]["gen"], row["s"]["blocks"]) if row["s"] else (0, None)
        found = self._journal(run_id, gen).select("urn", "dry_run")
        if gen:
            sketched = self.spark.read.parquet(f"{self.path('snapshot_sketch')}/gen={gen}")
            if not maybe_in(asked, "urn", sketched, blocks).isEmpty():
                found = found.unionByName(self._snapshot("snapshot_urns", gen, _URNS))
        return j.in_force(found, include_dry).join(asked, "urn", "left_semi").select("urn")

    def compact(self) -> None:
        """Fold the journal into a snapshot: latest row per key, and the granted URNs.

        Both go to folders of their own; readers move to them with the last, small
        write. A run that is folded in must not be repeated afterwards.
        """
        gen = self.generation()
        journal, urns = self._all_changes(None, gen)
        j.latest_rows(journal, ["dry_run"]).write.mode("overwrite").parquet(
            f"{self.path('snapshot_rows')}/gen={gen + 1}"
        )
        rows = self._snapshot("snapshot_rows", gen + 1, schemas.JOURNAL)
        newest = rows.agg(F.max(F.unix_millis("at")).alias("newest")).first()["newest"]
        j.calendar(rows).repartitionByRange("due_hour", F.xxhash64(*KEY)).write.mode(
            "overwrite"
        ).partitionBy("due_hour").parquet(f"{self.path('calendar')}/gen={gen + 1}")
        urns.distinct().write.mode("overwrite").parquet(
            f"{self.path('snapshot_urns')}/gen={gen + 1}"
        )
        folded = self._snapshot("snapshot_urns", gen + 1, _URNS)
        blocks = max(1, -(-folded.count() // KEYS_A_BLOCK))
        sketch(folded.where("urn IS NOT NULL"), "urn", blocks).write.mode("overwrite").parquet(
            f"{self.path('snapshot_sketch')}/gen={gen + 1}"
        )
        fresh = self.spark.createDataFrame([], schemas.JOURNAL).drop("run_id")
        fresh.write.mode("overwrite").parquet(
            f"{self.path('journal')}/gen={gen + 1}/run_id=none/step=none"
        )
        self._generation = None
        marker = self.spark.range(1).select(
            F.lit(gen + 1).alias("gen"),
            F.lit(blocks).cast("long").alias("blocks"),
            # An empty snapshot has no clock; any will do, as nothing of it can be newer.
            F.lit(newest or 0).cast("long").alias("newest_ms"),
        )
        self.write("snapshots", marker, f"snapshot-{gen + 1:06d}", "compact")

    def drop_folded(self) -> None:
        """Remove journal folders and snapshots of generations before the current one.

        To be called when no reader of an older generation is left.
        """
        current = self.generation()
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        configuration = self.spark._jsc.hadoopConfiguration()
        for table in ("journal", "snapshot_rows", "snapshot_urns", "snapshot_sketch", "calendar"):
            folder = hadoop(self.path(table))
            files = folder.getFileSystem(configuration)
            for entry in files.listStatus(folder) if files.exists(folder) else ():
                name = entry.getPath().getName()
                if name.startswith("gen=") and int(name.removeprefix("gen=")) < current:
                    files.delete(entry.getPath(), True)


def _counted(rows: DataFrame, include_dry: bool) -> DataFrame:
    return j.in_force(rows, include_dry).drop("dry_run", "run_id", "step")


def _others(rows: DataFrame, run_id: str | None) -> DataFrame:
    return rows if run_id is None else rows.filter(F.col("run_id") != run_id)


def state_ddl(settings: Settings) -> list[str]:
    """``CREATE TABLE`` statements for catalogs that manage the state tables."""
    tables = [
        (settings.state.qualified_grants_table, schemas.GRANTS),
        (settings.state.qualified_sla_table, schemas.SLA_NOTIFICATIONS),
        (settings.state.qualified_errors_table, schemas.PROVISIONING_ERRORS),
    ]
    return [
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet"
        for name, schema in tables
    ]
