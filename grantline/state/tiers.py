"""Key sets that grow run by run: sorted parts in tiers, named by a manifest.

A part is a folder that one step of a run wrote. ``FAN`` parts of one tier are folded into one
part of the next: one row per key, the first entry stays, sorted by key. So a set has at most
``FAN`` parts a tier, each row is rewritten once a tier, and a reader opens the files of the parts
that the manifest names, however many runs there were. Parts of the two newest runs are not
folded, so that a run can be repeated.

The manifest is a small file per version. A change writes the next version; readers take the
newest. Folders that a fold replaced are removed with the change after it, when no reader
of the old manifest is left: runs follow one another.

A folded part has a sketch: one row of 256 bits per block of keys. A key sets eight bits of
the block that its hash names. A batch of keys that a sketch rules out is not looked up in
the part; what it lets through is confirmed there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of one tier that are folded together.
FAN = 8
#: Keys per block of a sketch; 256 bits for 20 keys let about one of 300 others through.
KEYS_A_BLOCK = 20
_WORDS, _BITS = 4, 8
_SKETCH = T.StructType(
    [T.StructField("block", T.LongType())]
    + [T.StructField(f"w{i}", T.LongType()) for i in range(_WORDS)]
)


class Files:
    """Small files and folders of the file system that holds a path."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._system.exists(path):
            return []
        return sorted(e.getPath().getName() for e in self._system.listStatus(path))

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """All of a file or nothing: written beside its place, then renamed."""
        beside = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self._system.create(self._path(beside), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._system.rename(self._path(beside), self._path(path)):
            raise OSError(f"can't name {path}")

    def remove(self, path: str) -> None:
        self._system.delete(self._path(path), True)


class Manifest:
    """Versions of a small record under one folder."""

    def __init__(self, files: Files, folder: str):
        self.files, self.folder = files, folder

    def _versions(self) -> list[int]:
        names = self.files.names(self.folder)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def read(self) -> dict:
        versions = self._versions()
        if not versions:
            return {"parts": [], "replaced": []}
        return json.loads(self.files.read(f"{self.folder}/{versions[-1]:012d}.json"))

    def write(self, record: dict) -> None:
        versions = self._versions()
        number = versions[-1] + 1 if versions else 0
        self.files.write(f"{self.folder}/{number:012d}.json", json.dumps(record))
        for old in versions[:-1]:
            self.files.remove(f"{self.folder}/{old:012d}.json")


def _nothing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, and known to the optimizer to be none: joins with it cost nothing."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*columns).where(F.lit(False))


def _mask(key: Column, word: int) -> Column:
    """The bits of a key that fall into one word of its block."""
    bits = F.xxhash64(key, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(_BITS):
        place = F.shiftrightunsigned(bits, 8 * i).bitwiseAND(F.lit(255))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        mask = mask.bitwiseOR(F.when(F.floor(place / 64) == word, bit).otherwise(F.lit(0).cast("long")))
    return mask


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def sketch(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row per block that holds a key. An aggregate: partial sketches meet in a shuffle."""
    words = {f"w{i}": _mask(F.col(key), i) for i in range(_WORDS)}
    marked = keys.select(_block(F.col(key), blocks).alias("block"), *[c.alias(n) for n, c in words.items()])
    return marked.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in words])


def maybe_in(keys: DataFrame, key: str, sketched: DataFrame, blocks: int) -> DataFrame:
    """Keys that the sketch can't rule out."""
    asked = keys.select(key, _block(F.col(key), blocks).alias("block"))
    met = asked.join(sketched, "block")
    for i in range(_WORDS):
        mask = _mask(F.col(key), i)
        met = met.where(F.col(f"w{i}").bitwiseAND(mask) == mask)
    return met.select(key)


class KeySet:
    """One table of keyed rows, with the run and step that wrote each."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]):
        self.spark, self.folder, self.keys = spark, folder, list(keys)
        self.files = Files(spark, folder)
        self.manifest = Manifest(self.files, f"{folder}/manifest")
        self.schema = T.StructType(
            [*schema.fields, T.StructField("run_id", T.StringType()), T.StructField("step", T.StringType())]
        )

    def add(self, rows: DataFrame, run_id: str, step: str) -> DataFrame:
        """Write the rows of one step; those of an earlier attempt are replaced."""
        path = f"parts/{run_id}-{step}-{uuid.uuid4().hex}"
        marked = rows.withColumn("run_id", F.lit(run_id)).withColumn("step", F.lit(step))
        marked.select(*self.schema.names).write.parquet(f"{self.folder}/{path}")
        record = self.manifest.read()
        if any(run_id in p["runs"] and p["tier"] for p in record["parts"]):
            raise ValueError(f"run {run_id} is folded in and can't be repeated")
        same = [p for p in record["parts"] if p["runs"] == [run_id] and p["step"] == step]
        parts = [p for p in record["parts"] if p not in same]
        parts.append({"path": path, "tier": 0, "runs": [run_id], "step": step})
        self._change(parts, record["replaced"], [p["path"] for p in same])
        return self._read([path])

    def _change(self, parts: list[dict], gone: list[str], replaced: list[str]) -> None:
        self.manifest.write({"parts": parts, "replaced": replaced})
        for path in gone:
            self.files.remove(f"{self.folder}/{path}")

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return _nothing(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{p}" for p in paths])

    def _parts(self, run_id: str | None) -> list[dict]:
        """Parts that other runs wrote. Folded parts hold none of a run that can be repeated."""
        return [p for p in self.manifest.read()["parts"] if p["runs"] != [run_id]]

    def read(self, run_id: str | None = None) -> DataFrame:
        """All rows that other runs wrote."""
        return self._read([p["path"] for p in self._parts(run_id)])

    def matching(self, wanted: DataFrame, key: str, run_id: str | None = None) -> DataFrame:
        """Rows whose key is in ``wanted``, a small batch; sketches say which parts to open."""
        asked = wanted.select(F.col(key)).distinct()
        open_ = []
        for part in self._parts(run_id):
            if "blocks" in part:
                found = self.spark.read.schema(_SKETCH).parquet(f"{self.folder}/{part['sketch']}")
                if maybe_in(asked, key, found, part["blocks"]).isEmpty():
                    continue
            open_.append(part["path"])
        return self._read(open_).join(asked, key, "left_semi")

    def fold(self, run_id: str | None = None) -> bool:
        """Fold full tiers, from the lowest on; nothing of ``run_id`` or of the newest two runs."""
        folded = False
        tier = 0
        while True:
            record = self.manifest.read()
            runs = [r for p in record["parts"] if not p["tier"] for r in p["runs"]]
            fresh = {run_id, *list(dict.fromkeys(runs))[-2:]}
            old = [p for p in record["parts"] if p["tier"] == tier and not fresh & set(p["runs"])]
            if len(old) < FAN:
                if tier >= max([p["tier"] for p in record["parts"]], default=0):
                    return folded
                tier += 1
                continue
            self._fold(record, old, tier)
            folded = True

    def _fold(self, record: dict, old: list[dict], tier: int) -> None:
        rows = [self._read([p["path"]]).withColumn("part_", F.lit(i)) for i, p in enumerate(old)]
        keys = [*self.keys, "dry_run"]
        rest = [n for n in self.schema.names if n not in keys]
        first = (
            reduce(DataFrame.unionByName, rows)
            .groupBy(*keys)
            .agg(F.min_by(F.struct(*rest), F.struct("part_", *rest)).alias("row_"))
            .select(*keys, "row_.*")
            .select(*self.schema.names)
        )
        name = uuid.uuid4().hex
        path, outline = f"parts/tier-{tier + 1}-{name}", f"sketches/{name}"
        first.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys).write.parquet(
            f"{self.folder}/{path}"
        )
        written = self._read([path]).select(self.keys[0])
        blocks = max(1, -(-written.count() // KEYS_A_BLOCK))
        sketch(written.where(F.col(self.keys[0]).isNotNull()), self.keys[0], blocks).sort(
            "block"
        ).write.parquet(f"{self.folder}/{outline}")
        folded = {
            "path": path,
            "tier": tier + 1,
            # A part of many runs names only the two newest: older ones are never repeated.
            "runs": [r for p in old for r in p["runs"]][-2:],
            "step": "fold",
            "sketch": outline,
            "blocks": blocks,
        }
        at = record["parts"].index(old[0])
        parts = [p for p in record["parts"] if p not in old]
        parts.insert(at, folded)
        replaced = [p["path"] for p in old] + [p["sketch"] for p in old if "sketch" in p]
        self._change(parts, record["replaced"], replaced)


class Carried:
    """Rows that each run hands to the next one whole, such as what is still open.

    The newest two versions are kept, so that a run can be repeated: it starts from what the run
    before it left.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark, self.folder, self.schema = spark, folder, schema
        self.files = Files(spark, folder)
        self.manifest = Manifest(self.files, f"{folder}/manifest")

    def read(self, run_id: str | None = None) -> DataFrame:
        """What the newest run other than ``run_id`` left."""
        parts = [p for p in self.manifest.read()["parts"] if p["run"] != run_id]
        if not parts:
            return _nothing(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/{parts[-1]['path']}")

    def write(self, rows: DataFrame, run_id: str) -> DataFrame:
        path = f"versions/{run_id}-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(f"{self.folder}/{path}")
        record = self.manifest.read()
        others = [p for p in record["parts"] if p["run"] != run_id]
        parts = [*others[-1:], {"path": path, "run": run_id}]
        gone = [p["path"] for p in record["parts"] if p not in parts]
        self.manifest.write({"parts": parts, "replaced": gone})
        for old in record["replaced"]:
            self.files.remove(f"{self.folder}/{old}")
        return self.read()
