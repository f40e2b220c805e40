"""A Parquet table with keyed upsert.

Rows live in files by hash bucket of their key. An upsert writes new files for the buckets its batch touches and then
appends one small file to the manifest, which is the commit: readers see the old files before it and the new ones
after it. Buckets without batch keys are neither read nor rewritten, and within a bucket a small batch rewrites only
the files that hold one of its keys, which their Bloom filters, dictionaries and key ranges tell. There must be one
writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "key_bucket"
_NO_KEY = -1
_MANIFEST = "version bigint, bucket int, path string, replaces string, schema string, buckets int, commit_id string"
_ENTRIES = f"array<struct<{_MANIFEST}>>"
#: Keys that are looked for in the stored files by value; of a larger batch all files of its buckets are rewritten.
FEW_KEYS = 1000
#: Files of a bucket from which on an upsert that touches it puts them together again.
CROWDED = 32


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns followed by new ones; a column must keep its type."""
    types = {f.name: f.dataType for f in old}
    changed = [f.name for f in new if f.name in types and types[f.name] != f.dataType]
    if changed:
        raise ValueError(f"columns changed their type: {', '.join(changed)}")
    added = [T.StructField(f.name, f.dataType, True) for f in new if f.name not in types]
    return T.StructType([*old.fields, *added])


@dataclass
class _State:
    """What the manifest says about the table now."""

    version: int = 0
    folders: dict[int, list[str]] = field(default_factory=dict)
    schema: T.StructType = field(default_factory=T.StructType)
    buckets: int | None = None
    commit_ids: set[str] = field(default_factory=set)

    def apply(self, changes: list) -> None:
        """Apply the manifest rows of one commit: first what it removes, then what it adds."""
        if any(row["replaces"] == "table" for row in changes):
            self.folders = {}
        for row in changes:
            if row["replaces"] == "bucket":
                self.folders.pop(row["bucket"], None)
        gone = {row["path"] for row in changes if row["replaces"] == "file"}
        for bucket in {row["bucket"] for row in changes if row["replaces"] == "file"}:
            self.folders[bucket] = [p for p in self.folders.get(bucket, []) if p not in gone]
        for row in changes:
            if row["path"] is not None and row["replaces"] != "file":
                self.folders.setdefault(row["bucket"], []).append(row["path"])
        latest = changes[-1]
        self.version = latest["version"]
        self.schema = next(T.StructType.fromJson(json.loads(r["schema"])) for r in changes if r["schema"])
        self.buckets = latest["buckets"]
        self.commit_ids.update(row["commit_id"] for row in changes)

    def paths(self) -> list[str]:
        return [path for paths in self.folders.values() for path in paths]


class KeyedTable:
    """A table below ``path``, replaced key by key. ``key=None`` means every write replaces it all.

    ``buckets`` counts only when the table is created; an existing table keeps its number.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | None, buckets: int = 256):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.buckets = buckets

    def _state(self) -> _State:
        """Read the manifest; its size grows with commits and buckets, not with the data."""
        state = _State()
        try:
            rows = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return state
        for _, changes in groupby(sorted(rows, key=lambda r: r["version"]), key=lambda r: r["version"]):
            state.apply(list(changes))
        self.buckets = state.buckets or self.buckets
        return state

    def _load(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = [f"{self.path}/{p}" for p in paths]
        return self.spark.read.schema(schema).parquet(*full)

    def exists(self) -> bool:
        return self._state().version > 0

    def read_if_exists(self) -> DataFrame | None:
        """The current rows, or None before the first write; the manifest is read once."""
        state = self._state()
        return self._load(state.paths(), state.schema) if state.version else None

    def parts(self) -> tuple[list[str], T.StructType]:
        """The files that hold the current rows, below ``path``, and their schema. A file never changes."""
        state = self._state()
        return state.paths(), state.schema

    def read_parts(self, parts: list[str], schema: T.StructType) -> DataFrame:
        """The rows of some files, with the file's name as ``part``."""
        name = F.regexp_extract("_metadata.file_path", rf"(data/run-[^/]+/[^/]+/{_BUCKET}=-?[0-9]+/[^/]+)$", 1)
        return self._load(parts, schema).select("*", name.alias("part")) if parts else self._load(
            parts, T.StructType([*schema.fields, T.StructField("part", T.StringType())])
        )

    def read(self) -> DataFrame:
        """The current rows."""
        state = self._state()
        return self._load(state.paths(), state.schema)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        if self.key not in df.columns:
            return df.withColumn(_BUCKET, F.lit(_NO_KEY))
        hashed = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        return df.withColumn(_BUCKET, F.when(F.col(self.key).isNotNull(), hashed).otherwise(F.lit(_NO_KEY)))

    def _files(self, pattern: str) -> list[str]:
        """Files below the table's path."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place)
        depth = pattern.count("/") + 1
        return sorted("/".join(f.getPath().toString().split("/")[-depth:]) for f in found or [])

    def _write(self, df: DataFrame, folder: str, rebalance: bool = True) -> dict[int, list[str]]:
        """Write the rows by bucket and return the files of each bucket that has rows."""
        rows, options = self._bucketed(df), {}
        if rebalance:
            # Rebalancing splits a bucket that a hot key fills, and joins small ones.
            rows = rows.hint("rebalance", _BUCKET)
        if self.key in df.columns:
            options = {f"parquet.bloom.filter.enabled#{self.key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        # Writing needs the rows in bucket order anyway; in key order too, readers can skip row groups by key.
        order = [c for c in (_BUCKET, self.key) if c == _BUCKET or c in df.columns]
        rows.sortWithinPartitions(*order).write.options(**options).partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        files: dict[int, list[str]] = {}
        for path in self._files(f"{folder}/{_BUCKET}=*/*.parquet"):
            files.setdefault(int(path.split(f"{_BUCKET}=")[1].split("/")[0]), []).append(path)
        return files

    def _commit(
        self, version: int, entries: list[tuple], schema: T.StructType, commit_id: str | None = None,
        earlier_ids: Sequence[str] = (),
    ) -> None:
        shared = {"version": version, "buckets": self.buckets, "commit_id": commit_id}
        rows = [
            {**shared, "bucket": bucket, "path": path, "replaces": replaces}
            for bucket, path, replaces in entries
        ]
        rows += [{**shared, "bucket": _NO_KEY, "replaces": "nothing", "commit_id": i} for i in earlier_ids]
        # The schema is long and the same for all rows of a commit, so one of them carries it.
        rows[:1] = [{**row, "schema": schema.json()} for row in rows[:1]]
        listed = F.inline(F.from_json(F.lit(json.dumps(rows)), _ENTRIES))
        self.spark.range(1, numPartitions=1).select(listed).write.mode("append").json(f"{self.path}/manifest")

    def upsert(self, batch: DataFrame, commit_id: str | None = None) -> None:
        """Replace all rows of the keys in ``batch`` by the rows of ``batch``.

        Duplicate keys within the batch are all kept. Rows without a key are appended and replace
        nothing. New columns are null in older rows. A batch whose ``commit_id`` is already in the
        manifest is not written again.
        """
        state = self._state()
        if commit_id is not None and commit_id in state.commit_ids:
            return
        if self.key not in batch.columns:
            self.replace_all(batch, commit_id)
            return
        schema = _merged(state.schema, batch.schema)
        run = f"data/run-{uuid.uuid4().hex}"
        seen = Observation()
        new = self._write(batch.observe(seen, F.approx_count_distinct(self.key).alias("keys")), f"{run}/new")
        entries = [(b, path, "nothing") for b, paths in new.items() for path in paths]
        touched = {b: state.folders[b] for b in new if b != _NO_KEY and state.folders.get(b)}
        if touched:
            keyed = [path for b, paths in new.items() if b != _NO_KEY for path in paths]
            keys = self._load(keyed, batch.schema).select(self.key).distinct()
            # The estimate, which costs no pass, saves listing the keys of a batch that has far too many.
            entries += self._rewritten(touched, keys, seen.get["keys"] <= 2 * FEW_KEYS, state, run)
        self._commit(state.version + 1, entries, schema, commit_id)

    def _rewritten(
        self, touched: dict[int, list[str]], keys: DataFrame, maybe_few: bool, state: _State, run: str
    ) -> list[tuple]:
        """Write what stays of the buckets' files that hold one of the keys; the manifest entries of that."""
        listed = [r[0] for r in keys.limit(FEW_KEYS + 1).collect()] if maybe_few else []
        few = maybe_few and len(listed) <= FEW_KEYS
        asked = F.col(self.key).isin(listed)
        crowded = {b for b, paths in touched.items() if len(paths) > CROWDED}
        every = [path for paths in touched.values() for path in paths]
        stored = self.read_parts(every, state.schema)
        # Of many keys, the table's key column alone is compared first; files without any of them stay.
        named = stored.where(asked) if few else stored.select(self.key, "part").distinct().join(keys, self.key, "left_semi")
        found = {r["part"] for r in named.select("part").distinct().collect()}
        touched = {b: paths if b in crowded else [p for p in paths if p in found] for b, paths in touched.items()}
        files = [path for paths in touched.values() for path in paths]
        if not files:
            return []
        stored = self._load(files, state.schema)
        # Few keys are compared where the rows are read, and the rows stay in the tasks that read them.
        kept = stored.where(~asked) if few else stored.join(keys, self.key, "left_anti")
        written = self._write(kept, f"{run}/kept", rebalance=not few or bool(crowded))
        return [(b, path, "nothing") for b, paths in written.items() for path in paths] + [
            (b, path, "file") for b, paths in touched.items() for path in paths
        ]

    def upsert_runs(self, batch: DataFrame, run: str, commit_id: str | None = None) -> None:
        """Keep, for each key, the rows of its latest run among the table's and the batch's rows.

        ``run`` is a column whose order is that of the runs. Rows of one run may come in any number of batches and
        in any order of batches. Rows without a key are appended.
        """
        state = self._state()
        if commit_id is not None and commit_id in state.commit_ids:
            return
        schema = _merged(state.schema, batch.schema)
        folder = f"data/run-{uuid.uuid4().hex}"
        new = self._write(batch, f"{folder}/new")
        entries = [(b, path, "nothing") for b, paths in new.items() if b == _NO_KEY for path in paths]
        keyed = [path for b, paths in new.items() if b != _NO_KEY for path in paths]
        older = [path for b in new if b != _NO_KEY for path in state.folders.get(b, [])]
        if keyed:
            rows = self._load([*older, *keyed], schema)
            latest = rows.groupBy(self.key).agg(F.max(run).alias("_latest"))
            current = rows.join(latest, self.key).where(F.col(run).eqNullSafe(F.col("_latest"))).drop("_latest")
            kept = self._write(current.select(*schema.names), f"{folder}/current")
            entries += [(b, path, "bucket") for b, paths in kept.items() for path in paths]
        self._commit(state.version + 1, entries, schema, commit_id)

    def replace_all(self, df: DataFrame, commit_id: str | None = None) -> None:
        """Replace the whole table."""
        version = self._state().version
        run = f"data/run-{uuid.uuid4().hex}"
        entries = [(b, path, "table") for b, paths in self._write(df, f"{run}/all").items() for path in paths]
        self._commit(version + 1, entries or [(_NO_KEY, None, "table")], df.schema, commit_id)

    def vacuum(self) -> int:
        """Write the manifest anew as one commit and delete what it no longer names; the number of files deleted.

        The table's rows and the known commit ids stay. Readers and writers of earlier states must be done.
        """
        state = self._state()
        if not state.version:
            return 0
        known = self._files("manifest/*.json")
        entries = [(b, path, "table") for b, paths in state.folders.items() for path in paths]
        entries = entries or [(_NO_KEY, None, "table")]
        self._commit(state.version + 1, entries, state.schema, None, sorted(filter(None, state.commit_ids)))
        current = set(state.paths())
        stale = known + [f for f in self._files("data/*/*/*/*.parquet") if f not in current]
        files = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = files.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for path in stale:
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}"), False)
        return len(stale)
