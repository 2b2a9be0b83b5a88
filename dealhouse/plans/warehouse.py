"""Path-based warehouse layout on a shared file system.

``<root>/<layer>/<table>/v=<n>/`` holds full versions of replace-style and merged tables; a
version counts once what is known of it (rows, schema) is written beside its files, after
Spark's job commit, so a crashed write is never read. Readers take the newest complete version; older ones are kept for
rollback (``keep``), no version goes before it is ``retain_s`` seconds old, so that readers
which resolved an older one can finish, and none that a consumer has pinned.

A partitioned table, such as the fact, keeps ``<table>/data/_data_version=<n>/<column>=<value>/`` and names
in a manifest the version that each partition value is read from. A replace writes new
partitions beside the old ones and then puts the next manifest in place by one rename:
replaced, cleared and untouched partitions change at once, and a reader sees one manifest.

File-system calls go through Hadoop's ``FileSystem`` so the same code works on HDFS, object
stores and local disk.
"""
from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("raw", "staging", "analytics", "state")
# Written into each version folder; names starting with '_' are skipped by readers.
META_FILE = "_META"
# The folder of a partitioned table's data version; Spark reads it as a column, so no data column has this name.
VERSION = "_data_version"
# A partition column that only says where a row lies, and is not part of the table.
HIDDEN_BUCKET = "_bucket"


class ConcurrentReplace(RuntimeError):
    """Another writer put its manifest in place first; nothing of this replace is visible."""


class ReadOnlyWarehouse(PermissionError):
    pass


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, read_only: bool = False, keep: int = 2,
                 retain_s: int = 3600):
        self.spark = spark
        self.root = root.rstrip("/")
        self.read_only = read_only
        self.keep = keep
        self.retain_s = retain_s
        self.last_written_rows = 0

    # -- file system ---------------------------------------------------------
    def _path(self, p: str):
        jvm = self.spark._jvm
        jp = jvm.org.apache.hadoop.fs.Path(p)
        return jp.getFileSystem(self.spark._jsc.hadoopConfiguration()), jp

    def exists_path(self, p: str) -> bool:
        fs, jp = self._path(p)
        return bool(fs.exists(jp))

    def list_dir(self, p: str) -> list[str]:
        fs, jp = self._path(p)
        if not fs.exists(jp):
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(jp))

    def _write_text(self, p: str, text: str) -> None:
        fs, jp = self._path(p)
        out = fs.create(jp, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _read_text(self, p: str) -> str | None:
        fs, jp = self._path(p)
        if not fs.exists(jp):
            return None
        jvm = self.spark._jvm
        stream = fs.open(jp)
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put_next(self, folder: str, text: str, after: int | None = None) -> int:
        """Write ``text`` as the next numbered file of ``folder``, whole or not at all.

        With ``after``, only if that is still the newest number."""
        self._guard()
        newest = self._newest(folder)
        if after is not None and newest != after:
            raise ConcurrentReplace(f"{folder} went from {after} to {newest} meanwhile")
        fs, tmp = self._path(f"{folder}/_tmp-{uuid.uuid4().hex}")
        self._write_text(tmp.toString(), text)
        _, final = self._path(f"{folder}/n={newest + 1:09d}")
        if not fs.rename(tmp, final):
            fs.delete(tmp, False)
            raise ConcurrentReplace(f"{final.toString()} exists already")
        return newest + 1

    def _numbers(self, folder: str) -> list[int]:
        return sorted(int(f[2:]) for f in self.list_dir(folder) if f.startswith("n="))

    def _newest(self, folder: str) -> int:
        return max(self._numbers(folder), default=0)

    def _get_newest(self, folder: str) -> tuple[int, dict]:
        n = self._newest(folder)
        return n, json.loads(self._read_text(f"{folder}/n={n:09d}")) if n else {}

    def note(self, name: str, value: dict) -> None:
        """Keep a small JSON value under ``name``; the newest one counts."""
        self._put_next(f"{self.root}/_notes/{name}", json.dumps(value))

    def noted(self, name: str) -> dict:
        return self._get_newest(f"{self.root}/_notes/{name}")[1]

    def age_s(self, p: str) -> float:
        fs, jp = self._path(p)
        return time.time() - fs.getFileStatus(jp).getModificationTime() / 1000

    def delete_path(self, p: str) -> None:
        self._guard()
        fs, jp = self._path(p)
        if fs.exists(jp):
            fs.delete(jp, True)

    def move_path(self, source: str, target: str) -> None:
        self._guard()
        fs, a = self._path(source)
        _, b = self._path(target)
        if not fs.rename(a, b):
            raise OSError(f"cannot move {source} to {target}")

    def _guard(self) -> None:
        if self.read_only:
            raise ReadOnlyWarehouse(f"warehouse {self.root} is read-only")

    # -- versioned tables ----------------------------------------------------
    def table_path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def versions(self, layer: str, name: str) -> list[int]:
        """Numbers of the complete versions: of a partitioned table those of its manifests."""
        base = self.table_path(layer, name)
        if manifests := self._numbers(f"{base}/_manifests"):
            return manifests
        out = []
        for d in self.list_dir(base):
            if d.startswith("v=") and self.exists_path(f"{base}/{d}/{META_FILE}"):
                out.append(int(d[2:]))
        return sorted(out)

    def exists(self, layer: str, name: str) -> bool:
        return bool(self.versions(layer, name))

    def current_version(self, layer: str, name: str) -> int | None:
        vs = self.versions(layer, name)
        return vs[-1] if vs else None

    def meta(self, layer: str, name: str, version: int | None = None) -> dict:
        """What was written down beside a version: its rows and what the writer added."""
        v = version or self.current_version(layer, name)
        text = self._read_text(f"{self.table_path(layer, name)}/v={v:06d}/{META_FILE}") if v else None
        return json.loads(text) if text else {}

    def row_count(self, layer: str, name: str) -> int | None:
        """Rows of the current version, as observed when it was written (no job)."""
        number, manifest = self._manifest(layer, name)
        return sum(manifest["rows"].values()) if number else self.meta(layer, name).get("rows")

    def read(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        vs = self.versions(layer, name)
        if not vs or version is not None and version not in vs:
            raise FileNotFoundError(f"{layer}.{name} has no complete version {version or ''} under {self.root}")
        v = version or vs[-1]
        if self._newest(f"{self.table_path(layer, name)}/_manifests"):
            rows = self.read_parts(layer, name, version=v)
            return rows.drop(HIDDEN_BUCKET)
        # The schema as written: a partitioned table without rows has no file to tell it.
        schema = T.StructType.fromJson(self.meta(layer, name, v)["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.table_path(layer, name)}/v={v:06d}")

    def write(self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = (),
              meta: dict | None = None) -> int:
        """Write ``df`` as the next version; returns its row count (observed
        during the write, no second pass)."""
        self._guard()
        base = self.table_path(layer, name)
        existing = [int(d[2:]) for d in self.list_dir(base) if d.startswith("v=")]
        nxt = (max(existing) + 1) if existing else 1
        obs = Observation(f"{layer}.{name}.v{nxt}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").partitionBy(
            *partition_by).parquet(f"{base}/v={nxt:06d}")
        rows = int(obs.get["rows"])
        self._write_text(f"{base}/v={nxt:06d}/{META_FILE}", json.dumps(
            {**(meta or {}), "rows": rows, "schema": df.schema.jsonValue()}))
        pinned = self._pinned(f"{layer}.{name}")
        for old in self.versions(layer, name)[:-self.keep]:
            if old not in pinned and self.age_s(f"{base}/v={old:06d}") >= self.retain_s:
                self.delete_path(f"{base}/v={old:06d}")
        return rows

    def pin(self, consumer: str, versions: dict[str, int]) -> None:
        """Hold the versions, by ``layer.table``, that ``consumer`` was last built from."""
        self.note(f"pins/{consumer}", versions)

    def pins(self, consumer: str) -> dict[str, int]:
        return self.noted(f"pins/{consumer}")

    def _pinned(self, table: str) -> set[int]:
        return {self.pins(c).get(table) for c in self.list_dir(f"{self.root}/_notes/pins")}

    # -- partitioned table ---------------------------------------------------
    def _manifest(self, layer: str, name: str, version: int | None = None) -> tuple[int, dict]:
        folder = f"{self.table_path(layer, name)}/_manifests"
        if version is None:
            return self._get_newest(folder)
        return version, json.loads(self._read_text(f"{folder}/n={version:09d}"))

    def partition_versions(self, layer: str, name: str) -> dict[int, int]:
        """The data version that each partition value is read from."""
        return {int(value): v for value, v in self._manifest(layer, name)[1].get("partitions", {}).items()}

    def partition_rows(self, layer: str, name: str) -> dict[int, int]:
        """Rows per partition value, as observed when it was written (no job)."""
        return {int(value): n for value, n in self._manifest(layer, name)[1].get("rows", {}).items()}

    def read_partitioned(self, layer: str, name: str, schema: T.StructType, columns: Sequence[str],
                         part_col: str = "deal_year") -> DataFrame:
        """Read with a declared schema: columns absent from older files come
        back NULL (additive evolution), partition values keep their type."""
        data = f"{self.table_path(layer, name)}/data"
        paths = [f"{data}/{VERSION}={v:06d}/{part_col}={value}" for value, v in self.partition_versions(layer, name).items()]
        if not paths:
            return self.spark.createDataFrame([], schema).select(*columns)
        return self.spark.read.schema(schema).option("basePath", data).parquet(*paths).select(*columns)

    def partition_meta(self, layer: str, name: str) -> dict:
        """What the last replace wrote down."""
        return self._manifest(layer, name)[1].get("meta", {})

    def read_parts(self, layer: str, name: str, values: Sequence[int] | None = None,
                   version: int | None = None) -> DataFrame:
        """A partitioned table with its schema as last written; with ``values``, no other partition is listed or read."""
        number, manifest = self._manifest(layer, name, version)
        if not number:
            raise FileNotFoundError(f"{layer}.{name} has no manifest under {self.root}")
        schema, part_col = T.StructType.fromJson(manifest["schema"]), manifest["column"]
        data = f"{self.table_path(layer, name)}/data"
        paths = [f"{data}/{VERSION}={v:06d}/{part_col}={value}" for value, v in manifest["partitions"].items()
                 if values is None or int(value) in set(values)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", data).parquet(*paths).select(*schema.names)

    def replace_partitions(self, layer: str, name: str, df: DataFrame, part_col: str,
                           values: Sequence[int] | None = None, only: bool = False,
                           meta: dict | None = None) -> dict[int, int]:
        """Replace whole partitions of ``part_col``, all at once.

        With ``values``: rows outside them are ignored, and every listed value ends up holding
        exactly the rows ``df`` has for it; a value with no rows is cleared (static semantics).
        Without: every partition present in ``df`` is replaced, others are untouched. With
        ``only``, partitions that are not listed go. Returns rows per replaced value.

        Rows are rebalanced by partition value before the write: a large value is split over
        several tasks, small ones share one, so files are few at any number of tasks."""
        self._guard()
        base = self.table_path(layer, name)
        number, manifest = self._manifest(layer, name)
        src = df.filter(F.col(part_col).isNotNull())
        if values:
            src = src.filter(F.col(part_col).isin(list(values)))
        nxt = 1 + max((int(d.partition("=")[2]) for d in self.list_dir(f"{base}/data") if d.startswith(VERSION)), default=0)
        target = f"{base}/data/{VERSION}={nxt:06d}"
        src.hint("rebalance", F.col(part_col)).write.mode("errorifexists").partitionBy(part_col).parquet(target)
        # Counts come from the files' footers: only the partition column is read.
        written = {} if not any(d.startswith(f"{part_col}=") for d in self.list_dir(target)) else {
            int(r[0]): int(r[1]) for r in self.spark.read.option("basePath", target).parquet(target)
            .groupBy(part_col).agg(F.count(F.lit(1))).collect()}
        replaced = set(values or written)
        kept = {} if only else {k: v for k, v in manifest.get("partitions", {}).items() if int(k) not in replaced}
        rows = {k: n for k, n in manifest.get("rows", {}).items() if k in kept}
        self._put_next(f"{base}/_manifests", json.dumps({
            "partitions": {**kept, **{str(y): nxt for y in written}},
            "rows": {**rows, **{str(y): n for y, n in written.items()}},
            "column": part_col, "schema": df.schema.jsonValue(), "meta": meta or {}}), after=number)
        self.last_written_rows = sum(written.values())
        self._drop_unread(base, self._pinned(f"{layer}.{name}"))
        return {y: written.get(y, 0) for y in sorted(replaced)}

    def _drop_unread(self, base: str, pinned: set[int]) -> None:
        """Delete manifests beyond ``keep`` and data versions that none names, once they are old enough."""
        numbers = self._numbers(f"{base}/_manifests")
        for n in numbers[:-self.keep]:
            if n not in pinned and self.age_s(f"{base}/_manifests/n={n:09d}") >= self.retain_s:
                self.delete_path(f"{base}/_manifests/n={n:09d}")
                numbers.remove(n)
        named = {v for n in numbers
                 for v in json.loads(self._read_text(f"{base}/_manifests/n={n:09d}")).get("partitions", {}).values()}
        for d in self.list_dir(f"{base}/data"):
            if d.startswith(VERSION) and int(d.partition("=")[2]) not in named and self.age_s(f"{base}/data/{d}") >= self.retain_s:
                self.delete_path(f"{base}/data/{d}")

    # -- maintenance -----------------------------------------------------------
    def reset_layers(self, layers: Sequence[str] = ("analytics", "staging", "raw", "state")) -> list[str]:
        """Drop the layers that exist, and what is noted about them; returns their names."""
        self._guard()
        for notes in ("_notes", "_meta"):
            self.delete_path(f"{self.root}/{notes}")
        dropped = []
        for layer in layers:
            p = f"{self.root}/{layer}"
            if self.exists_path(p):
                self.delete_path(p)
                dropped.append(layer)
        return dropped
