"""Tables on plain Parquet: typed creation, append by name, overwrite, insert-if-absent, keyed
update, snapshots for small mutable state, immutable named and versioned datasets."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from datetime import datetime
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType, TimestampNTZType

from riskloom.functions.times import clock
from riskloom.sources.publish import exists, names, publish_text, published, read_text, remove, sizes


# --- reading ------------------------------------------------------------------------------------

def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by (qualified) name, or a Parquet folder by path."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def read_sql(spark: SparkSession, text: str, **args) -> DataFrame:
    """A query as SQL text with named parameters; nothing runs until it is used."""
    return spark.sql(text, args=args or None)


def read_folder(spark: SparkSession, path: str, file_glob: str = "*.parquet") -> DataFrame:
    """Parquet files of a folder whose names fit a pattern."""
    return spark.read.option("pathGlobFilter", file_glob).parquet(path)


def from_rows(spark: SparkSession, rows: list[tuple], schema: StructType | list[str]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# --- writing ------------------------------------------------------------------------------------

def with_default(name: str, kind: DataType, default: str) -> StructField:
    """A column whose default, a SQL expression, is kept with the table's schema."""
    return StructField(name, kind, True, {"default": default})


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """Create an empty typed table unless there is one. Column defaults stay with it."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).coalesce(1).write.parquet(path)


def _write(df: DataFrame, path: str, mode: str) -> int:
    """Write and return the number of rows, counted by the same job."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return seen.get["rows"]


def _add_files(df: DataFrame, path: str) -> int:
    """Append through a folder of its own, so that writers who append at the same time do not share one."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}/_staged/{uuid.uuid4().hex}"
    rows = _write(df, staged, "errorifexists")
    for name in sizes(spark, staged):
        if not published(spark, f"{staged}/{name}", f"{path}/{name}"):  # the names are unique to the write
            raise RuntimeError(f"{path}/{name} is there already")
    remove(spark, staged)
    return rows


def overwrite(df: DataFrame, target: str) -> int:
    """Replace a table by a query result; returns the row count. ``target`` is a path or table name."""
    if "/" in target:
        return _write(df, target, "overwrite")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").saveAsTable(target)
    return seen.get["rows"]


def append(df: DataFrame, path: str, schema: StructType | None = None, defaults: dict[str, Column] | None = None) -> int:
    """INSERT with a column list: columns match by name, absent ones take their default or NULL.

    Without ``schema`` the table's own one counts, with the defaults kept in it; ``defaults`` go before those."""
    defaults = defaults or {}
    schema = df.sparkSession.read.parquet(path).schema if schema is None else schema
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"not columns of the table: {unknown}")

    def value(field: StructField) -> Column:
        kept = F.expr(field.metadata["default"]) if "default" in field.metadata else F.lit(None)
        c = F.col(field.name) if field.name in df.columns else defaults.get(field.name, kept)
        return c.cast(field.dataType).alias(field.name, metadata=field.metadata)

    return _add_files(df.select(*[value(f) for f in schema.fields]), path)


def insert_row(spark: SparkSession, path: str, schema: StructType, **values) -> int:
    """Append one row of bound values (Column expressions allowed)."""
    row = spark.range(0, 1, 1, 1).select(*[
        (v if isinstance(v, Column) else F.lit(v)).alias(name) for name, v in values.items()])
    return append(row, path, schema)


# --- changes as new frames ----------------------------------------------------------------------

def insert_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE ... WHEN NOT MATCHED THEN INSERT."""
    fresh = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True).select(*target.columns)


def keyed_update(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """UPDATE by key: every non-key column of ``updates`` replaces the target's, NULL included.
    ``updates`` holds one row per key."""
    changed = [c for c in updates.columns if c not in keys]
    new = updates.select(*keys, F.struct(*changed).alias("_new"))
    hit = F.col("_new").isNotNull()
    return target.join(new, keys, "left").select(*[
        F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in target.columns])


# --- small mutable state ------------------------------------------------------------------------

#: Changes after which a state table folds its commits and drops old snapshots.
COMPACT_EVERY = 20
COMMITS = StructType([StructField("snapshot", LongType()), StructField("written_at", TimestampNTZType()), StructField("folder", StringType())])


class Conflict(RuntimeError):
    """Another writer has changed the state since it was read."""


class StateTable:
    """A small table kept as numbered snapshots, for any number of writers.

    A change writes its snapshot to a folder of its own and then publishes the commit of the next
    number, which only one writer can: the others read the new state and try again. Readers see the
    old or the new state, and nothing being read is overwritten."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        if self.current() is None:  # commit 0 is the empty state
            self._publish(0, self._snapshot(spark.createDataFrame([], schema), 0), None)

    def _numbers(self) -> list[int]:
        found = (re.fullmatch(r"commit-(\d+)\.parquet", name) for name in names(self.spark, f"{self.path}/commits"))
        return sorted(int(m[1]) for m in found if m)

    def current(self) -> int | None:
        """The number of the newest commit; listing names is all it takes."""
        return max(self._numbers(), default=None)

    def _file(self, number: int) -> str:
        return f"{self.path}/commits/commit-{number:012d}.parquet"

    def at(self, number: int) -> DataFrame:
        """The state of a commit."""
        folder = self.spark.read.schema(COMMITS).parquet(self._file(number)).first()["folder"]
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")

    def read(self) -> DataFrame:
        while True:
            number = self.current()
            try:
                return self.at(number)
            except AnalysisException:
                if exists(self.spark, self._file(number)):  # else it was folded away meanwhile, and there is a newer one
                    raise

    def _snapshot(self, df: DataFrame, number: int) -> str:
        """Write a state under a name of its own. One that never gets its commit belongs to no state, so nobody reads it."""
        folder = f"snapshot={number}/{uuid.uuid4().hex}"
        df.select(*self.schema.names).write.parquet(f"{self.path}/{folder}")
        return folder

    def _publish(self, number: int, folder: str, at: datetime | str | None) -> bool:
        draft = f"{self.path}/_drafts/{uuid.uuid4().hex}"
        self.spark.range(0, 1, 1, 1).select(
            F.lit(number).cast("long").alias("snapshot"), clock(at).alias("written_at"), F.lit(folder).alias("folder")).write.parquet(draft)
        (name,) = sizes(self.spark, draft)
        done = published(self.spark, f"{draft}/{name}", self._file(number))
        remove(self.spark, draft)
        return done

    def commit(self, df: DataFrame, base: int, at: datetime | str | None = None) -> int:
        """Make ``df`` the state after commit ``base``; `Conflict` if that is not the newest any more."""
        number = base + 1
        folder = self._snapshot(df, number)
        done = self._publish(number, folder, at)
        # Folding takes away a commit before its base. If the base is gone and this one stands, it was published long after its time: no reader saw it.
        if done and not exists(self.spark, self._file(base)) and exists(self.spark, self._file(number)):
            remove(self.spark, self._file(number))
            done = False
        if not done:
            remove(self.spark, f"{self.path}/{folder}")
            raise Conflict(f"{self.path}: commit {number} was another writer's")
        if number % COMPACT_EVERY == 0:
            self.compact(number)
        return number

    def update(self, change: Callable[[DataFrame], DataFrame], at: datetime | str | None = None, tries: int = 20) -> int:
        """Commit ``change`` of the newest state; whenever another writer comes first, of that one's state."""
        while True:
            base, tries = self.current(), tries - 1
            try:
                return self.commit(change(self.at(base)), base, at)
            except Conflict:
                if tries <= 0:
                    raise

    def replace(self, df: DataFrame, at: datetime | str | None = None) -> int:
        """Make ``df`` the new state, whatever the state is now. What depends on the state goes through `update`."""
        return self.update(lambda now: df, at)

    def compact(self, number: int) -> None:
        """Drop the commits before ``number``, newest first, and the snapshots before the last one (a reader may
        still hold that). Readers take the greatest number they find, so at no moment is there less than the current state."""
        for old in reversed(self._numbers()):
            if old < number:
                remove(self.spark, self._file(old))
        for gone in range(max(0, number - 2 - COMPACT_EVERY), number - 1):
            remove(self.spark, f"{self.path}/snapshot={gone}")


# --- immutable datasets -------------------------------------------------------------------------

def _manifest_path(root: str, name: str, version: str) -> str:
    return f"{root.rstrip('/')}/{quote(name, safe='')}/_manifests/{quote(version, safe='')}.json"


def manifest(spark: SparkSession, root: str, name: str, version: str) -> dict | None:
    """What a dataset's version consists of: folder, files with their bytes, rows, schema. None while there is no such version."""
    path = _manifest_path(root, name, version)
    return json.loads(read_text(spark, path)) if exists(spark, path) else None


def write_dataset(df: DataFrame, root: str, name: str, version: str) -> dict:
    """Freeze a frame as a version of a named dataset; an existing version is an error.

    The rows go to a folder of this try alone; the manifest that names it comes last, and only one
    can be published. A write that dies leaves nothing a reader sees, and nothing in the way of the next try."""
    spark = df.sparkSession
    taken = FileExistsError(f"dataset {name} has a version {version} already: it exists under {root}")
    if manifest(spark, root, name, version) is not None:
        raise taken
    folder = f"{root.rstrip('/')}/{quote(name, safe='')}/data/{uuid.uuid4().hex}"
    rows = _write(df, folder, "errorifexists")
    about = {"dataset_name": name, "dataset_version": version, "row_count": rows, "folder": folder,
             "files": sizes(spark, folder), "schema": json.loads(df.schema.json())}
    if not publish_text(spark, _manifest_path(root, name, version), json.dumps(about)):
        remove(spark, folder)
        raise taken
    return {"dataset_name": name, "dataset_version": version, "path": folder, "row_count": rows}


def list_datasets(spark: SparkSession, root: str) -> DataFrame:
    """(dataset_name, dataset_version, row_count) of every frozen dataset under ``root``, from the manifests."""
    rows = []
    for name in names(spark, root):
        for file in names(spark, f"{root.rstrip('/')}/{name}/_manifests"):
            if file.endswith(".json"):
                about = manifest(spark, root, unquote(name), unquote(file.removesuffix(".json")))
                rows.append((about["dataset_name"], about["dataset_version"], about["row_count"]))
    return spark.createDataFrame(rows, "dataset_name string, dataset_version string, row_count long")


def read_dataset(spark: SparkSession, root: str, name: str, version: str) -> DataFrame:
    about = manifest(spark, root, name, version)
    if about is None:
        raise FileNotFoundError(f"no dataset {name} {version} under {root}")
    return spark.read.schema(StructType.fromJson(about["schema"])).parquet(about["folder"])


def dataset_problems(spark: SparkSession, root: str, name: str, version: str) -> list[str]:
    """Files of a version that are missing, changed or too many, against its manifest."""
    about = manifest(spark, root, name, version)
    if about is None:
        return ["no manifest"]
    here = sizes(spark, about["folder"]) if exists(spark, about["folder"]) else {}
    return [f"{f}: {about['files'].get(f)} bytes expected, {here.get(f)} found" for f in sorted({*here, *about["files"]}) if here.get(f) != about["files"].get(f)]
