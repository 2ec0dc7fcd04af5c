"""Writing tables so that readers never see half of one, and cutting a plan at a written table."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- files of the cluster -------------------------------------------------------------------------


class _Store:
    """The file system of a path, whichever it is."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._java = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._files = self.path(path).getFileSystem(self._conf)

    def path(self, name: str):
        return self._java.Path(name)

    def exists(self, name: str) -> bool:
        return self._files.exists(self.path(name))

    def delete(self, name: str) -> None:
        self._files.delete(self.path(name), True)

    def rename(self, old: str, new: str) -> None:
        if not self._files.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def folders(self, name: str) -> list[str]:
        return [f.getPath().getName() for f in self._files.listStatus(self.path(name)) if f.isDirectory()]

    def replace(self, name: str, content: str) -> None:
        """Put a small file in place of another in one step."""
        draft = f"{name}-{uuid.uuid4().hex}"
        stream = self._files.create(self.path(draft), True)
        try:
            stream.write(content.encode())
        finally:
            stream.close()
        options = self._gateway.new_array(self._java.Options.Rename, 1)
        options[0] = self._java.Options.Rename.OVERWRITE
        whole = self.path(draft).makeQualified(self._files.getUri(), self._files.getWorkingDirectory())
        self._java.FileContext.getFileContext(whole.toUri(), self._conf).rename(whole, self.path(name), options)

    def read(self, name: str) -> str:
        stream = self._files.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


# --- tables that are replaced ------------------------------------------------------------------------


def _write(df: DataFrame, path: str, file_format: str, partition_by: Sequence[str]) -> None:
    if file_format == "csv":
        nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")]
        df = df.withColumns({name: F.to_json(name) for name in nested}) if nested else df
        df.write.option("header", True).option("escape", '"').csv(path)
    else:
        df.write.partitionBy(*partition_by).format(file_format).save(path)


def write_table(df: DataFrame, path: str, file_format: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write a table, replacing what is there.  Parquet between steps, CSV for hand-over.

    The table is written beside ``path`` and takes its place when it is complete: a write that fails leaves the old
    table as it was.  ``df`` may read the table it replaces.  Between two renames the table is away for a moment; where
    a reader must not meet that, see :func:`publish`.  CSV has no nested types, so arrays and structs are written as JSON text.
    """
    store = _Store(df.sparkSession, path)
    path = path.rstrip("/")
    folder, slash, name = path.rpartition("/")
    staging, old = (f"{folder}{slash}_{what}-{name}-{uuid.uuid4().hex}" for what in ("staging", "old"))
    try:
        _write(df, staging, file_format, partition_by)
        replaced = store.exists(path)
        if replaced:
            store.rename(path, old)
        try:
            store.rename(staging, path)
        except Exception:
            if replaced:
                store.rename(old, path)
            raise
        if replaced:
            store.delete(old)
    finally:
        if store.exists(staging):
            store.delete(staging)


_MANIFEST = "_CURRENT"


def publish(df: DataFrame, path: str, file_format: str = "parquet", partition_by: Sequence[str] = (), keep: int = 1) -> str:
    """Write a table as a new version below ``path`` and make it the current one; returns the version.

    A small manifest names the current version and is replaced in one step, so :func:`published` gives the old version
    or the new one and nothing between.  The ``keep`` versions before stay for readers that have begun; older ones and those
    of failed writes go.  One writer at a time.
    """
    store = _Store(df.sparkSession, path)
    path = path.rstrip("/")
    before = _manifest(store, path)
    version = f"version-{uuid.uuid4().hex}"
    try:
        _write(df, f"{path}/{version}", file_format, partition_by)
        earlier = [before["version"], *before["earlier"]][:keep] if before else []
        store.replace(f"{path}/{_MANIFEST}", json.dumps({"version": version, "format": file_format, "earlier": earlier}))
    except Exception:
        store.delete(f"{path}/{version}")
        raise
    for folder in store.folders(path):
        if folder.startswith("version-") and folder not in (version, *earlier):
            store.delete(f"{path}/{folder}")
    return version


def _manifest(store: _Store, path: str) -> dict | None:
    return json.loads(store.read(f"{path}/{_MANIFEST}")) if store.exists(f"{path}/{_MANIFEST}") else None


def published(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The current version of a table that :func:`publish` wrote, or an earlier one that is still kept."""
    path = path.rstrip("/")
    manifest = _manifest(_Store(spark, path), path)
    if manifest is None:
        raise ValueError(f"nothing is published at {path}")
    reader = spark.read.format(manifest["format"])
    if manifest["format"] == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return reader.load(f"{path}/{version or manifest['version']}")


# --- landed tables --------------------------------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, or a temporary one when everything runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="voxtally-")


class Landing:
    """Landed tables of one piece of work, in a folder that goes when the work is done.

    ``with Landing(spark) as landing:`` around what reads the tables; a result that is still lazy when the block ends
    has nothing to read any more.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.path = f"{shared_folder(spark)}/landing-{uuid.uuid4().hex}"

    def __enter__(self) -> Landing:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        _Store(self.spark, self.path).delete(self.path)

    def land(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` to the shared folder and read it back.

        For tables several results are computed from: the work behind them is then done once, survives lost
        executors, and each reader takes only its columns.
        """
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def land(df: DataFrame, name: str) -> DataFrame:
    """A landed table for a result that stays lazy; it is left in the shared folder, which the cluster empties."""
    return Landing(df.sparkSession).land(df, name)
