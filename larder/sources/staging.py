"""Staged tables in the cluster's shared folder.

Multi-pass operators write their small intermediate tables (and plans their reused large ones) as parquet under the folder
named by ``spark.checkpoint.dir`` and read them back. That cuts lineage, survives lost executors, and gives Catalyst the true
size of the table, so its own ``spark.sql.autoBroadcastJoinThreshold`` check decides between a broadcast and a sort-merge join.

- ``stage(by=)`` lays a table out in buckets of a key, so that tables laid out alike are joined and grouped by it without an exchange.
- ``stage(checks=)`` counts offending rows in the job that writes them.
- ``scope`` owns the tables that are staged inside it and deletes them at its end. With ``reuse`` it keeps them instead, under names made from
  the fingerprint of their plan and input files, and a later run with the same fingerprint reads what is there.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.operators.quality import Check, CheckFailed, enforce

SHARED_DIR_SETTING = "spark.checkpoint.dir"
#: Plans with these nodes or expressions read something that no file fingerprint covers, or differ between runs.
UNREPEATABLE = re.compile(r"\b(LogicalRDD|LocalRelation|ExternalRDD|PythonUDF|MapIn(Pandas|Arrow)|FlatMap\w+|current_(date|time|timestamp)|localtimestamp|now)\b")

_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only for a local session that names none."""
    folder = spark.conf.get(SHARED_DIR_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {SHARED_DIR_SETTING} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="larder-")
    return _local_folders[application]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; the innermost scope deletes what is written there."""
    path = f"{shared_dir(spark)}/larder/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].paths.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path; it reaches whatever store Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


@dataclass
class Scope:
    """What was staged since the scope was opened."""

    spark: SparkSession
    reuse: str | None = None
    paths: list[str] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)
    computed: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)

    def close(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        for path in self.paths:
            delete(self.spark, path)


_scopes: list[Scope] = []


@contextmanager
def scope(spark: SparkSession, reuse: str | None = None) -> Iterator[Scope]:
    """Staged tables made inside are deleted at the end, also after an error, so results must be written before.

    ``reuse`` names a folder instead, in which staged tables stay under their fingerprints: a rerun over unchanged files computes none of them
    again, and a table whose inputs have changed gets a new name. Plans over data that no file holds, or that differ between runs, are staged as without.
    """
    mine = Scope(spark, reuse.rstrip("/") if reuse else None)
    _scopes.append(mine)
    try:
        yield mine
    finally:
        _scopes.remove(mine)
        mine.close()


def fingerprint(df: DataFrame, *more) -> str | None:
    """A name for what ``df`` computes from which files: its analysed plan with expression ids in order of appearance, and path, length and
    time of change of every input file. None if the plan does not determine the result. ``more`` goes into the name."""
    spark = df.sparkSession
    analysed = df._jdf.queryExecution().analyzed()
    text = analysed.canonicalized().numberedTreeString()
    if UNREPEATABLE.search(text) or not analysed.deterministic():
        return None
    order: dict[str, str] = {}
    text = re.sub(r"#\d+", lambda m: order.setdefault(m.group(), f"#{len(order)}"), text)
    files = []
    for file in sorted(df.inputFiles()):
        system, place = _file_system(spark, file)
        status = system.getFileStatus(place)
        files.append(f"{file} {status.getLen()} {status.getModificationTime()}")
    if not files:
        return None
    return hashlib.sha256("\n".join([spark.version, df.schema.json(), text, *files, *map(str, more)]).encode()).hexdigest()[:32]


def stage(
    df: DataFrame,
    label: str,
    by: str | None = None,
    buckets: int | None = None,
    arranged: bool = False,
    checks: Sequence[Check] = (),
    drop: Sequence[str] = (),
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """Write ``df`` to the shared folder and return it as a parquet table.

    ``by`` lays it out in ``buckets`` buckets of that column (as many as shuffle partitions unless given), sorted by it: one exchange now, none in
    joins and groupings by that column later (see ``co_partitioned``). ``arranged`` says that the plan ends in that layout already.
    ``checks`` are counted while rows are written, before the columns ``drop`` go; the counts go to the scopes and to ``counts``, and too
    many offending rows raise ``quality.CheckFailed`` after the write. A table that fails is deleted.
    """
    spark = df.sparkSession
    number = (buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))) if by else None
    where = next((s.reuse for s in reversed(_scopes) if s.reuse), None)
    name = fingerprint(df, by, number, *[f"{c}" for c in checks]) if where else None
    path = f"{where}/{label}-{name}" if name else new_path(spark, label)
    out = df.drop(*drop)
    found = _kept_counts(spark, path) if name else None
    if found is None:
        if _scopes:
            _scopes[-1].computed.append(label)
        found = _write(df, out, path, label, by, number, arranged, checks, drop)
        if name:
            _keep_counts(spark, path, found)
    else:
        _scopes[-1].reused.append(label)
    if checks:
        for report in [each.counts.setdefault(label, {}) for each in _scopes] + ([counts] if counts is not None else []):
            report.update(found)
    if by is None:
        return spark.read.schema(out.schema).parquet(path)
    return _bucketed(spark, out, path, label, by, number)


def _write(df, out, path, label, by, number, arranged, checks, drop) -> dict[str, int]:
    """Write the table; returns what its checks counted. A table that fails a check is deleted again."""
    observation = Observation(f"{label}-{uuid.uuid4().hex}") if checks else None
    if observation is not None:
        out = df.observe(observation, F.count(F.lit(1)).alias("rows"), *[c.count() for c in checks]).drop(*drop)
    if by is None:
        with _shuffles_removed(df.sparkSession):
            out.write.mode("overwrite").parquet(path)
    else:
        rows = out if arranged else out.repartition(number, by)
        table = _table_name(label)
        with _shuffles_removed(df.sparkSession):
            rows.write.mode("overwrite").bucketBy(number, by).sortBy(by).format("parquet").option("path", path).saveAsTable(table)
        df.sparkSession.sql(f"DROP TABLE `{table}`")  # the files stay; the table is named anew for each reader
    if observation is None:
        return {}
    try:
        return enforce(label, checks, observation.get)
    except CheckFailed:
        delete(df.sparkSession, path)
        raise


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    former = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in former.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def _shuffles_removed(spark: SparkSession):
    """Shuffle files of a write that is run inside go with its end. Nobody reads them again, and else they stay until the driver collects its garbage."""
    return _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


COUNTS = "_counts.json"


def _keep_counts(spark: SparkSession, path: str, found: dict[str, int]) -> None:
    """The last file of a kept table: it is there only if the table is whole and passed its checks."""
    system, place = _file_system(spark, f"{path}/{COUNTS}")
    stream = system.create(place, True)
    stream.write(bytearray(json.dumps(found).encode()))
    stream.close()


def _kept_counts(spark: SparkSession, path: str) -> dict[str, int] | None:
    system, place = _file_system(spark, f"{path}/{COUNTS}")
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _table_name(label: str) -> str:
    return f"larder_{re.sub('[^a-z0-9]', '_', label.lower())}_{uuid.uuid4().hex}"


def _bucketed(spark: SparkSession, out: DataFrame, path: str, label: str, by: str, number: int) -> DataFrame:
    """A table over files that lie in buckets."""
    table = _table_name(label)
    layout = f"CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {number} BUCKETS"
    spark.sql(f"CREATE TABLE `{table}` ({out.schema.toDDL()}) USING parquet {layout} LOCATION '{path}'")
    if _scopes:
        _scopes[-1].tables.append(table)
    return spark.table(table)


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Plans executed inside may join by several columns on the layout of the first: (household, person) meets in buckets of the household."""
    settings = {
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.sources.bucketing.enabled": "true",
    }
    with _settings(spark, settings):
        yield


def drop_staged(spark: SparkSession) -> bool:
    """Delete every staged table of this application that no scope owns; call it once their results are written."""
    return delete(spark, f"{shared_dir(spark)}/larder/{spark.sparkContext.applicationId}")
