"""Tables by three-part name on a stock Spark session.

``catalog.schema.table`` is used as it is when that catalog is configured in Spark; otherwise it
maps to the table ``catalog__schema.table`` of the session catalog. Parquet tables are replaced
by writing a new folder beside the current one and pointing the table, or its partitions, at it.
So a table may be read while its next version is written, and a failed job leaves the old version
in place. The version before the current one is kept for readers that have begun; older ones go.

A table that ``append`` makes has a partition for each append, in a folder of its own, and the append
is done when the catalog knows the partition. So several runs may append to one table, or replace
their own slices of one, at once; no two of them ever commit into the same folder.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import datetime, timezone
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mendflow import schemas as S
from mendflow.functions.transforms import quoted


#: Partition column of tables made by ``append``: one value for each append. Readers do not see it.
APPEND = "__append"
#: Partitions added or dropped by one statement.
PARTITIONS_AT_ONCE = 1000


def table_name(spark: SparkSession, fqn: str) -> str:
    parts = [p.strip() for p in fqn.split(".")]
    if not all(parts) or len(parts) > 3:
        raise ValueError(f"bad table name {fqn!r}")
    if len(parts) < 3 or spark.conf.get(f"spark.sql.catalog.{parts[0]}", None) is not None:
        return ".".join(f"`{p}`" for p in parts)
    return f"`{parts[0]}__{parts[1]}`.`{parts[2]}`"


def schema_name(spark: SparkSession, schema: str) -> str:
    return table_name(spark, f"{schema}.x").rsplit(".", 1)[0]


def exists(spark: SparkSession, fqn: str) -> bool:
    return spark.catalog.tableExists(table_name(spark, fqn))


def read(spark: SparkSession, fqn: str) -> DataFrame:
    return spark.read.table(table_name(spark, fqn)).drop(APPEND)


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder whose files may have gained columns over time."""
    return spark.read.option("mergeSchema", True).parquet(path)


def discover(
    spark: SparkSession, schema: str, prefix: str = "", exclude_suffix: str = S.STAGED_SUFFIX
) -> DataFrame:
    """Quarantine tables of a schema; empty when the schema does not exist."""
    name = schema_name(spark, schema)
    if not spark.catalog.databaseExists(name.replace("`", "")):
        return spark.createDataFrame([], "fqn string")
    tables = spark.sql(f"SHOW TABLES IN {name}")
    return tables.filter(
        ~F.col("isTemporary")
        & F.col("tableName").startswith(prefix)
        & ~F.col("tableName").endswith(exclude_suffix)
    ).select(F.concat(F.lit(f"{schema}."), "tableName").alias("fqn"))


def _root(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


_VERSION = re.compile(r"/v-\d{17}-[0-9a-f]{8}$")


def _detail(spark: SparkSession, fqn: str, what: str) -> str | None:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(spark, fqn)}")
    row = described.filter(F.col("col_name") == what).select("data_type").head()
    return row[0] if row else None


def _versions_folder(spark: SparkSession, fqn: str) -> str:
    """Where the versions of a table are: beside its current folder, or in the warehouse."""
    if not exists(spark, fqn):
        return f"{_root(spark)}/{fqn.replace('.', '/')}"
    now = _detail(spark, fqn, "Location").rstrip("/")
    return _VERSION.sub("", now) if _VERSION.search(now) else f"{now}__versions"


def _new_folder(spark: SparkSession, fqn: str) -> str:
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")[:17]
    return f"{_versions_folder(spark, fqn)}/v-{stamp}-{uuid.uuid4().hex[:8]}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_old_versions(spark: SparkSession, fqn: str, keep: int = 1) -> None:
    """Delete the versions of an unpartitioned table that are older than the ``keep`` before the current."""
    folder = _versions_folder(spark, fqn)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted(f"{folder}/{f.getPath().getName()}" for f in files.listStatus(path)) if files.exists(path) else []
    found = [f for f in found if _VERSION.search(f)]
    for old in found[: max(0, len(found) - 1 - keep)]:
        delete_folder(spark, old)


def partition_columns(spark: SparkSession, fqn: str) -> list[str]:
    """The columns a table is partitioned by, except the number of the append."""
    return [c for c in all_partition_columns(spark, fqn) if c != APPEND]


def all_partition_columns(spark: SparkSession, fqn: str) -> list[str]:
    listed = spark.catalog.listColumns(table_name(spark, fqn).replace("`", ""))
    return [c.name for c in listed if c.isPartition]


def _create(spark: SparkSession, fqn: str, df: DataFrame, folder: str) -> None:
    name = table_name(spark, fqn)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    df.write.format("parquet").option("path", folder).saveAsTable(name.replace("`", ""))


def create_partitioned(spark: SparkSession, fqn: str, schema: StructType, by: str) -> None:
    """A table without rows, unless another run has just made it."""
    name = table_name(spark, fqn)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != by)
    kind = {f.name: f.dataType.simpleString() for f in schema}.get(by, "string")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}, `{by}` {kind}) USING parquet PARTITIONED BY (`{by}`) "
        f"LOCATION {quoted(_new_folder(spark, fqn))}"
    )


def _widen(spark: SparkSession, fqn: str, schema: StructType) -> StructType:
    """Add the columns that a table lacks; another run may add the same ones meanwhile."""
    name = table_name(spark, fqn)
    for tries_left in (2, 1, 0):
        now = spark.read.table(name).schema
        new = [f for f in schema if f.name not in now.names]
        if not new:
            return now
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        try:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
        except AnalysisException:
            if not tries_left:
                raise
        spark.catalog.refreshTable(name.replace("`", ""))
    return spark.read.table(name).schema


def append(df: DataFrame, fqn: str) -> None:
    """Append rows; the first append creates the table and later ones may add columns.

    Runs may append at the same time. A table that was made elsewhere takes the rows by its own
    format if that has transactions; into a plain Parquet table the finished files are moved.
    """
    spark = df.sparkSession
    name = table_name(spark, fqn)
    if not exists(spark, fqn):
        create_partitioned(spark, fqn, df.schema, APPEND)
    # Columns the frame lacks become typed nulls; insertInto matches by position.
    schema = _widen(spark, fqn, df.schema)
    parts = all_partition_columns(spark, fqn)
    aligned = df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
            if f.name != APPEND
        ]
    )
    if parts == [APPEND]:
        folder = _new_folder(spark, fqn)
        aligned.write.parquet(folder)
        spark.sql(f"ALTER TABLE {name} ADD PARTITION (`{APPEND}` = {quoted(_version_of(folder))}) LOCATION {quoted(folder)}")
        spark.catalog.refreshTable(name.replace("`", ""))
    elif (_detail(spark, fqn, "Provider") or "").lower() == "parquet" and not parts:
        _move_in(aligned, fqn)
    else:
        aligned.write.insertInto(name.replace("`", ""))


def _version_of(folder: str) -> str:
    return folder.rsplit("/", 1)[1]


def _move_in(df: DataFrame, fqn: str) -> None:
    """Write to a folder of its own, then move the files, whose names are unique, to the table's folder."""
    spark = df.sparkSession
    target = _detail(spark, fqn, "Location").rstrip("/")
    folder = _new_folder(spark, fqn)
    df.write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for file in files.listStatus(path(folder)):
        if file.getPath().getName().startswith("part-") and not files.rename(file.getPath(), path(f"{target}/{file.getPath().getName()}")):
            raise OSError(f"could not move {file.getPath().getName()} to {target}")
    files.delete(path(folder), True)
    spark.catalog.refreshTable(table_name(spark, fqn).replace("`", ""))


def replace(df: DataFrame, fqn: str, keep_versions: int = 1) -> None:
    """Write the next version to a new folder, then point the table at it.

    Partitions, properties and the place of the table stay. Columns may be added; any other
    change of columns makes a new table that takes the old one's name once it is there.
    """
    spark = df.sparkSession
    folder = _new_folder(spark, fqn)
    if not exists(spark, fqn):
        _create(spark, fqn, df, folder)
        return
    name = table_name(spark, fqn)
    if all_partition_columns(spark, fqn) == [APPEND]:
        _replace_appends(df, fqn, folder)
        return
    parts = partition_columns(spark, fqn)
    table = spark.read.table(name)
    writer = df.select(*[c for c in df.columns if c not in parts], *parts).write
    (writer.partitionBy(*parts) if parts else writer).parquet(folder)
    old = dict(table.dtypes)
    if all(dict(df.dtypes).get(c) == t for c, t in old.items()):
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in old)
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
        if parts:
            _repoint(spark, fqn, folder, df.schema, parts, table.select(*parts).distinct())
        else:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    else:
        _rename_in(spark, name, folder, df, parts)
    spark.catalog.refreshTable(name.replace("`", ""))
    if not parts:
        drop_old_versions(spark, fqn, keep_versions)


def _replace_appends(df: DataFrame, fqn: str, folder: str) -> None:
    """One partition for all that was appended. If columns are to change, the table is made anew and renamed."""
    spark = df.sparkSession
    name = table_name(spark, fqn)
    before = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    old = dict(read(spark, fqn).dtypes)
    df.write.parquet(folder)
    if not all(dict(df.dtypes).get(c) == t for c, t in old.items()):
        _rename_in(spark, name, folder, df, [])
        return
    _widen(spark, fqn, df.schema)
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (`{APPEND}` = {quoted(_version_of(folder))}) LOCATION {quoted(folder)}")
    for i in range(0, len(before), PARTITIONS_AT_ONCE):
        listed = ", ".join(f"PARTITION (`{APPEND}` = {quoted(v)})" for v in before[i : i + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {listed}")
    spark.catalog.refreshTable(name.replace("`", ""))
    for version in before[:-1]:  # the newest is kept for readers that have begun
        delete_folder(spark, f"{_versions_folder(spark, fqn)}/{version}")


def _partition_place(spark: SparkSession, fqn: str, part: str) -> str | None:
    """The folder of a partition, None if there is none."""
    if spark.sql(f"SHOW PARTITIONS {table_name(spark, fqn)} {part}").isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(spark, fqn)} {part}")
    return described.filter("col_name = 'Location'").select("data_type").head()[0]


def replace_partitions(df: DataFrame, fqn: str, touched: DataFrame) -> None:
    """Replace only the partitions listed in ``touched``; ``df`` has all of their next rows."""
    spark = df.sparkSession
    parts = partition_columns(spark, fqn)
    folder = _new_folder(spark, fqn)
    df.select(*[c for c in df.columns if c not in parts], *parts).write.partitionBy(*parts).parquet(folder)
    _repoint(spark, fqn, folder, df.schema, parts, touched.select(*parts).distinct())
    spark.catalog.refreshTable(table_name(spark, fqn).replace("`", ""))


def _spec(parts: list[str], row) -> str:
    values = ["NULL" if row[p] is None else quoted(row[p]) for p in parts]
    return "PARTITION (" + ", ".join(f"`{p}` = {v}" for p, v in zip(parts, values, strict=True)) + ")"


def _repoint(
    spark: SparkSession, fqn: str, folder: str, schema: StructType, parts: list[str], replaced: DataFrame
) -> None:
    """Point partitions at what was written; replaced ones without new rows go. One row a partition is read.

    Of a partition's folders the current one and the one before it stay.
    """
    name = table_name(spark, fqn)
    before = {tuple(r) for r in replaced.collect()}
    there = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    written = spark.read.schema(schema).parquet(folder)
    files = written.select(*parts, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("__folder"))
    rows = files.distinct().collect()
    now = [(tuple(r[p] for p in parts), _spec(parts, r), unquote(r["__folder"])) for r in rows]
    new = [(spec, place) for _, spec, place in now if _inside_version(place) not in there]
    for i in range(0, len(new), PARTITIONS_AT_ONCE):
        listed = " ".join(f"{spec} LOCATION {quoted(place)}" for spec, place in new[i : i + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD {listed}")
    for _, spec, place in now:
        if _inside_version(place) in there:  # a new location is one change of the catalog
            last = _partition_place(spark, fqn, spec)
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION {quoted(place)}")
            _drop_old_places(spark, fqn, place, last)
    gone = [_spec(parts, dict(zip(parts, g, strict=True))) for g in before - {values for values, _, _ in now}]
    for i in range(0, len(gone), PARTITIONS_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(gone[i : i + PARTITIONS_AT_ONCE])}")


def _drop_old_places(spark: SparkSession, fqn: str, place: str, last: str | None) -> None:
    """Delete what older versions hold of the partition at ``place``, except the ``last`` one."""
    folder, inside = _versions_folder(spark, fqn), _inside_version(place)
    before = re.search(r"/(v-\d{17}-[0-9a-f]{8})/", last or "")
    if not inside or not before:
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for version in files.listStatus(path(folder)) if files.exists(path(folder)) else []:
        name = version.getPath().getName()
        if _VERSION.search(f"/{name}") and name < before[1] and files.exists(path(f"{folder}/{name}/{inside}")):
            files.delete(path(f"{folder}/{name}/{inside}"), True)


def _inside_version(place: str) -> str | None:
    """The part of a partition's place below its version's folder."""
    found = re.search(r"/v-\d{17}-[0-9a-f]{8}/(.+)$", place)
    return found[1] if found else None


def _rename_in(spark: SparkSession, name: str, folder: str, df: DataFrame, parts: list[str]) -> None:
    """A table over ``folder`` with the old one's properties, made first and renamed last."""
    after = f"{name[:-1]}__next`"
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    spark.sql(f"DROP TABLE IF EXISTS {after}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    own = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items() if not k.startswith("transient"))
    kept = f"TBLPROPERTIES ({own})" if own else ""
    spark.sql(f"CREATE TABLE {after} ({columns}) USING parquet {by} LOCATION {quoted(folder)} {kept}")
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {after}")
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {after} RENAME TO {name}")


def replace_slice(df: DataFrame, fqn: str, column: str, value: str) -> None:
    """Replace the rows with ``column = value`` of a table partitioned by that column.

    The slice is written to a new folder and the partition is pointed at it, so other slices are
    not touched, and several runs may replace theirs at once. ``df`` must not read the table's slice
    after this call. The slice's folder before this one is kept for readers that have begun.
    """
    spark = df.sparkSession
    name = table_name(spark, fqn)
    if not exists(spark, fqn):
        create_partitioned(spark, fqn, df.schema, column)
    slice_name = f"slice-{hashlib.md5(value.encode(), usedforsecurity=False).hexdigest()}"
    folder = f"{_new_folder(spark, fqn)}/{slice_name}"
    df.drop(column).write.parquet(folder)
    part = f"PARTITION (`{column}` = {quoted(value)})"
    last = _partition_place(spark, fqn, part)
    if last is None:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} LOCATION {quoted(folder)}")
    else:
        spark.sql(f"ALTER TABLE {name} {part} SET LOCATION {quoted(folder)}")
    spark.catalog.refreshTable(name.replace("`", ""))
    _drop_old_places(spark, fqn, folder, last)


def supports_merge(spark: SparkSession, fqn: str) -> bool:
    """True when the table's format executes ``MERGE INTO`` itself."""
    return (_detail(spark, fqn, "Provider") or "").lower() in ("delta", "iceberg", "hudi")


def refs_for(
    spark: SparkSession, checks: Sequence[Mapping], given: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Frames of the tables that the checks compare with; those not given are read by name."""
    found = dict(given or {})
    for check in checks:
        args = (check.get("check") or check).get("arguments") or {}
        for name in (args.get("ref_table"), args.get("other_table")):
            if name and name not in found:
                found[name] = read(spark, name)
    return found


# --- scratch --------------------------------------------------------------------------------------

_made: ContextVar[list[str] | None] = ContextVar("scratch_folders", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the scratch folders that were made inside it."""
    folders: list[str] = []
    token = _made.set(folders)
    try:
        yield
    finally:
        _made.reset(token)
        for folder in folders:
            delete_folder(spark, folder)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder all executors reach: under ``spark.checkpoint.dir``, else the warehouse.

    Only local mode without that setting uses a temporary folder of the machine. A cluster whose
    warehouse is on the machines' own disks must name a shared folder in the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        root = tempfile.mkdtemp(prefix="mendflow-")
    if root is None:
        root = _root(spark)
        if urlsplit(root).scheme in ("", "file"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    folder = f"{root.rstrip('/')}/mendflow-{uuid.uuid4().hex}"
    if _made.get() is not None:
        _made.get().append(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written once to the shared scratch folder and read back from there.

    The files survive lost executors. Unlike a row checkpoint, later steps read only the columns
    they use and the optimizer knows the size. Inside ``scratch`` the files go at its end.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
