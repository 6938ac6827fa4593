"""Batch readers of the raw and processed zones (SRC-1, SRC-3, SRC-5, SRC-7)."""
from __future__ import annotations

from fnmatch import fnmatch
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from sensorwerk import schemas as S


def read_raw_logs(spark: SparkSession, path: str | list[str], schema: StructType = S.LOG_SCHEMA,
                  corrupt_col: str = S.CORRUPT_COL) -> DataFrame:
    """JSON lines with an explicit schema; unparseable or wrongly typed lines are kept with
    their raw text in ``corrupt_col`` (PERMISSIVE). Parsing is split per file block."""
    return (spark.read.schema(S.with_corrupt_column(schema, corrupt_col))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
            .json(path))


def _is_missing_path(err: AnalysisException) -> bool:
    cond = err.getCondition() if hasattr(err, "getCondition") else err.getErrorClass()
    return cond == "PATH_NOT_FOUND"


def load_registry(spark: SparkSession, path: str, schema: StructType = S.REGISTRY_SCHEMA) -> DataFrame:
    """Device registry Parquet; an absent path gives an empty registry of the same schema.
    Any other read error (bad schema, permissions) is raised, not hidden."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if not _is_missing_path(err):
            raise
        # a plan of known size (no rows), unlike an RDD scan, which the planner must take for huge; columns that
        # are no constants, so that a join on one stays an equi-join
        none = F.when(F.col("id") < 0, F.col("id"))
        return spark.range(0).select(*[(none if f.nullable else F.col("id")).cast(f.dataType).alias(f.name) for f in schema])


def load_staging(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Parquet prefix -> staging rows by column name; nested columns become JSON text
    (the warehouse stores them as strings). A column that the prefix lacks is an error, not NULLs."""
    df = spark.read.parquet(path)
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"staging at {path} lacks {', '.join(absent)}")
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in columns:
        if isinstance(have[c], (ArrayType, StructType, MapType)):
            out.append(F.to_json(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def register_lake_table(spark: SparkSession, table: str, path: str, partition_cols: list[str],
                        schema: StructType | None = None) -> DataFrame:
    """Catalog table over a Hive-partitioned Parquet folder, partitions discovered from the
    folder layout (the crawler's job). ``schema`` pins column types (partition values such
    as ``"05"`` would otherwise be inferred as integers)."""
    reader = spark.read.option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    sample = reader.parquet(path)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sample.schema.fields)
    parts = ", ".join(f"`{c}`" for c in partition_cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
              f"PARTITIONED BY ({parts}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


EXCLUDED = ("_*", ".*")          # folders and files that are no data: _temporary, _spark_metadata, _SUCCESS ...


def partition_folders(spark: SparkSession, path: str, partition_cols: list[str], exclude=EXCLUDED) -> list[dict]:
    """The partitions under a Hive-partitioned folder, ``{column: value, ..., "": folder}``.

    Folders are listed level by level; a name that matches a pattern of ``exclude`` is skipped with all
    below it, and one that is no ``column=value`` of its level is an error. The list has a row per
    partition, not per file.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    level = [({}, top)]
    for column in partition_cols:
        below = []
        for values, folder in level:
            for entry in fs.listStatus(folder):
                name = entry.getPath().getName()
                if any(fnmatch(name, pattern) for pattern in exclude):
                    continue
                if not entry.isDirectory() or not name.startswith(f"{column}="):
                    raise ValueError(f"{entry.getPath()} is no partition of {column}")
                value = unquote(name[len(column) + 1:])
                below.append(({**values, column: None if value == "__HIVE_DEFAULT_PARTITION__" else value}, entry.getPath()))
        level = below
    return [{**values, "": folder.toString()} for values, folder in level]


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sync_lake_table(spark: SparkSession, table: str, path: str, partition_cols: list[str], partition_types: dict[str, str] | None = None,
                    exclude=EXCLUDED) -> dict:
    """Brings a catalog table up to date with a Hive-partitioned Parquet folder (SRC-7).

    Only what changed is touched: the partitions that the catalog lacks are added, those whose folder is
    gone are dropped, and the files of the new ones alone are opened for their schema. A column that is
    new is added to the table (NULL in older files); one with another type is an error, and nothing is
    changed then. The first call creates the table. Returns the numbers and names of what was added.
    """
    found = {tuple(p[c] for c in partition_cols): p[""] for p in partition_folders(spark, path, partition_cols, exclude)}
    known: set[tuple] = set()
    exists = spark.catalog.tableExists(table)
    if exists:
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
            values = [unquote(x.split("=", 1)[1]) for x in row[0].split("/")]
            known.add(tuple(None if v in ("__HIVE_DEFAULT_PARTITION__", "null") else v for v in values))
    new = sorted((p for p in found if p not in known), key=repr)
    gone = sorted((p for p in known if p not in found), key=repr)
    fields = {}
    if new:
        seen = spark.read.option("mergeSchema", "true").parquet(*[found[p] for p in new]).schema
        fields = {f.name: f.dataType for f in seen if f.name not in partition_cols}
    have = {f.name: f.dataType for f in spark.table(table).schema} if exists else {}
    clash = [c for c, t in fields.items() if c in have and have[c] != t]
    if clash:
        raise ValueError(f"other types than in {table}: {', '.join(clash)}")
    added = [c for c in fields if c not in have]
    spec = lambda p: ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(partition_cols, p))
    if not exists:
        types = partition_types or {}
        columns = ", ".join([f"`{c}` {t.simpleString()}" for c, t in fields.items()] + [f"`{c}` {types.get(c, 'string')}" for c in partition_cols])
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)}) LOCATION '{path}'")
    elif added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {fields[c].simpleString()}' for c in added)})")
    for first in range(0, len(new), 500):
        parts = " ".join(f"PARTITION ({spec(p)}) LOCATION '{found[p]}'" for p in new[first:first + 500])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    for first in range(0, len(gone), 500):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f'PARTITION ({spec(p)})' for p in gone[first:first + 500])}")
    spark.catalog.refreshTable(table)
    return {"added": len(new), "dropped": len(gone), "columns": added if exists else []}
