"""Helpers shared by the operators: scratch tables in the shared folder and components.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir`` (never a machine-local folder),
so a lost executor costs a re-read, not a wrong result.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwerk.config import checkpoint_dir
from sensorwerk.sources.tables import table_path

SPACE = r"[\x20\x09-\x0D]+"      # white space of the contracts
WORD = r"[^\x20\x09-\x0D]+"      # a word of the contracts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows once to the shared folder and returns a reader of them."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a :func:`materialize` table that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a long that names each for good, and that column's name.

    Plain file relations are numbered by their files' places (a number per file, then the row's place
    in it), which no re-run changes; anything else is written once.
    """
    name = "row_no"
    while name in docs.columns:
        name += "_"
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation" or "_metadata" in docs.columns:
        return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name
    file, row = f"{name}file", f"{name}row"
    placed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    files = materialize(placed.select(F.col(file).alias("path")).distinct().coalesce(1).select(
        "path", F.monotonically_increasing_id().alias("file_no")), "files")            # a row per file
    at = F.shiftleft("file_no", 40).bitwiseOR(F.col(row))
    return placed.join(files, F.col(file) == F.col("path")).select(*[placed[c] for c in docs.columns], at.alias(name)), name


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """Smallest member of the connected component of every node that has a link.

    ``edges`` has two long columns. Alternates large-star and small-star steps (every node's
    larger, then smaller neighbours are re-hung under the smallest one) until the links are
    stable, so the work per round is linear in the links and nothing is gathered. Each round is
    written to the shared folder. Returns ``node, root`` (``root`` itself is not listed).
    """
    def star(links: DataFrame, large: bool) -> DataFrame:
        if large:
            near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            near = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = near.groupBy("u").agg(F.min("v").alias("m0")).select(
            F.col("u").alias("w"), F.least("u", "m0").alias("m"))
        pairs = near.join(low, near.u == low.w).select("u", "v", "m")
        if large:
            moved = pairs.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            own = low.select(F.col("w").alias("u"), F.col("m").alias("v"))
            moved = pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
        return moved.where("u <> v").distinct()

    def mark(links: DataFrame):
        return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    links = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where("u <> v").distinct(), "links")
    before = mark(links)
    for _ in range(max_rounds):
        if not before[0]:
            break
        nxt = materialize(star(star(links, True), False), "links")
        discard(links)
        links, now = nxt, mark(nxt)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
