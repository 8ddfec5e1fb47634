"""Session helpers of the operators: written tables, shipped code, joins with hot keys."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A key with more than this share of all rows counts as hot; there are fewer than HOT_SHARE of them.
HOT_SHARE = 1024
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500
#: Rows looked at for frequent keys, and how often a key must be among them.
SAMPLED, SEEN_OFTEN = 200_000, 100


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it, and give them
    batches that stay small with long texts, unless the session has its own batch size."""
    context = spark.sparkContext
    if spark.conf.get(BATCH_SETTING) == "10000":  # Spark's default
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    if getattr(context, "_laborloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    target = Path(tempfile.mkdtemp(prefix="laborloom-")) / "laborloom.zip"
    target.write_bytes(packed.getvalue())
    context.addPyFile(str(target))  # the driver serves it to the executors
    context._laborloom_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which all machines see. Only
    where there is one machine it may be a temporary one."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def saved(rows: DataFrame) -> DataFrame:
    """Write ``rows`` to the shared folder and read them back.

    Cuts the lineage: what follows survives lost executors without the work before it, and
    every branch sees the same rows. The tables stay until the folder's owner clears it.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row for each ``key``.

    ``weight`` is the number of rows with the key and ``total`` the number of all rows.
    Fewer than HOT_SHARE keys can hold more than ``total / HOT_SHARE`` rows each, so these
    are broadcast and their rows stay where they are; no key of the rest is large.
    """
    limit = total // HOT_SHARE
    hot = groups.where(F.col(weight) > limit).withColumn("hot_key", F.lit(True))
    cold = groups.where(F.col(weight) <= limit)
    marked = rows.join(F.broadcast(hot), key, "left")
    columns = [*rows.columns, *(c for c in groups.columns if c != key)]
    beside = marked.where("hot_key").select(*columns)
    moved = marked.where("hot_key IS NULL").select(*rows.columns).join(cold, key).select(*columns)
    return beside.unionByName(moved)


def join_keys(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row for each ``key``, as in
    :func:`join_groups`; how often a key occurs is counted first."""
    often = saved(rows.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")))
    total = often.agg(F.coalesce(F.sum("key_rows"), F.lit(0))).first()[0]
    return join_groups(rows, groups.join(often, key), key, "key_rows", total).drop("key_rows")


def frequent_keys(rows: DataFrame, key: str, total: int) -> list[tuple[int, int]]:
    """Keys that a sample shows often, each with a number of parts, a power of two, that leaves
    at most about a quarter of an even partition in one part. Keys: at most SAMPLED / SEEN_OFTEN
    and some; parts: in proportion to the partitions; whatever the input."""
    share = min(1.0, SAMPLED / max(1, total))
    seen = (rows.select(key).sample(share, 7).groupBy(key).count()
            .where(F.col("count") >= SEEN_OFTEN).limit(2 * SAMPLED // SEEN_OFTEN)).collect()
    wanted = 4 * partitions(rows.sparkSession) / max(1.0, share * total)
    return [(row[0], 1 << int(row[1] * wanted).bit_length()) for row in seen]


def with_bounds(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Saved ``rows`` with ``lo`` and ``hi``, the least and greatest ``value`` of their key.
    The keys are longs; neither they nor the values are null.

    Frequent keys are cut into parts. Their bounds come from a partial aggregation, and a row
    with the bounds joins each part, so no part needs the others. The sample decides the way,
    not the result.
    """
    frequent = frequent_keys(rows, key, rows.count())
    part, whole = F.lit(0), W.partitionBy(key, "part")
    spread = F.xxhash64(*rows.columns, F.spark_partition_id())
    for parts in sorted({n for _, n in frequent}):
        own = [k for k, n in frequent if n == parts]
        part = F.when(F.col(key).isin(own), F.pmod(spread, F.lit(parts)).cast("int")).otherwise(part)
    parted = rows.withColumns({"lo": F.col(value), "hi": F.col(value), "part": part})
    if frequent:
        sizes = rows.sparkSession.createDataFrame(frequent, f"{key} long, parts int")
        bounds = rows.where(F.col(key).isin([k for k, _ in frequent])).groupBy(key).agg(
            F.min(value).alias("lo"), F.max(value).alias("hi"))
        each = bounds.join(F.broadcast(sizes), key).select(
            key, "lo", "hi", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        parted = parted.unionByName(each, allowMissingColumns=True)
    bounded = parted.withColumns({"lo": F.min("lo").over(whole), "hi": F.max("hi").over(whole)})
    return bounded.where(F.col(value).isNotNull()).drop("part")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of saved ``links`` (a, b): the smallest node reachable.

    Each round hooks every node to its smallest neighbour, follows the hooks to their ends
    by doubling and contracts the links, so the nodes left at least halve.
    """
    spark = links.sparkSession
    links = saved(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    maps: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = saved(both.groupBy("a").agg(F.least("a", F.min("b")).alias("up")).withColumnRenamed("a", "node"))
        while True:
            ends = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = saved(join_keys(hooks, ends, "up").select("node", F.col("top").alias("up"),
                                                         (F.col("top") != F.col("up")).alias("moved")))
            still = not jumped.where("moved").isEmpty()
            hooks = jumped.select("node", "up")
            if not still:
                break
        maps.append(hooks)
        a = hooks.select(F.col("node").alias("a"), F.col("up").alias("new_a"))
        b = hooks.select(F.col("node").alias("b"), F.col("up").alias("new_b"))
        # A node may have any number of links as either end.
        moved = join_keys(saved(join_keys(links, a, "a")), b, "b").where("new_a <> new_b")
        links = saved(moved.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct())
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    found = maps[0].withColumnRenamed("up", "component")
    for hooks in maps[1:]:
        onward = hooks.select(F.col("node").alias("component"), "up")
        found = found.join(onward, "component", "left").select(
            "node", F.coalesce("up", "component").alias("component"))
    return saved(found)


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
