"""Stored tables that change: upserts that rewrite a few buckets, and what differs between two snapshots.

**Buckets.** A stored table is dealt over buckets by a hash of its key, each a folder of Parquet, and a manifest names the
folders of one version. An upsert rewrites the buckets that hold a key of it, beside the old ones, and commits by
creating the next manifest; whoever reads an older one keeps reading it. Of two upserts of one version the second
to commit fails, and its folders are never named.

**Hash trees.** A snapshot is dealt over leaves, ranges of a hash of its key, and has a digest for each leaf and
for each node above, of ``FAN`` children each. Two snapshots are compared from the root down where digests
differ, and only rows of differing leaves are read.

Cases: a key that stands twice, in a table or an upsert, fails, as does a null key; an empty upsert makes no version; an empty
table has buckets without folders; columns are those of the table, and names that begin with ``_bucket`` or ``_leaf`` are this module's.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carrel.operators.guards import DataError, fail_if_any

FAN = 16  #: children of a node
ASKED = 1024  #: leaves that are asked for by name; more are joined


def _file(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _manifests(spark: SparkSession, path: str) -> list[int]:
    system, where = _file(spark, f"{path}/manifests")
    return sorted(int(f.getPath().getName()) for f in system.listStatus(where)) if system.exists(where) else []


def _commit(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    system, where = _file(spark, f"{path}/manifests/{version:010d}")
    try:
        out = system.create(where, False)
    except Exception as e:
        if "already exists" in str(e):
            raise DataError(f"version {version} is there already: another upsert was first") from e
        raise
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """The newest manifest, or that of a version: version, key, schema, buckets, folders by bucket."""
    found = _manifests(spark, path)
    if not found or version is not None and version not in found:
        raise DataError(f"no version {version or ''} of {path}")
    text = spark.read.text(f"{path}/manifests/{found[-1] if version is None else version:010d}", wholetext=True).first()[0]
    return json.loads(text)


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _checked(rows: DataFrame, key: list[str], what: str) -> None:
    fail_if_any(rows.filter(F.array_contains(F.array(*(F.col(k).isNull() for k in key)), True)), f"{what} holds a null key")
    fail_if_any(rows.groupBy(*key).count().filter("count > 1"), f"{what} holds a key twice")


def _written(rows: DataFrame, path: str, key: list[str], buckets: int) -> dict[str, str]:
    """The folder of each bucket that rows were written to."""
    folder = f"{path}/data/{uuid.uuid4().hex}"
    dealt = rows.withColumn("_bucket", _bucket(key, buckets))
    dealt.repartition("_bucket").write.partitionBy("_bucket").parquet(folder)
    system, where = _file(rows.sparkSession, folder)
    names = [f.getPath().getName() for f in system.listStatus(where)]
    return {n.removeprefix("_bucket="): f"{folder}/{n}" for n in names if n.startswith("_bucket=")}


def create(rows: DataFrame, path: str, key: list[str], buckets: int = 64) -> dict:
    """Stores a table; returns its first manifest."""
    _checked(rows, key, "a table")
    made = {"version": 0, "key": key, "schema": rows.schema.json(), "buckets": buckets, "folders": _written(rows, path, key, buckets)}
    _commit(rows.sparkSession, path, 0, made)
    return made


def read(spark: SparkSession, told: dict, buckets: list[str] | None = None) -> DataFrame:
    """The rows that a manifest names, or those of some buckets."""
    schema = T.StructType.fromJson(json.loads(told["schema"]))
    folders = [f for b, f in told["folders"].items() if buckets is None or b in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert(new: DataFrame, path: str, base: dict | None = None) -> dict:
    """Puts ``new`` in place of rows of equal key of version ``base`` (the newest one); returns the new manifest.

    ``rewritten`` names the buckets that were read and written; the driver knows buckets, no keys.
    """
    spark = new.sparkSession
    told = base or manifest(spark, path)
    schema = T.StructType.fromJson(json.loads(told["schema"]))
    new = new.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
    key = told["key"]
    _checked(new, key, "an upsert")
    hit = sorted(str(r[0]) for r in new.select(_bucket(key, told["buckets"])).distinct().collect())
    if not hit:
        return told
    kept = read(spark, told, hit).join(new.select(*key), key, "left_anti").select(*schema.names)
    folders = _written(kept.unionByName(new), path, key, told["buckets"])
    made = told | {"version": told["version"] + 1, "folders": told["folders"] | folders, "rewritten": hit}
    _commit(spark, path, made["version"], made)
    return made


def snapshot(rows: DataFrame, path: str, key: list[str], levels: int = 3) -> None:
    """Writes a snapshot of ``FAN ** levels`` leaves and its tree (level, node, n, digest); level 0 is the root."""
    _checked(rows, key, "a snapshot")
    leaves = FAN**levels
    leaf = F.pmod(F.xxhash64(*key), F.lit(leaves)).cast("int")
    row = F.xxhash64(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}))
    dealt = rows.withColumns({"_leaf": leaf, "_leaf_row": row}).withColumn("_leaf_top", F.floor(F.col("_leaf") / FAN ** (levels - 1)).cast("int"))
    dealt.repartition("_leaf_top", "_leaf").sortWithinPartitions("_leaf").write.partitionBy("_leaf_top").parquet(f"{path}/rows")
    # sums of the rows' hashes and of these mixed anew: equal for equal rows in any order
    found = rows.sparkSession.read.schema(dealt.schema).parquet(f"{path}/rows")
    sums = [F.sum(F.col("_leaf_row").cast("decimal(38,0)")).cast("string"), F.sum(F.xxhash64("_leaf_row").cast("decimal(38,0)")).cast("string")]
    tree = now = found.groupBy(F.lit(levels).alias("level"), F.col("_leaf").alias("node")).agg(F.count("*").alias("n"), F.sha2(F.concat_ws("/", *sums), 256).alias("digest"))
    for level in reversed(range(levels)):
        parts = F.array_sort(F.collect_list(F.struct("node", "digest")))
        now = now.groupBy(F.lit(level).alias("level"), F.floor(F.col("node") / FAN).cast("int").alias("node")).agg(F.sum("n").alias("n"), F.sha2(F.to_json(parts), 256).alias("digest"))
        tree = tree.unionByName(now)
    tree.write.parquet(f"{path}/tree")
    about = json.dumps([key, levels, dealt.schema.json()])
    rows.sparkSession.createDataFrame([(about,)], "about string").coalesce(1).write.parquet(f"{path}/about")


def differing_leaves(spark: SparkSession, old: str, new: str) -> DataFrame:
    """(leaf) of two snapshots' trees, from the root down where they differ."""
    (_, levels, _), (_, other, _) = (json.loads(spark.read.parquet(f"{p}/about").first()[0]) for p in (old, new))
    if levels != other:
        raise ValueError("snapshots of different levels can't be compared")
    schema = "level int, node int, n long, digest string"
    a, b = (spark.read.schema(schema).parquet(f"{p}/tree") for p in (old, new))
    open_ = spark.createDataFrame([(0,)], "node int")
    for level in range(levels + 1):
        x = a.filter(F.col("level") == level).join(open_, "node", "left_semi").select("node", F.col("digest").alias("x"))
        y = b.filter(F.col("level") == level).join(open_, "node", "left_semi").select("node", F.col("digest").alias("y"))
        differ = x.join(y, "node", "full_outer").filter(~F.col("x").eqNullSafe(F.col("y"))).select("node")
        open_ = differ if level == levels else differ.select(F.explode(F.sequence(F.col("node") * FAN, F.col("node") * FAN + FAN - 1)).alias("node"))
    return open_.select(F.col("node").alias("leaf"))


def changes(spark: SparkSession, old: str, new: str) -> DataFrame:
    """(key..., change): added, removed or changed rows between two snapshots, of the differing leaves alone."""
    key, levels, kind = json.loads(spark.read.parquet(f"{old}/about").first()[0])
    leaves = differing_leaves(spark, old, new)
    few = [r.leaf for r in leaves.limit(ASKED + 1).collect()]

    def side(path: str, name: str) -> DataFrame:
        rows = spark.read.schema(T.StructType.fromJson(json.loads(json.loads(spark.read.parquet(f"{path}/about").first()[0])[2]))).parquet(f"{path}/rows")
        if len(few) <= ASKED:
            rows = rows.filter(F.col("_leaf").isin(few) & F.col("_leaf_top").isin(sorted({x // FAN ** (levels - 1) for x in few})))
        else:
            rows = rows.join(leaves.withColumnRenamed("leaf", "_leaf"), "_leaf", "left_semi")
        return rows.select(*key, F.col("_leaf_row").alias(name))

    both = side(old, "_old").join(side(new, "_new"), key, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    return both.select(*key, F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed").alias("change"))
