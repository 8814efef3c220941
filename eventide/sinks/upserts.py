"""Upsert table of plain files (K5): newest row per key, under numbered manifests.

Rows lie in ``n_buckets`` buckets by a hash of their key. A manifest, one small
JSON file per version that never changes, names the folder of every bucket. A
merge reads only the buckets that its batch touches, keeps the newest row per
key by ``order`` (a stored row loses only to one that is at least as new),
writes those buckets to a folder of its own and then creates the manifest of
the next number. Creating it fails if another writer came first, which starts
the merge anew on that writer's version; a crash before leaves a folder that
no manifest names, and the table as it was. A manifest also notes the last
batch of every stream, so a replayed batch changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .writers import for_each_batch

N_BUCKETS = 64
_BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer committed this version first."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def manifest(spark: SparkSession, target: str) -> dict | None:
    """The newest manifest; None if there is no table yet. One whose writer died half way does not count."""
    fs, p = _fs(spark, f"{target}/_manifests")
    if not fs.exists(p):
        return None
    for name in sorted((s.getPath().getName() for s in fs.listStatus(p)), reverse=True):
        try:
            found = json.loads(_read_text(spark, f"{target}/_manifests/{name}"))
        except ValueError:
            continue
        return found
    return None


def commit(spark: SparkSession, target: str, new: dict) -> None:
    """Create the manifest of ``new['version']``; ``Conflict`` if that version exists."""
    path = f"{target}/_manifests/{new['version']:012d}.json"
    fs, p = _fs(spark, path)
    if fs.exists(p):
        try:
            json.loads(_read_text(spark, path))
        except ValueError:
            fs.delete(p, False)  # of a writer that died half way
    try:
        out = fs.create(p, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            raise Conflict(path) from None
        raise
    out.write(bytearray(json.dumps(new).encode()))
    out.close()


def latest_per_key(df: DataFrame, key, order: str) -> DataFrame:
    """Newest row per key by ``order`` (NULL is oldest; ties: any). An aggregate, merged map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(order)).alias("_r"))
    return newest.select(*[F.col(f"_r.`{c}`").alias(c) for c in df.columns])


def upsert_into(target: str, batch: DataFrame, key, order: str, name: str = "", batch_id: int | None = None,
                n_buckets: int = N_BUCKETS) -> None:
    """Merge ``batch`` into the table at ``target``: per key the newest row by ``order`` stays.

    ``name`` and ``batch_id`` identify a micro-batch: once merged it is not
    merged again.
    """
    spark = batch.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    while True:
        old = manifest(spark, target) or {"version": -1, "n_buckets": n_buckets, "buckets": {}, "batches": {}}
        if batch_id is not None and old["batches"].get(name, -1) >= batch_id:
            return
        try:
            commit(spark, target, _merged(spark, target, old, batch, keys, order, name, batch_id))
            return
        except Conflict:
            continue


def _merged(spark, target, old, batch, keys, order, name, batch_id) -> dict:
    """Write the buckets that ``batch`` touches, merged with what they hold, and return the next manifest."""
    number = F.pmod(F.xxhash64(*keys), F.lit(old["n_buckets"])).cast("int")
    fresh = latest_per_key(batch, keys, order).withColumn("_new", F.lit(1))
    touched = [r[0] for r in batch.select(number.alias("b")).distinct().collect()]  # at most n_buckets
    held = [f"{target}/{old['buckets'][str(b)]}" for b in touched if str(b) in old["buckets"]]
    rows = fresh
    if held:
        rows = spark.read.parquet(*held).withColumn("_new", F.lit(0)).unionByName(fresh, allowMissingColumns=True)
    cols = [c for c in rows.columns if c != "_new"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(order, "_new")).alias("_r")).select(
        *[F.col(f"_r.`{c}`").alias(c) for c in cols])
    folder = f"data/{old['version'] + 1:012d}-{uuid.uuid4().hex}"
    if touched:
        newest.withColumn(_BUCKET, number).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{target}/{folder}")
    return {"version": old["version"] + 1, "n_buckets": old["n_buckets"],
            "buckets": old["buckets"] | {str(b): f"{folder}/{_BUCKET}={b}" for b in touched},
            "batches": old["batches"] | ({name: batch_id} if batch_id is not None else {})}


def upsert(df: DataFrame, key, order: str, target: str, name: str = "upsert",
           trigger: dict | None = None, n_buckets: int = N_BUCKETS):
    """Upsert-mode sink: each micro-batch is merged once."""
    return for_each_batch(df, lambda b, i: upsert_into(target, b, key, order, name, i if df.isStreaming else None, n_buckets), name,
                          output_mode="update" if df.isStreaming else "append", trigger=trigger)


def read_upserted(spark: SparkSession, target: str) -> DataFrame:
    found = manifest(spark, target)
    return spark.read.parquet(*[f"{target}/{f}" for f in sorted(set(found["buckets"].values()))])
