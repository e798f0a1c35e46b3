"""Streams: deliveries of new versions and change records applied to a version table, and duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.arrays import arr_cat
from ..operators import history as H
from ..session import checkpoint_dir


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str, table: str) -> list[int]:
    """Numbers of the parts of a table that are completely written."""
    fs, p = _fs(spark, f"{root}/{table}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    done = [int(n.split("=")[1]) for n in names if n.startswith("batch=")]
    return sorted(n for n in done if fs.exists(_fs(spark, f"{root}/{table}/batch={n}/_SUCCESS")[1]))


def finished(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the batches whose closes, their last part, are completely written."""
    return _numbers(spark, root, "closes")


def _part(spark: SparkSession, root: str, table: str, numbers: list[int]) -> DataFrame:
    return spark.read.option("basePath", f"{root}/{table}").parquet(*[f"{root}/{table}/batch={n}" for n in numbers])


def snapshot(spark: SparkSession, root: str, before: int | None = None, base_before: int | None = None) -> DataFrame:
    """Version table under ``root`` after all finished batches, or those before a batch.

    ``base_before`` leaves out later bases, for writing them (again).

    The latest base, the versions inserted since and the closes since.  A close
    counts for versions that were there in its batch: a version that is removed
    and delivered again later stays.
    """
    limit = before if base_before is None else base_before
    base = max(n for n in _numbers(spark, root, "base") if limit is None or n < limit)
    done = [n for n in finished(spark, root) if n > base and (before is None or n < before)]
    rows = spark.read.parquet(f"{root}/base/batch={base}")
    if not done:
        return rows
    columns = rows.columns
    rows = rows.withColumn("_since", F.lit(base))
    if inserted := [n for n in _numbers(spark, root, "inserts") if n in set(done)]:
        rows = rows.unionByName(_part(spark, root, "inserts", inserted).select(*columns, F.col("batch").alias("_since")))
    # one close of a version a batch, so the array is no longer than the batches since the base
    one = F.struct("batch", "new_end", "added", "removed")
    closed = _part(spark, root, "closes", done).groupBy(H.ID, H.BEGIN).agg(F.array_sort(F.collect_list(one)).alias("_closes"))
    valid = F.filter("_closes", lambda c: c["batch"] >= F.col("_since"))
    rows = rows.join(closed, [H.ID, H.BEGIN], "left").withColumn("_closes", F.when(F.size(valid) > 0, valid))
    rows = rows.filter(~F.coalesce(F.exists("_closes", lambda c: c["removed"]), F.lit(False)))
    added = F.flatten(F.transform("_closes", lambda c: c["added"]))
    changed = {H.END: F.coalesce(F.element_at("_closes", -1)["new_end"], H.END),
               H.REASONS: F.when(F.size(added) > 0, arr_cat(H.REASONS, added)).otherwise(F.col(H.REASONS))}
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in columns])


def start_snapshot(versions: DataFrame, root: str, batch: int = -1) -> None:
    """Writes a version table as it is after ``batch`` as a base."""
    versions.write.mode("overwrite").parquet(f"{root}/base/batch={batch}")


def compact(spark: SparkSession, root: str, new_root: str) -> None:
    """Writes the table with all inserts and closes as the base of a new folder."""
    start_snapshot(snapshot(spark, root), new_root)


def expire(spark: SparkSession, root: str) -> None:
    """Deletes what lies before the last base but one; a batch that runs again still finds the state before it."""
    bases = _numbers(spark, root, "base")
    if len(bases) < 2:
        return
    for table in ("base", "inserts", "closes", "outcomes"):
        for n in _numbers(spark, root, table):
            if n < bases[-2] or (n == bases[-2] and table != "base"):
                fs, p = _fs(spark, f"{root}/{table}/batch={n}")
                fs.delete(p, True)


def outcomes(spark: SparkSession, root: str, *status: str) -> DataFrame:
    """Change records of all finished batches with batch, status and problem; those of the given ``status`` only."""
    out = _part(spark, root, "outcomes", finished(spark, root))
    return out.filter(F.col("status").isin(*status)) if status else out


def delivery(inserts: DataFrame, changes: DataFrame) -> DataFrame:
    """One table of new versions and change records, as a stream of deliveries carries them."""
    return inserts.select(F.struct("*").alias("insert")).unionByName(changes.select(F.struct("*").alias("change")), allowMissingColumns=True)


def apply_batch(batch: DataFrame, batch_id: int, root: str, delivery_time: str, keep_history: bool = True, compact_every: int = 50) -> None:
    """Applies one delivery in two phases: new versions go in, then change records close versions, the new ones included.

    Only new folders are written, so a batch that runs again after a failure
    works on the same state and gives the same result.  A version that is stored
    already is not inserted again.  Every change record goes to ``outcomes`` with
    its status, those that failed with their problem.
    """
    spark = batch.sparkSession
    before = snapshot(spark, root, before=batch_id)
    changes = batch
    if "insert" in batch.columns:
        new = batch.filter(F.col("insert").isNotNull()).select("insert.*").select(*before.columns)
        H.drop_known(new, before, (H.ID, H.BEGIN)).write.mode("overwrite").parquet(f"{root}/inserts/batch={batch_id}")
        before = before.unionByName(spark.read.schema(before.schema).parquet(f"{root}/inserts/batch={batch_id}"))
        changes = batch.filter(F.col("change").isNotNull()).select("change.*")
    H.plan_changes(changes, before, delivery_time, keep_history).write.mode("overwrite").parquet(f"{root}/outcomes/batch={batch_id}")
    planned = spark.read.parquet(f"{root}/outcomes/batch={batch_id}")
    H.planned_closes(planned, keep_history).write.mode("overwrite").parquet(f"{root}/closes/batch={batch_id}")
    if batch_id - max(n for n in _numbers(spark, root, "base") if n < batch_id) >= compact_every:
        start_snapshot(snapshot(spark, root, before=batch_id + 1, base_before=batch_id), root, batch_id)


def apply_stream(changes: DataFrame, root: str, delivery_time: str, keep_history: bool = True, checkpoint: str | None = None,
                 compact_every: int = 50):
    """Applies every micro batch of change records, or of deliveries (see ``delivery``), to the version table under ``root``.

    The base table is not rewritten for a batch: it adds a small table of new
    versions and one of closed versions.  After ``compact_every`` batches they
    are merged into a new base.  Returns the running query.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, root, delivery_time, keep_history, compact_every)

    return (changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint or f"{root}/_checkpoint")
            .trigger(availableNow=True).start())


def dedupe_stream(rows: DataFrame, keys: list[str], event_time: str, delay: str, path: str, checkpoint: str | None = None):
    """Writes each key once; repeats are known for at least ``delay`` of event time."""
    once = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return (once.writeStream.format("parquet").option("path", path).outputMode("append")
            .option("checkpointLocation", checkpoint or path + "_checkpoint").trigger(availableNow=True).start())


def run_folder(spark: SparkSession, name: str) -> str:
    """New folder for one run below the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
