"""Structured Streaming: scored rows upserted per account, with running risk counts (M1, M2).

The state is a streaming aggregate in update mode: per account the newest successfully scored row (``max_by`` on SEQ; a
late, lower SEQ never overwrites) and the number of rows processed. It runs in the JVM, is combined before the shuffle
(a hot account costs one row for each task and micro-batch), and only the accounts of a micro-batch leave it.

``foreachBatch`` writes these accounts to a folder of their own and commits it to the sink's log
(:mod:`riskframe.streaming.commits`); a retried batch finds itself in the log, or writes anew, so the sink is exactly-once.
With its accounts a batch takes back what their old state had added to the risk counts and adds what the new one does
(retraction), so the log carries the counts of every version. For that it reads the old state of its accounts only: tables
are cut into ``BUCKETS`` folders by the key's hash, of which it reads those that it touches.

Reading combines the base and the changes of one version: the current table (M1) is the change with the largest row count
of each account (the count only grows). The risk counts (M2) are in the version itself. ``compact`` folds the changes into
a new base while the stream runs; readers go on with the version they have. A micro-batch folds them itself where there are
``FOLD`` of them, so neither a batch nor a reader meets more tables the longer the stream runs.

Failed rows (null or NaN score) count as processed but are never stored. The key has whatever type the schema gives it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.defaults import SCORE_MEDIUM
from riskframe.functions.bands import risk_band_score
from riskframe.streaming import commits

KEY = "ACCT_NBR"
LEVELS = ("high", "medium", "low")
COUNT_NAMES = (*LEVELS, "stored", "flagged", "processed")
#: Folders that a table is cut into by the key's hash.
BUCKETS, BUCKET = 16, "rf_bucket"
#: Change tables that a version may list; a micro-batch that makes as many folds them into a new base.
FOLD = 8


def latest_scored(rows: DataFrame, key: str = KEY) -> DataFrame:
    """Per account: SEQ and SCORE of the newest scored row (null: none yet), N_ROWS processed. Batch or stream."""
    score = F.when(~F.isnan("SCORE"), F.col("SCORE"))
    newest = F.max_by(F.struct(F.col("SEQ"), score.alias("SCORE")), F.when(score.isNotNull(), F.col("SEQ")))
    out = rows.groupBy(key).agg(newest.alias("_rf_r"), F.count(F.lit(1)).alias("N_ROWS"))
    return out.select(key, F.col("_rf_r.SEQ").alias("SEQ"), F.col("_rf_r.SCORE").alias("SCORE"), "N_ROWS")


def run_upsert_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    sink: str,
    checkpoint: str,
    score_fn,
    files_per_trigger: int | None = None,
    state_partitions: int | None = None,
) -> None:
    """M1 + M2: stream the files under ``source`` (``availableNow``), score each row with ``score_fn`` (DataFrame ->
    DataFrame adding SCORE, null on failure) and keep the latest scored row per account; changes go to ``sink``.
    One checkpoint belongs to one sink: batch numbers are those of the checkpoint.

    ``files_per_trigger`` limits a micro-batch (by default it takes all files there are). ``state_partitions`` fixes the
    number of state-store partitions when the query first starts (it cannot change later for the same checkpoint); by
    default the session's ``spark.sql.shuffle.partitions`` applies."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    latest = latest_scored(score_fn(reader.parquet(source)))
    key_conf = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key_conf)
    if state_partitions:
        spark.conf.set(key_conf, str(state_partitions))  # read once when the stream starts (session is cloned)
    try:
        q = (
            latest.writeStream.foreachBatch(lambda df, batch_id: write_batch(df, sink, batch_id))
            .option("checkpointLocation", checkpoint)
            .outputMode("update")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(key_conf, before)
    q.awaitTermination()


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int")


def _write(df: DataFrame, path: str, key: str) -> None:
    """One folder for each bucket of the key that occurs, so that a later batch reads back only the buckets it touches. A
    bucket's rows come together first (large ones are split), so there are as many files as the data need."""
    df.withColumn(BUCKET, _bucket(key)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)


def write_batch(changed: DataFrame, sink: str, batch_id: int, key: str = KEY) -> None:
    """foreachBatch body: the accounts of this micro-batch with their new state, and what they change in the counts.

    A batch that is in the log already is left as it is; one that failed before its commit left a folder that no version
    names. The old state of the batch's accounts comes from the version that the batch is committed on."""
    spark = changed.sparkSession
    log = commits.Log(spark, sink)
    if batch_id <= log.latest().last_batch:
        return
    folder = log.fresh(f"batch-{batch_id}")
    _write(changed.select(key, "SEQ", "SCORE", "N_ROWS"), log.full(folder), key)
    new = spark.read.schema(_stored_schema(changed, key)).parquet(log.full(folder))
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # BUCKETS numbers at most

    def change(at: commits.Version) -> commits.Version | None:
        if batch_id <= at.last_batch:
            return None
        old = _state(spark, log, at, key, touched)
        delta = _delta(new, old, key)
        added = ((batch_id, folder),) if touched else ()  # a batch without rows has no table
        return commits.Version(0, at.base, at.changes + added, batch_id, {n: at.counts.get(n, 0) + delta[n] for n in COUNT_NAMES})

    if len(log.commit(change).changes) >= FOLD:
        compact(spark, sink, key)


def _stored_schema(df: DataFrame, key: str) -> T.StructType:
    fields = [df.schema[c] for c in (key, "SEQ", "SCORE", "N_ROWS")]
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in fields], T.StructField(BUCKET, T.IntegerType())])


def _counted(sign: int) -> list[Column]:
    """The counts of rows with SCORE and N_ROWS, each times ``sign``."""
    stored, level = F.col("SCORE").isNotNull(), risk_band_score("SCORE")
    flags = {**{lv: stored & (level == lv) for lv in LEVELS}, "stored": stored, "flagged": F.col("SCORE") >= SCORE_MEDIUM}
    return [*[(F.when(c, sign).otherwise(0)).alias(n) for n, c in flags.items()], (F.col("N_ROWS") * sign).alias("processed")]


def _delta(new: DataFrame, old: DataFrame | None, key: str) -> dict[str, int]:
    """What these accounts add to the counts, less what their old state had added: a row of six numbers."""
    rows = new.select(*_counted(1))
    if old is not None:
        rows = rows.unionByName(old.join(new.select(key), key, "left_semi").select(*_counted(-1)))
    row = rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in COUNT_NAMES]).first()
    return {n: int(row[n]) for n in COUNT_NAMES}


def _state(spark: SparkSession, log: commits.Log, at: commits.Version, key: str = KEY, buckets: list[int] | None = None) -> DataFrame | None:
    """The last state of every account (of some buckets) in a version: key, SEQ, SCORE, N_ROWS."""
    folders = [log.full(f) for f in at.folders()]
    if not folders:
        return None
    rows, schema = None, None
    for f in folders:
        part = (spark.read.schema(schema) if schema else spark.read).parquet(f)
        schema = schema or part.schema  # all tables have the first one's: their files needn't be opened for it
        if buckets is not None:
            part = part.where(F.col(BUCKET).isin(buckets))
        part = part.select(key, "SEQ", "SCORE", "N_ROWS")
        rows = part if rows is None else rows.unionByName(part)
    last = rows.groupBy(key).agg(F.max_by(F.struct("SEQ", "SCORE", "N_ROWS"), F.col("N_ROWS")).alias("_rf_r"))
    return last.select(key, "_rf_r.SEQ", "_rf_r.SCORE", "_rf_r.N_ROWS")


def version(spark: SparkSession, sink: str) -> int:
    """The newest version's number, for readers that want to stay on it (0: nothing was committed)."""
    return commits.Log(spark, sink).latest().number


def _at(spark: SparkSession, sink: str, number: int | None) -> tuple[commits.Log, commits.Version]:
    log = commits.Log(spark, sink)
    at = log.latest() if number is None else log.read(number) if number else commits.Version()
    if at is None:
        raise ValueError(f"version {number} isn't in the log of {sink}")
    return log, at


def compact(spark: SparkSession, sink: str, key: str = KEY) -> str:
    """Folds base and changes of the newest version into a new base, while the stream may go on: batches that are committed
    meanwhile stay in the list after it. Readers of older versions keep theirs until ``vacuum``. Returns the sink."""
    log = commits.Log(spark, sink)
    seen = log.latest()
    state = _state(spark, log, seen, key)
    if state is not None and (seen.changes or not seen.base):
        folder = log.fresh("base")
        _write(state, log.full(folder), key)

        def change(at: commits.Version) -> commits.Version | None:
            if at.base != seen.base:
                return None  # another compaction was first
            return commits.Version(0, folder, at.changes[len(seen.changes) :], at.last_batch, at.counts)

        log.commit(change)
    return sink


def vacuum(spark: SparkSession, sink: str, keep: int = 10) -> list[str]:
    return commits.Log(spark, sink).vacuum(keep)


def current_table(spark: SparkSession, sink: str, key: str = KEY, number: int | None = None) -> DataFrame:
    """M1: latest scored row per account, with its level, in the newest version or in one that the reader names."""
    state = _state(spark, *_at(spark, sink, number), key)
    if state is None:
        return spark.createDataFrame([], f"{key} long, SEQ long, SCORE double, LEVEL string")
    return state.where(F.col("SCORE").isNotNull()).select(key, "SEQ", "SCORE", risk_band_score("SCORE").alias("LEVEL"))


def latest_counts(spark: SparkSession, sink: str, number: int | None = None) -> DataFrame:
    """M2: accounts by level, stored and flagged accounts, processed rows, as rows (NAME, N): read from the version's entry
    in the log, no table is scanned."""
    _, at = _at(spark, sink, number)
    return spark.createDataFrame([(n, at.counts[n]) for n in COUNT_NAMES if n in at.counts], "NAME string, N bigint")


def recounted(spark: SparkSession, sink: str, key: str = KEY, number: int | None = None) -> DataFrame:
    """The counts of a version from its whole state, as a check of the running ones."""
    state = _state(spark, *_at(spark, sink, number), key)
    if state is None:
        return spark.createDataFrame([], "NAME string, N bigint")
    c = state.select(*_counted(1)).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in COUNT_NAMES])
    pairs = ", ".join(f"'{n}', `{n}`" for n in COUNT_NAMES)
    return c.selectExpr(f"stack({len(COUNT_NAMES)}, {pairs}) AS (NAME, N)")
