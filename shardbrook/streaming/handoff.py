"""Hand records to user code, in batches or in shard order."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shardbrook.operators.intervals import PROCESS
from shardbrook.operators.positions import (
    LATEST,
    TRIM_HORIZON,
    freeze_tips,
    resume_or_start,
    start_at,
)
from shardbrook.operators.progress import latest_checkpoints
from shardbrook.operators.running import shard_positions
from shardbrook.schema import PROGRESS, SAMPLE, SHARD_KEYS
from shardbrook.sources.progress_table import add_updates, next_number, read_progress
from shardbrook.storage import write_once
from shardbrook.streaming.runner import start
from shardbrook.streaming.timing import BatchTimes

BatchFunction = Callable[[DataFrame, int], None]
CheckpointFunction = Callable[[DataFrame], DataFrame]


def start_handoff(
    records: DataFrame,
    process: BatchFunction,
    *,
    checkpoint: str,
    progress_path: str | None = None,
    writer: str | None = None,
    checkpoints_of: CheckpointFunction | None = latest_checkpoints,
    resume: bool = False,
    position: str = TRIM_HORIZON,
    log: DataFrame | None = None,
    times: BatchTimes | None = None,
    fold_every: int = 100,
    **trigger,
) -> StreamingQuery:
    """Call ``process(batch, batch_id)`` for every micro-batch of a stream.

    ``process`` must accept an empty batch.  After it returns, progress is
    written to ``progress_path``: by default the last record of each shard in
    the batch; for that the batch's keys are read a second time.  ``checkpoints_of``
    replaces that (return ``stream, shard_id, sequence_id`` and optionally
    ``closed``); None turns it off.

    With ``resume`` a new stream hands over only records after the progress stored
    at its first start; that is kept beside ``checkpoint``, so a restart skips the
    same ones.  Shards without progress, or all without ``resume``, begin at ``position``:
    TRIM_HORIZON or LATEST.  LATEST needs ``log``, a batch read of the same log; its tips are
    taken at the first start and kept in the same way.

    After every ``fold_every`` batches the writer's progress is folded
    (``progress_table.fold_updates``).

    ``times`` measures every batch (``timing``); for that the batch's shards are read once
    more.

    Delivery is at least once: a batch whose run was cut short is handed over
    again under the same number, and leaves the same progress.  Recovery follows
    Spark's own ``checkpoint``; the progress table is output.  An error in
    ``process`` or in writing progress fails the batch.
    """
    spark = records.sparkSession
    first = 0
    if progress_path and checkpoints_of:
        # A new stream goes on from the writer's numbers in the table, and a
        # restarted one must find the number it began with.
        def following() -> DataFrame:
            return spark.sql(f"SELECT {next_number(spark, progress_path, writer)}L AS first")

        base = write_once(
            spark, f"{checkpoint.rstrip('/')}.progress_base", "first bigint", following
        )
        first = base.first()[0]

    beside = checkpoint.rstrip("/")
    tips = None
    if position == LATEST:
        if log is None:
            raise ValueError("LATEST needs a batch read of the log")
        tips = freeze_tips(log, f"{beside}.tips")
    if resume:
        if not progress_path:
            raise ValueError("resume needs the path of a progress table")
        bounds = write_once(
            spark, f"{beside}.resumed_from", PROGRESS, lambda: read_progress(spark, progress_path)
        )
        records = resume_or_start(records, bounds, position, tips)
    else:
        records = start_at(records, position, tips)

    if times:
        records = times.observed(records)

    def run(batch: DataFrame, batch_id: int) -> None:
        process(batch, batch_id)
        if times:
            times.add_shards(batch, batch_id)
        if progress_path and checkpoints_of:
            commit_progress(
                checkpoints_of(batch), progress_path, first + batch_id, writer, fold_every
            )

    writer_of = records.writeStream.foreachBatch(run)
    if times:
        writer_of = writer_of.queryName(times.name)
    return start(writer_of, checkpoint, spark, **trigger)


def commit_progress(
    updates: DataFrame,
    path: str,
    number: int,
    writer: str | None = None,
    fold_every: int | None = None,
) -> None:
    """Add a batch's checkpoints under its number; a replay changes nothing."""
    add_updates(updates, path, number, writer, fold_every)


class ShardProcessor:
    """User code for ordered hand-off; subclass, or write the same three methods.

    One object serves one task.  ``init`` is called when a shard (or the next
    stretch of one) begins, ``process`` with records of that shard in sequence
    order, ``shutdown`` once at the end.  As with all Python code on Spark, a
    class from a module needs that module on the executors.
    """

    def init(self, shard_id: str) -> None:
        pass

    def process(self, batch: pd.DataFrame) -> pd.DataFrame | None:
        raise NotImplementedError

    def shutdown(self) -> None:
        pass


def handoff_ordered(
    records: DataFrame,
    make_processor: Callable[[], ShardProcessor],
    schema: T.StructType | str | None = None,
    whole_shards: bool = False,
    digits: int | None = None,
    partitions: int | None = None,
    columns: Sequence[str] | None = None,
    target_records: int = 250_000,
) -> DataFrame:
    """Hand every shard's records to a ``ShardProcessor`` in sequence order.

    A shard is cut into stretches of sequence numbers, handled by different
    tasks; each record carries its 1-based ``position`` in the whole shard, and
    ``init`` is called per stretch.  That keeps a hot shard from becoming one
    task.  ``target_records`` and ``digits`` set the length of a stretch as in
    ``shard_positions``; a task sorts at least a whole stretch, payloads included, so it is
    shorter here.

    With ``whole_shards`` a shard goes to one task and is not numbered, in
    ``partitions`` tasks at most.  Use it on micro-batches, whose size the
    trigger bounds, when the processor must see a shard unbroken.

    ``columns`` limits what is sent to Python; all columns by default.

    ``schema`` describes what ``process`` returns.  Without it the result is one
    SAMPLE row per call: the time ``process`` took, in whole milliseconds.
    """
    wanted = list(columns or [*records.columns, *([] if whole_shards else ["position"])])
    if whole_shards:
        by = list(SHARD_KEYS)
        spread = records.repartition(*([partitions] if partitions else []), *by)
        # Built on the partitioning that is there already.
        in_order = Window.partitionBy(*by).orderBy("seq_key")
        ordered = spread.withColumn(
            "_starts", F.lag(F.lit(True)).over(in_order).isNull()
        ).sortWithinPartitions(*by, "seq_key")
    else:
        # In order as it is: another sort would hold a stretch in memory once more.
        ordered = shard_positions(records, digits, target_records, starts="_starts")
        if partitions:
            by = [*SHARD_KEYS, "_stretch"]
            ordered = ordered.repartition(partitions, *by).sortWithinPartitions(*by, "position")
    ordered = ordered.select(
        *wanted,
        "_starts",
        F.col("shard_id").alias("_shard"),
        *([F.col("stream").alias("_stream")] if schema is None else []),
    )
    timings = schema is None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        processor = make_processor()
        try:
            for batch in batches:
                starts = batch["_starts"].to_numpy()
                cuts = sorted({0, *starts.nonzero()[0].tolist()}) if len(batch) else []
                given = batch[wanted]
                for begin, end in zip(cuts, [*cuts[1:], len(batch)]):
                    if starts[begin]:
                        processor.init(batch["_shard"].iloc[begin])
                    began = time.monotonic_ns()
                    result = processor.process(given.iloc[begin:end])
                    spent = float((time.monotonic_ns() - began) // 1_000_000)
                    if timings:
                        yield pd.DataFrame(
                            {
                                "stream": [batch["_stream"].iloc[begin]],
                                "shard_id": [batch["_shard"].iloc[begin]],
                                "ts": [pd.Timestamp.now(tz="UTC")],
                                "metric": [PROCESS],
                                "value": [spent],
                            }
                        )
                    elif result is not None:
                        yield result
        finally:
            processor.shutdown()

    return ordered.mapInPandas(run, SAMPLE if timings else schema)

