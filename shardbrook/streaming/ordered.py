"""Ordered hand-off of a live stream: one processor for each shard, however long it lives."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shardbrook.schema import SHARD_KEYS
from shardbrook.streaming.handoff import ShardProcessor

# Bytes of waiting records that are one entry of the state.
CHUNK_BYTES = 4 << 20


def handoff_live(
    records: DataFrame,
    make_processor: Callable[[], ShardProcessor],
    schema: str | T.StructType,
    delay: str,
    columns: Sequence[str] = ("sequence_number", "data"),
    ends: str | None = None,
) -> DataFrame:
    """What ``ShardProcessor.process`` makes of every shard's records, in sequence order.

    Records may come in any order within ``delay``.  They wait in the shard's state until the
    watermark has passed their ``arrival_ts``; then those that are ready are handed over together,
    ordered by ``seq_key``, with ``columns`` and their 1-based ``position`` in the shard.  A
    record that comes again while it waits, or with a key at or below the last one handed
    over, is left out.

    ``init`` is called once for a shard, at its first record.  What the processor keeps in its
    attributes (they must be picklable) is part of the state, so it goes on after a restart
    and on another executor.  ``ends`` names a boolean column that marks the last record of a shard;
    after it ``shutdown`` is called, once, and only the fact that the shard has ended is kept.

    A shard is one task at a time, as order in it demands; its state holds the records of
    ``delay``, in chunks of ``CHUNK_BYTES``.  New records are added to it; it is read when some are
    ready, so a batch in which none is costs no more than its own records.  Where order within
    stretches is enough, ``handoff_ordered`` spreads a hot shard.
    """
    wanted = list(columns)
    key = records.select("seq_key", "arrival_ts", *wanted)
    kept = T.StructType([T.StructField("ready_ms", T.LongType()), *key.drop("arrival_ts").schema.fields])
    kept.add("is_last", T.BooleanType())
    names = kept.fieldNames()

    class Ordered(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            # A record by itself would be a call and a row of the state; a chunk is pickled rows.
            self.waiting = handle.getMapState("waiting", "chunk bigint", "rows binary")
            # The first moment when a record is ready, and how many chunks there are.
            self.timer = handle.getValueState("timer", "at bigint, chunks bigint")
            # The last key, how many were handed over, and what the processor remembers.
            self.shard = handle.getValueState(
                "shard", "last string, position bigint, memory binary, ended boolean"
            )

        def hand_over(self, key, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            processor = make_processor()
            if self.shard.exists():
                last, position, memory, ended = self.shard.get()
                if ended:
                    return
                vars(processor).update(pickle.loads(memory))
                rows = rows[rows["seq_key"] > last]
            else:
                position = 0
                processor.init(key[1])
            rows = rows.sort_values("seq_key").drop_duplicates("seq_key")
            closing = rows["is_last"].fillna(False).astype(bool).to_numpy()
            if closing.any():
                rows = rows.iloc[: closing.argmax() + 1]
            if len(rows):
                last = rows["seq_key"].iloc[-1]
                given = rows[wanted].reset_index(drop=True)
                given["position"] = range(position + 1, position + 1 + len(rows))
                result = processor.process(given)
                if result is not None and len(result):
                    yield result
            if closing.any():
                processor.shutdown()
                self.shard.update((last, position + len(rows), b"", True))
            elif len(rows):
                memory = pickle.dumps(vars(processor))
                self.shard.update((last, position + len(rows), memory, False))

        def keep(self, rows: pd.DataFrame, chunks: int) -> int:
            """Add rows to those that wait; how many chunks there are then."""
            size = rows.memory_usage(index=False, deep=True).sum()
            step = max(1, len(rows) * CHUNK_BYTES // max(1, size))
            for begin in range(0, len(rows), step):
                part = rows.iloc[begin : begin + step]
                self.waiting.updateValue((chunks,), (pickle.dumps(part),))
                chunks += 1
            return chunks

        def wait(self, at: int | None, chunks: int) -> None:
            """Set the timer for the first record that is ready."""
            was = self.timer.get()[0] if self.timer.exists() else None
            self.timer.update((at, chunks))
            if was == at:
                return
            if was is not None:
                self.handle.deleteTimer(was)
            if at is not None:
                self.handle.registerTimer(at)

        def release(self, key, chunks: int, watermark: int) -> Iterator[pd.DataFrame]:
            """Hand over what the watermark has passed; the rest waits for the next timer."""
            stored = (pickle.loads(self.waiting.getValue((i,))[0]) for i in range(chunks))
            rows = pd.concat(stored, ignore_index=True)
            ready = rows["ready_ms"] <= watermark
            rest = rows[~ready]
            if ready.any():
                yield from self.hand_over(key, rows[ready])
            self.waiting.clear()
            first = rest["ready_ms"].min()
            self.wait(None if pd.isna(first) else int(first), self.keep(rest, 0))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            # The watermark is that of the batches before; none is ready sooner than it.
            at, chunks = self.timer.get() if self.timer.exists() else (None, 0)
            for come in rows:
                chunks = self.keep(come[names], chunks)
                first = come["ready_ms"].min()
                if not pd.isna(first) and (at is None or first < at):
                    at = int(first)
            watermark = timerValues.getCurrentWatermarkInMs()
            if at is not None and at <= watermark:
                yield from self.release(key, chunks, watermark)
            else:
                self.wait(at, chunks)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            chunks = self.timer.get()[1] if self.timer.exists() else 0
            if chunks:
                yield from self.release(key, chunks, timerValues.getCurrentWatermarkInMs())

        def close(self) -> None:
            pass

    # The first whole millisecond that is not before the arrival.
    ready = F.ceil(F.unix_micros("arrival_ts") / 1000).cast("bigint")
    return (
        records.withWatermark("arrival_ts", delay)
        .select(
            *(F.col(c).alias(f"of_{c}") for c in SHARD_KEYS),
            "arrival_ts",
            ready.alias("ready_ms"),
            "seq_key",
            *wanted,
            (F.col(ends) if ends else F.lit(False)).alias("is_last"),
        )
        .groupBy(*(f"of_{c}" for c in SHARD_KEYS))
        .transformWithStateInPandas(Ordered(), schema, "Append", "EventTime")
    )
