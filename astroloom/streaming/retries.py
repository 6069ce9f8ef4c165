"""Tiles that are tried again: keyed state with attempts and the time of the next one.

A request for a tile is tried at once. If its files aren't there yet, the tile waits in the state and is tried again when its timer ends, until it is
ready or the attempts are used up. State and timers live in the checkpoint, so a stream that restarts goes on counting where it stopped.
Only keys and counts are in the state; what is made of a ready tile is the work of the batch that gets its row.

Defined results: a tile asked for again while it waits is tried once more at its timer, not sooner; one asked for after its end starts anew;
null keys are a tile of their own, which ready() judges; a test that raises counts as an attempt that failed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Attempts at a tile, and seconds from one to the next.
ATTEMPTS, PAUSE = 3, 5.0


def tried(requests: DataFrame, key: list[str], ready: Callable[[tuple], bool], attempts: int = ATTEMPTS, pause: float = PAUSE) -> DataFrame:
    """key, status (ready or failed) and attempts of each tile, once it is known. requests: a stream with the key columns; ready: whether the files of a key are there, called in the tasks."""
    kept = requests.select(*key)
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def attempt(own: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        for _ in rows:  # a request says no more than its key
            pass
        used = state.get[0] if state.exists else 0
        if used and not state.hasTimedOut:  # asked for again while it waits
            state.setTimeoutDuration(max(1, int(pause * 1000)))
            return
        try:
            done = bool(ready(own))
        except Exception:  # a store that can't be reached is a failed attempt
            done = False
        used += 1
        if done or used >= attempts:
            if state.exists:
                state.remove()
            yield pd.DataFrame([(*own, "ready" if done else "failed", used)], columns=[*key, "status", "attempts"])
            return
        state.update((used,))
        state.setTimeoutDuration(max(1, int(pause * 1000)))

    return kept.groupBy(*key).applyInPandasWithState(attempt, f"{typed}, status string, attempts int", "attempts int", "append", GroupStateTimeout.ProcessingTimeTimeout)


def retried(requests: DataFrame, key: list[str], ready: Callable[[tuple], bool], made: Callable[[DataFrame], DataFrame], out: str, status: str, checkpoint: str, attempts: int = ATTEMPTS, pause: float = PAUSE, every: str = "1 second") -> StreamingQuery:
    """A stream that writes made(tiles that are ready) to out and each tile's end to status, both in a folder for each batch, so that a batch that runs again replaces its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        known = batch.persist()  # the attempts of a batch are made once
        try:
            if not known.count():  # runs all partitions, so that all state is stored
                return
            made(known.where("status = 'ready'").select(*key)).write.mode("overwrite").parquet(f"{out}/batch={number}")
            known.write.mode("overwrite").parquet(f"{status}/batch={number}")
        finally:
            known.unpersist()

    return tried(requests, key, ready, attempts, pause).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
