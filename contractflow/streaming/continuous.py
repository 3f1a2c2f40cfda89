"""Continuous medallion: contracts applied to every micro-batch of landed files."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contract import Contract
from ..plans.pipeline import run_contract
from ..sinks.tables import Tables

# Fixed value: pause between runs of the continuous loop.
LOOP_INTERVAL = "300 seconds"

BatchHandler = Callable[[DataFrame, int], None]


def contract_batches(tables: Tables, contract: Contract, stream: str, *,
                     on_error: Callable[[Exception, int], None] | None = None) -> BatchHandler:
    """A ``foreachBatch`` handler that runs one contract on each micro-batch.

    ``stream`` names the stream: batch numbers of two streams, or of a stream with a new checkpoint, are different runs. A
    redelivered batch is harmless: merges are keyed, and a run first looks for its id in the run log and removes what a
    broken attempt left. With ``on_error`` the rows of a failed batch go to ``dead_<contract>`` as JSON, with the run and
    the error, before it is reported and the stream goes on; if even that fails, the stream stops.
    """
    name = hashlib.sha256(stream.encode()).hexdigest()[:16]

    def handle(batch: DataFrame, batch_id: int) -> None:
        try:
            # The batch lives in its own copy of the session.
            session = batch.sparkSession
            run_contract(session, contract, Tables(session, tables.root), {"source": batch},
                         run_id=f"{name}-batch-{batch_id}", once=True)
        except Exception as error:  # noqa: BLE001 - the caller decides
            if on_error is None:
                raise
            letters = Tables(batch.sparkSession, tables.root)
            dead, run = f"dead_{contract.name}", f"{name}-batch-{batch_id}"
            letters.forget_runs(dead, "run_id", [run])
            letters.append(dead, batch.select(
                F.lit(run).alias("run_id"), F.lit(str(error)[:2000]).alias("error"), F.to_json(F.struct(*batch.columns)).alias("row")))
            on_error(error, batch_id)

    return handle


def start_contract_stream(tables: Tables, contract: Contract, source: DataFrame,
                          checkpoint: str, *, available_now: bool = False, trigger: str = LOOP_INTERVAL,
                          on_error: Callable[[Exception, int], None] | None = None) -> StreamingQuery:
    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        contract_batches(tables, contract, checkpoint, on_error=on_error)
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()


def run_until(query: StreamingQuery, seconds: float) -> bool:
    """Let a query run until a deadline, then stop it. True if it ended by itself."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)
