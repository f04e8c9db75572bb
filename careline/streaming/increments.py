"""New report files to an upserted table, one micro-batch at a time."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from careline.operators.tables import save


def stream_upsert(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                  order: Sequence | None = None, by: Sequence[str] = ()) -> StreamingQuery:
    """Process what is available and stop, the way a daily job runs.

    A replayed batch upserts the same rows again, so the table is right after a
    failure.  ``order`` picks the surviving row of a key among the batch and what is
    stored, so a file that arrives late does not replace a newer row.  Rows with a NULL
    in the key are inserted, each time they are read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        save(transform(batch), path, keys, by, order)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
