"""A quality gate in a stream: a micro-batch is published as a whole or not at all."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.quality import QualityGateFailed, Rule, failures, observed
from tidemart.sources.scratch import materialise
from tidemart.sources.tables import add_rows

BATCH, REASONS = "_batch", "_reasons"


def gate_batch(
    batch: DataFrame, batch_id: int, suite: Sequence[Rule], path: str, quarantine: str, source: str
) -> list:
    """Publish a batch that passes, set aside one that fails; the failed results. A repeated batch is not added again.

    The batch is written to scratch once; row rules are counted on the way, and only what has been measured is published.
    """
    counted, results = observed(batch, suite)
    rows = materialise(counted, "gated-batch")
    failed = failures(results(rows))
    if failed:
        reasons = F.array(*[F.lit(f"{f['rule']} on {f['column'] or 'table'}: {f['detail']}") for f in failed])
        add_rows(rows.withColumns({BATCH: F.lit(batch_id).cast("long"), REASONS: reasons}), quarantine, source, batch_id)
    else:
        add_rows(rows, path, source, batch_id)
    return failed


def stream_gated(
    stream: DataFrame,
    suite: Sequence[Rule],
    path: str,
    quarantine: str,
    checkpoint: str,
    every: str | None = None,
    stop: bool = True,
) -> StreamingQuery:
    """Append each micro-batch that passes the suite to the table at `path`.

    A batch that fails goes to the table at `quarantine`, with its number in `_batch` and what failed in `_reasons`, and ends the query
    with `QualityGateFailed`: later batches wait. Started again, the query meets that batch again: with a suite that it passes, it
    is published; with `stop=False` failing batches are set aside and the stream goes on.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        failed = gate_batch(batch, batch_id, suite, path, quarantine, checkpoint)
        if failed and stop:
            raise QualityGateFailed(failed)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
