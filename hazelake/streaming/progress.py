"""What each batch of a stream read, rejected and wrote."""

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

logger = logging.getLogger(__name__)

_METRICS = "hazelake_rows"


class BatchCounts(NamedTuple):
    """Rows of one batch; ``written`` is None where the sink does not tell."""

    batch: int
    read: int
    rejected: int
    written: int | None


def counted(judged: DataFrame) -> DataFrame:
    """A stream of judged rows whose rows and rejects are observed as they pass, without a pass of their own."""
    rejected = F.count_if(F.col("reason").isNotNull())
    return judged.observe(_METRICS, F.count(F.lit(1)).alias("read"), rejected.alias("rejected"))


class BatchLog(StreamingQueryListener):
    """Logs the counts of every batch of the streams whose rows went through :func:`counted`.

    Add it by ``spark.streams.addListener``. ``batches`` holds one entry per batch, the last one where a batch was repeated.
    """

    def __init__(self):
        self.batches: dict[int, BatchCounts] = {}
        self._written: dict[int, int] = {}

    def wrote(self, batch_id: int, rows: int) -> None:
        """The sink says how many rows it wrote; it does so before the batch is reported."""
        self._written[batch_id] = rows

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(_METRICS)
        if seen is None:
            return
        batch = event.progress.batchId
        self.batches[batch] = BatchCounts(batch, seen.read, seen.rejected, self._written.get(batch))
        logger.info("Batch %s: %s rows read, %s rejected, %s written", *self.batches[batch])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
