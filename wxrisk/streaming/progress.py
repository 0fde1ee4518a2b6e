"""Run-time figures of streaming queries."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from wxrisk.session import file_system


@dataclass
class Figures:
    """Running sums over all batches; ``rate_sum`` and ``rate_peak`` are of the rates of single batches."""

    batches: int = 0
    rows: int = 0
    errors: int = 0
    seconds: float = 0.0
    last_batch: str | None = None
    rate_sum: float = 0.0
    rate_peak: float = 0.0

    @property
    def per_second(self) -> float:
        return self.rows / self.seconds if self.seconds > 0 else 0.0

    @property
    def per_minute(self) -> float:
        return self.per_second * 60

    @property
    def mean_rate(self) -> float:
        return self.rate_sum / self.batches if self.batches else 0.0


_STORED = "query string, number long, batches long, rows long, errors long, seconds double, last_batch string, rate_sum double, rate_peak double"


class ProgressCounter(StreamingQueryListener):
    """Counts batches, rows, failures and rates from the engine's own progress reports.

    With ``store`` a row of sums is written after each batch that had rows, into one of two folders in turn, and a
    counter with the same store goes on from the newest. A batch that is counted twice (reported, then repeated after a
    failure) is told by its query and number and counts once.
    """

    def __init__(self, spark: SparkSession | None = None, store: str | None = None):
        self.spark, self.store, self.seen = spark, store, {}
        self.figures = self._stored() or Figures()

    def _stored(self) -> Figures | None:
        if not self.store:
            return None
        there = [f"{self.store}/turn={k}" for k in (0, 1) if self._exists(f"{self.store}/turn={k}/_SUCCESS")]
        if not there:
            return None
        newest = self.spark.read.schema(_STORED).json(there).orderBy("batches", ascending=False).first()
        self.seen = {newest["query"]: newest["number"]}
        return Figures(**{k: v for k, v in newest.asDict().items() if k not in ("query", "number")})

    def _exists(self, path: str) -> bool:
        files, handle = file_system(self.spark, path)
        return files.exists(handle)

    def _store(self, query: str, number: int) -> None:
        row = (query, number, *asdict(self.figures).values())
        rows: DataFrame = self.spark.createDataFrame([row], _STORED)
        rows.coalesce(1).write.mode("overwrite").json(f"{self.store}/turn={self.figures.batches % 2}")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress, figures = event.progress, self.figures
        query, number = str(progress.id), progress.batchId
        if progress.numInputRows and number > self.seen.get(query, -1):
            self.seen[query] = number
            figures.batches += 1
            figures.rows += progress.numInputRows
            figures.seconds += progress.batchDuration / 1000
            figures.last_batch = progress.timestamp
            figures.rate_sum += progress.processedRowsPerSecond
            figures.rate_peak = max(figures.rate_peak, progress.processedRowsPerSecond)
            if self.store:
                self._store(query, number)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.figures.errors += event.exception is not None
