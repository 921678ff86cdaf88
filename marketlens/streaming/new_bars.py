"""New bars since the last load, as an `availableNow` stream.

Landing files are read as a stream with the bars schema and the time and name
of their file.  Keyed state drops what a pull repeats word for word: a bar of
the same (ticker, date, values) as one that came in within STATE_DELAY of load
time goes no further.  The state is bounded by that delay, and since it counts
load time, not bar dates, a ticker or day that arrives late is never dropped.
Each micro-batch then goes through the same `store_bars` as the batch load:
repeats are reduced to the bar written last, days that the target lacks are
appended however late they come, and corrected ones replace what is stored.
So both loads store the same bars, and a retried batch adds nothing.  The
target is parquet with the bars schema, partitioned by year, whatever the
landing format.  The checkpoint lives in the cluster's shared checkpoint folder
(`spark.checkpoint.dir`).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import one_per_day
from ..operators.normalize import LOAD_MARKS, normalize_bars, with_load_marks
from ..schemas import BAR_COLUMNS, BARS
from ..session import checkpoint_root
from ..sinks.tables import store_bars

STATE_DELAY = "7 days"
STORED = T.StructType([*BARS.fields, T.StructField("year", T.IntegerType())])


def bar_stream(spark: SparkSession, landing: str, fmt: str = "parquet") -> DataFrame:
    """Streaming bars with their load marks.

    Streams need a schema up front and CSV maps it by position, so CSV
    landing files must carry the BARS column order; parquet and JSON map
    by name.
    """
    raw = with_load_marks(spark.readStream.schema(BARS).format(fmt).load(landing))
    return normalize_bars(raw, keep=[*LOAD_MARKS])


def without_repeats(stream: DataFrame, delay: str = STATE_DELAY) -> DataFrame:
    """The bars that no pull of the last `delay` brought before."""
    return stream.withWatermark(LOAD_MARKS[0], delay).dropDuplicatesWithinWatermark(BAR_COLUMNS)


def stored_bars(spark: SparkSession, target: str) -> DataFrame:
    """The stored bars and their year, empty before the first load."""
    try:
        return spark.read.schema(STORED).parquet(target)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], STORED)


def _store(target: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        store_bars(stored_bars(batch.sparkSession, target), target, one_per_day(batch).select(
            *[F.col(c) for c in BAR_COLUMNS]))
    return run


def load_new_bars(spark: SparkSession, landing: str, target: str, name: str = "new_bars",
                  fmt: str = "parquet", checkpoint: str | None = None) -> StreamingQuery:
    """Process every landing file present now, store new and corrected bars, stop."""
    checkpoint = checkpoint or os.path.join(checkpoint_root(spark), "streams", name)
    q = (without_repeats(bar_stream(spark, landing, fmt)).writeStream
         .foreachBatch(_store(target))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .queryName(name)
         .start())
    q.awaitTermination()
    return q
