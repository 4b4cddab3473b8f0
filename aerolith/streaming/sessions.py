"""Sessions and legs on a stream: stretches of rows without a long gap, emitted once they are over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.operators.flights import GAP_S

#: Rows of a partition are merged into sessions before they are shuffled.
LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def sessions(stream: DataFrame, gap: float = GAP_S, late: str = "1 hour", at: str = "at", by: Sequence[str] = ()) -> DataFrame:
    """by, start_s, end_s, n_rows of the sessions of a stream with epoch seconds `at`, in append mode: a session comes out when
    the watermark, `late` behind the latest row, has passed its end by gap. Rows up to that late join or connect sessions; later ones
    are dropped. Times count in whole microseconds. What comes out of rows that aren't later is what `flights.sessions` finds in them.

    A stream needs a key besides the session; without `by` it is one for all rows, so rows are merged into sessions before
    the shuffle. Rows without a time are left out."""
    stream.sparkSession.conf.set(LOCAL_MERGE, "true")
    micros = F.round(F.col(at) * 1_000_000).cast("long")
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(by)] or [F.lit(0).alias("_k0")]
    rows = stream.where(F.col(at).isNotNull()).select(*keys, F.col(at).cast("double").alias("_at"), F.timestamp_micros(micros).alias("_ts"))
    window = F.session_window("_ts", f"{round(gap * 1_000_000)} microseconds")  # a gap of exactly that much doesn't end a session
    found = rows.withWatermark("_ts", late).groupBy(*[f"_k{i}" for i in range(len(keys))], window.alias("_w"))
    named = [F.col(f"_k{i}").alias(c) for i, c in enumerate(by)]
    return found.agg(F.min("_at").alias("start_s"), F.max("_at").alias("end_s"), F.count("*").alias("n_rows")).select(*named, "start_s", "end_s", "n_rows")


def run(stream: DataFrame, path: str, checkpoint: str, gap: float = GAP_S, late: str = "1 hour", at: str = "at", by: Sequence[str] = ()) -> None:
    """All that the stream holds now, as Parquet under path; sessions that may still grow wait in the checkpoint for the next call.
    `flights.legs` numbers what lies under path by date."""
    query = sessions(stream, gap, late, at, by).writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
