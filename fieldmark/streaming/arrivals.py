"""Rows that arrive over time: scoring, upserts and 15-minute means.

Writes are idempotent: a batch that is run again after a failure replaces what
it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldmark.models.score import score_model
from fieldmark.operators.joins import merge_upsert
from fieldmark.sources.versions import CELL, cell, replace_cells


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The newest row of each key."""
    others = [c for c in df.columns if c not in set(keys) | set(by)]
    best = df.groupBy(*keys).agg(F.max(F.struct(*by, *others)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def upsert_partitions(
    rows: DataFrame, path: str, keys: Sequence[str], partition: str, newest_by: Sequence[str] = ()
) -> int:
    """Merge rows into a table in versions (`sources.versions`); the number of the new version.

    A new row replaces the stored one of its key, or, with `newest_by`, the newer of
    the two stays; on a tie it is the larger row, so that the order of batches never shows.

    Only the partitions that the rows touch are read and written, to new files: until the
    last step, one rename, the table is what it was, and running a failed merge again
    gives the same rows.  Read it with `read_table`.
    """
    each = [*keys, *([partition] if partition not in keys else [])]

    def merged(target: DataFrame, new: DataFrame) -> DataFrame:
        if newest_by:
            return latest_per_key(target.unionByName(new), each, newest_by)
        # By the partition's cell, so that rows without a partition value meet as well.
        beside = [*[k for k in keys if k != partition], CELL]
        both = (df.withColumn(CELL, cell(partition)) for df in (target, new))
        return merge_upsert(*both, beside).select(*rows.columns)

    return replace_cells(rows, path, partition, merged)


def _start(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, mode: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(run)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def stream_upsert(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    partition: str,
    newest_by: Sequence[str],
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Merge arriving rows; of several rows with one key the newest counts, whenever it came."""

    def run(batch: DataFrame, _: int) -> None:
        unique = latest_per_key(batch, [*keys, *([partition] if partition not in keys else [])], newest_by)
        upsert_partitions(unique, path, keys, partition, newest_by)

    return _start(stream, run, checkpoint, "append", once)


def score_on_arrival(
    stream: DataFrame,
    model: Callable[[], PipelineModel],
    ids: Sequence[str],
    path: str,
    checkpoint: str,
    unlabelled: Column | None = None,
    name: str = "score",
    once: bool = True,
) -> StreamingQuery:
    """Score new rows without a label; `model` gives the latest model per batch.

    A batch has a partition of its own, which a second run of it overwrites.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        fresh = batch if unlabelled is None else batch.filter(unlabelled)
        scored = score_model(model(), fresh, ids, name).withColumn("batch", F.lit(batch_id))
        (
            scored.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(path)
        )

    return _start(stream, run, checkpoint, "append", once)


def tumbling_means(
    stream: DataFrame, time: str, keys: Sequence[str], value: str, minutes: int = 15, late: str = "20 minutes"
) -> DataFrame:
    """Mean and count per key and window; rows later than `late` are left out.

    Works on a stream and on a table alike.
    """
    timed = stream.withWatermark(time, late) if stream.isStreaming else stream
    slot = F.window(time, f"{minutes} minutes")
    out = timed.groupBy(*keys, slot.alias("_slot")).agg(
        F.avg(value).alias(f"mean_{value}"), F.count(value).alias("n")
    )
    return out.select(*keys, F.col("_slot.start").alias("window_start"), f"mean_{value}", "n")


def final_windows(
    means: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append each window of `tumbling_means` once, when the watermark has passed its end.

    A batch has a partition of its own, which a second run of it overwrites; no stored
    window is ever read or written again.  Windows that may still grow wait in the state of
    the stream, and rows that come after their window was written are left out of it: see
    `late_rows`.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(path)
        )

    return _start(means, run, checkpoint, "append", once)


def late_rows(rows: DataFrame, windows: DataFrame, time: str, keys: Sequence[str], value: str, minutes: int = 15) -> DataFrame:
    """How many rows came too late for their window: keys, window_start, n_late.

    The arrived rows are counted once more and compared with what `final_windows` has stored.
    A window up to the last stored one is closed; if nothing is stored of it, all its rows
    were late.  Windows without late rows are not listed, nor those that are still open.
    """
    slot = F.window(time, f"{minutes} minutes")
    came = rows.groupBy(*keys, slot.alias("_slot")).agg(F.count(value).alias("_came"))
    came = came.select(*keys, F.col("_slot.start").alias("window_start"), "_came")
    came = came.filter(F.col("window_start") <= windows.agg(F.max("window_start")).scalar())
    joined = came.join(windows.select(*keys, "window_start", "n"), [*keys, "window_start"], "left")
    late = F.col("_came") - F.coalesce("n", F.lit(0))
    return joined.filter(late > 0).select(*keys, "window_start", late.alias("n_late"))


def store_tumbling(
    means: DataFrame, path: str, keys: Sequence[str], checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Keep the table of windows up to date before they are final; a changed window replaces its row.

    Each batch is a version of the table: read it with `read_table`.
    """

    def run(batch: DataFrame, _: int) -> None:
        dated = batch.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
        upsert_partitions(dated, path, [*keys, "window_start"], "day")

    return _start(means, run, checkpoint, "update", once)
