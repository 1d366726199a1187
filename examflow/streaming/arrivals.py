"""Questions from arriving lines: the batch operators applied to what each trigger brings.

Lines are kept as they arrive; each trigger reads again the uploads it brought lines of, so an upload
that comes in several files is whole in the end and no state is held in memory. Late repeated
deliveries are dropped by a watermark on the arrival time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.segment import build_questions


def without_repeats(lines: DataFrame, key: str = "line_id", at: str = "ingested_at", delay: str = "30 days") -> DataFrame:
    """A stream without rows delivered again within ``delay``."""
    return lines.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def arrivals_per_hour(lines: DataFrame, at: str = "ingested_at", delay: str = "2 hours") -> DataFrame:
    """(window, n_lines) of a stream."""
    return lines.withWatermark(at, delay).groupBy(F.window(at, "1 hour")).agg(F.count(F.lit(1)).alias("n_lines"))


def write_questions(lines: DataFrame, path: str, checkpoint: str, held: str | None = None) -> StreamingQuery:
    """Append the questions of the uploads of each trigger to a table of files; safe to restart.

    ``held`` (beside ``path`` if not given) keeps the lines. Of an upload in several triggers the latest
    batch has all questions: ``latest_questions`` reads those.
    """
    kept = held or f"{path}_lines"

    def one(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{kept}/arrived={batch_id}")
        known = batch.sparkSession.read.schema(batch.schema).parquet(kept)
        whole = known.join(batch.select("upload_id").distinct(), "upload_id", "left_semi")
        build_questions(whole.dropDuplicates(["line_id"])).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return lines.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_questions(questions: DataFrame) -> DataFrame:
    """The questions of the latest batch of each upload, from the table that ``write_questions`` writes."""
    last = questions.groupBy("upload_id").agg(F.max("batch").alias("batch"))
    return questions.join(last, ["upload_id", "batch"]).drop("batch")
