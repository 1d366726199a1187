"""Reading text off rasters with any recogniser: a grid of attempts for each raster, the best one kept.

The recogniser is an adapter: ``make()`` gives a function (raster bytes, width, height, config) -> text
once in each worker, so heavy models are loaded where they are used. What is tried is data: attempts
are rows, the choice among them is an aggregate, and failures and empty readings are counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# What is tried for a cell of a choice table, and for a region.
CELL_SCALES, CELL_THRESHOLDS = (4, 6), (160, 185, 210)
CELL_CONFIGS = ("--oem 1 --psm 7", "--oem 1 --psm 8", "--oem 1 --psm 6")
REGION_CONFIGS = ("--oem 1 --psm 6", "--oem 1 --psm 4", "--oem 3 --psm 6")

Reader = Callable[[bytes, int, int, str], str]


def attempts(df: DataFrame, key: str, make: Callable[[], Reader], scales=(1,), thresholds=(None,), configs=("",)) -> DataFrame:
    """(key, attempt, scale, threshold, config, text, error): every reading of every raster (w, h, data)."""
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, attempt int, scale int, threshold int, config string, text string, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        try:
            reader, missing = make(), None
        except ImportError as e:
            reader, missing = None, str(e)
        for f in frames:
            rows = []
            for k, w, h, data in zip(f[key], f["w"], f["h"], f["data"]):
                plain = np.frombuffer(data, dtype="uint8").reshape(h, w)
                for n, (scale, threshold, config) in enumerate(product(scales, thresholds, configs)):
                    a = plain if threshold is None else np.where(plain < threshold, 0, 255).astype("uint8")
                    a = np.repeat(np.repeat(a, scale, 0), scale, 1) if scale > 1 else a
                    text, error = "", missing
                    if reader is not None:
                        try:
                            text = (reader(a.tobytes(), a.shape[1], a.shape[0], config) or "").strip()
                        except Exception as e:  # noqa: BLE001 - an adapter may fail in any way
                            error = str(e)
                    rows.append((k, n + 1, scale, threshold, config, text, error))
            yield pd.DataFrame(rows, columns=[key, "attempt", "scale", "threshold", "config", "text", "error"]).astype({"threshold": "Int32"})

    return df.select(key, "w", "h", "data").mapInPandas(run, schema)


def best_cells(tried: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    """(key, text): the reading of each cell with the best score, the mask of its signs if it holds no digit."""
    row = T.sparse_row(F.col("text"))
    best = tried.groupBy(key).agg(F.max_by(row, F.struct(T.sparse_score(row).alias("s"), (-F.col("attempt")).alias("a"))).alias("text"))
    out = best.join(masks, key, "left")
    return out.select(key, F.when(~F.col("text").rlike(r"\d") & (F.coalesce("mask", F.lit("")) != ""), F.col("mask")).otherwise(F.col("text")).alias("text"))


def cell_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row_no, text): cells of each row from left to right, blanks between them."""
    parts = F.array_sort(F.collect_list(F.struct("column_no", "text")))
    return cells.where(F.col("text") != "").groupBy(*keys, "row_no").agg(F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("text"))


def first_found(tried: DataFrame, key: str) -> DataFrame:
    """(key, text, attempt): the first reading that found anything; empty and without attempt if none did."""
    hit = F.col("text") != ""
    return tried.groupBy(key).agg(F.coalesce(F.min_by("text", F.when(hit, F.col("attempt"))), F.lit("")).alias("text"), F.min(F.when(hit, F.col("attempt"))).alias("attempt"))


def warnings(tried: DataFrame) -> DataFrame:
    """(error, n): each failure once, with how often it happened."""
    return tried.where("error is not null").groupBy("error").agg(F.count(F.lit(1)).alias("n"))
