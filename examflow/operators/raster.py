"""Pixel work on raw rasters, and adapters for renderers, readers of text and language services.

A raster is (w int, h int, data binary) of grey values. Pixels need arrays, so these are Arrow UDFs
over NumPy; whatever can be said by numbers per row or column is in ``layout`` instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _array(w: int, h: int, data: bytes):
    import numpy as np

    return np.frombuffer(data, dtype="uint8").reshape(h, w)


def runs(dark) -> tuple:
    """Runs of dark pixels: row, first column, end column of each, and the number of the component it belongs to.

    Runs of neighbouring rows that overlap are one component: the overlaps of all rows are found at once
    by binary search, and only they are joined one by one, so the time grows with the runs, not the pixels.
    """
    import numpy as np

    h, w = dark.shape
    edges = np.diff(np.pad(dark.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edges == 1)
    _, end = np.nonzero(edges == -1)
    below = w + 2
    first = np.searchsorted(end + (row + 1) * below, start + row * below, side="right")
    stop = np.searchsorted(start + (row + 1) * below, end + row * below, side="left")
    owner = np.arange(len(row))

    def root(i: int) -> int:
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    for i in np.flatnonzero(stop > first):
        for j in range(first[i], stop[i]):
            a, b = root(i), root(j)
            owner[max(a, b)] = min(a, b)
    return row, start, end, np.array([root(i) for i in range(len(row))], dtype=np.int64)


def components(dark) -> tuple:
    """(labels, names): the number of the 4-connected component of each dark pixel, 0 elsewhere, and all numbers."""
    import numpy as np

    labels = np.zeros(dark.shape, dtype=np.int64)
    for y, x0, x1, name in zip(*runs(dark)):
        labels[y, x0:x1] = name + 1
    return labels, np.unique(labels[dark])


def dark_box(df: DataFrame, key: str, threshold: int = 245) -> DataFrame:
    """(key, x0, y0, x1, y1, n_dark): box around all pixels at most as bright as the threshold."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, x0 int, y0 int, x1 int, y1 int, n_dark int"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for f in frames:
            rows = []
            for k, w, h, data in zip(f[key], f["w"], f["h"], f["data"]):
                ys, xs = np.nonzero(_array(w, h, data) <= threshold)
                rows.append((k, int(xs.min()), int(ys.min()), int(xs.max()) + 1, int(ys.max()) + 1, len(xs)) if len(xs) else (k, None, None, None, None, 0))
            yield pd.DataFrame(rows, columns=[key, "x0", "y0", "x1", "y1", "n_dark"]).astype({c: "Int32" for c in ("x0", "y0", "x1", "y1", "n_dark")})

    return df.select(key, "w", "h", "data").mapInPandas(run, schema)


def without_edge_components(df: DataFrame, key: str, threshold: int = 245) -> DataFrame:
    """(key, w, h, data): rasters whose dark parts that touch an edge are white."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, w int, h int, data binary"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for f in frames:
            out = []
            for w, h, data in zip(f["w"], f["h"], f["data"]):
                a = _array(w, h, data).copy()
                labels, _ = components(a <= threshold)
                edge = np.unique(np.concatenate([labels[0], labels[-1], labels[:, 0], labels[:, -1]]))
                a[np.isin(labels, edge[edge > 0])] = 255
                out.append(a.tobytes())
            yield pd.DataFrame({key: f[key], "w": f["w"], "h": f["h"], "data": out})

    return df.select(key, "w", "h", "data").mapInPandas(run, schema)


def strips(df: DataFrame, key: str, count: str) -> DataFrame:
    """(key, strip_no, w, h, data): equal horizontal strips; rasters at most 8 high a strip give none."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, strip_no int, w int, h int, data binary"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, w, h, data, n in zip(f[key], f["w"], f["h"], f["data"], f[count]):
                if n >= 1 and h > 8 * n:
                    a, step = _array(w, h, data), h / n
                    for i in range(n):
                        part = a[round(i * step) : round((i + 1) * step)]
                        rows.append((k, i + 1, w, part.shape[0], part.tobytes()))
            yield pd.DataFrame(rows, columns=[key, "strip_no", "w", "h", "data"])

    return df.select(key, "w", "h", "data", count).mapInPandas(run, schema)


def read_text(df: DataFrame, key: str, readers: Callable[[], list[Callable[[bytes], str]]]) -> DataFrame:
    """(key, text, reader): the text of the first reader that finds any; a reader that fails finds none.

    ``readers`` makes the readers once in each worker, so heavy models are loaded there only.
    """
    schema = f"{key} {df.schema[key].dataType.simpleString()}, text string, reader int"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = readers()
        for f in frames:
            rows = []
            for k, data in zip(f[key], f["data"]):
                got, who = "", None
                for i, reader in enumerate(made):
                    try:
                        got = (reader(data) or "").strip()
                    except Exception:  # noqa: BLE001 - an adapter may fail in any way
                        got = ""
                    if got:
                        who = i
                        break
                rows.append((k, got, who))
            yield pd.DataFrame(rows, columns=[key, "text", "reader"]).astype({"reader": "Int32"})

    return df.select(key, "data").mapInPandas(run, schema)


def holds_object(raw: str | None) -> bool:
    """Whether a reply is a JSON object, bare or in a code fence."""
    import json
    import re

    try:
        return isinstance(json.loads(re.sub(r"^\s*```\w*\s*|\s*```\s*$", "", raw or "")), dict)
    except ValueError:
        return False


def ask(df: DataFrame, keys: list[str], prompt: str, client: Callable[[], Callable[[str], str]], max_attempts: int = 3) -> DataFrame:
    """(keys, attempt, raw, error): every attempt until a reply is a JSON object, for the merges in ``canonical``."""
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", attempt int, raw string, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = client()
        for f in frames:
            rows = []
            for values in f[[*keys, prompt]].itertuples(index=False):
                for attempt in range(1, max(max_attempts, 1) + 1):
                    try:
                        raw, error = call(values[-1]), None
                        done = holds_object(raw)
                    except Exception as e:  # noqa: BLE001 - reported as a row
                        raw, error, done = None, str(e), False
                    rows.append((*values[:-1], attempt, raw, error))
                    if done:
                        break
            yield pd.DataFrame(rows, columns=[*keys, "attempt", "raw", "error"])

    return df.select(*keys, prompt).mapInPandas(run, schema)


def binarised(df: DataFrame, key: str, threshold: int, scale: int = 1) -> DataFrame:
    """(key, w, h, data): pixels under the threshold are black, others white, each ``scale`` times as large."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, w int, h int, data binary"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for f in frames:
            out = []
            for w, h, data in zip(f["w"], f["h"], f["data"]):
                a = np.where(_array(w, h, data) < threshold, 0, 255).astype("uint8")
                out.append(np.repeat(np.repeat(a, scale, 0), scale, 1).tobytes())
            yield pd.DataFrame({key: f[key], "w": f["w"] * scale, "h": f["h"] * scale, "data": out})

    return df.select(key, "w", "h", "data").mapInPandas(run, schema)


def row_statistics(df: DataFrame, key: str, columns: bool = False) -> DataFrame:
    """(key, position, pixels): grey values of every row (or column), for ``layout.pixel_stats``."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, position int, pixels array<double>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, w, h, data in zip(f[key], f["w"], f["h"], f["data"]):
                a = _array(w, h, data)
                rows += [(k, i, r.astype("float64")) for i, r in enumerate(a.T if columns else a)]
            yield pd.DataFrame(rows, columns=[key, "position", "pixels"])

    return df.select(key, "w", "h", "data").mapInPandas(run, schema)


# Shares of the height and width of a table cell that tell its signs apart, and pixels of a speck.
SIGNS = {
    "speck": 12, "frame": 0.9, "rule_height": 0.08, "rule_pixels": 3, "rule_width": 0.5,
    "tall": 0.30, "broad": 0.05, "low": 0.24, "narrow": 0.10, "comma_from": 0.55,
}
#: Pixels count as so many by so many.
SIGN_SCALE = 4


def symbol_mask(df: DataFrame, key: str, threshold: int = 210) -> DataFrame:
    """(key, mask): dark parts of a table cell from left to right as ``#``, comma or dot; empty without ``#``.

    Tall parts are signs, small ones are commas in the lower and dots in the upper part of the cell;
    rules, frames and specks are none of these. Pixels count as four by four.
    """
    schema = f"{key} {df.schema[key].dataType.simpleString()}, mask string"

    def mask_of(dark) -> str:
        import numpy as np

        row, start, end, part = runs(dark)
        names, at = np.unique(part, return_inverse=True)
        box = {}
        for name, how, values in (("top", np.minimum, row), ("bottom", np.maximum, row + 1), ("left", np.minimum, start), ("right", np.maximum, end)):
            box[name] = np.full(len(names), 10**9 if how is np.minimum else -1)
            how.at(box[name], at, values)
        box = {k: v * SIGN_SCALE for k, v in box.items()}
        h, w = (SIGN_SCALE * x for x in dark.shape)
        pixels = np.bincount(at, weights=end - start, minlength=len(names)) * SIGN_SCALE**2
        high, wide = box["bottom"] - box["top"], box["right"] - box["left"]
        rule = (high <= max(SIGNS["rule_pixels"], int(h * SIGNS["rule_height"]))) & (wide >= int(w * SIGNS["rule_width"]))
        counts = (pixels >= SIGNS["speck"]) & (np.maximum(wide / w, high / h) <= SIGNS["frame"]) & ~rule
        is_sign = counts & (high >= int(h * SIGNS["tall"])) & (wide >= int(w * SIGNS["broad"]))
        is_point = counts & ~is_sign & (high <= int(h * SIGNS["low"])) & (wide <= int(w * SIGNS["narrow"]))
        point = np.where((box["top"] + box["bottom"] - 1) / 2 >= h * SIGNS["comma_from"], ",", ".")
        shown = np.where(is_sign, "#", np.where(is_point, point, ""))
        text = "".join(shown[np.argsort(box["left"] + box["right"], kind="stable")])
        return text if "#" in text else ""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], "mask": [mask_of(_array(w, h, data) < threshold) for w, h, data in zip(f["w"], f["h"], f["data"])]})

    return df.select(key, "w", "h", "data").mapInPandas(run, schema)


def trimmed(df: DataFrame, key: str, trims: DataFrame) -> DataFrame:
    """(key, w, h, data, trimmed): rasters without ``top``, ``bottom``, ``left`` and ``right`` pixels of rules.

    Rasters that would be under 10 high or 20 wide stay. The trims come from ``segment.prefix_run``
    over rule-like rows and columns.
    """
    schema = f"{key} {df.schema[key].dataType.simpleString()}, w int, h int, data binary, trimmed boolean"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, w, h, data, t, b, le, r in zip(f[key], f["w"], f["h"], f["data"], f["top"], f["bottom"], f["left"], f["right"]):
                fits = h - t - b >= 10 and w - le - r >= 20 and t + b + le + r > 0
                a = _array(w, h, data)
                a = a[t : h - b, le : w - r] if fits else a
                rows.append((k, a.shape[1], a.shape[0], a.tobytes(), fits))
            yield pd.DataFrame(rows, columns=[key, "w", "h", "data", "trimmed"])

    joined = df.join(trims, key, "left").fillna(0, ["top", "bottom", "left", "right"])
    return joined.select(key, "w", "h", "data", "top", "bottom", "left", "right").mapInPandas(run, schema)


def reading_variants(df: DataFrame, key: str, separator: str | None = None) -> DataFrame:
    """(key, variant, w, h, data): the whole raster, and two halves of wide ones (8 % shared) or either side of a separator."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, variant int, w int, h int, data binary"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for values in f.itertuples(index=False):
                k, w, h, data = values[:4]
                a = _array(w, h, data)
                at = values[4] if separator else None
                parts = [a]
                if at is not None and at == at:
                    gap = max(8, int(w * 0.015))
                    parts += [a[:, : max(1, int(at) - gap)], a[:, min(w - 1, int(at) + gap) :]]
                elif w >= 1000:
                    over = int(w * 0.08)
                    parts += [a[:, : w // 2 + over], a[:, w // 2 - over :]]
                rows += [(k, i, p.shape[1], p.shape[0], p.tobytes()) for i, p in enumerate(parts)]
            yield pd.DataFrame(rows, columns=[key, "variant", "w", "h", "data"])

    return df.select(key, "w", "h", "data", *([separator] if separator else [])).mapInPandas(run, schema)
