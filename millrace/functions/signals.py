"""Measures of small grids and sample arrays: built-in where Spark has the functions, else Arrow-batched numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, StringType


def grid_stats(pixels: Column) -> Column:
    """(brightness, contrast): mean and population standard deviation of an array."""
    n = F.size(pixels)
    mean = F.aggregate(pixels, F.lit(0.0), lambda t, x: t + x) / n
    square = F.aggregate(pixels, F.lit(0.0), lambda t, x: t + x * x) / n
    return F.struct(mean.alias("brightness"), F.sqrt(F.greatest(F.lit(0.0), square - mean * mean)).alias("contrast"))


@pandas_udf(DoubleType())
def sharpness(pixels: pd.Series) -> pd.Series:
    """Mean absolute Laplacian over the inside of a square grid, row by row; null for other shapes."""

    def one(p):
        side = 0 if p is None else int(round(len(p) ** 0.5))
        if side < 3 or side * side != len(p):
            return None
        g = np.asarray(p, float).reshape(side, side)
        inside = g[1:-1, 1:-1]
        return float(np.abs(4 * inside - g[:-2, 1:-1] - g[2:, 1:-1] - g[1:-1, :-2] - g[1:-1, 2:]).mean())

    return pixels.map(one, na_action="ignore").astype("float64")


@pandas_udf(StringType())
def dhash64(pixels: pd.Series) -> pd.Series:
    """Hash of an 8 x 9 grid, row by row: bit i is set where a pixel is brighter than its right neighbour; 16 hex digits."""

    def one(p):
        if p is None or len(p) != 72:
            return None
        g = np.asarray(p, float).reshape(8, 9)
        return f"{sum(1 << int(i) for i in np.flatnonzero((g[:, :-1] > g[:, 1:]).ravel())):016x}"

    return pixels.map(one, na_action="ignore")


@pandas_udf(ArrayType(DoubleType()))
def homography(source: pd.Series, target: pd.Series) -> pd.Series:
    """The nine entries that map four source corners (x1, y1, ...) to target corners; null if there is no such map."""

    def one(s, t):
        if s is None or t is None or len(s) != 8 or len(t) != 8:
            return None
        s, t = np.asarray(s, float).reshape(4, 2), np.asarray(t, float).reshape(4, 2)
        zero, one_ = np.zeros(4), np.ones(4)
        top = np.stack([s[:, 0], s[:, 1], one_, zero, zero, zero, -t[:, 0] * s[:, 0], -t[:, 0] * s[:, 1]], 1)
        low = np.stack([zero, zero, zero, s[:, 0], s[:, 1], one_, -t[:, 1] * s[:, 0], -t[:, 1] * s[:, 1]], 1)
        try:
            return [*np.linalg.solve(np.concatenate((top, low)), np.concatenate((t[:, 0], t[:, 1]))).tolist(), 1.0]
        except np.linalg.LinAlgError:
            return None

    return pd.Series([one(s, t) for s, t in zip(source, target)], dtype=object)


def audio_stats(samples: Column, rate: Column, clip: float = 0.999, silence: float = 0.001) -> Column:
    """(seconds, rms_dbfs, clipping, silence, dc) of samples in [-1, 1]."""
    n = F.size(samples)
    share = lambda test: F.size(F.filter(samples, test)) / n
    total = F.aggregate(samples, F.lit(0.0), lambda t, x: t + x)
    square = F.aggregate(samples, F.lit(0.0), lambda t, x: t + x * x)
    return F.struct(
        (n / rate).alias("seconds"),
        (20 * F.log10(F.sqrt(square / n) + 1e-12)).alias("rms_dbfs"),
        share(lambda x: F.abs(x) >= clip).alias("clipping"),
        share(lambda x: F.abs(x) < silence).alias("silence"),
        (total / n).alias("dc"),
    )
