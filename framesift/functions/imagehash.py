"""Perceptual hashes of images: a pandas UDF over the pixels that Spark's image source decodes.

Grey by the usual luma weights, resampled to 32 x 32 by a Lanczos window of three lobes in two passes of 8 bits, an
unnormalised DCT-II, and of its lowest 8 x 8 coefficients one bit each: above their median.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The name under which hashes of this kind are stored; luma weights of red, green and blue (of 65536).
ALGORITHM = "phash-dct-64-v1"
LUMA = (19595, 38470, 7471)
SIDE, LOW = 32, 8


def _window(n: int, out: int = SIDE) -> np.ndarray:
    """The weights (out x n) that resample n pixels to out: a Lanczos window, widened when there are fewer pixels to come."""
    scale = n / out
    wide = max(scale, 1.0)
    centre = (np.arange(out) + 0.5) * scale
    d = (np.arange(n) + 0.5 - centre[:, None]) / wide
    w = np.where(np.abs(d) < 3, np.sinc(d) * np.sinc(d / 3), 0.0)
    low, high = np.floor(centre - 3 * wide + 0.5), np.floor(centre + 3 * wide + 0.5)
    at = np.arange(n)
    w[(at < low[:, None]) | (at >= high[:, None])] = 0
    return w / w.sum(axis=1, keepdims=True)


def _eight_bits(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(x + 0.5), 0, 255)


_DCT = 2 * np.cos(np.pi * np.outer(np.arange(LOW), 2 * np.arange(SIDE) + 1) / (2 * SIDE))


def grey(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Pixels of one, three (blue, green, red) or four channels as grey values of 8 bits."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.int64)
    if channels == 1:
        return x[:, :, 0]
    return (x[:, :, 2] * LUMA[0] + x[:, :, 1] * LUMA[1] + x[:, :, 0] * LUMA[2] + 32768) >> 16


def hash_of(pixels: np.ndarray) -> str:
    """16 hex digits of a grey image."""
    x = _eight_bits(pixels.astype(np.float64) @ _window(pixels.shape[1]).T)
    x = _eight_bits(_window(pixels.shape[0]) @ x)
    low = _DCT @ x @ _DCT.T
    return np.packbits(low > np.median(low)).tobytes().hex()


@F.pandas_udf(StringType())
def _hash(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.Series:
    usable = lambda d, h, w, c: d is not None and h > 0 and w > 0 and len(d) == h * w * c
    return pd.Series([hash_of(grey(d, int(h), int(w), int(c))) if usable(d, h, w, c) else None for d, h, w, c in zip(data, height, width, channels, strict=True)], dtype=object)


def perceptual_hash(image: Column) -> Column:
    """image: a column of Spark's image source; null where it could not be decoded."""
    return _hash(image["data"], image["height"], image["width"], image["nChannels"])


def hash_is_current(phash: Column, algorithm: Column) -> Column:
    """Whether a stored hash needs no new computation: hashes of another kind or of none do."""
    return (F.coalesce(phash, F.lit("")) != "") & (F.coalesce(algorithm, F.lit("")) == ALGORITHM)
