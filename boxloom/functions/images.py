"""Pixel measures of decoded images (``image`` source columns) in Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def _pixels(height: int, width: int, channels: int, data: bytes) -> np.ndarray | None:
    """Rows of blue, green and red, or grey in all three; None if unreadable."""
    if height <= 0 or width <= 0 or not data:
        return None
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)[..., :3].astype(np.float64)
    return np.repeat(a, 3, axis=2) if a.shape[2] == 1 else a


def _grey(a: np.ndarray) -> np.ndarray:
    return a @ np.array([0.114, 0.587, 0.299])


def _shrink(a: np.ndarray, size: int) -> np.ndarray:
    """Area means on a square grid."""
    def weights(n):
        edges = np.linspace(0, n, size + 1)
        low, high = np.arange(n), np.arange(1, n + 1)
        w = np.clip(np.minimum(high, edges[1:, None]) - np.maximum(low, edges[:-1, None]), 0, None)
        return w / w.sum(axis=1, keepdims=True)

    return weights(a.shape[0]) @ a @ weights(a.shape[1]).T


def _long(bits: np.ndarray) -> int:
    value = int("".join("1" if b else "0" for b in bits.ravel()), 2)
    return value - (1 << 64) if value >= 1 << 63 else value


def perceptual_hash(grey: np.ndarray) -> int:
    """64 bits of the low cosine frequencies of a 32 x 32 image, against their median without the first row."""
    n = np.arange(32)
    basis = np.cos(np.pi * (2 * n[None, :] + 1) * n[:, None] / 64)
    low = np.round((basis @ _shrink(grey, 32) @ basis.T)[:8, :8], 6)  # of an even image all but the first are 0
    return _long(low > np.median(low[1:]))


def average_hash(grey: np.ndarray) -> int:
    small = _shrink(grey, 8)
    return _long(np.round(small, 6) >= np.round(small.mean(), 6))  # sums of shares are not exact


QUALITY = "brightness double, contrast double, sharpness double, dark_ratio double, bright_ratio double, saturation double, phash long, ahash long"


def image_measures():
    """A function of (height, width, nChannels, data): quality measures and both hashes; nulls if unreadable."""

    @F.pandas_udf(QUALITY)
    def measure(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.DataFrame:
        rows = []
        for h, w, c, d in zip(height, width, channels, data, strict=True):
            a = _pixels(h, w, c, d)
            if a is None:
                rows.append((None,) * 8)
                continue
            g = _grey(a)
            high, low = a.max(axis=2), a.min(axis=2)
            lap = g[1:-1, 1:-1] * -4 + g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] if min(g.shape) > 2 else np.zeros(1)
            saturation = np.divide(high - low, high, out=np.zeros_like(high), where=high > 0).mean() * 255
            rows.append((g.mean(), g.std(), lap.var(), (g < 25).mean(), (g > 240).mean(), saturation, perceptual_hash(g), average_hash(g)))
        # whole numbers as such: beside a null, pandas would turn the hashes into floats
        out = pd.DataFrame(rows, columns=[x.split()[0] for x in QUALITY.split(", ")], dtype=object)
        return out.astype({c: "Int64" if c.endswith("hash") else "float64" for c in out.columns})

    return measure


def mask_regions():
    """A function of (height, width, nChannels, data, regions): the pixels with regions filled black."""

    @F.pandas_udf("binary")
    def mask(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series, regions: pd.Series) -> pd.Series:
        out = []
        for h, w, c, d, rs in zip(height, width, channels, data, regions, strict=True):
            if h <= 0 or d is None:
                out.append(d)
                continue
            a = np.frombuffer(d, np.uint8).reshape(h, w, c).copy()
            for r in rs if rs is not None else []:
                a[max(0, int(r["top"])) : max(0, int(np.ceil(r["bottom"]))), max(0, int(r["left"])) : max(0, int(np.ceil(r["right"])))] = 0
            out.append(a.tobytes())
        return pd.Series(out)

    return mask
