"""Scalar expressions: names, hashes, time, statistics, uncertainty."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import LongType

from boxloom.constants import STEM_FORMAT, TAXONOMY, Z95
from boxloom.functions.geometry import c


def stem_timestamp(stem) -> Column:
    """Capture time from a file stem; null when the name does not follow the format."""
    return F.try_to_timestamp(c(stem), F.lit(STEM_FORMAT))


def path_camera(path) -> Column:
    return F.regexp_extract(c(path), r"([^/]+)/[^/]+$", 1)


def path_stem(path) -> Column:
    return F.regexp_extract(c(path), r"([^/]+?)(?:\.[^./]*)?$", 1)


def image_identity(dataset, capture, camera) -> Column:
    """Stable image id from the source identity; never from a task id."""
    return F.sha2(F.concat_ws("|", c(dataset), c(capture).cast("string"), c(camera)), 256)


def sha256(value) -> Column:
    return F.sha2(c(value), 256)


def delta_ms(later_us, earlier_us) -> Column:
    return (c(later_us) - c(earlier_us)) / F.lit(1000.0)


def class_name(class_id) -> Column:
    pairs = [F.lit(v) for cid, name, _ in TAXONOMY if cid is not None for v in (cid, name)]
    return F.try_element_at(F.create_map(*pairs), c(class_id))


def class_number(label) -> Column:
    pairs = [F.lit(v) for cid, name, _ in TAXONOMY if cid is not None for v in (name, cid)]
    return F.try_element_at(F.create_map(*pairs), c(label))


def clamp_probability(score, eps: float = 1e-6) -> Column:
    return F.least(F.greatest(c(score), F.lit(eps)), F.lit(1.0 - eps))


def temperature_scaled(score, temperature) -> Column:
    s = clamp_probability(score)
    logit = F.log(s / (F.lit(1.0) - s))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit / c(temperature)))


def wilson_lower(successes, trials, z: float = Z95) -> Column:
    """Lower end of the Wilson score interval; null without trials."""
    n = F.when(c(trials) > 0, c(trials).cast("double"))
    p = c(successes).cast("double") / n
    z2 = F.lit(z * z)
    spread = F.lit(z) * F.sqrt(p * (1.0 - p) / n + z2 / (4.0 * n * n))
    return (p + z2 / (2.0 * n) - spread) / (1.0 + z2 / n)


def hamming(a, b) -> Column:
    return F.bit_count(c(a).bitwiseXOR(c(b)))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, term: total + term)


def cosine(a, b) -> Column:
    a, b = c(a), c(b)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


@lru_cache(maxsize=8)
def _signs(width: int) -> np.ndarray:
    """Sign of each component (rows) in each of 64 projections: a bit of a mixed number of both."""
    j, i = np.arange(1, width + 1, dtype=np.int64)[:, None], np.arange(1, 65, dtype=np.int64)[None, :]
    mixed = (i * 7919 + j * 104729 + i * j * 1299709) % 1000003
    return np.where(mixed * mixed % 1000003 % 2 == 0, 1.0, -1.0)


@F.pandas_udf(LongType())
def _sign_hash(vectors: pd.Series) -> pd.Series:
    out = np.zeros(len(vectors), np.int64)
    known = vectors.notna().to_numpy()
    widths = np.array([len(v) if v is not None else -1 for v in vectors])
    for width in np.unique(widths[known & (widths > 0)]):
        rows = np.flatnonzero(widths == width)
        with np.errstate(invalid="ignore"):
            above = np.stack([np.asarray(vectors.iloc[r], float) for r in rows]) @ _signs(int(width)) > 0
        out[rows] = np.packbits(above, axis=1, bitorder="little").view(np.int64)[:, 0]
    return pd.Series(out).astype("Int64").where(known)


def sign_hash(vector) -> Column:
    """64-bit hash: bit i is set where the i-th seeded projection of the whole vector is positive.

    A projection adds or takes away each component; the rule holds for any width. One matrix product per Arrow batch;
    a null component counts as not a number, which sets no bit.
    """
    return _sign_hash(c(vector))


def least_confidence(score) -> Column:
    return F.lit(1.0) - c(score)


def binary_entropy(score) -> Column:
    s = clamp_probability(score)
    return -(s * F.log2(s) + (1.0 - s) * F.log2(1.0 - s))


def canonical_json(*columns) -> Column:
    """JSON with a fixed key order and explicit nulls."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def config_hash(*columns) -> Column:
    return F.sha2(canonical_json(*columns), 256)
