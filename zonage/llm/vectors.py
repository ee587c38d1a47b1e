"""Integer vectors in blocks, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Components beyond this magnitude (after scaling) have squared distances or
# inner products that no 64-bit integer holds, from 64 components on.
LARGEST = 1 << 27


def integers(df: DataFrame, vector: Column, scale: int, components: int | None = None) -> tuple[Column, Column]:
    """``(kept, x)``: whether a vector takes part (not null, no component null,
    non-finite or beyond :data:`LARGEST` after scaling, and of the wanted
    length), and ``floor(scale * component)``, components taken as doubles."""
    double = vector.cast("array<double>")
    scaled = F.transform(double, lambda c: c * F.lit(float(scale)))
    # null: a null component; NaN is larger than any number
    fine = F.coalesce(F.forall(scaled, lambda c: F.coalesce(F.abs(c) <= F.lit(float(LARGEST)), F.lit(False))), F.lit(False))
    if components is not None:
        fine = fine & (F.size(vector) == components)
    return fine, F.transform(scaled, lambda c: F.floor(c).cast("int"))


def matrix(lists, width: int | None = None) -> np.ndarray:
    """Rows of an Arrow list array as a matrix, shorter ones padded with 0."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    width = int(sizes.max(initial=0)) if width is None else width
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out
