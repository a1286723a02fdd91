"""Vectors of whole numbers from array columns, inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute


def lengths(column: pa.Array) -> np.ndarray:
    """Lengths of lists; -1 for null."""
    return np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), -1))


def whole(column: pa.Array, d: int, times: int, plus: int = 0, limit: float = 2.0 ** 52) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors, and floor(times * entry) + plus of theirs.
    Usable: of length ``d``, no entry null or not finite, every floor's size under
    ``limit``."""
    places = np.flatnonzero(lengths(column) == d)
    flat = column.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False).astype(float)
    scaled = np.floor(flat.reshape(len(places), d) * times)
    good = (np.abs(scaled) < limit).all(axis=1)  # false for NaN too
    return places[good], scaled[good].astype(np.int64) + plus
