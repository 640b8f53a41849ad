"""Integer components of a column of vectors, as numpy arrays inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute


def floors(column: pa.Array, scale: float, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of an Arrow list column, and floor(scale * x) of their components.

    Null vectors and vectors with a null or non-finite component are not usable. Shorter vectors are filled with zeros up to
    ``dim`` components, or up to the longest. Components whose products could pass 2^53 raise an error, since results
    would no longer be exact.
    """
    column = column.slice(0)
    lengths = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0), np.int64)
    flat = column.flatten()
    values = np.floor(scale * np.asarray(pa.compute.fill_null(flat.cast(pa.float64()), float("nan")), np.float64))
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    kept = np.flatnonzero(np.asarray(column.is_valid()) & (bad[ends] == bad[ends - lengths]))
    dim = int(lengths[kept].max(initial=0)) if dim is None else dim
    if len(kept) and (lengths[kept] == dim).all():
        parts = values.reshape(len(lengths), dim)[kept] if (lengths == dim).all() else values[((ends - lengths)[kept, None] + np.arange(dim))]
    else:
        parts = np.zeros((len(kept), dim))
        for i, k in enumerate(kept):
            parts[i, : lengths[k]] = values[ends[k] - lengths[k] : ends[k]]
    if parts.size and np.abs(parts).max() ** 2 * dim * 16 >= 2.0**53:
        raise ValueError("components are too large for exact products")
    return kept, parts
