"""Arrays in one compressed binary value."""

from __future__ import annotations

import pickle

import numpy as np
import zstandard


def packed(**arrays: np.ndarray) -> bytes:
    return zstandard.compress(pickle.dumps({k: _planes(v) for k, v in arrays.items()}), 1)


def _planes(array: np.ndarray) -> tuple:
    """The bytes of equal weight side by side: those that vary little compress well."""
    array = np.ascontiguousarray(array)
    return array.dtype.str, np.ascontiguousarray(array.view(np.uint8).reshape(len(array), -1).T).tobytes() if len(array) else b""


def unpacked(content: bytes) -> dict[str, np.ndarray]:
    found = {}
    for name, (kind, planes) in pickle.loads(zstandard.decompress(content)).items():
        kind = np.dtype(kind)
        flat = np.frombuffer(planes, np.uint8)
        found[name] = np.ascontiguousarray(flat.reshape(kind.itemsize, -1).T).view(kind).ravel()
    return found
