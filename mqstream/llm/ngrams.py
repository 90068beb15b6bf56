"""Hashed byte n-grams of whole texts."""

from __future__ import annotations

import numpy as np

BITS = 16
SIZE = 1 << BITS
STEP = 1 << 20


def trigrams(raw: bytes) -> np.ndarray:
    """Hash in [0, SIZE) of each run of three bytes."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    h = (b[:-2] * np.uint32(65599) + b[1:-1]) * np.uint32(65599) + b[2:]
    return (h * np.uint32(2654435761)) >> np.uint32(32 - BITS)

