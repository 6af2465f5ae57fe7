"""Arrays as compressed bytes, for rows that carry many small values at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(x: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(x: bytes, kind) -> np.ndarray:
    size = int.from_bytes(x[:8], "little")
    return np.frombuffer(pa.decompress(x[8:], decompressed_size=size, codec="zstd"), kind)
