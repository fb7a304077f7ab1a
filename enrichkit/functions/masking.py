"""FN-20: masking of sensitive columns (coordinates, addresses).

``aes`` encrypts with AES-256-GCM (key supplied by the caller, 32 bytes) and
base64-encodes the result; ``sha2`` replaces the value with its SHA-256 hex
digest (one-way, deterministic, joinable).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask_columns(df: DataFrame, cols: list[str], key: str | None = None,
                 method: str = "sha2") -> DataFrame:
    exprs = {}
    for c in cols:
        src = F.col(c).cast("string")
        if method == "sha2":
            exprs[c] = F.sha2(src, 256)
        elif method == "aes":
            if key is None or len(key.encode()) != 32:
                raise ValueError("AES-256 masking needs a 32-byte key")
            exprs[c] = F.base64(F.aes_encrypt(src, F.lit(key), F.lit("GCM")))
        else:
            raise ValueError(f"unknown masking method {method!r}")
    return df.withColumns(exprs)


def unmask_aes(col: Column | str, key: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.aes_decrypt(F.unbase64(c), F.lit(key), F.lit("GCM")).cast("string")
