"""Random perturbation of reading values.

Two forms:

* ``seeded`` uses Spark's ``rand``/``randn``: fast, but a draw depends on
  how rows fall into partitions, so a retried task may draw differently.
* ``hashed`` derives the draw from an MD5 of row-identifying columns, so the
  same row always gets the same noise, on retries and in any engine that has
  MD5.  Gaussian draws use the Box-Muller transform on two such uniforms.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.text import as_col

_TWO_52 = float(2 ** 52)


def hash_uniform(*key_cols, salt: str = "u") -> Column:
    """Uniform [0, 1) from the first 13 hex digits (52 bits) of an MD5."""
    text = F.concat_ws("|", F.lit(salt), *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in key_cols])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return bits / F.lit(_TWO_52)


def hash_gaussian(*key_cols, salt: str = "g") -> Column:
    """Standard normal draw via Box-Muller on two hashed uniforms."""
    u1 = hash_uniform(*key_cols, salt=salt + "1")
    u2 = hash_uniform(*key_cols, salt=salt + "2")
    # 1 - u1 lies in (0, 1], so the log is finite.
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def noise(kind: str, key_cols=(), seed: int | None = None, mode: str = "hashed", salt: str | None = None) -> Column:
    """Noise column of ``kind`` in {none, gaussian, uniform}; hashed draws with
    different salts are independent."""
    if kind == "none":
        return F.lit(0.0)
    if mode == "seeded":
        return F.randn(seed) if kind == "gaussian" else F.rand(seed)
    if not key_cols:
        raise ValueError("hashed noise needs row-identifying key columns")
    if kind == "gaussian":
        return hash_gaussian(*key_cols, salt=salt or "g")
    if kind == "uniform":
        return hash_uniform(*key_cols, salt=salt or "u")
    raise ValueError(f"unknown noise kind {kind!r}")
