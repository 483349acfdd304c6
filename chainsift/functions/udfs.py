"""Arrow-batched pandas UDFs for the two things Spark cannot express natively.

* ``wide_int_to_decimal`` -- 256-bit integers (78 decimal digits exceed
  ``DecimalType``'s 38).  It only receives the values the JVM fast paths in
  :func:`chainsift.functions.words.decimal_plan` left over; everything else
  arrives as null and costs nothing.
* ``checksum_address`` -- EIP-55 needs Keccak-256.  Each Arrow batch hashes
  its *distinct* addresses once (vectorised Keccak), and a per-worker cache
  carries results across batches, so a pool that emits millions of logs costs
  one hash per worker -- no shuffle, no join, nothing broadcast.
* ``keccak_topic`` -- event signature -> topic0, used on the (small) ABI table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from .keccak import checksum_many, keccak256_many

_CHECKSUM_CACHE: dict[str, str | None] = {}
_CACHE_LIMIT = 1 << 18


def _to_decimal(body: str | None, mode) -> str | None:
    """Decimal text of hex digits; of a list ``name:mode=digits,...`` the list ``name=decimal,...``."""
    if body is None:
        return None
    if "=" in body:
        parts = (x.replace("=", ":").split(":") for x in body.split(","))
        return ",".join(f"{name}={v}" for name, m, digits in parts if (v := _to_decimal(digits, int(m))) is not None)
    try:
        v = int(body, 16)
    except (ValueError, TypeError):
        return None
    m = 0 if mode is None or mode != mode else int(mode)
    if m > 0:
        if v >= 1 << (m - 1):
            v -= 1 << m
    elif m < 0:
        n = -m
        v &= (1 << n) - 1
        if v >= 1 << (n - 1):
            v -= 1 << n
    return str(v)


@pandas_udf(StringType())
def wide_int_to_decimal(bodies: pd.Series, modes: pd.Series) -> pd.Series:
    out = pd.Series(None, index=bodies.index, dtype=object)
    present = bodies.notna().to_numpy().nonzero()[0]
    if len(present):  # the JVM fast paths leave most rows null: touch only the rest
        b = bodies.to_numpy()[present]
        m = modes.to_numpy()[present]
        out.iloc[present] = [_to_decimal(x, y) for x, y in zip(b, m)]
    return out


@pandas_udf(StringType())
def checksum_address(addresses: pd.Series) -> pd.Series:
    uniq = pd.unique(addresses.dropna())
    # the batch's own map is complete before anything is evicted
    found = {a: _CHECKSUM_CACHE[a] for a in uniq if a in _CHECKSUM_CACHE}
    missing = [a for a in uniq if a not in found]
    if missing:
        found.update(zip(missing, checksum_many(missing)))
        if len(_CHECKSUM_CACHE) + len(missing) > _CACHE_LIMIT:
            _CHECKSUM_CACHE.clear()
        _CHECKSUM_CACHE.update((a, found[a]) for a in missing)
    return addresses.map(found).astype(object)


@pandas_udf(StringType())
def keccak_topic(signatures: pd.Series) -> pd.Series:
    vals = signatures.tolist()
    present = [s for s in vals if s is not None]
    digests = dict(zip(present, ("0x" + d.hex() for d in keccak256_many([s.encode() for s in present]))))
    return pd.Series([None if s is None else digests[s] for s in vals], dtype=object)
