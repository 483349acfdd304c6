"""Keccak-256 (the pre-FIPS padding used by Ethereum), vectorised with numpy.

Spark has no Keccak (``sha2``/``sha3`` use the FIPS padding), so the two
places that need it -- event signature -> topic0 and EIP-55 checksums of
contract addresses -- call this from Arrow-batched pandas UDFs.  A batch of
messages is hashed at once: every lane operation of Keccak-f[1600] runs on a
numpy ``uint64`` vector holding that lane for all messages of the batch.

Round constants and rotation offsets are derived from their defining rules
(the rc(t) LFSR and the (x, y) -> (y, 2x + 3y) walk) instead of being typed in.
"""

from __future__ import annotations

import numpy as np

_RATE = 136  # bytes absorbed per block for a 256-bit digest
_MASK = (1 << 64) - 1


def _rc_bit(t: int) -> int:
    r = 1
    for _ in range(t % 255):
        r <<= 1
        if r & 0x100:
            r ^= 0x171
    return r & 1


def _round_constants() -> list[int]:
    out = []
    for rnd in range(24):
        c = 0
        for j in range(7):
            if _rc_bit(j + 7 * rnd):
                c |= 1 << ((1 << j) - 1)
        out.append(c)
    return out


def _rotations() -> list[int]:
    rot = [0] * 25
    x, y = 1, 0
    for t in range(24):
        rot[x + 5 * y] = ((t + 1) * (t + 2) // 2) % 64
        x, y = y, (2 * x + 3 * y) % 5
    return rot


_RC = [np.uint64(c) for c in _round_constants()]
_ROT = _rotations()
# pi: lane (x, y) moves to (y, 2x + 3y)
_PI_SRC = [0] * 25
for _y in range(5):
    for _x in range(5):
        _PI_SRC[_y + 5 * ((2 * _x + 3 * _y) % 5)] = _x + 5 * _y


def _rotl(v: np.ndarray, n: int) -> np.ndarray:
    if n == 0:
        return v
    return (v << np.uint64(n)) | (v >> np.uint64(64 - n))


def _keccak_f(state: list[np.ndarray]) -> list[np.ndarray]:
    a = state
    for rc in _RC:
        c = [a[x] ^ a[x + 5] ^ a[x + 10] ^ a[x + 15] ^ a[x + 20] for x in range(5)]
        d = [c[(x - 1) % 5] ^ _rotl(c[(x + 1) % 5], 1) for x in range(5)]
        a = [a[i] ^ d[i % 5] for i in range(25)]
        b = [None] * 25
        for dst in range(25):
            src = _PI_SRC[dst]
            b[dst] = _rotl(a[src], _ROT[src])
        a = [
            b[i] ^ (~b[(i % 5 + 1) % 5 + 5 * (i // 5)] & b[(i % 5 + 2) % 5 + 5 * (i // 5)])
            for i in range(25)
        ]
        a[0] = a[0] ^ rc
    return a


def _pad(msg: bytes) -> bytes:
    n = _RATE - (len(msg) % _RATE)
    pad = bytearray(n)
    pad[0] |= 0x01
    pad[-1] |= 0x80
    return msg + bytes(pad)


def keccak256_many(messages: list[bytes]) -> list[bytes]:
    """Keccak-256 digests of ``messages`` (same order)."""
    if not messages:
        return []
    out: list[bytes | None] = [None] * len(messages)
    padded = [_pad(m) for m in messages]
    by_blocks: dict[int, list[int]] = {}
    for i, p in enumerate(padded):
        by_blocks.setdefault(len(p) // _RATE, []).append(i)
    for nblocks, idx in by_blocks.items():
        buf = np.frombuffer(b"".join(padded[i] for i in idx), dtype="<u8").reshape(len(idx), nblocks, _RATE // 8)
        state = [np.zeros(len(idx), dtype=np.uint64) for _ in range(25)]
        for blk in range(nblocks):
            for lane in range(_RATE // 8):
                state[lane] = state[lane] ^ buf[:, blk, lane]
            state = _keccak_f(state)
        digest = np.stack(state[:4], axis=1).astype("<u8")
        raw = digest.tobytes()
        for k, i in enumerate(idx):
            out[i] = raw[32 * k: 32 * k + 32]
    return out  # type: ignore[return-value]


def keccak256_hex(text: str) -> str:
    return "0x" + keccak256_many([text.encode()])[0].hex()


def checksum_many(addresses: list[str | None]) -> list[str | None]:
    """EIP-55 mixed-case form of 0x-prefixed 20-byte hex addresses.

    Invalid inputs map to None. Duplicates are hashed once.
    """
    uniq: dict[str, str | None] = {}
    for a in addresses:
        if a is not None and a not in uniq:
            uniq[a] = None
    valid = []
    for a in uniq:
        low = a.lower()
        body = low[2:] if low.startswith("0x") else low
        if len(body) == 40 and all(ch in "0123456789abcdef" for ch in body):
            valid.append((a, body))
    digests = keccak256_many([b.encode() for _, b in valid])
    for (a, body), dg in zip(valid, digests):
        h = dg.hex()
        uniq[a] = "0x" + "".join(ch.upper() if ch > "9" and int(h[i], 16) >= 8 else ch for i, ch in enumerate(body))
    return [None if a is None else uniq[a] for a in addresses]
