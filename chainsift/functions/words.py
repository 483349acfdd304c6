"""Column expressions over ABI hex text (no row-at-a-time Python).

Log payloads become bytes once: a 32-byte word is a substring of them, zero tests
compare against literal runs of zeros, integer ranges against literal words.  Only
integers wider than the JVM fast paths below reach the Arrow UDF in
:mod:`chainsift.functions.udfs`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = "0123456789abcdef"
WORD = 64  # hex characters per 32-byte word


def strip_0x(c: Column) -> Column:
    """Drop one leading ``0x``/``0X`` and lower-case."""
    c = F.coalesce(c, F.lit(""))
    return F.lower(F.when(F.lower(F.substring(c, 1, 2)) == "0x", F.substring(c, 3, 1 << 30)).otherwise(c))


def is_hex(h: Column, allow_empty: bool = True, even: bool = True) -> Column:
    """``h`` is made of hex digits (even length when ``even``).

    ``unhex`` decodes without per-character allocation and yields null on any
    non-hex character (``translate`` would allocate a String per character).
    """
    ok = F.unhex(h).isNotNull()
    if even:
        ok = ok & (F.length(h) % 2 == 0)
    if not allow_empty:
        ok = ok & (F.length(h) > 0)
    return ok


def word(h: Column, i: int, prefixed: bool = False) -> Column:
    """i-th 32-byte word of hex payload ``h`` (possibly partial / empty past the end)."""
    return F.substring(h, WORD * i + (3 if prefixed else 1), WORD)


def words(h: Column, first: int, count: int, prefixed: bool = False) -> Column:
    """``count`` consecutive words starting at word ``first`` (one substring)."""
    return F.substring(h, WORD * first + (3 if prefixed else 1), WORD * count)


def runs(indices) -> list[tuple[int, int]]:
    """Group sorted distinct word indices into (first, count) runs."""
    out: list[list[int]] = []
    for i in sorted(set(indices)):
        if out and out[-1][0] + out[-1][1] == i:
            out[-1][1] += 1
        else:
            out.append([i, 1])
    return [(a, n) for a, n in out]


def is_zero_hex(w: Column, width: int = WORD) -> Column:
    """True when every hex digit of ``w`` (at most ``width`` digits) is 0; empty counts as zero.

    Compared against a literal run of zeros of the same length (a memcmp).
    """
    w = F.coalesce(w, F.lit(""))
    return w == F.substring(F.lit("0" * width), F.lit(1), F.length(w))


def has_zero_prefix(w: Column, n: int) -> Column:
    """The first ``n`` digits of a 64-digit word are all zero."""
    return F.substring(w, 1, n) == F.lit("0" * n)


def address_from_word(w: Column) -> Column:
    return F.concat(F.lit("0x"), F.substring(w, 25, 40))


def address_from_topic(t: Column) -> Column:
    return F.concat(F.lit("0x"), F.right(F.lower(t), F.lit(40)))


def topic_body(t: Column) -> Column:
    """Hex digits of a topic, without its 0x prefix, lower-case."""
    return strip_0x(t)


def significant(h: Column) -> Column:
    """Hex digits left after stripping leading zeros."""
    return F.ltrim(h, F.lit("0"))


def int_bits(typ: str) -> int:
    """Bit width of an ABI ``intN``/``uintN`` type name (bare int/uint = 256)."""
    digits = typ[4:] if typ.startswith("uint") else typ[3:]
    return int(digits) if digits else 256


def is_int_type(typ: str) -> bool:
    return typ.startswith("uint") or typ.startswith("int")


def byte_words(payload: Column, first: int, count: int = 1) -> Column:
    """``count`` words of a payload in bytes from word ``first`` on (fewer bytes past its end).

    A substring of bytes is taken in place; one of text walks over every character before it."""
    return F.substring(payload, 32 * first + 1, 32 * count)


def is_zero_bytes(w: Column, width: int = 32) -> Column:
    """Every byte of ``w`` (at most ``width``) is 0; none counts as zero."""
    return w == F.substring(F.lit(bytes(width)), F.lit(1), F.length(w))


def address_from_bytes(w: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(F.substring(w, 13, 20))))


def topic_word(body: Column) -> Column:
    """The 32 bytes of a topic's digits, padded; null if they are no hex digits or more than one word."""
    return F.when(F.length(body) <= WORD, F.unhex(F.lpad(body, WORD, "0")))


def _word_of(v: int) -> Column:
    return F.lit(v.to_bytes(32, "big"))


def _u60(word: Column) -> Column:
    """The lowest 60 bits of a word as a long (exact)."""
    return F.conv(F.substring(F.hex(F.substring(word, 25, 8)), 2, 15), 16, 10).cast("long")


_Q18, _R18 = divmod(1 << 256, 10**18)
_E18 = 10**18


def _two256_minus(m: Column) -> Column:
    """Decimal text of ``2^256 - m`` for a long ``0 < m <= 2^62``, in long arithmetic only.

    With 2^256 = Q*10^18 + R and m = mh*10^18 + ml (mh <= 4): the low 18 digits are
    ``R - ml`` (or ``R + 10^18 - ml`` with a borrow) and the high part is one of the
    few literals ``Q - mh - borrow``.
    """
    ml = m % F.lit(_E18)
    mh = ((m - ml) / F.lit(_E18)).cast("long")  # exact: m - ml is a multiple of 10^18 below 2^63
    borrow = F.when(ml > F.lit(_R18), F.lit(1)).otherwise(F.lit(0))
    low = F.lit(_R18) + borrow * F.lit(_E18) - ml
    highs = F.array(*[F.lit(str(_Q18 - k)) for k in range(6)])
    return F.concat(F.element_at(highs, (mh + borrow + 1).cast("int")), F.lpad(low.cast("string"), 18, "0"))


def bytes_plan(word: Column, mode: int) -> tuple[Column, Column | None]:
    """JVM fast path for an integer in a word of 32 bytes, and whether it is left for the Arrow UDF.

    ``mode``: 0 unsigned; +N signed ``intN`` with the reference rule (``v >= 2^(N-1)``
    => ``v - 2^N`` on the full 256-bit word); -N signed ``intN`` by ABI rules (low N
    bits, two's complement).

    Returns ``(fast, left)``: ``fast`` is the decimal string when the value is
    handled JVM-side (else null); ``left`` is true of the other words, null ones too
    (None when the JVM path is exhaustive), so the UDF only sees the few wide values.
    """
    top, dist = word >= _word_of((1 << 256) - (1 << 60)), F.lit(1 << 60) - _u60(word)  # within 2^60 of 2^256, how far
    if mode == 0:
        handled = word <= _word_of((1 << 64) - 1)
        fast = F.when(handled, F.conv(F.hex(F.substring(word, 25, 8)), 16, 10)).when(top, _two256_minus(dist))
        return fast, ~F.coalesce(handled | top, F.lit(False))
    n = abs(mode)
    if mode < 0 and n <= 60:
        # ABI rule, narrow type: only the low N bits matter.
        low = _u60(word).bitwiseAND(F.lit((1 << n) - 1))
        val = F.when(low >= F.lit(1 << (n - 1)), low - F.lit(1 << n)).otherwise(low)
        return val.cast("string"), None
    handled, v = word <= _word_of((1 << 60) - 1), _u60(word)
    if n <= 60:
        v = F.when(v >= F.lit(1 << (n - 1)), v - F.lit(1 << n)).otherwise(v)
    fast = F.when(handled, v.cast("string"))
    if mode > 0 and n <= 61:
        # reference rule on a sign-extended narrow negative: 2^256 - (dist + 2^N)
        fast, handled = fast.when(top, _two256_minus(dist + F.lit(1 << n))), handled | top
    if n == 256 or mode < 0:
        # sign-extended small negative
        fast, handled = fast.when(top, (-dist).cast("string")), handled | top
    return fast, ~F.coalesce(handled, F.lit(False))


def decimal_plan(body: Column, mode: int, fixed_width: bool) -> tuple[Column, Column | None]:
    """``bytes_plan`` for hex text: the fast path, and the text that is left for the Arrow UDF (else null; None: nothing is).

    ``fixed_width``: ``body`` is exactly 64 digits (a data word); topics may have any length."""
    fast, left = bytes_plan(F.unhex(body) if fixed_width else topic_word(body), mode)
    return fast, None if left is None else F.when(left, body)


def zero_value_test(w: Column, typ: str, semantics: str) -> Column | None:
    """Whether a data word (32 bytes) decodes to integer 0; None for non-integer types."""
    if not is_int_type(typ):
        return None
    if typ.startswith("uint"):
        return is_zero_bytes(w)
    n = int_bits(typ)
    if semantics == "abi":
        if n % 8 == 0:
            return is_zero_bytes(F.substring(w, 33 - n // 8, n // 8))
        return is_zero_hex(F.right(F.hex(w), F.lit((n + 3) // 4))) if n % 4 == 0 else is_zero_bytes(w)
    if n >= 256:
        return is_zero_bytes(w)
    # reference rule: v - 2^N == 0 when v == 2^N
    return is_zero_bytes(w) | (w == _word_of(1 << n))
