"""Feature hashing (BKDR string hash) and padded sequence hashing.

The hash folds ``h = h * 131 + code`` over the characters of ``name:value`` in wrapping 32-bit
arithmetic, masks the sign bit and reduces modulo 2**27. Because 2**27 divides 2**32 the same
number results from folding modulo 2**27 throughout, which keeps every step inside a bigint.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the studied jobs: multiplier and hash space.
HASH_SEED = 131
HASH_SPACE = 134217728  # 2**27
SEQUENCE_LENGTH = 50    # padded length of hashed id sequences
SEQUENCE_PAD = "0"      # padding token


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_text(text: str, start: int = 0) -> int:
    """The same fold on the driver, for constant text (names, padding tokens)."""
    h = start
    for ch in text:
        h = (h * HASH_SEED + ord(ch)) % HASH_SPACE
    return h


def bkdr_hash(text, start: int = 0) -> Column:
    """Hash of a string column as a bigint in [0, 2**27), folding on from ``start``."""
    t = _col(text)
    folded = F.aggregate(F.split(t, ""), F.lit(start).cast("bigint"),
                         lambda acc, ch: F.pmod(acc * HASH_SEED + F.ascii(ch).cast("bigint"),
                                                F.lit(HASH_SPACE).cast("bigint")))
    # split('', '') yields [''] (one empty piece), which must not add a fold step.
    return F.when(F.length(t) == 0, F.lit(start).cast("bigint")).otherwise(folded)


def feature_prefix(value) -> Column:
    """Text that a ``split(':')`` of ``name:value`` yields at index 1, else ``-1``.

    Splitting drops trailing empty pieces, so a value made only of colons (or empty) has no
    second piece and maps to ``-1``; otherwise the piece is the value up to its first colon.
    """
    v = _col(value)
    return F.when(F.length(F.regexp_replace(v, ":", "")) > 0, F.substring_index(v, ":", 1)).otherwise(F.lit("-1"))


def hash_feature(name: str, value) -> Column:
    """``<prefix>:<hash of name:value>`` - the safe variant that never fails on empty values.

    The fold over the constant ``name:`` is done once on the driver; rows fold only their value.
    Pass a column reference (not a large expression) as ``value``: it is used three times.
    """
    v = _col(value)
    h = bkdr_hash(v, fold_text(name + ":"))
    return F.concat(feature_prefix(v), F.lit(":"), h.cast("string"))


def hashed_constant(name: str, value: str) -> str:
    """Driver-side ``hash_feature`` of a constant value."""
    prefix = value.split(":")[0] if value.replace(":", "") else "-1"
    return f"{prefix}:{fold_text(name + ':' + value)}"


def sequence_parts(value) -> Column:
    """Ids of a comma-joined list (trailing empty pieces dropped); empty for ``''`` / ``-1``."""
    v = _col(value)
    stripped = F.regexp_replace(v, ",+$", "")
    empty = (v == "") | (v == "-1") | (stripped == "")
    return F.when(empty, F.array().cast("array<string>")).otherwise(F.split(stripped, ","))


def hash_sequence_parts(parts, fea: str, length: int = SEQUENCE_LENGTH) -> Column:
    """Hash an id array padded with ``0`` / truncated to ``length``, then append its true length.

    Only real ids are hashed per row; the padding entry is one driver-side constant.
    """
    p = _col(parts)
    head = F.transform(F.slice(p, 1, length), lambda x: hash_feature(fea, x))
    n = F.least(F.size(p), F.lit(length))
    pad = F.array_repeat(F.lit(hashed_constant(fea, SEQUENCE_PAD)), (F.lit(length) - n).cast("int"))
    return F.concat(F.array_join(F.concat(head, pad), ","), F.lit(","), n.cast("string"))


def hash_sequence(value, fea: str, length: int = SEQUENCE_LENGTH) -> Column:
    """Hash a comma-joined id list (see :func:`hash_sequence_parts`)."""
    return hash_sequence_parts(sequence_parts(value), fea, length)
