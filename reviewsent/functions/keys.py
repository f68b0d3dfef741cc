"""Hash keys: the same row gets the same draw in every run and every partitioning."""

from pyspark.sql import Column, functions as F


def key_hash(key: Column, seed: int, purpose: str) -> Column:
    """md5 of ``seed:purpose:key`` as 32 hex digits.

    Each ``purpose`` is a stream of its own: a split of the rows that a sample has kept is
    not bent by the sample, whatever seeds are given. A null key counts as an empty one.
    """
    return F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), F.coalesce(key.cast("string"), F.lit(""))))


def hex_threshold(fraction: float) -> str:
    """Eight hex digits below which a share ``fraction`` (< 1) of all hashes lies."""
    return f"{int(fraction * 2**32):08x}"


def hash_below(key: Column, fraction: float, seed: int, purpose: str) -> Column:
    """True for a share ``fraction`` of all keys."""
    if fraction >= 1:
        return F.lit(True)
    return F.substring(key_hash(key, seed, purpose), 1, 8) < hex_threshold(fraction)


def row_digest(*columns: Column) -> Column:
    """256-bit digest of a row as 32 bytes: what a shuffle carries instead of whole texts.

    Each field is prefixed with its length, null is written apart, so different
    rows never share the digested string.
    """
    fields = []
    for column in columns:
        value = column.cast("string")
        prefixed = F.concat(F.length(value).cast("string"), F.lit(":"), value)
        fields.append(F.coalesce(prefixed, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*fields), 256))
