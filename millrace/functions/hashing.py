"""Row hashes for splits and folds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Keys:
    """The columns that decide a row's part.

    The hash depends on nothing but the row's own values, so a task that runs
    again after a lost executor puts every row back where it was. The default
    is xxhash64; `portable` takes md5 over text, more than ten times the work,
    to get the same parts in any engine.
    """

    columns: tuple[str, ...]
    portable: bool = False

    @staticmethod
    def of(keys: Keys | Sequence[str]) -> Keys:
        return keys if isinstance(keys, Keys) else Keys(tuple(keys))

    def __iter__(self) -> Iterator[str]:
        return iter(self.columns)


def hash_bucket(keys: Keys | Sequence[str], buckets: int, salt: str = "") -> Column:
    """Bucket 0..buckets-1. Two splits of the same rows need different salts,
    or the second follows the first."""
    keys = Keys.of(keys)
    first = [F.lit(salt)] if salt else []
    if not keys.portable:
        return F.pmod(F.xxhash64(*first, *keys), F.lit(buckets)).cast("int")
    text = F.concat_ws("|", *first, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (number % buckets).cast("int")
