from millrace.functions.hashing import Keys, hash_bucket
from millrace.functions.vectors import (
    as_doubles,
    one_hot_position,
    squared_distance,
    vector_slots,
)

__all__ = [
    "Keys",
    "as_doubles",
    "hash_bucket",
    "one_hot_position",
    "squared_distance",
    "vector_slots",
]
