"""Exact dedup of batches against immutable snapshots.

A snapshot is a table of digests in buckets, with one static binary-fuse filter
per bucket. The distinct digests of a new batch meet the filters first. Those
that none may hold are new. The others join the snapshot's exact buckets, and
texts whose digests meet are compared byte by byte. Copies inside the new batch
are grouped on their own, before and apart from the filters.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import kernels
from millrace.llm.store import written
from millrace.session import BROADCAST_BYTES

_BUCKET_KEYS = 50_000
_FILTER = "bucket int, seed long, segment int, slots int, prints binary"


# ---- binary-fuse filters over arrays of distinct 64-bit keys

def _spots(keys: np.ndarray, seed: int, segment: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of every key, in neighbouring segments, and its print."""
    h = kernels.mix(keys + np.uint64(seed))
    span = np.uint64(slots - 2 * segment)
    first = ((h >> np.uint64(32)) * span) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(seed, segment, slots, prints) of a filter that holds the distinct keys."""
    n = len(keys)
    segment = 1 << min(18, max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    wanted = int(round(n * factor)) if n > 1 else 4
    slots = (max(-(-wanted // segment) - 2, 1) + 2) * segment
    for seed in range(1, 200):
        spots, prints = _spots(keys, seed * 0x9E3779B9, segment, slots)
        held = np.bincount(spots.ravel(), minlength=slots)
        names = np.zeros(slots, np.int64)
        for row in spots:
            np.bitwise_xor.at(names, row, np.arange(n))
        order: list[tuple[np.ndarray, np.ndarray]] = []
        done = 0
        while len(alone := np.flatnonzero(held == 1)):
            key, at = np.unique(names[alone], return_index=True)
            order.append((key, alone[at]))
            done += len(key)
            for row in spots:
                np.subtract.at(held, row[key], 1)
                np.bitwise_xor.at(names, row[key], key)
        if done == n:
            table = np.zeros(slots, np.uint8)
            for key, slot in reversed(order):
                s = spots[:, key]
                table[slot] = 0
                table[slot] = prints[key] ^ table[s[0]] ^ table[s[1]] ^ table[s[2]]
            return seed * 0x9E3779B9, segment, slots, table
    raise RuntimeError("no seed gave a filter; are the keys distinct?")


def may_hold(keys: np.ndarray, seed: int, segment: int, slots: int, table: np.ndarray) -> np.ndarray:
    spots, prints = _spots(keys, seed, segment, slots)
    return (table[spots[0]] ^ table[spots[1]] ^ table[spots[2]]) == prints


# ---- digests

def _digest(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for _, data, offsets in kernels.slices(batch.column("text")):
                data = kernels.LOWER_ASCII[data].tobytes()
                texts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                arrays = [batch.column("doc_id")[row : row + len(texts)], pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
                names = ["doc_id", "sha"]
                if with_text:
                    arrays.append(pa.array(texts, pa.binary()))
                    names.append("bytes")
                row += len(texts)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, sha) of every row: SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    return docs.mapInArrow(_digest(False), "doc_id long, sha string")


def grouped(marked: DataFrame) -> DataFrame:
    """(sha, size, last): the copies within one batch; counts combine before the shuffle."""
    return marked.groupBy("sha").agg(F.count("*").alias("size"), F.max("doc_id").alias("last"))


def _key(sha: Column) -> Column:
    return F.conv(F.substring(sha, 1, 15), 16, 10).cast("long")


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("key", _key(F.col("sha"))).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))


def snapshot_filters(groups: DataFrame) -> DataFrame:
    """One filter per bucket of a snapshot's digests; `groups` has bucket and key."""

    def build(table: pa.Table) -> pa.Table:
        keys = np.unique(table.column("key").to_numpy()).astype(np.uint64)
        seed, segment, slots, prints = build_filter(keys)
        return pa.table(
            {
                "bucket": table.column("bucket")[:1], "seed": pa.array([seed], pa.int64()), "segment": pa.array([segment], pa.int32()),
                "slots": pa.array([slots], pa.int32()), "prints": pa.array([prints.tobytes()], pa.binary()),
            }
        )

    return groups.select("bucket", "key").groupBy("bucket").applyInArrow(build, _FILTER)


def screen(groups: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows of a new batch's groups that the snapshot may hold."""

    def run(new: pa.Table, held: pa.Table) -> pa.Table:
        if not len(held) or not len(new):
            return new.slice(0, 0)
        row = held.to_pylist()[0]
        keys = new.column("key").to_numpy().astype(np.uint64)
        keep = may_hold(keys, row["seed"], row["segment"], row["slots"], np.frombuffer(row["prints"], np.uint8))
        return new.filter(pa.array(keep))

    return groups.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(run, groups.schema)


def dedup(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", batch: Column | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest id stays. `batch` says which rows
    are the snapshot (false) and which the batch that comes to it (true); by
    default a hash of the id decides. The result does not depend on it. Rows
    repeated with their id count in group_size and are kept together; a null id
    is smaller than all others. Other columns are not read, and an empty table
    gives an empty result.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    marked = written(digests(docs), "exact-digests")
    new = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1 if batch is None else batch, F.lit(False))
    old_groups, new_groups = grouped(marked.filter(~new)), grouped(marked.filter(new))
    buckets = max(64, math.ceil(marked.count() / _BUCKET_KEYS))
    snapshot = written(_bucketed(old_groups, buckets), "exact-snapshot")
    filters = written(snapshot_filters(snapshot), "exact-filters")
    incoming = written(_bucketed(new_groups, buckets), "exact-batch")
    positive = screen(incoming, filters)
    inside = snapshot.select(F.col("bucket").alias("in"), F.col("sha").alias("of"), F.col("size").alias("size2"), F.col("last").alias("last2"))
    met = positive.join(inside, (F.col("bucket") == F.col("in")) & (F.col("sha") == F.col("of")))
    met = written(met.select("of", F.col("size").alias("more"), F.col("last").alias("later")), "exact-met")

    total = snapshot.join(met, F.col("sha") == F.col("of"), "left").select(
        "sha", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"), F.greatest("last", "later").alias("last")
    )
    fresh = incoming.join(met, F.col("sha") == F.col("of"), "left_anti").select("sha", "size", "last")
    total = written(total.unionByName(fresh), "exact-groups")
    split = _unequal(docs, marked, total)
    rows = marked.join(total.withColumnRenamed("sha", "of"), F.col("sha") == F.col("of")).select("doc_id", "sha", "last", "size")
    if not split.isEmpty():
        rows = _by_bytes(docs, rows, split)
    return rows.select(
        F.col("doc_id").alias(id_column),
        F.col("last").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("last")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _texts_of(docs: DataFrame, marked: DataFrame, shas: DataFrame) -> DataFrame:
    """(doc_id, sha, bytes) of the rows with one of the digests."""
    ids = written(marked.join(shas, "sha", "left_semi").select(F.col("doc_id").alias("want")).distinct(), "exact-ids")
    ids = F.broadcast(ids) if ids.count() * 64 <= BROADCAST_BYTES else ids
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("want")), "left_semi")
    return texts.mapInArrow(_digest(True), "doc_id long, sha string, bytes binary")


def _unequal(docs: DataFrame, marked: DataFrame, total: DataFrame) -> DataFrame:
    """The digests under which the texts themselves differ.

    Grouping by the bytes compares them; copies combine before the shuffle.
    """
    several = total.filter("size > 1").select("sha")
    kinds = _texts_of(docs, marked, several).groupBy("sha", "bytes").agg(F.count("*").alias("n"))
    return written(kinds.groupBy("sha").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("sha"), "exact-unequal")


def _by_bytes(docs: DataFrame, rows: DataFrame, split: DataFrame) -> DataFrame:
    """Rows whose digest stands for several texts, grouped by the texts."""
    texts = _texts_of(docs, rows, split).join(split, "sha", "left_semi")
    kinds = texts.groupBy("sha", "bytes").agg(F.max("doc_id").alias("last"), F.count("*").alias("size"))
    kinds = kinds.select(F.col("sha").alias("s2"), F.col("bytes").alias("b2"), "last", "size")
    texts = texts.join(kinds, (F.col("sha") == F.col("s2")) & (F.col("bytes") == F.col("b2"))).select("doc_id", "sha", "last", "size")
    return rows.join(split, "sha", "left_anti").unionByName(texts)
