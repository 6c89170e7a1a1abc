"""N-gram Jaccard self-join with filters under several global token orders.

Every text becomes the set of its distinct word shingles. Two texts link when
their sets' Jaccard similarity reaches the threshold. Under any total order of
all tokens two linked sets share a token among the first n - ceil(t n) + 1 of
each. Three orders are used and their filters intersected: by rarity, by a hash
ascending and by the same hash descending. Rarity comes from one table of counts
over all texts, of fixed size, in which a task counts to 65,535 at most.

Postings of the rarity prefix meet by token. A token's rows are joined with one
hub of its list, which links a group of near copies by a star instead of all
its pairs; rows that the links already connect are then dropped from the lists,
hubs are taken off, and what is left between different components is compared
pair by pair. The links are exact and complete up to pairs that are already in
one component, so components are exact.

Texts with equal sets are one node throughout: a group of exact copies costs as
much as one text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import kernels
from millrace.llm.components import connected_components
from millrace.llm.store import written
from millrace.session import BROADCAST_BYTES

_WIDTH_BITS = 22
_PARTS = 64
_GROUP = 256
_POST = np.dtype([("token", "<u8"), ("node", "<u8"), ("n", "<u4"), ("pos", "<u4")])
_SALTS = 16
_FLUSH = 1 << 19
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _sets(text: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a batch."""
    for _, data, offsets in kernels.slices(text):
        hashes, starts = kernels.shingles(*kernels.words(data, offsets), size)
        for i in range(len(starts) - 1):
            part = np.sort(hashes[starts[i] : starts[i + 1]])
            yield part[np.concatenate([[True], part[1:] != part[:-1]])] if len(part) else part


def _node(tokens: np.ndarray) -> int:
    """One number for a set."""
    total = np.add.reduce(kernels.mix(tokens ^ _SALT)) + np.uint64(len(tokens))
    return int(kernels.mix(np.array([total], np.uint64)).view(np.int64)[0])


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _profile(size: int):
    """Per text its node and set size; once per task, the counts of its tokens by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _WIDTH_BITS, np.uint32)
        most = np.iinfo(np.uint16).max
        for batch in batches:
            nodes, sizes, held, n_held = [], [], [], 0
            for tokens in _sets(batch.column("text"), size):
                nodes.append(_node(tokens))
                sizes.append(len(tokens))
                held.append(tokens)
                n_held += len(tokens)
                if n_held > _FLUSH:
                    _count_into(counts, held)
                    held, n_held = [], 0
            _count_into(counts, held)
            n = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("doc_id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                names=["key", "doc_id", "node", "n", "part", "counts"],
            )
        if counts.any():
            rows = [np.minimum(x, most).astype(np.uint16).tobytes() for x in np.split(counts, _PARTS)]
            none = pa.nulls(_PARTS, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.nulls(_PARTS, pa.int32()), pa.array(range(_PARTS), pa.int32()), pa.array(rows, pa.binary())],
                names=["key", "doc_id", "node", "n", "part", "counts"],
            )

    return run


def _count_into(counts: np.ndarray, held: list[np.ndarray]) -> None:
    """Add the tokens by bucket in place; nothing of the table's width is made beside it."""
    if held:
        at, n = np.unique((np.concatenate(held) >> np.uint64(64 - _WIDTH_BITS)).astype(np.uint32), return_counts=True)
        counts[at] += n.astype(np.uint32)


def _add_counts(last: bool):
    """The sum of a group's tables, which pass through one at a time; the last round gives it by _scaled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, part = np.zeros((1 << _WIDTH_BITS) // _PARTS, np.uint64), None
        for batch in batches:
            part = batch.column("part")[0].as_py()
            for row in batch.column("counts"):
                raw = row.as_buffer()
                counts += np.frombuffer(raw, np.uint16 if raw.size == 2 * len(counts) else np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()), pa.array([(_scaled(counts) if last else counts).tobytes()], pa.binary()),
                pa.array([int(counts.sum())], pa.int64()),
            ],
            names=["part", "counts", "total"],
        )

    return run


def _rarity(profile: DataFrame) -> tuple[np.ndarray, int]:
    """Of all tokens by bucket, the logarithm of the count in steps of 1/256: eight megabytes, whatever the input.

    Also the number of all tokens. The tasks' tables are summed in rounds, at most _GROUP
    of them in one: a group is read as a stream and holds one sum.
    """
    parts = profile.filter("part IS NOT NULL").select("part", "counts")
    n = parts.count() // _PARTS
    while True:
        n = -(-n // _GROUP)
        grouped = parts.select("part", "counts").withColumn("group", F.pmod(F.xxhash64("counts"), F.lit(max(n, 1))).cast("int"))
        parts = grouped.groupBy("part", "group").applyInArrow(_add_counts(n <= 1), "part int, counts binary, total long")
        if n <= 1:
            break
    out = np.zeros(1 << _WIDTH_BITS, np.uint16)
    width, total = len(out) // _PARTS, 0
    for row in parts.collect():
        out[row.part * width : (row.part + 1) * width] = np.frombuffer(row.counts, np.uint16)
        total += row.total
    return out, total


def _scaled(counts: np.ndarray) -> np.ndarray:
    return np.round(256 * np.log2(1.0 + counts)).astype(np.uint16)


def _postings(size: int, percent: int, table, buckets: int, hot: int):
    """Packed postings of the rarity prefixes, a row for each bucket of tokens and flush."""

    def pack(held: list[np.ndarray]) -> pa.RecordBatch:
        counts = table.value
        rows = np.concatenate(held)
        bucket = ((rows["token"] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets
        is_hot = counts[(rows["token"] >> np.uint64(64 - _WIDTH_BITS)).astype(np.int64)] > hot
        bucket[is_hot] = (bucket[is_hot] + (rows["node"][is_hot] % np.uint64(_SALTS)).astype(np.int64)) % buckets
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        starts = np.concatenate([[0], cuts])
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[starts], pa.int32()), pa.array([x.tobytes() for x in np.split(rows, cuts)], pa.binary())],
            names=["bucket", "rows"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        held, n_held, seen = [], 0, set()
        for batch in batches:
            for tokens in _sets(batch.column("text"), size):
                n = len(tokens)
                if not n or (node := _node(tokens)) in seen:
                    continue
                seen.add(node)
                rarity = counts[(tokens >> np.uint64(64 - _WIDTH_BITS)).astype(np.int64)]
                p = _prefix(n, percent)
                rows = np.zeros(p, _POST)
                rows["token"] = tokens[np.argsort(rarity, kind="stable")[:p]]
                rows["node"] = np.int64(node).view(np.uint64)
                rows["n"] = n
                rows["pos"] = np.arange(p)
                held.append(rows)
                n_held += p
                if n_held > _FLUSH:
                    yield pack(held)
                    held, n_held, seen = [], 0, set()
        if held:
            yield pack(held)

    return run


def _meet(table, hot: int):
    """Of one bucket, the postings of tokens that more than one node has, or may have elsewhere."""

    def run(packed: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x.as_py(), _POST) for x in packed.column("rows")])
        rows = rows[np.lexsort((rows["node"], rows["token"]))]
        same = rows["token"][1:] == rows["token"][:-1]
        rows = rows[np.concatenate([[True], ~(same & (rows["node"][1:] == rows["node"][:-1]))])]
        same = rows["token"][1:] == rows["token"][:-1]
        shared = np.zeros(len(rows), bool)
        shared[1:] = same
        shared[:-1] |= same
        shared |= table.value[(rows["token"] >> np.uint64(64 - _WIDTH_BITS)).astype(np.int64)] > hot
        rows = rows[shared]
        return pa.table(
            {
                "token": pa.array(rows["token"].view(np.int64)), "node": pa.array(rows["node"].view(np.int64)),
                "n": pa.array(rows["n"].astype(np.int32)), "pos": pa.array(rows["pos"].astype(np.int32)),
            }
        )

    return run


def _set_rows(size: int):
    """Per text its node and its set as hashes in one order, which the kernel reads from both ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets, n_held = [], [], 0
            for tokens in _sets(batch.column("text"), size):
                nodes.append(_node(tokens))
                sets.append(np.sort(kernels.mix(tokens ^ _SALT)).tobytes())
                n_held += len(tokens)
                if n_held > _FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "tokens"])
                    nodes, sets, n_held = [], [], 0
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "tokens"])

    return run


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int(np.count_nonzero(y[at] == x))


def _verify(percent: int):
    """The pairs that pass the two hash orders and then the exact similarity."""

    def similar(x: np.ndarray, y: np.ndarray) -> bool:
        p, q = _prefix(len(x), percent), _prefix(len(y), percent)
        if not _common(x[:p], y[:q]) or not _common(x[-p:], y[-q:]):
            return False
        both = _common(x, y)
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _passes(percent: int) -> str:
    """Length and position filters between rows (n, pos) and (n2, pos2) that share a token.

    The bound holds for the first token two sets share, and that is one of the
    tokens at which they meet.
    """
    need = f"((n + n2) * {percent} + {99 + percent}) DIV {100 + percent}"
    return (
        f"100 * least(n, n2) >= {percent} * greatest(n, n2) "
        f"AND 1 + least(n - pos - 1, n2 - pos2 - 1) >= {need}"
    )


def _joined(docs: DataFrame, cand: DataFrame, profile: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    """The candidate pairs (a, b) that really link."""
    needed = cand.select(F.col("a").alias("need")).unionByName(cand.select(F.col("b").alias("need"))).distinct()
    nodes = profile.filter("part IS NULL AND n > 0").select("key", "node")
    keys = nodes.join(needed, F.col("node") == F.col("need")).groupBy("node").agg(F.min("key").alias("want")).select("want")
    keys = written(keys, f"{name}-keys")
    if keys.count() * 64 <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    texts = docs.join(keys, F.col("key") == F.col("want"), "left_semi").select("text")
    sets = written(texts.mapInArrow(_set_rows(size), "node long, tokens binary"), f"{name}-sets")
    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return written(cand.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long"), f"{name}-links")


def link_documents(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    percent: int = 75,
    hub_rounds: int = 1,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    component_id is the least id reachable over links, the row's own included.
    Two texts link when 100 * |intersection| >= percent * |union| of their sets
    of `words`-word shingles; a shorter text is one shingle. Null and empty
    texts, and texts without words, have no shingle and link with nothing.
    Repeated rows are kept and share a component. A null id keeps its row and
    never becomes a component_id unless its whole component has null ids.
    Other columns are not read, whatever their names; an empty table gives an
    empty result.
    """
    docs = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.xxhash64(F.col(text_column))).alias("key"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
    )
    profile = written(
        docs.mapInArrow(_profile(words), "key long, doc_id long, node long, n int, part int, counts binary"), "ngram-profile"
    )
    counts, total = _rarity(profile)
    hot = int(_scaled(np.array([max(64, 4 * math.ceil(total / len(counts)))]))[0])
    counts = docs.sparkSession.sparkContext.broadcast(counts)  # of fixed size
    buckets = max(64, math.ceil(total * (100 - percent) / 100 / 250_000))
    packed = docs.select("text").mapInArrow(_postings(words, percent, counts, buckets, hot), "bucket int, rows binary")
    rows = packed.groupBy("bucket").applyInArrow(_meet(counts, hot), "token long, node long, n int, pos int")
    rows = written(rows, "ngram-rows")
    counts.destroy()  # the rows are on shared storage, nothing reads it again

    links, passes = [], _passes(percent)
    spark = docs.sparkSession
    none = spark.createDataFrame([], "node long, component long")
    component = none
    for k in range(hub_rounds):
        hubs = rows.groupBy("token").agg(F.min(F.struct("pos", "n", "node")).alias("hub"))
        hubs = hubs.select(
            F.col("token").alias("at"), F.col("hub.pos").alias("pos2"), F.col("hub.n").alias("n2"), F.col("hub.node").alias("node2")
        )
        met = rows.join(hubs, F.col("token") == F.col("at")).filter("node <> node2")
        star = met.filter(passes).select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
        links.append(_joined(docs, written(star, "ngram-star"), profile, words, percent, f"ngram-{k}"))
        component = _components(links)
        rest = met.select("token", "node", "n", "pos").join(component.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        rest = rest.select("token", "node", "n", "pos", F.coalesce("component", "node").alias("c"))
        mixed = rest.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select(F.col("token").alias("at"))
        rows = written(rest.join(mixed, F.col("token") == F.col("at"), "left_semi"), "ngram-rest")
    if "c" not in rows.columns:
        rows = rows.withColumn("c", F.col("node"))
    other = rows.select(
        F.col("token").alias("at"), F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("c").alias("c2")
    )
    cross = rows.join(other, (F.col("token") == F.col("at")) & (F.col("node") < F.col("node2")) & (F.col("c") != F.col("c2")) & F.expr(passes))
    cross = written(cross.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct(), "ngram-cross")
    if not cross.isEmpty():
        links.append(_joined(docs, cross, profile, words, percent, "ngram-last"))
        component = _components(links)

    texts = profile.filter("part IS NULL").select("doc_id", "node", "n")
    component = component.withColumnRenamed("node", "of")
    texts = texts.join(component, (F.col("node") == F.col("of")) & (F.col("n") > 0), "left")
    texts = texts.select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("component", "node")).alias("c"))
    least = texts.filter("c IS NOT NULL").groupBy("c").agg(F.min("doc_id").alias("least")).withColumnRenamed("c", "group")
    return texts.join(least, F.col("c") == F.col("group"), "left").select(
        F.col("doc_id").alias(id_column),
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("least", "doc_id").alias("component_id"),
    )


def _components(links: list[DataFrame]) -> DataFrame:
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    return written(connected_components(edges), "ngram-components")
