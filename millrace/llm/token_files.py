"""Token ids in files of directly addressable codes.

A file holds the ids of some documents end to end. An id is cut into chunks of
bits, lowest first. Level 0 has the first chunk of every id, level 1 the second
of those that have one, and so on. A level is its chunks, bit-packed, a bitmap
that says which ids go on, and a rank directory over the bitmap, which gives an
id's place on the next level. So any id is read from a few bytes a level, and
any range of ids is a contiguous range on each level; no block is decoded. The
chunk widths are those that make the file smallest.

Documents are dealt by range of their id, tokenised where they land and written
to files in that order. A file counts when the row that names it does: what a
lost task leaves behind has another name and no row.

Layout, little-endian: 8 bytes magic, 4 bytes length of a JSON header, header,
then the arrays at the offsets the header names.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm import kernels
from millrace.llm.packing import Encoder
from millrace.llm.store import folder, written

MAGIC = b"MRDAC001"
_WIDEST = 24
_BLOCK_BITS = 512  # of the bitmap, for one entry of the rank directory
_RANK_BITS = 32
_PIECE = 1 << 20  # ids worked on at once
_PAD = 8


def chunk_widths(histogram: np.ndarray) -> list[int]:
    """Widths of the levels with the fewest bits in all, from the number of ids by bit length."""
    top = max((b for b in range(len(histogram)) if histogram[b]), default=1) or 1
    longer = [int(histogram[b + 1 :].sum()) for b in range(top + 1)]
    longer[0] = int(histogram.sum())
    best: list[tuple[float, int]] = [(0.0, 0)] * (top + 1)
    for at in range(top - 1, -1, -1):
        options = []
        for to in range(at + 1, min(top, at + _WIDEST) + 1):
            bitmap = longer[at] * (1 + _RANK_BITS / _BLOCK_BITS) if to < top else 0
            options.append((longer[at] * (to - at) + bitmap + best[to][0], to))
        best[at] = min(options)
    widths, at = [], 0
    while at < top:
        widths.append(best[at][1] - at)
        at = best[at][1]
    return widths


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    """Number of ids by bit length; 0 counts as one bit."""
    out = np.zeros(33, np.int64)
    for at in range(0, len(ids), _PIECE):
        out += np.bincount(np.frexp(np.maximum(ids[at : at + _PIECE], 1).astype(np.float64))[1], minlength=33)
    return out


def _packed(chunks: np.ndarray, width: int) -> bytes:
    kind = "u1" if width <= 8 else "<u2" if width <= 16 else "<u4"
    parts = []
    for at in range(0, len(chunks), _PIECE):  # a multiple of eight, so that parts begin at bytes
        part = chunks[at : at + _PIECE].astype(kind)
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), -1)[:, :width]
        parts.append(np.packbits(bits.ravel(), bitorder="little").tobytes())
    return b"".join(parts) + bytes(_PAD)


def encode_file(ids: np.ndarray, starts: np.ndarray, keys: np.ndarray, known: np.ndarray) -> bytes:
    """The bytes of a file of documents ids[starts[k]:starts[k + 1]]; `known` says which keys are not null."""
    ids = np.ascontiguousarray(ids, np.uint32)
    parts: list[bytes] = []
    filled = 0

    def put(data: bytes) -> int:
        nonlocal filled
        at = filled
        padded = data + bytes(-len(data) % 8)
        parts.append(padded)
        filled += len(padded)
        return at

    levels, rest = [], ids
    widths = chunk_widths(_bit_lengths(ids))
    for k, width in enumerate(widths):
        level = {"width": width, "n": len(rest), "chunks": put(_packed(rest & np.uint32((1 << width) - 1), width))}
        if k + 1 < len(widths):
            rest = rest >> np.uint32(width)
            more = rest > 0
            bitmap = np.packbits(more, bitorder="little")
            bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (_BLOCK_BITS // 8) + _BLOCK_BITS // 8, np.uint8)])
            ones = np.bitwise_count(bitmap.view(np.uint64)).reshape(-1, _BLOCK_BITS // 64).sum(axis=1, dtype=np.int64)
            level["bitmap"] = put(bitmap.tobytes())
            level["ranks"] = put((np.cumsum(ones) - ones).astype("<u4").tobytes())
            rest = rest[more]
        levels.append(level)
    header = {
        "ids": len(ids), "documents": len(keys), "levels": levels, "starts": put(starts.astype("<i8").tobytes()),
        "keys": put(keys.astype("<i8").tobytes()), "known": put(known.astype(np.uint8).tobytes()),
    }
    text = json.dumps(header).encode()
    text += b" " * (-(len(MAGIC) + 4 + len(text)) % 8)
    return b"".join([MAGIC, len(text).to_bytes(4, "little"), text, *parts])


class TokenFile:
    """Random access to a file. `source` has read_at(n_bytes, offset), as Arrow's random access files do."""

    def __init__(self, source):
        self.source = source
        head = source.read_at(len(MAGIC) + 4, 0)
        if bytes(head[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        size = int.from_bytes(head[len(MAGIC) :], "little")
        self.base = len(MAGIC) + 4 + size
        self.header = json.loads(bytes(source.read_at(size, len(MAGIC) + 4)))
        self.n_ids, self.n_documents = self.header["ids"], self.header["documents"]
        self.bytes_read = 0

    def _read(self, kind: str, at: int, count: int) -> np.ndarray:
        size = np.dtype(kind).itemsize
        self.bytes_read += size * count
        return np.frombuffer(self.source.read_at(size * count, self.base + at), kind)

    def documents(self, first: int, end: int) -> tuple[list[int | None], np.ndarray]:
        """Keys of documents first to end, and where their ids begin, the last one's end included."""
        header = self.header
        keys = self._read("<i8", header["keys"] + 8 * first, end - first).tolist()
        known = self._read("u1", header["known"] + first, end - first)
        keys = [k if ok else None for k, ok in zip(keys, known, strict=True)]
        return keys, self._read("<i8", header["starts"] + 8 * first, end - first + 1)

    def _chunks(self, level: dict, first: int, end: int) -> np.ndarray:
        """A level's chunks first to end."""
        width = level["width"]
        low = first * width >> 3
        data = self._read("u1", level["chunks"] + low, ((end * width + 7) >> 3) - low + 4)
        bit = np.arange(first, end, dtype=np.int64) * width - (low << 3)
        at = bit >> 3
        word = data[at].astype(np.uint32)
        for k in range(1, (width + 14) >> 3):
            word |= data[at + k].astype(np.uint32) << np.uint32(8 * k)
        return (word >> (bit & 7).astype(np.uint32)) & np.uint32((1 << width) - 1)

    def _rank(self, level: dict, at: int) -> int:
        """How many ids of a level before `at` go on: a directory entry and one block of the bitmap."""
        block = at // _BLOCK_BITS
        before = int(self._read("<u4", level["ranks"] + 4 * block, 1)[0])
        bits = np.unpackbits(self._read("u1", level["bitmap"] + block * (_BLOCK_BITS // 8), _BLOCK_BITS // 8), bitorder="little")
        return before + int(bits[: at - block * _BLOCK_BITS].sum())

    def ids(self, first: int, end: int) -> np.ndarray:
        """Ids first to end of the file."""
        if not 0 <= first <= end <= self.n_ids:
            raise IndexError((first, end))
        out = np.zeros(end - first, np.uint32)
        open_at: np.ndarray | slice = slice(None)
        shift = 0
        for level in self.header["levels"]:
            if first == end:
                break
            out[open_at] |= self._chunks(level, first, end) << np.uint32(shift)
            shift += level["width"]
            if "bitmap" not in level:
                break
            low = first >> 3
            bits = np.unpackbits(self._read("u1", level["bitmap"] + low, ((end + 7) >> 3) - low), bitorder="little")
            more = np.flatnonzero(bits[first - (low << 3) : end - (low << 3)])
            open_at = more if isinstance(open_at, slice) else open_at[more]
            first = self._rank(level, first)
            end = first + len(more)
        return out

    def id_at(self, at: int) -> int:
        """One id of the file."""
        return int(self.ids(at, at + 1)[0])


def _open(path: str):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _write(path: str, data: bytes) -> None:
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(name) as out:
        out.write(data)


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


MANIFEST = "part int, number int, path string, documents long, ids long"


def write_token_files(
    docs: DataFrame,
    *,
    tokenizer: str,
    end_id: int,
    path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    file_ids: int = 1 << 24,
    partition_bytes: int = 64 << 20,
) -> DataFrame:
    """Write all documents' ids to files in ascending order of their id; one row per file, with the ids before it.

    The rows are (part, number, path, documents, ids, start). Every text is
    encoded under the tokenizer file, then `end_id` follows. A null text is an
    empty one, a null id comes first. Rows that share an id come in the order
    of a hash of their texts. An empty table makes no file. Other columns are
    not read. A file ends at the first document's end from `file_ids` on, so
    it holds a document of any length whole.

    `path` is a folder every executor can write to, as a URI of a kind that
    Arrow opens (file, s3, gs, hdfs); without one it lies below the shared folder
    and goes at the driver's exit.
    """
    place = _uri(path or folder(docs.sparkSession, "token-files"))
    docs = docs.select(F.col(id_column).cast("long").alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    # ties are dealt too: a repeated id, or row, is spread over the ranges
    keyed = docs.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["key", "tie", "row"]
    dealt = keyed.repartitionByRange(max(1, math.ceil(total / partition_bytes)), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = Encoder(tokenizer, end_id)
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        keys: list[pa.Array] = []
        made = n_ids = 0

        def close() -> pa.RecordBatch:
            nonlocal made, n_ids
            starts = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)
            column = pa.concat_arrays(keys)
            known = np.asarray(column.is_valid())
            name = f"{place}/part-{part:06d}-{made:06d}-{uuid.uuid4().hex}.dac"
            _write(name, encode_file(np.concatenate(ids), starts, np.asarray(column.fill_null(0)), known))
            values = [[part], [made], [name], [len(column)], [n_ids]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            row = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
            for held in (ids, counts, keys):
                held.clear()
            made, n_ids = made + 1, 0
            return pa.RecordBatch.from_arrays(row, names=["part", "number", "path", "documents", "ids"])

        for batch in batches:
            for row, data, offsets in kernels.slices(batch.column("text")):
                encoded, first = encoder.encode(data, offsets)
                ids.append(encoded)
                counts.append(np.diff(first))
                keys.append(batch.column("key")[row : row + len(offsets) - 1])
                n_ids += len(encoded)
                if n_ids >= file_ids:
                    yield close()
        if keys:
            yield close()

    files = written(dealt.select("key", "text").mapInArrow(run, MANIFEST), "token-manifest")
    # the ids before a part: one row per part; before a file: within its part
    parts = files.groupBy("part").agg(F.sum("ids").alias("n"))
    parts = parts.select(F.col("part").alias("of"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("number")) - F.col("ids")
    return files.withColumn("inside", inside).join(parts, F.col("part") == F.col("of")).select(
        "part", "number", "path", "documents", "ids", (F.col("before") + F.col("inside")).alias("start")
    )


def read_token_files(files: DataFrame, *, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, and the ids if asked.

    Read back from the files; start is the number of ids of all documents
    before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with _open(path) as source:
                    held = TokenFile(source)
                    at = 0
                    while at < held.n_documents:
                        keys, starts = held.documents(at, min(at + 10_000, held.n_documents))
                        n = max(1, int(np.searchsorted(starts, starts[0] + _PIECE, side="right")) - 1)
                        n = min(n, len(keys))
                        ids = held.ids(int(starts[0]), int(starts[n])).astype("<u4", copy=False)
                        first = starts[: n + 1] - starts[0]
                        parts = [ids[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                        arrays = [
                            pa.array(keys[:n], pa.int64()), pa.array(starts[:n] + start, pa.int64()), pa.array(np.diff(first), pa.int64()),
                            pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        ]
                        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                        if with_ids:
                            arrays.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32))))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(arrays, names=names)
                        at += n

    extra = ", ids array<int>" if with_ids else ""
    # rows of files are few bytes and much work: their number sets the tasks, not their size
    spread = files.select("path", "start").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(run, f"doc_id long, start long, n_tokens long, ids_crc32 long{extra}")


def ids_at(files: DataFrame, positions: DataFrame, *, column: str = "position", step: int = 1 << 24) -> DataFrame:
    """(position, id) of the wanted places in the sequence of all ids, each read alone.

    Files meet positions by steps of the sequence, so neither side is broadcast
    and a step's positions are spread over the files in it. Places outside the
    sequence, and null ones, give no row.
    """
    spans = files.filter("ids > 0").select(
        "path", "start", "ids", F.explode(F.sequence(F.floor(F.col("start") / step), F.floor((F.col("start") + F.col("ids") - 1) / step))).alias("step")
    )
    wanted = positions.select(F.col(column).cast("long").alias("position")).withColumn("at", F.floor(F.col("position") / step))
    met = wanted.join(spans, (F.col("at") == F.col("step")) & F.expr("position >= start AND position < start + ids"))
    met = met.select("path", "start", "position").repartition("path").sortWithinPartitions("path", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of, source = None, None, None
        for batch in batches:
            out = []
            for path, start, position in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "position")), strict=True):
                if path != of:
                    if source is not None:
                        source.close()
                    source, of = _open(path), path
                    held = TokenFile(source)
                out.append(held.id_at(position - start))
            yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(out, pa.int64())], names=["position", "id"])
        if source is not None:
            source.close()

    return met.mapInArrow(run, "position long, id long")
