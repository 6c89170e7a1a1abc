"""Order-independent document fingerprints, in DataFrame operations only.

A text is cut into short paragraphs: at newlines and sentence ends, and after
sixty characters at the next word's end. A paragraph hashes to a wide vector of
two parts: four lanes of 31 bits, and 128 lanes of one bit. A fingerprint is the
sum of its paragraphs' vectors, all lanes modulo 2^31, and their number. So the order of paragraphs does not matter, and
paragraphs go in and out by adding and subtracting their vectors.

The one-bit lanes, read as plus or minus one, sum to random projections of the
paragraph counts; their inner products estimate how much two texts share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.neighbours import ordered_neighbours
from millrace.llm.store import written

WIDE, LANES = 4, 128
_PIECE = r"[^.!?|\n]{1,60}(?:[.!?|\n]+\s*|\S*\s*)|[.!?|\n]+\s*"
_LOW31 = (1 << 31) - 1
# Two one-bit lanes are summed in one number: the second 31 bits up.
_TWO = 1 | (1 << 31)


def _vector_sums() -> list[Column]:
    """Aggregates over rows with the paragraph's hashes h0, h1 (for 64 lanes each) and w0, w1."""
    wide = []
    for h in ("w0", "w1"):
        for shift in (0, 32):
            wide.append(F.sum(F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_LOW31))))
    pairs = []
    for h in ("h0", "h1"):
        # bits i and i + 31 of the hash, for i in 0..30; and the two left over
        for i in range(31):
            pairs.append(F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_TWO))))
        pairs.append(F.sum(F.shiftrightunsigned(h, 62).bitwiseAND(F.lit(1)) + F.shiftleft(F.shiftrightunsigned(h, 63), 31)))
    return [s.alias(f"a{k}") for k, s in enumerate(wide)] + [s.alias(f"p{k}") for k, s in enumerate(pairs)]


def fingerprints(texts: DataFrame, keys: list[str], text_column: str = "text") -> DataFrame:
    """(keys, units, wide, lanes): a fingerprint per key; null counts as empty, and an empty text has zeros.

    Rows that share their keys are taken as parts of one text.
    """
    pieces = texts.select(*keys, F.explode_outer(F.regexp_extract_all(F.coalesce(text_column, F.lit("")), F.lit(_PIECE), F.lit(0))).alias("u"))
    hashed = pieces.select(
        *keys, F.when(F.col("u").isNull(), 0).otherwise(1).alias("one"),
        *[
            F.when(F.col("u").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), "u")).alias(name)
            for seed, name in enumerate(("w0", "w1", "h0", "h1"))
        ],
    )
    sums = hashed.groupBy(*keys).agg(F.sum("one").alias("units"), *_vector_sums())
    lanes = []
    for k in range(LANES // 2):
        lanes += [F.col(f"p{k}").bitwiseAND(F.lit(_LOW31)), F.shiftright(f"p{k}", 31).bitwiseAND(F.lit(_LOW31))]
    return sums.select(
        *keys, "units",
        F.array(*[F.col(f"a{k}").bitwiseAND(F.lit(_LOW31)) for k in range(WIDE)]).alias("wide"),
        F.array(*[c.cast("int") for c in lanes]).alias("lanes"),
    )


def combined(x: str, y: str, sign: int = 1) -> list[Column]:
    """Columns units, wide, lanes of the sum (or difference) of two fingerprints held as structs x and y."""

    def join(name: str, mask: int, kind: str) -> Column:
        return F.zip_with(
            F.col(f"{x}.{name}"), F.col(f"{y}.{name}"), lambda a, b: (a.cast("long") + sign * b.cast("long")).bitwiseAND(F.lit(mask)).cast(kind)
        ).alias(name)

    return [(F.col(f"{x}.units") + sign * F.col(f"{y}.units")).alias("units"), join("wide", _LOW31, "long"), join("lanes", _LOW31, "int")]


def as_text(wide: str | Column, lanes: str | Column, units: str | Column) -> Column:
    """A fingerprint as hexadecimal text."""
    head = F.transform(F.col(wide) if isinstance(wide, str) else wide, lambda x: F.lpad(F.hex(x), 8, "0"))
    tail = F.transform(F.col(lanes) if isinstance(lanes, str) else lanes, lambda x: F.lpad(F.hex(x), 8, "0"))
    return F.concat(F.array_join(head, ""), F.lpad(F.hex(units), 8, "0"), F.array_join(tail, ""))


def likeness(x: str, y: str) -> Column:
    """0 to 1: the estimated share of paragraphs that two fingerprints, held as structs, have in common."""
    zero = F.lit(0).cast("long")

    def dot(a: str, b: str) -> Column:
        # lanes count paragraphs with the bit set; twice that less all is the sum of plus and minus ones
        terms = F.zip_with(
            F.col(f"{a}.lanes"), F.col(f"{b}.lanes"),
            lambda p, q: (2 * p.cast("long") - F.col(f"{a}.units")) * (2 * q.cast("long") - F.col(f"{b}.units")),
        )
        return F.aggregate(terms, zero, lambda acc, t: acc + t)

    size = (dot(x, x) + dot(y, y)) / 2
    same = F.col(f"{x}.units").eqNullSafe(F.col(f"{y}.units")) & (F.col(f"{x}.wide") == F.col(f"{y}.wide"))
    share = F.when(size > 0, dot(x, y) / size).otherwise(0.0)
    return F.when(same, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def _neighbours(keyed: DataFrame) -> DataFrame:
    """Keys (doc_id, tie) with the next key in order, the previous one and its half; the first follows the last.

    """
    rows = ordered_neighbours(keyed.select("doc_id", "tie", "n"), ["doc_id", "tie"], "fingerprint-order")
    first = rows.filter("before IS NULL").select(F.col("k").alias("first"), F.lit(1).alias("one"))
    last = rows.filter("after IS NULL").select(F.col("k").alias("last"), F.lit(1).alias("two"))
    rows = rows.withColumn("is_first", F.when(F.col("before").isNull(), 1)).withColumn("is_last", F.when(F.col("after").isNull(), 1))
    rows = rows.join(F.broadcast(last), F.col("is_first") == F.col("two"), "left").join(F.broadcast(first), F.col("is_last") == F.col("one"), "left")
    p, q = F.coalesce("before", "last"), F.coalesce("after", "first")
    return rows.select(
        F.col("k.doc_id").alias("k_id"), F.col("k.tie").alias("k_tie"), p["doc_id"].alias("prev_id"), p["tie"].alias("prev_tie"),
        F.floor(p["n"] / 2).cast("int").alias("prev_half"), q["doc_id"].alias("next_id"), q["tie"].alias("next_tie"),
    )


def _same(a: str, b: str, a_tie: str, b_tie: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b)) & (F.col(a_tie) == F.col(b_tie))


def fingerprint_with_edits(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n / 2) characters replaced by the first
    as many, or all, of the next document's, in ascending order of id; the
    first follows the last. Null counts as empty. Rows repeated with id and text
    are one document in the order and each keep a row; rows that share an id are
    ordered by a hash of the text, and null ids come first. A single document
    follows itself. Other columns are not read.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    repeats = not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()
    beside = written(_neighbours(docs.select("doc_id", "tie", F.length("text").alias("n"))), "fingerprint-beside")
    rows = docs.join(beside, _same("doc_id", "k_id", "tie", "k_tie")).select(
        "doc_id", "tie", "text", "prev_id", "prev_tie", "prev_half", "next_id", "next_tie"
    )
    # a document's start goes to the one before it, once
    heads = rows.select(
        F.col("prev_id").alias("to_id"), F.col("prev_tie").alias("to_tie"), F.expr("substring(text, 1, prev_half)").alias("head")
    )
    heads = heads.dropDuplicates(["to_id", "to_tie"]) if repeats else heads
    texts = rows.drop("prev_id", "prev_tie", "prev_half").join(heads, _same("doc_id", "to_id", "tie", "to_tie"))
    edited = F.concat(F.expr("substring(text, 1, length(text) - CAST(floor(length(text) / 2) AS INT))"), F.col("head"))
    # repeated rows are the same parts twice; a running mark keeps them apart
    texts = texts.withColumn("row", F.monotonically_increasing_id()) if repeats else texts.withColumn("row", F.lit(0).cast("long"))
    both = texts.select(
        "doc_id", "tie", "row", "next_id", "next_tie",
        F.explode(F.array(F.struct(F.lit(0).alias("edit"), F.col("text").alias("text")), F.struct(F.lit(1).alias("edit"), edited.alias("text")))).alias("t"),
    )
    both = both.select("doc_id", "tie", "row", "next_id", "next_tie", "t.edit", "t.text")
    keys = ["doc_id", "tie", "row", "next_id", "next_tie", "edit", "n_chars", "sha"]
    both = both.withColumn("n_chars", F.length("text").cast("long")).withColumn("sha", F.when(F.col("edit") == 1, F.sha2("text", 256)))
    made = fingerprints(both, keys)
    made = written(made.withColumn("f", F.struct("units", "wide", "lanes")).drop("units", "wide", "lanes"), "fingerprint-made")
    plain = made.filter("edit = 0").select("doc_id", "tie", "row", "next_id", "next_tie", "n_chars", "f")
    changed = made.filter("edit = 1").select(
        F.col("doc_id").alias("e_id"), F.col("tie").alias("e_tie"), F.col("row").alias("e_row"), F.col("sha").alias("edited_sha256"), F.col("f").alias("e")
    )
    after = made.filter("edit = 0").select(F.col("doc_id").alias("x_id"), F.col("tie").alias("x_tie"), F.col("f").alias("x"))
    after = after.dropDuplicates(["x_id", "x_tie"]) if repeats else after
    out = plain.join(changed, _same("doc_id", "e_id", "tie", "e_tie") & (F.col("row") == F.col("e_row")))
    out = out.join(after, _same("next_id", "x_id", "next_tie", "x_tie"))
    return out.select(
        F.col("doc_id").alias(id_column), "n_chars", "edited_sha256",
        as_text(F.col("f.wide"), F.col("f.lanes"), F.col("f.units")).alias("fingerprint"),
        as_text(F.col("e.wide"), F.col("e.lanes"), F.col("e.units")).alias("edited_fingerprint"),
        likeness("f", "e").alias("near_edited"), likeness("f", "x").alias("near_next"),
    )

