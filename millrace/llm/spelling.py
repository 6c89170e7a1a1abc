"""Spelling variants: words one edit apart, found by walking a trie that is a table.

The words' prefixes are the nodes of a trie, and the trie is a table of edges
(node, char, child), dealt by node over the cluster. A state is (word, position,
node, edits): so much of the word has been read, and the node was reached with
so many edits. All states advance together, one level of the trie at a time, by
joins of the frontier with the edge table. A state with one edit that ends with
its word on a node where a word ends is a neighbour.

An edit near the root would send every word to every branch. So there are two
tries, of the words and of the words reversed, and a word starts in each at the
node of its own first half, which it reaches without an edit: an edit in the
second half of a word is found in the first trie, one in the first half in the
other. Where the edit is possible, nodes have few children.

An edge also carries a signature of all that follows it, some bits set by the
hashes of the rests of the words below. A state with an edit whose own rest has
left no bit there can never end on a word, and goes at once. Where one word only
lies below, the edge has its rest's hash and its id: a state with an edit ends
there, as a neighbour or not at all, and the trie's unbranched ends are not
walked with it.

Nodes and words are numbered by hash; a collision can only add a state or a pair,
and neighbours are compared as texts at the end.

The number of rounds is that of the longest word. Words of more than LEVELS code
points would need one for each; they meet by the hash of the rest that is left
when a place is taken out, which is exact too, and a row for each code point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import kernels
from millrace.llm.store import written

LEVELS = 40
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def count_words(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shortest: int = 7, least: int = 2, drop_every: int | None = 31
) -> DataFrame:
    """(word, n): the words of all texts that occur `least` times or more.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case.
    With `drop_every`, a run whose crc32 of "<id>:<run>" it divides loses the
    code point at crc32 modulo length. Words shorter than `shortest` code
    points are left out. A null text has no words, a null id is an empty one.
    """
    lower = F.translate(F.col(text_column), _UPPER, _UPPER.lower())
    # a run that is too short before a code point goes is too short after it
    runs = F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{shortest},}}+"), F.lit(0))
    words = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    word = F.col("run")
    if drop_every:
        words = words.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run"))
    words = words.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return words.filter((F.col("n") >= least) & (F.length("word") >= shortest))


def _prefix(word: Column | str, size: Column | int) -> Column:
    return F.substring(word, F.lit(1), size if isinstance(size, Column) else F.lit(size))


def _node(side: Column | str, prefix: Column) -> Column:
    return F.xxhash64(side, prefix)


def _char(word: str, at: str) -> Column:
    """The code point at a place, from 0; an empty text past the end."""
    return F.substring(word, F.col(at) + 1, F.lit(1))


def _start() -> Column:
    """The place from which edits of a word are looked for: its half, the larger one in the second trie."""
    return F.floor((F.length("word") + F.col("side")) / 2).cast("int")


def _both_sides(words: DataFrame) -> DataFrame:
    """(side, word, id): every word for the first trie, and reversed for the second; id is the hash of the word as it is."""
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("word")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("word")))
    return words.select(F.explode(sides).alias("s"), _id("word").alias("id")).select("s.*", "id")


def _id(word: str) -> Column:
    return F.xxhash64(word)


def _rest(position: Column) -> Column:
    """The hash of what is left of a word from a place on."""
    return F.xxhash64(F.substring("word", position + 1, F.length("word")))


# Bits of the mark a text leaves in the signature of a node, in so many longs.
_SIGNATURE = 2
# What an edge says of the words below it: signature, least and largest hash of their rests, id of the last of them.
_BELOW = [*[f"s{k}" for k in range(_SIGNATURE)], "low", "high", "leaf"]


def _mark(h: Column) -> list[Column]:
    """The signature of one text, given its hash: a bit of one of the longs."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    of = F.pmod(F.shiftright(h, 6), F.lit(_SIGNATURE))
    return [F.when(of == k, bit).otherwise(F.lit(0).cast("long")) for k in range(_SIGNATURE)]


def _may_follow(h: Column) -> Column:
    """Whether a rest may follow the node: of one word it must be the rest itself, of several one that left the same bit."""
    of = F.pmod(F.shiftright(h, 6), F.lit(_SIGNATURE))
    signature = F.col("s0")
    for k in range(1, _SIGNATURE):
        signature = F.when(of == k, F.col(f"s{k}")).otherwise(signature)
    marked = F.call_function("getbit", signature, h.bitwiseAND(F.lit(63)).cast("int")) == 1
    return F.when(F.col("low") == F.col("high"), h == F.col("low")).otherwise(marked)


def _edges(sided: DataFrame, start: int) -> DataFrame:
    """(level, node, char, child) of both tries, from the level `start` on.

    child_word is the id of the word that ends on the child, if one does; the
    columns of _BELOW speak of all that follows the child.
    """
    steps = sided.select("side", "word", "id", F.explode(F.sequence(F.lit(start), F.length("word") - 1)).alias("level"))
    steps = steps.select(
        "level",
        _node("side", _prefix("word", F.col("level"))).alias("node"),
        _char("word", "level").alias("char"),
        _node("side", _prefix("word", F.col("level") + 1)).alias("child"),
        F.when(F.col("level") == F.length("word") - 1, F.col("id")).alias("child_word"),
        "id",
        _rest(F.col("level") + 1).alias("h"),
    )
    signature = [F.bit_or(m).alias(f"s{k}") for k, m in enumerate(_mark(F.col("h")))]
    below = [F.min("h").alias("low"), F.max("h").alias("high"), F.max("id").alias("leaf")]
    return steps.groupBy("level", "node", "char", "child").agg(F.max("child_word").alias("child_word"), *signature, *below)


def _skipped(states: DataFrame) -> DataFrame:
    """The frontier, and the states that leave out the word's next code point at the same node."""
    free = states.filter("edits = 0 AND position < length(word)")
    # of a run of equal code points only the first after the start: to leave out another of them is the same
    again = _char("word", "position") == F.substring("word", F.col("position"), F.lit(1))
    free = free.filter((F.col("position") == _start()) | ~again)
    skipped = free.select("side", "word", (F.col("position") + 1).alias("position"), "node", F.lit(1).alias("edits"))
    return states.unionByName(skipped)


def _advanced(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level on; of those with an edit the ones whose rest may follow.

    near is the id of the word that a state with an edit ends on: the only one
    below its node, whose rest is its own, or the one that ends there with it.
    """
    edges = edges.select(F.col("node").alias("at"), "char", "child", "child_word", *_BELOW)
    here, after = F.col("position"), F.col("position") + 1
    # hashes of rests are taken before the join, which gives a state a row for every child
    states = states.filter("edits = 0 OR position < length(word)").select(
        "side", "word", "position", "node", "edits", _char("word", "position").alias("next"), _rest(here).alias("h_here"), _rest(after).alias("h_after")
    )
    met = states.join(edges, (F.col("node") == F.col("at")) & ((F.col("edits") == 0) | (F.col("next") == F.col("char"))))
    free, same, ended = F.col("edits") == 0, F.col("next") == F.col("char"), F.col("next") == ""
    # read, replace, or take the child's code point as one more
    read = free & same
    on = (~free | (~same & ~ended)) & _may_follow(F.col("h_after"))
    met = met.withColumn("read", read).withColumn("on", on).withColumn("inserted", free & ~same & _may_follow(F.col("h_here")))
    met = met.filter("read OR on OR inserted")
    step = lambda position, edits: F.struct(position.alias("position"), F.lit(edits).alias("edits"))
    moves = (
        F.when(F.col("read"), F.array(step(after, 0)))
        .when(~F.col("on"), F.array(step(here, 1)))
        .when(~F.col("inserted"), F.array(step(after, 1)))
        .otherwise(F.array(step(after, 1), step(here, 1)))
    )
    met = met.select("side", "word", F.col("child").alias("node"), "child_word", "low", "high", "leaf", F.explode(moves).alias("m"))
    met = met.select("side", "word", "m.position", "node", "m.edits", "child_word", "low", "high", "leaf")
    near = F.when(F.col("low") == F.col("high"), F.col("leaf")).when(F.col("position") == F.length("word"), F.col("child_word"))
    return met.select("side", "word", "position", "node", "edits", F.when(F.col("edits") == 1, near).alias("near"))


def _walk(words: DataFrame) -> DataFrame:
    """(word, near) by the trie frontier, for words of at most LEVELS code points."""
    sided = _both_sides(words)
    bounds = words.agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    if bounds[0] is None:
        return words.select("word", F.col("word").alias("near")).limit(0)
    start, deepest = bounds[0] // 2, bounds[1]
    edges = written(_edges(sided, start).sortWithinPartitions("level"), "spelling-edges")
    # every word at the node of its own first half
    half = _start()
    starts = sided.select("side", "word", half.alias("position"), _node("side", _prefix("word", half)).alias("node"), F.lit(0).alias("edits"))
    starts = written(starts.sortWithinPartitions("position"), "spelling-starts")
    frontier, found = starts.limit(0), []
    for level in range(start, deepest + 2):
        frontier = frontier.unionByName(starts.filter(F.col("position") == level))
        moved = written(_advanced(_skipped(frontier), edges.filter(F.col("level") == level)), f"spelling-{level}")
        found.append(moved.filter("near IS NOT NULL").select("side", "word", "near"))
        frontier = moved.filter("near IS NULL AND (edits = 0 OR position < length(word))").drop("near")
    # a word without its last code point ends on the node where it started, or passed without an edit
    last = sided.select("side", "word", _node("side", _prefix("word", F.length("word") - 1)).alias("node"))
    ends = sided.select(F.col("id").alias("near"), _node("side", F.col("word")).alias("at"))
    found.append(last.join(ends, F.col("node") == F.col("at")).select("side", "word", "near"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    pairs = pairs.select(F.when(F.col("side") == 1, F.reverse("word")).otherwise(F.col("word")).alias("word"), F.col("near").alias("of"))
    texts = words.select(_id("word").alias("id"), F.col("word").alias("near"))
    # rows that are equal meet by `of` already, so that taking them together needs no further shuffle
    return pairs.join(texts, F.col("of") == F.col("id")).select("word", "of", "near").distinct().select("word", "near")


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of every word as it is and without each of its code points, in one pass over the word."""
    for batch in batches:
        for number, word in zip(batch.column("number").to_pylist(), batch.column("word").to_pylist(), strict=True):
            points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
            n = len(points)
            up = kernels._power_table(kernels._R, n + 1, "up")[: n + 1]
            value = kernels.mix(points.astype(np.uint64) + np.uint64(1))
            before, later = np.zeros(n + 1, np.uint64), np.zeros(n, np.uint64)
            np.cumsum(value * up[:n], out=before[1:])
            np.cumsum(value[1:] * up[: n - 1], out=later[1:])
            rest = kernels.mix(before[:-1] + (later[-1] - later)).view(np.int64)
            whole = kernels.mix(before[-1:]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n + 1, number), pa.int64()), pa.array(np.arange(-1, n), pa.int32()), pa.array(np.concatenate([whole, rest])),
                    pa.array(np.full(n + 1, n), pa.int32()),
                ],
                names=["number", "place", "hash", "size"],
            )


def _long_pairs(words: DataFrame) -> DataFrame:
    """(word, near) of long words: equal but for one place, or one the other without a place.

    Words that agree in all but one place differ in its letter alone, so a key
    has no more words than the alphabet letters.
    """
    # rows of a place carry the word's number only; words that share one are told apart when pairs are compared
    words = words.select(F.xxhash64("word").alias("number"), "word")
    keys = written(words.mapInArrow(_rests, "number long, place int, hash long, size int"), "spelling-rests")
    other = keys.select(F.col("number").alias("number2"), F.col("place").alias("place2"), F.col("hash").alias("hash2"), F.col("size").alias("size2"))
    same = (F.col("hash") == F.col("hash2")) & (F.col("place") == F.col("place2")) & (F.col("size") == F.col("size2"))
    replaced = keys.filter("place >= 0").join(other, same & (F.col("number") < F.col("number2"))).select("number", "number2")
    shorter = other.filter("place2 = -1")
    longer = keys.filter("place >= 0").join(shorter, (F.col("hash") == F.col("hash2")) & (F.col("size") == F.col("size2") + 1))
    pairs = replaced.unionByName(longer.select("number", "number2")).distinct()
    x = words.select(F.col("number").alias("at"), "word")
    y = words.select(F.col("number").alias("at2"), F.col("word").alias("near"))
    pairs = pairs.join(x, F.col("number") == F.col("at")).join(y, F.col("number2") == F.col("at2")).select("word", "near")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _one_apart(word: str, near: str) -> Column:
    """Whether two texts differ by one inserted, deleted or replaced code point, in time linear in them for long ones."""
    return F.expr(f"levenshtein({word}, {near}, 1) = 1")


def near_words(words: DataFrame, *, levels: int = LEVELS) -> DataFrame:
    """(word, near): all pairs of distinct words of the column `word` that are one edit apart, both ways round."""
    words = written(words.select("word").filter("word <> ''").distinct(), "spelling-distinct")
    short = words.filter(F.length("word") <= levels)
    pairs = _walk(short).filter(_one_apart("word", "near"))
    # the two kinds overlap by one length, so that pairs across the bound are found
    long = words.filter(F.length("word") >= levels)
    if not words.filter(F.length("word") > levels).isEmpty():
        pairs = pairs.unionByName(_long_pairs(long).filter(_one_apart("word", "near"))).distinct()
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: the last of its chain, by doubling the steps."""
    jumps = written(forms.select("word", F.col("form").alias("root")), "spelling-jumps")
    while True:
        onward = jumps.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = jumps.join(onward, F.col("root") == F.col("at"), "left")
        moved = written(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-jumps")
        jumps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return jumps


def group_variants(words: DataFrame, *, times: int = 10, levels: int = LEVELS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words.

    n_near is the number of words one edit away. form is the one of largest n
    among them, of equal ones the first in code-point order, if that is at
    least `times` the word's n; root follows forms from the word to the last and is the
    word itself if it has none. An empty table gives an empty result.
    """
    words = written(words.filter("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    pairs = written(near_words(words, levels=levels), "spelling-pairs")
    counts = words.select(F.col("word").alias("of"), F.col("n").alias("near_n"))
    met = pairs.join(counts, F.col("near") == F.col("of"))
    best = met.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best")
    )
    best = best.select(F.col("word").alias("of"), "n_near", F.col("best.near").alias("near"), (-F.col("best.m")).alias("near_n"))
    rows = words.join(best, F.col("word") == F.col("of"), "left")
    strong = F.col("near_n") >= times * F.col("n")
    rows = written(
        rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("near")).alias("form"),
            F.when(strong, F.col("near_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(rows.filter("form IS NOT NULL")).select(F.col("word").alias("of"), "root")
    rows = rows.join(roots, F.col("word") == F.col("of"), "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shortest: int = 7, least: int = 2, times: int = 10) -> DataFrame:
    """group_variants() of count_words(): the words of all texts with their near words, forms and roots.

    Repeated rows count each time. Other columns are not read.
    """
    return group_variants(count_words(docs, id_column=id_column, text_column=text_column, shortest=shortest, least=least), times=times)
