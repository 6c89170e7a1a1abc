"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is its words; its tokens are the distinct shingles of those. Lines with
equal words are copies. Other lines match when the Jaccard similarity of their
token sets reaches the threshold. A line goes when an earlier line, by document
id and then by place in the document, is a copy or a match.

Under any order of all tokens, matching lines share one among the first
n - ceil(t n) + 1 of each. That holds for an order by hash, under which every
line is seen once: only lines that meet another there can match at all. The
tokens of those lines are counted and put in order of rarity, and the join
itself runs on that order's prefixes, with length and position filters. A
token's rows first meet the earliest line of its list alone, which settles a
group of near copies without its pairs. Only lines that this leaves unsettled
meet the rest of their lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.store import written
from millrace.session import BROADCAST_BYTES

# A line's prefix by hash is longer by its size over this.
_MORE = 20
_WHITE = r"[\x20\x09-\x0D]+"


def _placed(docs: DataFrame) -> DataFrame:
    """The documents as (doc_id, version, text): rows that share an id and differ in text get versions."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    repeated = docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("of"))
    if repeated.isEmpty():
        return docs.withColumn("version", F.lit(0).cast("long"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    ties = docs.join(repeated, F.col("doc_id").eqNullSafe(F.col("of")), "left_semi").select("doc_id", "tie").distinct()
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("tie")) - 1
    ties = ties.select(F.col("doc_id").alias("of"), F.col("tie").alias("of_tie"), rank.cast("long").alias("version"))
    docs = docs.join(ties, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("of_tie")), "left")
    return docs.select("doc_id", "text", F.coalesce("version", F.lit(0)).alias("version"))


def _cut(docs: DataFrame) -> DataFrame:
    """(doc_id, place, line): one row per line that has words; place orders the lines of an id.

    Lines are in lower case, their words one blank apart.
    """
    cut = docs.select("doc_id", "version", F.posexplode(F.split(F.lower("text"), "\n")).alias("k", "raw"))
    line = F.trim("raw")
    # other white space than single blanks is rare: only lines that have it pay for the pattern
    odd = F.contains("raw", F.lit("  "))
    for code in (9, 11, 12, 13):
        odd = odd | F.contains("raw", F.lit(chr(code)))
    line = F.when(odd, F.trim(F.regexp_replace("raw", _WHITE, " "))).otherwise(line)
    cut = cut.select("doc_id", (F.shiftleft("version", 32) + F.col("k")).alias("place"), line.alias("line"))
    return cut.filter(F.col("line") != "")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, place, w): the words of every line that has any."""
    return _cut(docs).select("doc_id", "place", F.split("line", " ").alias("w"))


def _shingles(words: Column, size: int) -> Column:
    """Shingles of a list of words, as hashes; a shorter list is one shingle."""

    def of(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(h) - size, F.lit(0)))
        # single elements, as slice() goes over the whole list; past its end they are null and not hashed
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))

    # every word is hashed once and not once per shingle; bound as a variable: the optimizer would else put
    # the split into words inside the function
    return F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), of)[0]


def _tokens(words: Column, size: int) -> Column:
    """The distinct shingles."""
    return F.array_distinct(_shingles(words, size))


def _need(percent: int) -> str:
    return f"((n + n2) * {percent} + {99 + percent}) DIV {100 + percent}"


def _passes(percent: int) -> str:
    """Length and position filters between (n, pos) and (n2, pos2), which share a token."""
    return (
        f"100 * least(n, n2) >= {percent} * greatest(n, n2) "
        f"AND 1 + least(n - pos - 1, n2 - pos2 - 1) >= {_need(percent)}"
    )


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast the rows if they are few enough, else leave them to a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _matches(docs: DataFrame, pairs: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    """The pairs (doc_id, place, doc2, place2) that match, with their similarity."""
    ends = pairs.select(F.col("doc_id").alias("need"), F.col("place").alias("at")).unionByName(
        pairs.select(F.col("doc2").alias("need"), F.col("place2").alias("at"))
    )
    ends = written(ends.distinct(), f"{name}-ends")
    ids = _small(ends.select(F.col("need").alias("whole")).distinct(), 64)
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("whole")), "left_semi")
    here = F.col("doc_id").eqNullSafe(F.col("need")) & (F.col("place") == F.col("at"))
    sets = _lines(texts).join(_small(ends, 96), here, "left_semi")
    sets = written(sets.select("doc_id", "place", _tokens(F.col("w"), size).alias("t")), f"{name}-sets")
    x = sets.select(F.col("doc_id").alias("xd"), F.col("place").alias("xp"), F.col("t").alias("x"))
    y = sets.select(F.col("doc_id").alias("yd"), F.col("place").alias("yp"), F.col("t").alias("y"))
    both = pairs.join(x, F.col("doc_id").eqNullSafe(F.col("xd")) & (F.col("place") == F.col("xp")))
    both = both.join(y, F.col("doc2").eqNullSafe(F.col("yd")) & (F.col("place2") == F.col("yp")))
    both = both.withColumn("common", F.size(F.array_intersect("x", "y")))
    both = both.withColumn("whole", F.size("x") + F.size("y") - F.col("common")).filter(f"100 * common >= {percent} * whole")
    return written(both.select("doc_id", "place", "doc2", "place2", (F.col("common") / F.col("whole")).alias("similarity")), f"{name}-matches")


def find_repeated_lines(docs: DataFrame, *, words: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, place, doc2, place2, similarity) of every line that goes, with one earlier line it repeats.

    `docs` has doc_id, version and text as _placed() gives them; place is
    version * 2^32 + line number from 0.
    """
    copies = written(_cut(docs).select("doc_id", "place", F.xxhash64("line").alias("digest")), "lines-digests")
    firsts = copies.groupBy("digest").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    firsts = written(firsts.select(F.col("digest").alias("of"), F.col("first.doc_id").alias("doc2"), F.col("first.place").alias("place2"), "copies"), "lines-firsts")
    again = copies.join(firsts, F.col("digest") == F.col("of"))
    is_first = F.col("doc_id").eqNullSafe(F.col("doc2")) & (F.col("place") == F.col("place2"))
    again = written(again.filter(~is_first).select("doc_id", "place", "doc2", "place2", F.lit(1.0).alias("similarity")), "lines-copies")

    gone = again.select(F.col("doc_id").alias("gone"), F.col("place").alias("gone_at"))
    here = F.col("doc_id").eqNullSafe(F.col("gone")) & (F.col("place") == F.col("gone_at"))
    few = again.count() * 96 <= BROADCAST_BYTES
    # of lines with fewer words all are one shingle, which only copies share
    fresh = _cut(docs).filter(F.substring_index("line", " ", words - 1) != F.col("line"))
    if few:  # copies need not be looked at again; else they go once the rows are small
        fresh = fresh.join(F.broadcast(gone), here, "left_anti")
    fresh = fresh.select("doc_id", "place", F.sort_array(_tokens(F.split("line", " "), words)).alias("t")).withColumn("n", F.size("t"))
    # of l tokens more, l must meet: of a match at least as many as the shorter line has, which is 0.75 of this one or more
    prefix = F.slice("t", 1, F.expr(f"n - ({percent} * n + 99) DIV 100 + 1 + n DIV {_MORE}"))
    met = fresh.select("doc_id", "place", "n", F.explode(prefix).alias("token"))
    # one narrow row per token: ids only, sorted and counted where they meet
    met = met.withColumn("held", F.count("*").over(Window.partitionBy("token"))).filter("held > 1")
    meeting = met.groupBy("doc_id", "place", "n").agg(F.count("*").alias("met"))
    meeting = meeting.filter(f"met >= 1 + ({percent} * n DIV 100) DIV {_MORE}").select("doc_id", "place")
    if not few:
        meeting = meeting.join(gone, here, "left_anti")
    meeting = written(meeting.select(F.col("doc_id").alias("need"), F.col("place").alias("at")), "lines-meeting")

    # the lines that met another, with their tokens by rarity among them
    ids = _small(meeting.select(F.col("need").alias("whole")).distinct(), 64)
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("whole")), "left_semi")
    there = F.col("doc_id").eqNullSafe(F.col("need")) & (F.col("place") == F.col("at"))
    sets = _lines(texts).join(_small(meeting, 96), there, "left_semi").select("doc_id", "place", _tokens(F.col("w"), words).alias("t"))
    # the size goes first: else every token's row would carry the whole list up to here
    sets = sets.withColumn("n", F.size("t"))
    tokens = written(sets.select("doc_id", "place", "n", F.explode("t").alias("token")), "lines-tokens")
    df = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1").withColumnRenamed("token", "in")
    ranked = tokens.join(df, F.col("token") == F.col("in"), "left")
    order = Window.partitionBy("doc_id", "place").orderBy(F.coalesce("df", F.lit(1)), "token")
    ranked = ranked.select("token", "doc_id", "place", "n", F.coalesce("df", F.lit(1)).alias("df"), (F.row_number().over(order) - 1).alias("pos"))
    kept = ranked.filter(f"pos <= n - ({percent} * n + 99) DIV 100 AND df > 1")
    rows = written(kept.select("token", "doc_id", "place", "n", "pos"), "lines-rows")

    heads = rows.groupBy("token").agg(F.min(F.struct("doc_id", "place", "n", "pos")).alias("head"), F.count("*").alias("held")).filter("held > 1")
    heads = heads.select(
        F.col("token").alias("in"), "held", F.col("head.doc_id").alias("doc2"), F.col("head.place").alias("place2"),
        F.col("head.n").alias("n2"), F.col("head.pos").alias("pos2"),
    )
    met = rows.join(heads, F.col("token") == F.col("in")).filter(~is_first)
    pairs = written(met.filter(_passes(percent)).select("doc_id", "place", "doc2", "place2").distinct(), "lines-heads")
    near = _matches(docs, pairs, words, percent, "lines-first")

    settled = near.select(F.col("doc_id").alias("gone"), F.col("place").alias("gone_at")).distinct()
    open_rows = met.filter("held > 2").select("token", "doc_id", "place", "n", "pos").join(settled, here, "left_anti")
    other = rows.select(
        F.col("token").alias("in"), F.col("doc_id").alias("doc2"), F.col("place").alias("place2"), F.col("n").alias("n2"), F.col("pos").alias("pos2")
    )
    earlier = F.struct("doc2", "place2") < F.struct("doc_id", "place")
    rest = open_rows.join(other, (F.col("token") == F.col("in")) & earlier & F.expr(_passes(percent)))
    rest = rest.select("doc_id", "place", "doc2", "place2").distinct()
    rest = written(rest.join(pairs, ["doc_id", "place", "doc2", "place2"], "left_anti"), "lines-rest")
    found = again.unionByName(near)
    if not rest.isEmpty():
        found = found.unionByName(_matches(docs, rest, words, percent, "lines-last"))
    best = F.min(F.struct("doc2", "place2", "similarity"))
    return found.groupBy("doc_id", "place").agg(best.alias("m")).select("doc_id", "place", "m.doc2", "m.place2", "m.similarity")


def dedup_lines(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """The rows with repeated lines taken out of the text, and two columns n_lines and n_removed added.

    Lines are cut at newlines and joined again. A line with no words is never
    removed. Null text stays null, with 0 lines; an empty text has one line. A
    null id comes before all others. Repeated rows are one document and stay
    equal; rows that share an id and differ in text come after each other, in
    an order fixed by a hash. A document all of whose lines go keeps its row,
    with an empty text. Other columns go through, whatever their names, but for
    any already called n_lines or n_removed, which are replaced.
    """
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    placed = _placed(own)
    gone = find_repeated_lines(placed, words=words, percent=percent)
    gone = gone.groupBy("doc_id", F.shiftright("place", 32).alias("gone_version")).agg(
        F.collect_set(F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")).alias("gone_lines")
    )
    gone = gone.select(F.col("doc_id").alias("gone_id"), "gone_version", "gone_lines")
    rest = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    row = row.select("row", F.col("row")[id_column].cast("long").alias("doc_id"), F.col("row")[text_column].alias("text"))
    if placed.filter("version > 0").isEmpty():  # known without a scan where ids do not repeat
        row = row.withColumn("version", F.lit(0).cast("long"))
    else:
        versions = placed.select(F.col("doc_id").alias("v_id"), F.xxhash64("text").alias("v_tie"), "version").distinct()
        same = F.col("doc_id").eqNullSafe(F.col("v_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("v_tie"))
        row = row.join(versions, same, "left")
    here = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("version") == F.col("gone_version"))
    gone = written(gone, "lines-gone")
    size = gone.agg(F.sum(F.size("gone_lines") * 4 + 96)).first()[0] or 0
    row = row.join(F.broadcast(gone) if size <= BROADCAST_BYTES else gone, here, "left").withColumn("cut", F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), F.col("gone_lines"))
    text = F.when(F.col("gone_lines").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda k: F.col("cut")[k]), "\n"))
    return row.select(
        *[text.alias(c) if c == text_column else F.col("row")[c].alias(c) for c in rest],
        F.when(F.col("text").isNull(), 0).otherwise(F.size("cut")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone_lines"), F.lit(0)).cast("long").alias("n_removed"),
    )

