"""The operators as queries over the test tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm import exact_dedup, packing, pieces, quality, token_files, toxicity
from millrace.llm.alignment import align_tokenizers
from millrace.llm.fingerprint import fingerprint_with_edits
from millrace.llm.html_text import extract_text
from millrace.llm.labelled import remainder
from millrace.llm.licenses import RULES, SENTENCES, scan_licenses
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.ngram_join import link_documents
from millrace.llm.spelling import spelling_variants

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHINGLES = r"""
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1)"""

_NGRAM_SQL = f"""
WITH RECURSIVE {_SHINGLES},
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, s.n, t.n HAVING 100 * count(*) >= 75 * (s.n + t.n - count(*))
),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, (SELECT min(y) FROM reach r WHERE r.x = d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
"""


@query("op10_ngram_jaccard_join", _NGRAM_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    known = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    steps, before = [], "start"
    for k, (run, name) in enumerate(RULES):
        mark = " " + run.replace(" ", "  ") + " "
        steps.append(
            f"r{k} AS (SELECT doc_id, n_sentences, identifiers, replace(l, '{mark}', ' | ') AS l, "
            f"CASE WHEN contains(l, '{mark}') AND NOT list_contains(names, '{name}') THEN list_append(names, '{name}') ELSE names END AS names FROM {before})"
        )
        before = f"r{k}"
    return rf"""
WITH known(s, i) AS (VALUES {known}),
cut AS (SELECT doc_id, regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), '\n+') AS parts FROM documents),
sentences AS (SELECT doc_id, unnest(range(len(parts))) AS k, trim(regexp_replace(lower(unnest(parts)), '[^a-z0-9]+', ' ', 'g')) AS s FROM cut),
found AS (SELECT doc_id, string_agg(i, ' ' ORDER BY k) AS identifiers, count(*) AS n_sentences FROM sentences JOIN known USING (s) GROUP BY 1),
start AS (
  SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(identifiers, '') AS identifiers,
    ' ' || replace(coalesce(identifiers, ''), ' ', '  ') || ' ' AS l, CAST([] AS VARCHAR[]) AS names
  FROM documents LEFT JOIN found USING (doc_id)
),
{", ".join(steps)}
SELECT doc_id, identifiers, array_to_string(names, ' ') AS licenses, n_sentences FROM {before}
"""


@query("op9_license_scan", _license_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _scored(docs: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    return docs.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path(TOKENIZER))


_LINE_SQL = r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(range(len(parts))) AS k, unnest(parts) AS line FROM cut),
words AS (SELECT doc_id, k, line, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') AS w FROM lines),
sets AS (
  SELECT doc_id, k, w, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words WHERE len(w) > 0
),
grams AS (SELECT doc_id, k, len(s) AS n, unnest(s) AS g FROM sets),
near AS (
  SELECT a.doc_id, a.k FROM grams a JOIN grams b ON a.g = b.g AND (b.doc_id, b.k) < (a.doc_id, a.k)
  GROUP BY a.doc_id, a.k, a.n, b.doc_id, b.k, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
gone AS (SELECT DISTINCT doc_id, k FROM near)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(c.parts) END AS n_lines,
  (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN coalesce((
    SELECT string_agg(l.line, chr(10) ORDER BY l.k) FROM lines l
    WHERE l.doc_id = d.doc_id AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.k = l.k)
  ), '') END AS text
FROM documents d JOIN cut c USING (doc_id)
"""


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.encode_documents(docs, model=tokenizer_path("piece_bpe_32k.model"), kind="bpe", with_ids=False)


@query("op3_line_dedup", _LINE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


_EXACT_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
FROM t
"""


@query("op4_exact_dedup", _EXACT_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query("op6_document_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_edits(table(spark, sf_dir, "documents"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_from_labels(docs, table(spark, sf_dir, "labels"), skip=remainder(F.col("of"), 5) == 0)
    return _scored(toxicity.score(docs, model), remainder(F.col("doc_id"), 5) == 0, 0.5)


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_from_labels(docs, table(spark, sf_dir, "labels"), skip=remainder(F.col("of"), 4) == 2)
    return _scored(quality.score(docs, model), remainder(F.col("doc_id"), 4) == 2, 0.7)


@query("op13_token_files")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path(TOKENIZER), end_id=2)
    return token_files.read_token_files(files)


_SPELLING_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))
),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents
),
each AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM each, crc
),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7
),
cut AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
),
near AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.rest
),
ranked AS (
  SELECT near.word, near, b.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY b.n DESC, near) AS k
  FROM near JOIN words b ON b.word = near
),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND k = 1
),
chain(word, root, further) AS (
  SELECT word, word, form FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.further
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.further IS NULL
"""


@query("op12_spelling_variants", _SPELLING_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


@query("op11_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), a=tokenizer_path(TOKENIZER), b=tokenizer_path("piece_bpe_32k.model"))
