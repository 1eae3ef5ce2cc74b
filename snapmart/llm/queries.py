"""The registered queries of the operators: production parameters, whole tables, full results."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

from snapmart.llm.common import documents

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query
def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.compression import quality

    return quality(documents(spark, sf_dir))


@query
def op2_pii_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.pii import personal_data

    return personal_data(documents(spark, sf_dir))


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.bpe import encoded

    return encoded(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.tiktoken"), split_pattern())


@query
def op4_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.katz import katz_scores

    return katz_scores(documents(spark, sf_dir))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.packing import pack

    return pack(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), split_pattern())


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.exact_dedup import exact_groups

    return exact_groups(documents(spark, sf_dir)).drop("bucket", "chain")


ORACLES["op6_exact_dedup"] = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), g AS (
  SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.secrets import secrets

    return secrets(documents(spark, sf_dir))


@query
def op8_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.toxicity import toxicity

    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.ngram_join import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


@query
def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.recompression import removed_repeats

    return removed_repeats(documents(spark, sf_dir))


ORACLES["op9_recompression"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)
), first AS (
  SELECT k, min(doc_id) AS d FROM win GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win JOIN first USING (k) WHERE d < doc_id
), words AS (
  SELECT doc_id, i, ws[i] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ORACLES["op10_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * c >= 75 * (p.n + q.n - c)
), reached AS (
  SELECT doc_id, doc_id AS r FROM w
  UNION
  SELECT y, r FROM reached JOIN links ON doc_id = x
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words op11 judges: a tenth of the documents, by the checksum of their id, repeat from some word on."""
    if doc_id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    n = len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + [words[start + i % period] for i in range(n - start)]


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.periodic import run_summary

    return run_summary(documents(spark, sf_dir), planted_period)


# A lag's matches are found from repeated five-word sequences, as every run has five matches in a row.
ORACLES["op11_periodic_runs"] = r"""
WITH crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    xor(4294967295, list_reduce(list_concat([4294967295],
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM documents, crc
), sized AS (
  SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS planted, h // 10 AS g FROM texts
), w AS (
  SELECT doc_id, n, i, CASE WHEN planted AND i >= g % n
    THEN ws[g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) + 1] ELSE ws[i + 1] END AS word
  FROM (SELECT *, unnest(range(0, n)) AS i FROM sized)
), five AS (
  SELECT doc_id, n, i, count(*) OVER v AS c, string_agg(word, ' ') OVER v AS k FROM w
  WINDOW v AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
), hits AS (
  SELECT a.doc_id, b.i - a.i AS q, a.i FROM five a JOIN five b ON a.doc_id = b.doc_id AND a.k = b.k AND b.i > a.i
  WHERE a.c = 5 AND b.c = 5 AND 4 * (b.i - a.i) <= a.n
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM hits)
  GROUP BY doc_id, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period, chr(10) ORDER BY start, period) || chr(10) AS lines
  FROM runs GROUP BY doc_id
), best AS (
  SELECT a.* FROM runs a ANTI JOIN runs b ON a.doc_id = b.doc_id AND
    (b.length * a.period > a.length * b.period OR b.length * a.period = a.length * b.period AND
      (b.start < a.start OR b.start = a.start AND b.period < a.period))
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM w ANTI JOIN runs r
    ON w.doc_id = r.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length
  GROUP BY doc_id
)
SELECT s.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.start AS BIGINT) AS start, CAST(b.length AS BIGINT) AS length,
       CAST(b.period AS BIGINT) AS period, CAST(b.length * 1000 // b.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM sized s LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.alignment import Tokenizers, aligned

    files = Tokenizers(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"), split_pattern())
    return aligned(documents(spark, sf_dir), files)


@query
def op12_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapmart.llm.warc import archived_pages

    return archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLES["op12_warc_normaliser"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS page FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page <> page_id THEN page END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
