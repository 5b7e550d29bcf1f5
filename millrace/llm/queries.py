"""The registered queries of this subpackage, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import ann, bpe, exact, langid, license, minhash, packing, phrases, shard, simhash, substring, variants, warc
from millrace.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


WARC_SQL = """
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM rows)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts"""


@query("op1_warc_round_trip", WARC_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, equal payloads as revisits, and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return langid.identify(table(spark, sf_dir, "documents")).drop("uid")


NEAR_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
    THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT b, root FROM reach JOIN ways ON node = a),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, root AS component_id, d.doc_id = root AS kept
FROM documents d JOIN roots ON d.doc_id = node LEFT JOIN sizes s ON s.doc_id = d.doc_id"""


@query("op3_near_duplicates", NEAR_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near-duplicates."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("uid", "chosen")


@query("op4_repeated_passages")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of at least 50 words that an earlier document has as well."""
    return substring.repeated_passages(table(spark, sf_dir, "documents")).drop("uid", "match_uid")


@query("op5_pack_sequences")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, and digests of the ids and of what they decode to."""
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents")))


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_SQL = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256({LOWERED}) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY {LOWERED})"""


@query("op7_exact_dedup", EXACT_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equal texts."""
    return exact.exact_duplicates(table(spark, sf_dir, "documents")).drop("uid")


@query("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document.

    The table has no file names, so they are made: a document is a file in
    source/lang, and one whose first line speaks of a licence is a licence file.
    """
    docs = table(spark, sf_dir, "documents")
    opening = F.lower(F.substring_index("text", "\n", 1)).contains("licen")
    name = F.concat(F.when(opening, "LICENSE.").otherwise("text."), F.col("doc_id").cast("string"))
    files = docs.select(F.concat_ws("/", "source", "lang", name).alias("path"), "text")
    found = license.scan_files(files)
    number = F.expr("try_cast(substring_index(path, '.', -1) as long)")
    return found.select(number.alias("doc_id"), "licence", "similarity", "origin", "from_dir")


@query("op9_nearest_vectors")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every fiftieth embedding."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query("op10_jump_shards")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by the key law."""
    return shard.assign(table(spark, sf_dir, "documents"), 40)


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the more frequent word it is a variant of."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') FOR i IN range(1, len(ws) - k + 2)]) AS phrase
  FROM split, (SELECT unnest(range(1, 6)) AS k) sizes),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
found AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lft, array_to_string(w[k + 1:size], ' ') AS rgt
  FROM (SELECT *, unnest(range(1, size)) AS k FROM found)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = lft JOIN counts y ON y.lang = c.lang AND y.phrase = rgt
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, a AS f, unnest(flatten([[array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, size - m + 2)]
    FOR m IN range(2, size)])) AS phrase FROM found WHERE size > 2),
covers AS (SELECT lang, phrase, max(f) AS most FROM inner_phrases GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN covers c ON c.lang = b.lang AND c.phrase = b.phrase
  WHERE most IS NULL OR 100 * most < 100 * a) WHERE rank <= 2000"""


@query("op12_phrase_collocations", PHRASE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2000 phrases of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents")).drop("uid")


@query("op13_covering_simhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the component of those within two bits."""
    return simhash.near_fingerprints(table(spark, sf_dir, "documents"))
