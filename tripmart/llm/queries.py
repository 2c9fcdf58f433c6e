"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.chosen_path import near_duplicates
from tripmart.llm.common import small_batches
from tripmart.llm.filter_audit import filter_audit
from tripmart.llm.host_paths import main_texts
from tripmart.llm.mixing import mixture
from tripmart.llm.multi_index import vector_links
from tripmart.llm.quality import quality_verdicts
from tripmart.llm.quotes import reply_threads
from tripmart.llm.rank_bpe import encode_documents
from tripmart.llm.skip_chain import personal_data
from tripmart.llm.spelling import spelling_variants
from tripmart.llm.top_k import top_k
from tripmart.llm.toxicity import toxicity_scores
from tripmart.llm.warc_zip import archive_round_trip

VOCABULARY = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, by source weights 3, 1, 2 in turn."""
    return mixture(_table(spark, sf_dir, "documents"))


def op2_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotes, with its place in the thread of replies."""
    return reply_threads(_table(spark, sf_dir, "conversations"))


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives as a WARC record and read back."""
    return archive_round_trip(_table(spark, sf_dir, "pages")).drop("target")


def op4_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and survivor of every document, three words and 85 percent."""
    return near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    labels = _table(spark, sf_dir, "labels")
    return toxicity_scores(_table(spark, sf_dir, "documents"), labels)


def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return vector_links(_table(spark, sf_dir, "embeddings"))


def op7_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(_table(spark, sf_dir, "pages"))


def op8_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return personal_data(_table(spark, sf_dir, "documents"))


def op9_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    path = public_tokenizers.path(VOCABULARY)
    return encode_documents(_table(spark, sf_dir, "documents"), path)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, score and verdict of every document; trusted are those of good quality."""
    trusted = _table(spark, sf_dir, "labels").where(F.col("quality") == 1)
    return quality_verdicts(_table(spark, sf_dir, "documents"), trusted)


def _occurrences(docs: DataFrame) -> DataFrame:
    """Column ``word``: runs of letters, every 31st (by a hash) without one of its letters.

    Runs shorter than the least word are not looked at: losing a letter makes none longer.
    A null id counts as an empty text.
    """
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.coalesce("text", F.lit("")), capitals, capitals.lower())
    found = F.regexp_extract_all(lowered, F.lit(r"[a-z\u00C0-\u00FF]{7,}"), F.lit(0))
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(ids.alias("id"), F.explode(found).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of at least 7 letters with its more frequent spelling."""
    return spelling_variants(_occurrences(_table(spark, sf_dir, "documents")))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best matches of every 50th vector among all others."""
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each language in every order."""
    labels = _table(spark, sf_dir, "labels")
    return filter_audit(_table(spark, sf_dir, "documents"), labels)


def queries() -> dict[str, Query]:
    """Query name -> callable over (session, folder of the tables)."""
    named = {
        "op1_source_mixing": op1_source_mixing,
        "op3_warc_zip": op3_warc_zip,
        "op4_chosen_path": op4_chosen_path,
        "op2_quote_linking": op2_quote_linking,
        "op6_multi_index": op6_multi_index,
        "op7_host_paths": op7_host_paths,
        "op5_toxicity": op5_toxicity,
        "op8_skip_chain": op8_skip_chain,
        "op9_rank_bpe": op9_rank_bpe,
        "op10_quality_rules": op10_quality_rules,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_top_k": op12_top_k,
        "op13_filter_audit": op13_filter_audit,
    }
    return {name: _in_small_batches(query) for name, query in named.items()}


def _in_small_batches(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


# CRC-32 bit by bit: each byte is followed by eight shifts, marked -1.
_SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY id, run),
coded AS (SELECT run, n, hex(id || ':' || run) AS code FROM counted),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(
    [4294967295] || flatten(list_transform(range(1, length(code), 2), lambda i:
      [CAST('0x' || substr(code, i, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(3988292384, c >> 1)
      ELSE c >> 1 END)) AS h FROM coded),
changed AS (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run))
  || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
known AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 7
  GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM known),
masked AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask FROM places),
dropped AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM masked AS a JOIN masked AS b
    ON a.mask = b.mask AND a.word <> b.word
  UNION ALL SELECT d.word, k.word, k.n FROM dropped AS d JOIN known AS k ON d.rest = k.word
  UNION ALL SELECT k.word, d.word, d.n FROM dropped AS d JOIN known AS k ON d.rest = k.word),
best AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM near),
formed AS (SELECT k.word, k.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.near_n >= 10 * k.n THEN b.near END AS form,
    CASE WHEN b.near_n >= 10 * k.n THEN b.near_n END AS form_n
  FROM known AS k LEFT JOIN best AS b ON k.word = b.word AND b.place = 1),
walk AS (SELECT word, form AS root, 1 AS step FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT w.word, f.form, w.step + 1 FROM walk AS w JOIN formed AS f ON f.word = w.root
    WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, step) AS root FROM walk GROUP BY word)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM formed AS f LEFT JOIN ends AS e ON f.word = e.word
"""
_TOP_K = """
WITH usable AS (SELECT vec_id, embedding,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS scaled
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asked AS (SELECT DISTINCT * FROM usable WHERE vec_id % 50 = 0),
scored AS (SELECT q.vec_id AS query_id, q.embedding, c.vec_id,
    CAST(list_inner_product(q.scaled, c.scaled) AS BIGINT) AS score
  FROM asked AS q JOIN usable AS c
    ON len(q.scaled) = len(c.scaled) AND q.vec_id IS DISTINCT FROM c.vec_id),
ranked AS (SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id, embedding
    ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""
_AUDIT = r"""
WITH told AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY text) AS least FROM told),
marked AS (SELECT doc_id, part,
    CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text)
      THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails FROM worded),
known AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good,
    coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
classes AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good,
    count(*) FILTER (WHERE toxic) AS toxic
  FROM marked LEFT JOIN known USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
removals AS (SELECT *, coalesce(list_min(list_filter(range(1, 6),
    lambda i: contains(fails, substr(filter_order, i, 1)))), 6) AS at_step FROM classes, orders),
steps AS (SELECT part, filter_order, CAST(s.step AS INTEGER) AS step,
    substr(filter_order, s.step, 1) AS letter,
    sum(CASE WHEN at_step > s.step THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN at_step = s.step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN at_step < s.step AND contains(fails, substr(filter_order, s.step, 1))
      THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = substr(filter_order, s.step, 1) THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN at_step = s.step THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN at_step = s.step THEN toxic ELSE 0 END) AS toxic_lost
  FROM removals, range(1, 6) AS s(step) GROUP BY part, filter_order, s.step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM steps
"""


def oracle_sql() -> dict[str, str]:
    """Query name -> the same result in DuckDB SQL, where SQL can express it."""
    return {
        "op3_warc_zip": """
WITH told AS (SELECT page_id, coalesce(html, '') AS html,
    CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
first AS (SELECT html, min(page_id) AS first_id FROM told WHERE payload_bytes >= 100 GROUP BY html)
SELECT t.page_id, t.payload_bytes, sha256(t.html) AS payload_digest,
  CASE WHEN t.page_id > f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN t.page_id > f.first_id THEN f.first_id END AS refers_to
FROM told AS t LEFT JOIN first AS f ON t.html = f.html
""",
        "op11_spelling_variants": _SPELLING,
        "op12_top_k": _TOP_K,
        "op13_filter_audit": _AUDIT,
    }
