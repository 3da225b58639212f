"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import chat_digest
from .collocations import collocations
from .decontaminate import contamination_digest
from .language_id import languages_digest
from .line_dedup import drop_repeated_lines
from .ngram_join import near_duplicates
from .packing import pack_digest
from .periodic_runs import runs_digest
from .pii_surrogates import pii_digest
from .quality_rules import quality_digest, train_quality
from .secret_scan import identifier_samples, random_samples, secrets_digest, train
from .topk_search import top_k
from .url_filter import judge_urls

URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


PII_KEY = "an example; a real one comes from a secret store"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT rid, n, p, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths)
), hits AS (SELECT rid, p, h.n, item_id FROM doc_windows h JOIN item_windows USING (n, g)
), words_hit AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hits) GROUP BY rid
), items_hit AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hits GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (rid) LEFT JOIN items_hit USING (rid)
"""


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"), PII_KEY)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH doc_lines AS (
  SELECT row_id, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM doc_lines
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, (f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.keeper) AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_id
"""


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(random_samples(spark).unionByName(identifier_samples(docs)))
    return secrets_digest(docs, model)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("<|im_end|><|im_start|>assistant ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    turns = turns.unionByName(spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text")))
    return chat_digest(turns)


OP7_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
  SELECT *, row_number() OVER w AS nth, lag(role) OVER w AS before, lead(role) OVER w AS after
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), turns AS (
  SELECT *, CASE role WHEN 'system' THEN nth > 1
                      WHEN 'user' THEN nth > 1 AND before NOT IN ('system', 'assistant')
                      WHEN 'assistant' THEN nth = 1 OR before <> 'user' ELSE true END AS bad
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars,
       NOT bool_or(bad) AND bool_or(role = 'assistant' AND after IS NULL) AS valid,
       min(nth - 1) FILTER (bad) AS bad_turn
FROM turns GROUP BY conv_id
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_digest(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, piece_text FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece_text
    FROM documents)
), listed AS (SELECT lang, regexp_extract_all(piece_text, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, w[p : p + k - 1] AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM listed, range(1, 6) t(k))
), totals AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), f AS (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY lang, k, g HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.g, c.a, cut, x.a AS l, y.a AS r, n, (1000 * c.a::HUGEINT * n) // (x.a::HUGEINT * y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1) c JOIN f x ON x.lang = c.lang AND x.g = c.g[:cut]
  JOIN f y ON y.lang = c.lang AND y.g = c.g[cut + 1:] JOIN totals t ON t.lang = c.lang
), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), held AS (
  SELECT lang, inner_g AS g, max(a) AS longer
  FROM (SELECT lang, a, unnest(list_concat([g[p : p + m - 1] for p in range(1, k - m + 2)], [])) AS inner_g FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2))
  GROUP BY lang, inner_g
), kept AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM lowest LEFT JOIN held USING (lang, g) WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of documents, those of one in ten hashes repeating a part of their words up to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", (F.col("text").isNotNull() & (h % 10 == 0)).alias("bent"), F.floor(h / 10).alias("g"))
    words = F.when(F.col("bent"), F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    sized = rows.withColumn("words", words).withColumn("n", F.size("words"))
    a, n, g = F.col("a"), F.col("n"), F.col("g")
    placed = sized.withColumn("a", F.when(n > 0, g % n).cast("int"))
    placed = placed.withColumn("p", F.when(n > 0, 1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
    often = F.array_repeat(F.slice("words", a + 1, F.col("p")), F.ceil((n - a) / F.col("p")).cast("int"))
    ends = F.slice(F.flatten(often), F.lit(1), n - a)
    bent = F.array_join(F.concat(F.slice("words", F.lit(1), a), ends), " ")
    return placed.select("doc_id", F.when(F.col("bent") & (n > 0), bent).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_digest(with_periodic_ends(table(spark, sf_dir, "documents")))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages_digest(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 4 == 2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_url_filters": op2_url_filters,
    "op3_decontamination": op3_decontamination,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_line_dedup": op5_line_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_chat_format": op7_chat_format,
    "op8_packing": op8_packing,
    "op9_top_k_search": op9_top_k_search,
    "op10_quality_rules": op10_quality_rules,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_language_id": op13_language_id,
}
SQL = {
    "op3_decontamination": OP3_SQL,
    "op5_line_dedup": OP5_SQL,
    "op7_chat_format": OP7_SQL,
    "op9_top_k_search": OP9_SQL,
    "op11_collocations": OP11_SQL,
}
