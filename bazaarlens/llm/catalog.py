"""The queries of this subpackage by name, each with its checking SQL where SQL can express it."""
from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm import chat_format, language_id, packing, prefix_trie, quality_ranking, quality_rules, sentence_pieces, sharding, simhash, source_audit, substrings, topk, url_rules
from bazaarlens.llm.rows import id_crc32
from bazaarlens.plans.registry import table
from bazaarlens.session import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_substring_dedup", r"""
WITH split AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 48, 1)), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS h,
  unnest(range(1, greatest(len(w) - 48, 1))) AS p FROM split),
firsts AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
removed AS (SELECT DISTINCT doc_id, p + o AS p FROM windows JOIN firsts USING (h) CROSS JOIN range(50) AS r(o) WHERE first_id < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM split),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM removed GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, COALESCE(n, 0) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_digests(table(spark, sf_dir, "documents"))


@query("op2_quality_ranking")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = quality_rules.label_quality(table(spark, sf_dir, "labels"))
    model = quality_ranking.fit_ranking(docs.filter(id_crc32(F.col("doc_id"), 5) != 0), labels)
    scored = quality_ranking.score_quality(docs, model)
    return scored.select("doc_id", F.coalesce(id_crc32(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op3_topk", """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 20 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cut(topk.quantized(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, 20)


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), corpus_pipeline.TOKENIZER, corpus_pipeline.CAPACITY, corpus_pipeline.RANKS)


#: Rules of the contract (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _fits_sql(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


_LONGEST = " ".join(f"WHEN {_fits_sql(h, p)} THEN '{h}{p}'" for h, p, _ in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1])))
_VERDICTS = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in URL_RULES)


@query("op6_url_filter", f"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id, COALESCE(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  COALESCE(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
ruled AS (SELECT *, CASE {_LONGEST} END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE rule {_VERDICTS} ELSE 'allow' END AS verdict FROM ruled""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rules_table(spark, URL_RULES), "page_id", "url")


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit_languages(docs.filter(id_crc32(F.col("doc_id"), 3) != 1))
    named = language_id.identify(docs.select("doc_id", "text"), model)
    return named.select("doc_id", F.coalesce(id_crc32(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op9_histogram_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_sentence_pieces")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = sentence_pieces.decode(sentence_pieces.encode(table(spark, sf_dir, "documents"), model), model)
    crc = lambda c: F.crc32(F.coalesce(c, F.lit("")).cast("binary"))
    return both.select("doc_id", "n_chunks", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
                       crc(F.col("text")).alias("text_crc32"), crc(F.col("decoded")).alias("decoded_crc32"))


_CRC_TABLE = "[list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) FOR x IN range(256)]"


@query("op11_prefix_trie", rf"""
WITH crcs AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc),
raw AS (SELECT conv_id, turn, md5(CAST(length(COALESCE(role, '')) AS VARCHAR) || ':' || COALESCE(role, '') || COALESCE(text, '')) AS t,
  len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS pos FROM raw),
sized AS (SELECT conv_id, count(*) AS own, conv_id - conv_id % 20 AS donor, CAST(conv_id AS VARCHAR) AS s FROM own GROUP BY conv_id),
headed AS (SELECT conv_id, own, donor, xor(list_reduce(list_concat([4294967295], [CAST(ascii(c) AS BIGINT) FOR c IN string_split(s, '')]),
  lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h FROM sized, crcs),
convs AS (SELECT c.conv_id, c.donor, c.h, least(c.h, COALESCE(d.own, 0)) AS k FROM headed c LEFT JOIN headed d ON d.conv_id = c.donor),
turns AS (SELECT c.conv_id, o.pos, t, words FROM convs c JOIN own o ON o.conv_id = donor AND o.pos <= h
  UNION ALL SELECT conv_id, o.pos - h + k, t, words FROM convs c JOIN own o USING (conv_id) WHERE o.pos > h),
paths AS (SELECT *, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM turns),
rows AS (SELECT conv_id, pos AS depth, md5(path) AS node, md5(path[:32 * (pos - 1)]) AS parent, words FROM paths
  UNION ALL SELECT conv_id, 0, md5(''), NULL, 0 FROM convs),
nodes AS (SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words FROM rows GROUP BY node, depth),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
below AS (SELECT r.node, sum((v.n - 1) * v.words) AS saved, count(*) FILTER (k.node IS NULL) AS leaves
  FROM nodes v JOIN rows r ON r.conv_id = v.conv_id AND r.depth <= v.depth LEFT JOIN kids k ON k.node = v.node GROUP BY r.node),
ended AS (SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM
  (SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY node)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n AS n_convs, COALESCE(n_children, 0) AS n_children, leaves AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, COALESCE(ends, sha256('')) AS ends_sha256
FROM nodes v LEFT JOIN nodes u ON u.node = v.parent LEFT JOIN kids k ON k.node = v.node JOIN below b ON b.node = v.node LEFT JOIN ended e ON e.node = v.node""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut(prefix_trie.ordered_turns(table(spark, sf_dir, "conversations")))
    convs, rebuilt = prefix_trie.with_shared_heads(turns, F.col("conv_id") - F.col("conv_id") % 20, id_crc32(F.col("conv_id"), 4), most=3)
    return prefix_trie.prefix_trie(convs, rebuilt)


@query("op12_source_audit", r"""
WITH docs AS (SELECT row_number() OVER () AS r, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
  translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
terms AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n_lang FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(n_lang) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
cells AS (SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS n, n_lang FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
shares AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
  1 + (1000000000::HUGEINT * (n_lang + 2)) // (total + 2 * v) AS q FROM cells JOIN sizes USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY a.lang, a.source, b.source),
found AS (SELECT lang, source, 'pair' AS part, item, COALESCE(value, 0) AS value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, sf_dir, "documents"))


_ECHO = "</s>[INST] ok [/INST]"
_ESCAPED = r"regexp_replace({}, '(<)(\\*(?:\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>|\|endoftext\|>))|(\[)(\\*(?:INST\]|/INST\]))', '\1\3\\\2\4', 'g')"


@query("op13_chat_format", f"""
WITH turns AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_ECHO}' UNION ALL SELECT -7, 1, 'assistant', '{_ECHO}'),
sized AS (SELECT *, {len("<|im_start|><|im_sep|><|im_end|>")} + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) AS n,
  row_number() OVER w AS p, count(*) OVER (PARTITION BY conv_id) AS n_turns FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
summed AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY p) AS upto FROM sized)
SELECT conv_id, n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
  CAST(COALESCE(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY p) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR p = n_turns) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id, n_turns""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    echo = spark.sql(f"""SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{_ECHO}' AS text
        UNION ALL SELECT -7L, 1L, 'assistant', '{_ECHO}'""")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(echo)
    return chat_format.digests(chat_format.prefix_examples(turns))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
