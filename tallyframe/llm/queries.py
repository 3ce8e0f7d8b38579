"""Registered queries of the operators and, where SQL expresses one, its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import ann, chat_format, collocations, exact_topk, filter_audit, html_extract, line_dedup, lm_scoring, ngram_join, packing, sentence_codec, toxicity, url_filter
from tallyframe.llm.common import table, vocabulary


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentence_codec.encode_decode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"), with_links=True)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_multi_index_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_products(table(spark, sf_dir, "embeddings"))


#: The rules that the contract names.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the seven parts of ids, 2 is held out and 5 fits the mixture's weights."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    part = F.when(fold == 2, lm_scoring.HELD_OUT).when(fold == 5, lm_scoring.WEIGHTS).otherwise(lm_scoring.ESTIMATES)
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"), part)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sentencepiece, op2_ngram_jaccard, op3_packing, op4_multi_index_ann, op5_line_dedup, op6_html_extract, op7_toxicity,
                            op8_chat_format, op9_exact_topk, op10_url_filter, op11_collocations, op12_filter_audit, op13_lm_scoring)
}
ORACLE: dict[str, str] = {
    "op5_line_dedup": r"""
WITH raw AS (SELECT doc_id, len(string_split(text, chr(10))) AS n, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
lines AS (SELECT doc_id, n, pos, trim(line, E' \t\r') AS line FROM raw WHERE trim(line, E' \t\r') <> ''),
weighed AS (SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS words FROM lines),
counted AS (SELECT *, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos), n) - 1 AS end_pos, (sum(words) OVER (PARTITION BY doc_id ORDER BY pos))::BIGINT AS upto, (sum(words) OVER (PARTITION BY doc_id))::BIGINT AS total FROM weighed),
spans AS (
  SELECT doc_id, upto - words + 50 <= total AS valid,
         min(pos) OVER f AS first_pos, max(end_pos) OVER f AS last_pos, string_agg(line, chr(10)) OVER f AS run
  FROM counted WINDOW f AS (PARTITION BY doc_id ORDER BY upto - words RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, upto >= 50, min(pos) OVER f, max(end_pos) OVER f, string_agg(line, chr(10)) OVER f
  FROM counted WINDOW f AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
origin AS (SELECT run, min(struct_pack(d := doc_id, p := first_pos)) AS origin FROM spans WHERE valid GROUP BY run),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(first_pos, last_pos + 1)) AS pos
  FROM spans JOIN origin USING (run) WHERE valid AND struct_pack(d := doc_id, p := first_pos) > origin),
kept AS (SELECT raw.doc_id, count(*) FILTER (gone.pos IS NOT NULL) AS removed, string_agg(line, chr(10) ORDER BY raw.pos) FILTER (gone.pos IS NULL) AS text
  FROM raw LEFT JOIN gone ON raw.doc_id = gone.doc_id AND raw.pos = gone.pos GROUP BY raw.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, d.lang, d.source, d.n_chars,
       coalesce(k.removed, 0)::INTEGER AS lines_removed
FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op9_exact_topk": r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5""",
    "op10_url_filter": r"""
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) r(h, p, v)),
fits AS (SELECT page_id, host, path, max(struct_pack(n := length(h || p), h := length(h), rule := h || p, v := v)) AS best
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM fits""",
    "op11_collocations": r"""
WITH docs AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT doc, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
words AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
spans AS (SELECT lang, w, m.m, unnest(range(1, len(w) - m.m + 2)) AS i FROM words, range(1, 6) m(m)),
counted AS (SELECT lang, m, w[i:i + m - 1] AS g, count(*) AS f FROM spans GROUP BY 1, 2, 3 HAVING count(*) >= 100),
cuts AS (SELECT c.lang, c.g, c.f AS a, t.n, k.k, l.f AS l, r.f AS r, (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM counted c JOIN totals t USING (lang) JOIN range(1, 5) k(k) ON k.k < c.m
  JOIN counted l ON l.lang = c.lang AND l.g = c.g[1:k.k] JOIN counted r ON r.lang = c.lang AND r.g = c.g[k.k + 1:c.m]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
subs AS (SELECT lang, g, m, f, s.s, unnest(range(1, m - s.s + 2)) AS i FROM counted, range(2, 5) s(s) WHERE s.s < m),
around AS (SELECT lang, g[i:i + s - 1] AS g, max(f) AS f FROM subs GROUP BY 1, 2),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN around USING (lang, g) WHERE around.f IS NULL OR 100 * around.f < 100 * a),
placed AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM placed WHERE rank <= 2000""",
    "op12_filter_audit": r"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
failed AS (SELECT doc_id, part, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM words),
tallies AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
letters AS (SELECT x, chr(65 + x::INTEGER) AS c FROM range(5) r(x)),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.x, b.x, c.x, d.x, e.x] AS xs
  FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step::INTEGER AS step, (1 << xs[step])::INTEGER AS one, list_sum(list_transform(xs[1:step], lambda x: 1 << x))::INTEGER AS upto
  FROM orders, range(1, 6) s(step)),
counted AS (SELECT part, filter_order, step, one,
    sum(CASE WHEN mask & upto = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & upto = one THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & one <> 0 AND mask & (upto - one) <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = one THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & upto = one THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & upto = one THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM tallies, steps GROUP BY part, filter_order, step, one)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, one))::BIGINT AS shapley FROM counted""",
}
