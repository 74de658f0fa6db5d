"""Named queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import (
    decontaminate, languages, lines, packing, pii, ranked, repeats, runs, simhash, tokens, toxicity, urls, vectors,
)
from lakemart.llm.common import LOWER, UPPER, read_table

Query = Callable[[SparkSession, str], DataFrame]

# The url rules of the registered query.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Key of the registered query only. Real runs pass a secret.
SAMPLE_KEY = b"example key, replace it"


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination_report(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_report(read_table(spark, folder, "documents"))


def op3_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeats_report(read_table(spark, folder, "documents"))


def op4_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.nearest_report(read_table(spark, folder, "embeddings"))


def op5_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.lines_report(read_table(spark, folder, "documents"))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_report(read_table(spark, folder, "documents"), SAMPLE_KEY)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_report(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op8_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_report(spark, read_table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_near(read_table(spark, folder, "documents"))


def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    return urls.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op11_languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages.language_report(read_table(spark, folder, "documents"))


def op12_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.ranked_report(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.runs_report(read_table(spark, folder, "documents"))


def llm_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_decontaminate, op2_simhash, op3_repeats, op4_nearest, op5_lines, op6_pii,
                                    op7_toxicity, op8_tokens, op9_packing, op10_urls, op11_languages, op12_ranked,
                                    op13_runs)}


def words_sql(text: str) -> str:
    """List of the words of the benchmark search."""
    return f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({words_sql('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {words_sql('text')} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS run, least(len(w), 10) AS size
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS run
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i) WHERE len(w) >= size),
hits AS (SELECT g.doc_id, g.i, g.size, x.item_id FROM grams g JOIN windows x ON g.run = x.run AND g.size = x.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP5_SQL = """
WITH l AS (
  SELECT doc_id, no, line, list_sort(list_distinct(list_filter(string_split(replace(lower(line), chr(9), ' '), ' '), lambda x: x <> ''))) AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM documents)),
e AS (SELECT *, len(w) AS n FROM l WHERE len(w) >= 1),
f AS (SELECT line, any_value(w) AS w, any_value(n) AS n, min((doc_id, no)) AS place FROM e GROUP BY line),
t AS (SELECT line, n, place, unnest(w) AS word FROM f),
c AS (SELECT word, count(*) AS freq FROM t GROUP BY word),
o AS (SELECT line, n, place, word, row_number() OVER (PARTITION BY line ORDER BY freq, word) AS pos FROM t JOIN c USING (word)),
p AS (SELECT * FROM o WHERE pos <= n - ceil(0.8 * n - 1e-9) + 1),
cand AS (SELECT DISTINCT x.line AS la, y.line AS lb FROM p x JOIN p y ON x.word = y.word AND x.line <> y.line AND x.n >= y.n * 0.8 - 1e-9 AND y.n >= x.n * 0.8 - 1e-9),
pairs AS (
  SELECT la, lb, b.place AS other FROM cand JOIN f a ON a.line = la JOIN f b ON b.line = lb
  WHERE len(list_intersect(a.w, b.w)) >= (a.n + b.n - len(list_intersect(a.w, b.w))) * 0.8 - 1e-9),
linked AS (SELECT la AS line, count(*) AS links, min(other) AS earliest FROM pairs GROUP BY la),
v AS (
  SELECT e.doc_id, (e.doc_id, e.no) <> f.place OR coalesce(earliest < f.place, false) AS removed, coalesce(links, 0) AS links,
    least(f.place, coalesce(earliest, f.place)) AS class
  FROM e JOIN f USING (line) LEFT JOIN linked USING (line)),
g AS (SELECT doc_id, count(*) AS n_lines, count_if(removed) AS n_removed, sum(links) AS n_links, min(class) AS class FROM v GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_links, 0)::BIGINT AS n_links, class[1]::BIGINT AS source_doc
FROM documents d LEFT JOIN g USING (doc_id)
"""

_HOST = f"coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '')"
_PATH = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
OP10_SQL = f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
rules(rhost, rpath, action) AS (VALUES {', '.join(str(r) for r in URL_RULES)}),
fits AS (
  SELECT r, rhost || rpath AS rule, action,
    row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC, action = 'block' DESC, rhost || rpath DESC) AS nth
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM fits WHERE nth = 1) USING (r)
"""

OP12_SQL = f"""
WITH d AS (
  SELECT r, doc_id, w, len(w) AS n
  FROM (SELECT row_number() OVER () AS r, doc_id, {words_sql('text')} AS w FROM documents) WHERE len(w) > 0),
s AS (SELECT count(*) AS total, coalesce(sum(n), 0)::BIGINT AS words FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
i AS (SELECT row_number() OVER () AS item_no, item_id, {words_sql('text')} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_no, item_id, term, count(*) AS times FROM (SELECT item_no, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM df, s),
scores AS (
  SELECT item_no, item_id, r, doc_id, sum(times * weight
    * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * total) // words))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN weights USING (term) JOIN d USING (r), s GROUP BY ALL),
places AS (
  SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM places WHERE rank <= 20
"""


def llm_oracles() -> dict[str, str]:
    """Oracles where SQL can express the result at a bearable cost. The rest is tested against brute force."""
    return {"op1_decontaminate": OP1_SQL, "op5_lines": OP5_SQL, "op10_urls": OP10_SQL, "op12_ranked": OP12_SQL}
