"""The operators of this package as queries on whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.catalog.registry import Query
from turnweave.llm.decontaminate import contamination, is_contaminated, items_digest
from turnweave.llm.fingerprints import neighbour_fingerprints
from turnweave.llm.licenses import TEMPLATES, Template, indexed_words, scan_licenses
from turnweave.llm.ngram_join import similar_groups
from turnweave.llm.prefix_trie import prefix_trie
from turnweave.llm.pseudonyms import found, pseudonymize
from turnweave.llm.resample import resample
from turnweave.llm.sentence_fst import encode_pieces
from turnweave.llm.substring_dedup import remove_repeats
from turnweave.llm.token_counts import length_histogram, suffix_sums, with_token_counts
from turnweave.llm.topk import top_k
from turnweave.llm.toxicity import fit, held_out, score_toxicity
from turnweave.llm.url_filter import Rule, filter_urls, section
from turnweave.session import materialize

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Words of digits, letters and characters beyond ASCII, as DuckDB's patterns spell them.
ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
VISIBLE = r"[^\x20\x09-\x0D]+"


def sql_words(text: str, pattern: str = ALPHANUMERIC, lower: bool = True) -> str:
    value = f"coalesce({text}, '')"
    return f"regexp_extract_all({LOWER.format(value) if lower else value}, '{pattern}')"


#: The CRC-32 of some bytes, which DuckDB does not have: its table of 256 entries, and a table expression of
#: ``(s, crc)`` for the strings ``s`` of another one.
_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))"


def sql_crc(source: str) -> str:
    byte = "CAST('0x' || substr(hex(encode(s)), 2 * k + 1, 2) AS BIGINT)"
    folded = "list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))"
    return f"""SELECT s, xor({folded}, 4294967295) AS crc FROM (
      SELECT s, list_transform(range(octet_length(encode(s))), lambda k: {byte}) AS b FROM (SELECT DISTINCT s FROM {source})), (SELECT {_CRC_TABLE} AS t)"""


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"""WITH d AS (SELECT doc_id, {sql_words("text")} AS w FROM documents),
b AS (SELECT item_id, {sql_words("text")} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s FROM (
  SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM b WHERE len(w) > 0)),
places AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, n, p FROM places JOIN windows USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that benchmark items hold, and whether it is contaminated."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        items_digest().alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix sums over the encoded lengths of all documents."""
    docs = table(spark, sf_dir, "documents").select("text")
    return suffix_sums(materialize(length_histogram(with_token_counts(docs)), "token-lengths"))


RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]
#: A page whose html has this mark so often is junk; parts of sites with one junk page in so many, or more, are listed.
JUNK_MARK, JUNK_MARKS, ONE_IN = "$$$", 5, 20

_URL_PARTS = r"^[\s\S]*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_SQL_RULES = "[" + ", ".join(f"{{'verdict': '{r.verdict}', 'h': '{r.host}', 'p': '{r.path}'}}" for r in RULES) + "]"


@query(f"""WITH parts AS (SELECT page_id, {LOWER.format(f"regexp_extract(coalesce(url, ''), '{_URL_PARTS}', 1)")} AS host,
  regexp_extract(coalesce(url, ''), '{_URL_PARTS}', 2) AS path,
  coalesce(length(html) - length(replace(html, '{JUNK_MARK}', '')), 0) >= {JUNK_MARKS * len(JUNK_MARK)} AS junk FROM pages),
keyed AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '') || '/' || regexp_extract(path, '^/([^/]*)', 1) END AS k FROM parts),
listed AS (SELECT k FROM keyed WHERE k IS NOT NULL GROUP BY k HAVING {ONE_IN} * count(*) FILTER (junk) >= count(*)),
fits AS (SELECT page_id, arg_max(r, len(r.h || r.p)) AS r FROM (SELECT page_id, host, path, unnest({_SQL_RULES}) AS r FROM keyed)
  WHERE (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p) GROUP BY page_id)
SELECT page_id, host, path, r.h || r.p AS rule,
  coalesce(r.verdict, CASE WHEN k IN (SELECT k FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed LEFT JOIN fits USING (page_id)""")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page; listed are the parts of sites with many junk pages, whatever page is judged."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    marks = F.char_length("html") - F.char_length(F.replace(F.col("html"), F.lit(JUNK_MARK), F.lit("")))
    junk = F.coalesce(marks >= JUNK_MARKS * len(JUNK_MARK), F.lit(False))
    counts = pages.groupBy(section(F.col("url")).alias("part")).agg(F.count_if(junk).alias("junk"), F.count(F.lit(1)).alias("n"))
    listing = counts.where(ONE_IN * F.col("junk") >= F.col("n")).select("part")
    return filter_urls(pages.drop("html"), listing, RULES, key=section).select("page_id", "host", "path", "rule", "verdict")


@query()
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness."""
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model of the labelled ones outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query(f"""WITH RECURSIVE d AS (SELECT doc_id, {sql_words("text", VISIBLE)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reached ON reached.a = d.doc_id GROUP BY ALL""")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and group of similar documents of each document."""
    return similar_groups(table(spark, sf_dir, "documents"))


#: Of the test tables; a real one is kept secret.
PSEUDONYM_KEY = "key of the test tables"


@query()
def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for its personal values, and how many were looked at."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("n_found", found("text"))
    return pseudonymize(docs, key=PSEUDONYM_KEY, n_found="n_found")


@query()
def op9_sentence_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and whether they decode to its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = encode_pieces(docs, decoded="decoded")
    return decoded.select("doc_id", "n_pieces", "piece_ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def _sql_template(t: Template) -> str:
    indexed = [{"w": x.word, "at": x.at} for x in indexed_words(t)]
    return f"{{'label': '{t.label}', 'base': {t.base}, 'o': {t.offset}, 'k': {t.key}, 'n': {t.words}, 'x': {indexed}}}"


_SQL_TEMPLATES = "[" + ", ".join(map(_sql_template, TEMPLATES)) + "]"


@query(f"""WITH d AS (SELECT doc_id, {sql_words("text")} AS w FROM documents),
t AS (SELECT unnest({_SQL_TEMPLATES}) AS t),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
firsts AS (SELECT doc_id, w, p, t FROM starts JOIN t ON w[p] = t.k[1]),
found AS (SELECT * FROM firsts WHERE w[p:p + len(t.k) - 1] = t.k
  AND len(list_filter(t.x, lambda x: p - t.o + x.at > 0 AND w[p - t.o + x.at] = x.w)) >= 2),
places AS (SELECT doc_id, t.label, t.base, p - 1 AS b,
  len(list_filter(range(1, len(t.n) + 1), lambda k: p - t.o + k - 1 > 0 AND w[p - t.o + k - 1] = t.n[k])) / len(t.n) AS s FROM found),
sums AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(b) FILTER (base) AS f, max(b) FILTER (base) AS l,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(s) AS s
  FROM places GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, f AS first_word, l AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(s, 0.0)::DOUBLE AS score
FROM d LEFT JOIN sums USING (doc_id)""")
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "places")


@query(f"""WITH d AS (SELECT doc_id, {sql_words("text", VISIBLE, lower=False)} AS w FROM documents),
p AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
r AS (SELECT doc_id, p FROM p WHERE s IN (SELECT s FROM p GROUP BY s HAVING count(*) > 1)),
gone AS (SELECT doc_id, list(DISTINCT x) AS x FROM (SELECT doc_id, unnest(range(p, p + 35)) AS x FROM r) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(v, ' ' ORDER BY i) AS k FROM (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS i FROM d) t
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(x) AS x FROM gone) g WHERE g.doc_id = t.doc_id AND g.x = t.i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(x), 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that stand in a passage repeated anywhere, and what is kept."""
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query(f"""WITH d AS (SELECT doc_id, {sql_words("text")} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS s FROM d), aims AS (SELECT unnest({sql_words("text")}) AS s FROM benchmark),
crc AS ({sql_crc("(SELECT s FROM words UNION ALL SELECT s FROM aims)")}),
source AS (SELECT crc % 10000 AS b, count(*) AS n FROM words JOIN crc USING (s) GROUP BY b),
target AS (SELECT crc % 10000 AS b, count(*) AS n FROM aims JOIN crc USING (s) GROUP BY b),
gain AS (SELECT i AS b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + 10000)
  / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM aims) + 10000)))) AS BIGINT) AS g
  FROM range(10000) r(i) LEFT JOIN source s ON s.b = i LEFT JOIN target t ON t.b = i),
weights AS (SELECT doc_id, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight FROM words JOIN crc USING (s) JOIN gain ON b = crc % 10000 GROUP BY doc_id),
scored AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
  (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * (SELECT count(*) FROM ranked) // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)""")
def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document, and the rank of those drawn towards the benchmark's words."""
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""")
def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one by whole-number inner product."""
    return top_k(table(spark, sf_dir, "embeddings"))


@query(f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, r, x) AS w FROM turns GROUP BY conv_id),
crc AS ({sql_crc("(SELECT CAST(conv_id AS VARCHAR) AS s FROM own)")}),
shared AS (SELECT conv_id, w, CAST(crc % 6 AS INT) AS h FROM own JOIN crc ON s = CAST(conv_id AS VARCHAR)),
built AS (SELECT c.conv_id, list_concat(coalesce(p.w[1:h], []), c.w[h + 1:]) AS w FROM shared c LEFT JOIN own p ON p.conv_id = c.conv_id - c.conv_id % 100),
members AS (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM built),
nodes AS (SELECT d, w[1:d] AS k, w[1:d][1:d - 1] AS up, min(conv_id) AS conv_id, count(*) AS n,
  string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(w) = d) AS ends FROM members GROUP BY ALL),
kids AS (SELECT up, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
trie AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN nodes.d = 0 THEN 0 ELSE (n - 1) * length(k[nodes.d].x) END AS saved
  FROM nodes LEFT JOIN kids ON kids.up = nodes.k AND kids.d = nodes.d),
below AS (SELECT a.d, a.k, count(*) FILTER (b.n_children = 0) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved
  FROM trie a JOIN trie b ON b.d >= a.d AND b.k[1:a.d] = a.k GROUP BY a.d, a.k)
SELECT t.conv_id, t.d AS depth, p.conv_id AS parent_conv_id, t.n AS n_convs, t.n_children, n_leaves, below.saved AS saved_tokens, sha256(coalesce(t.ends, '')) AS ends_sha256
FROM trie t JOIN below ON below.d = t.d AND below.k = t.k LEFT JOIN trie p ON t.d > 0 AND p.d = t.d - 1 AND p.k = t.up""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, with what sharing their prefixes saves."""
    return prefix_trie(table(spark, sf_dir, "conversations"))
