"""The registered queries of the operators, with production parameters, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import bpe, collocations, common, divergence, hosts, lines, multiset, packing, simhash, sketches, suffixes, surrogates, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Bytes that a task of op13 takes in at once: what batches take up in an executor, it does not give back.
BATCH_BYTES = 2 << 20


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    common.importable(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query()
def op1_pack(spark, sf):
    parts = packing.pieces(table(spark, sf, "documents"), VOCABULARY, size=2048, end=0)
    return packing.pack(parts, size=2048)


@query()
def op2_bpe(spark, sf):
    return bpe.round_trip(table(spark, sf, "documents"), VOCABULARY)


@query()
def op3_simhash(spark, sf):
    return simhash.groups(table(spark, sf, "documents"), words=4, radius=4, seed=42)


# The payload of the largest page stands for all equal ones of 1000 bytes and more.
WARC_SQL = """SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM (SELECT page_id, bytes, digest,
        CASE WHEN bytes >= 1000 THEN max(page_id) OVER (PARTITION BY digest, bytes) ELSE page_id END AS first
      FROM (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages))"""


@query(WARC_SQL)
def op4_warc(spark, sf):
    return warc.round_trip(table(spark, sf, "pages"))


# Texts as hexadecimal digits, two for a byte; every string of 400 bytes is counted by its digest.
REPEATS_SQL = """WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
grams AS (SELECT doc_id, i, md5(substring(x, 2 * i + 1, 800)) AS g FROM (SELECT doc_id, x, unnest(range(0, n - 399)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM grams WHERE g IN (SELECT g FROM grams GROUP BY g HAVING count(*) > 1)),
cuts AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new FROM twice),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b
          FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM cuts) GROUP BY doc_id, k),
parts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT p.doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
                string_agg(substring(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substring(any_value(x), 2 * max(b) + 1) AS rest
         FROM parts p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(rest, x))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""


@query(REPEATS_SQL)
def op5_repeats(spark, sf):
    return suffixes.removed(table(spark, sf, "documents"), length=400)


QUALITY_SQL = rf"""WITH w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^ \t-\r]+') AS ws
           FROM (SELECT doc_id, source, coalesce(text, '') AS t FROM documents)),
windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
often AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS j FROM often) GROUP BY doc_id),
lined AS (SELECT doc_id, source, l, regexp_extract_all(l, '[^ \t-\r]+') AS lw
          FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM w)),
dups AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lined WHERE len(lw) > 0 GROUP BY doc_id),
hashed AS (SELECT doc_id, source, h, sum(n) AS n FROM (
             SELECT doc_id, source, len(lw) AS n, substring(md5(regexp_replace(translate(array_to_string(lw, ' '),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g')), 1, 15) AS h
             FROM lined WHERE len(lw) > 0) GROUP BY doc_id, source, h),
known AS (SELECT doc_id, md5(array_to_string(list_sort(list(h)), ' ')) AS id FROM hashed GROUP BY doc_id),
limits AS (SELECT w.source, greatest(CAST({lines.MIN_DOCUMENTS} AS DOUBLE), CAST({lines.MAX_SHARE} AS DOUBLE) * count(DISTINCT coalesce(id, ''))) AS most
           FROM w LEFT JOIN known ON known.doc_id = w.doc_id GROUP BY w.source),
common AS (SELECT source, h, count(DISTINCT id) AS n
           FROM hashed JOIN known ON known.doc_id = hashed.doc_id GROUP BY source, h),
lost AS (SELECT hashed.doc_id, sum(hashed.n) AS n FROM hashed
         JOIN common ON common.h = hashed.h AND common.source IS NOT DISTINCT FROM hashed.source
         JOIN limits ON limits.source IS NOT DISTINCT FROM hashed.source WHERE common.n > most GROUP BY hashed.doc_id),
base AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(ws) - coalesce(lost.n, 0) AS BIGINT) AS words_left
         FROM w LEFT JOIN dups ON dups.doc_id = w.doc_id LEFT JOIN covered ON covered.doc_id = w.doc_id LEFT JOIN lost ON lost.doc_id = w.doc_id),
judged AS (SELECT *, n_words < {lines.MIN_WORDS} OR 100 * n_repeat_words > {lines.MAX_REPEATED} * n_words AS base_failed,
             words_left < CAST({lines.MIN_LEFT} AS DOUBLE) * n_words AS depleted FROM base)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM judged"""


@query(QUALITY_SQL)
def op6_quality(spark, sf):
    return lines.rules(table(spark, sf, "documents")).drop("_place", "_host", "_lost", "_drop")


@query()
def op7_token_counts(spark, sf):
    return trie.token_counts(table(spark, sf, "documents"), VOCABULARY)


SURROGATE_KEY = "panelwright corpus"
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


@query()
def op8_surrogates(spark, sf):
    return surrogates.replace(table(spark, sf, "documents").select("doc_id", "text"), SURROGATE_KEY)


@query()
def op9_urls(spark, sf):
    return hosts.judge(table(spark, sf, "pages"), URL_RULES)


@query()
def op10_multiset(spark, sf):
    return multiset.compare_with_next(table(spark, sf, "documents"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NEAR_SQL = rf"""WITH RECURSIVE w AS (SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^ \t-\r]+') AS ws FROM documents),
sh AS (SELECT DISTINCT d, s FROM (
  SELECT d, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS s FROM w)),
size AS (SELECT d, count(*) AS n FROM sh GROUP BY d),
named AS (SELECT d, n, sets FROM (SELECT d, md5(string_agg(s, chr(10) ORDER BY s)) AS sets FROM sh GROUP BY d) JOIN size USING (d)),
one AS (SELECT sets, min(d) AS d FROM named GROUP BY sets),
lone AS (SELECT sh.d, s FROM sh JOIN one ON one.d = sh.d),
common AS (SELECT a.d AS a, b.d AS b, count(*) AS c FROM lone a JOIN lone b ON a.s = b.s AND a.d < b.d GROUP BY a.d, b.d),
link AS (SELECT a, b FROM common JOIN size x ON x.d = a JOIN size y ON y.d = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link UNION SELECT d, d FROM one),
reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
class AS (SELECT x.sets, y.sets AS other FROM reach JOIN one x ON x.d = reach.a JOIN one y ON y.d = reach.b),
least AS (SELECT class.sets, min(w.doc_id) AS component_id FROM class JOIN named ON named.sets = class.other JOIN w ON w.d = named.d GROUP BY class.sets)
SELECT w.doc_id, coalesce(named.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, w.doc_id = coalesce(component_id, w.doc_id) AS kept
FROM w LEFT JOIN named ON named.d = w.d LEFT JOIN least ON least.sets = named.sets"""


@query(NEAR_SQL)
def op11_sketches(spark, sf):
    return sketches.groups(table(spark, sf, "documents"), words=3, percent=85)


DIVERGENCE_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM d),
kept AS (SELECT lang, w FROM w GROUP BY lang, w HAVING count(DISTINCT d) >= 30),
v AS (SELECT g.lang, count(k.w) AS v FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN kept k ON k.lang = g.lang GROUP BY g.lang),
n AS (SELECT w.lang, source, w.w, count(*) AS n FROM w JOIN kept k ON k.lang = w.lang AND k.w = w.w GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
sums AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS s FROM n GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.w, coalesce(n.n, 0) AS n,
        1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n.n, 0) + 5)) // (coalesce(s.s, 0) + 5 * v.v) AS p
      FROM g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.w = k.w),
q AS (SELECT x.lang, x.w, 1 + (CAST(1000000000 AS HUGEINT) * (x.n + 5)) // (t.s + 5 * v.v) AS q
      FROM (SELECT lang, w, CAST(sum(n) AS HUGEINT) AS n FROM n GROUP BY lang, w) x
      JOIN (SELECT lang, CAST(sum(n) AS HUGEINT) AS s FROM n GROUP BY lang) t ON t.lang = x.lang JOIN v ON v.lang = x.lang),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
          FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
          LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.w = x.w
          GROUP BY a.lang, a.source, b.source),
terms AS (SELECT p.lang, p.source, p.w AS item, CAST(p.p - q.q AS BIGINT) AS value FROM p JOIN q ON q.lang = p.lang AND q.w = p.w WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms) WHERE rank <= 50"""


@query(DIVERGENCE_SQL)
def op12_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents"), least=30, most=50)


COLLOCATIONS_SQL = rf"""WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
pieces AS (SELECT row_number() OVER () AS p, lang, piece FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?
-
]')) AS piece FROM d)),
w AS (SELECT p, lang, regexp_extract_all(piece, '[^ 	]+') AS ws FROM pieces),
placed AS (SELECT p, lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
one AS (SELECT lang, ws[i] AS x, count(*) AS f FROM placed GROUP BY ALL),
two AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, count(*) AS f FROM placed WHERE i + 1 <= len(ws) GROUP BY ALL),
three AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z, count(*) AS f FROM placed WHERE i + 2 <= len(ws) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang),
inner_pairs AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM three WHERE f >= 10 UNION ALL SELECT lang, y, z, f FROM three WHERE f >= 10) GROUP BY lang, x, y),
cuts AS (
  SELECT two.lang, two.x || ' ' || two.y AS phrase, two.f AS a, 1 AS k, p.f AS l, q.f AS r FROM two
    JOIN one p ON p.lang = two.lang AND p.x = two.x JOIN one q ON q.lang = two.lang AND q.x = two.y
    LEFT JOIN inner_pairs b ON b.lang = two.lang AND b.x = two.x AND b.y = two.y
    WHERE two.f >= 10 AND (b.f IS NULL OR 100 * b.f < 50 * two.f)
  UNION ALL SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, p.f, q.f FROM three t
    JOIN one p ON p.lang = t.lang AND p.x = t.x JOIN two q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z WHERE t.f >= 10
  UNION ALL SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, p.f, q.f FROM three t
    JOIN two p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN one q ON q.lang = t.lang AND q.x = t.z WHERE t.f >= 10),
scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT ranked.lang, rank, phrase, a, l, r, n.n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000"""


@query(COLLOCATIONS_SQL)
def op13_collocations(spark, sf):
    common.sharing(spark, BATCH_BYTES)
    return collocations.mine(table(spark, sf, "documents"), least=10, inside=50, most=2000)
