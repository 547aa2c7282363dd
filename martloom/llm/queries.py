"""The queries of this subpackage, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import collocations, grouped_prefix, kd_shards, license_scan, minhash_hamming, nn_descent, packing, pairwise_quality, periodic_runs, quality_rules, sentencepiece_backend, suffix_dedup, url_filter
from martloom.llm.frames import ROW
from martloom.queries.registry import Build, Query, table

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = Query(name, build, sql)
        return build

    return register


SHARDS = 24
#: Scores from here on are predicted as label 1.
THRESHOLD = 0.3


@query("op3_kd_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shards = kd_shards.sharded(docs, ["n_chars", "doc_id", "source", "lang"], leaves=SHARDS)
    return shards.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


#: The rules that the query is to apply.
URL_RULES = (
    url_filter.Rule("org", "/", url_filter.ALLOW),
    url_filter.Rule("example.org", "/es/", url_filter.BLOCK),
    url_filter.Rule("example.org", "/en/1", url_filter.BLOCK),
    url_filter.Rule("com", "/fr/", url_filter.ALLOW),
    url_filter.Rule("com", "/de/", url_filter.BLOCK),
)
#: Blocked where no rule fits: farms, hosts by bare number, downloads.
BLOCKED_GLOBS = ("*spam*/**", "*casino*/**", "*.zip", "**/*.exe", "**/login**", "?.?.?.?/**")

URL_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts),
ruled AS (
  SELECT *, '.' || host AS dotted, CASE
    WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM split)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN host = '' THEN 'block'
  WHEN regexp_matches(host || path, '^(?:[^/]*spam[^/]*/(?s:.*)|[^/]*casino[^/]*/(?s:.*)|[^/]*\.zip|(?s:.*)/[^/]*\.exe|(?s:.*)/login(?s:.*)|[^/]\.[^/]\.[^/]\.[^/]/(?s:.*))$')
  THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op4_url_filter", URL_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES, BLOCKED_GLOBS)


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
grams AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w),
found AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM grams),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM found, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    length(array_to_string(lines, '')) AS all_chars,
    length(array_to_string(list_filter(lines, lambda l: NOT (
      (len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) < 10
        AND NOT regexp_matches(l, '[.!?:;,…»”"'')\]][\x20\x09-\x0D]*$'))
      OR len(regexp_extract_all(l, '\|')) >= 3 OR len(regexp_extract_all(l, '>')) >= 3
      OR len(regexp_extract_all(l, '»')) >= 3 OR len(regexp_extract_all(l, '•')) >= 3
      OR (length(l) < 200 AND regexp_matches(l, '(?i)all rights reserved|licensed under|license, version|released under|privacy policy|terms of use|terms of service|cookie|enable javascript|click here|sign up|log in|lorem ipsum'))
      OR length(regexp_replace(l, '[^#*$%&|<>]+', '', 'g')) * 10 > length(l)
      OR (length(l) >= 10 AND l = upper(l) AND l <> lower(l)))), '')) AS line_chars
  FROM w)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  n_words < 50 OR coalesce(n_repeat_words, 0) * 100 > n_words * 50 AS base_failed,
  NOT (n_words < 50 OR coalesce(n_repeat_words, 0) * 100 > n_words * 50) AND line_chars * 100 >= all_chars * 50 AS kept
FROM counted LEFT JOIN repeated USING (doc_id)
"""


@query("op7_quality_rules", QUALITY_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, sf_dir, "documents"))
    return judged.select(F.col(f"{ROW}.doc_id").alias("doc_id"), *quality_rules.MEASURES, "base_failed", "kept")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_pack_sequences")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequences(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op8_pairwise_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = pairwise_quality.learned(docs, labels, THRESHOLD)
    doc_id = F.col(f"{ROW}.doc_id")
    return pairwise_quality.scored(docs, model).select(
        doc_id.alias("doc_id"),
        pairwise_quality.held_out(doc_id).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_backend.summary(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), parity_every=1)


def _canonical_sql(column: str) -> str:
    small = f"translate(coalesce({column}, ''), '{url_filter.UPPER}', '{url_filter.LOWER}')"
    text = f"regexp_replace({small}, '{license_scan.COPYRIGHT_LINE}', '', 'g')"
    for spelling, kept in license_scan.SPELLINGS:
        text = f"replace({text}, '{spelling}', '{kept}')"
    return f"sha256(trim(regexp_replace({text}, '{license_scan.OTHERS}', ' ', 'g')))"


_KNOWN_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in license_scan.KNOWN.items())
LICENSE_SQL = rf"""
WITH known AS (SELECT {_canonical_sql("text")} AS digest, license FROM (VALUES {_KNOWN_ROWS}) AS k(license, text)),
texts AS (SELECT doc_id, {_canonical_sql("text")} AS digest FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
notices AS (
  SELECT doc_id, count(*) AS n_notices, array_to_string(list_sort(list_distinct(list(license))), ' ') AS notices
  FROM (SELECT doc_id, {_canonical_sql("line")} AS digest FROM lines) JOIN known USING (digest) GROUP BY doc_id)
SELECT doc_id, digest, license, coalesce(n_notices, 0) AS n_notices, coalesce(notices, '') AS notices
FROM texts LEFT JOIN known USING (digest) LEFT JOIN notices USING (doc_id)
"""


@query("op10_license_scan", LICENSE_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents"), license_scan.known_digests(spark))


def jaccard_sql(words: int, percent: int) -> str:
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: {shingle})) END AS s FROM w),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {percent}
  GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * c >= {percent} * (na + nb - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a)
SELECT doc_id, len(s) AS n_shingles, (SELECT min(other) FROM reach WHERE reach.doc_id = sets.doc_id) AS component_id FROM sets
"""


@query("op5_prefix_join", jaccard_sql(grouped_prefix.WORDS, grouped_prefix.PERCENT))
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_prefix.linked(table(spark, sf_dir, "documents"))


NEAR_SQL = f"SELECT *, doc_id = component_id AS kept FROM ({jaccard_sql(minhash_hamming.WORDS, minhash_hamming.PERCENT)})"


@query("op13_minhash_hamming", NEAR_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_hamming.linked(table(spark, sf_dir, "documents"))


def with_repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that the query is to work on: in a tenth of the documents, by the CRC of the id, the tail is repeated."""
    if doc_id is None or not words:
        return words
    crc = zlib.crc32(str(doc_id).encode())
    if crc % 10:
        return words
    g, n = crc // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + [words[start + i % period] for i in range(n - start)]


_W, _R = periodic_runs.WINDOW, periodic_runs.REPEATS
#: A stretch of windows that recur q words on is a run with period q, unless the same stretch has a smaller period.
RUNS_SQL = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
bits AS (
  SELECT doc_id, w, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda crc, c: CASE WHEN c >= 0 THEN xor(crc, c) ELSE xor(crc >> 1, 3988292384::BIGINT * (crc & 1)) END), 4294967295::BIGINT) AS h FROM w),
parts AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS m FROM bits),
words AS (
  SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // m) + 1] END)
    ELSE w END AS w FROM parts),
windows AS (SELECT doc_id, i, w[i + 1:i + {_W}] AS win FROM (SELECT doc_id, w, unnest(range(n - {_W - 1})) AS i FROM words)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM windows x JOIN windows y ON x.doc_id = y.doc_id AND x.win = y.win AND x.i < y.i),
islands AS (
  SELECT doc_id, q, min(i) AS start, count(*) + {_W - 1} + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM islands
  WHERE length >= greatest({periodic_runs.SHORTEST}, {_R} * q) GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    flatten(list(range(start + period, start + length))) AS dropped FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(dropped) AS i FROM listed),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM words) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM words LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op12_periodic_runs", RUNS_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summary(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), with_repeated_tail))


_C = collocations
COLLOCATION_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, {_C.LONGEST + 1})) AS k) WHERE len(w) >= k),
counted AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= {_C.LEAST}),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.j, x.f AS l, y.f AS r, ({_C.SCALE}::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.j], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.j + 1:], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, a AS longer, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates))),
dropped AS (SELECT DISTINCT lang, phrase FROM inside JOIN candidates c USING (lang, phrase) WHERE 100 * longer >= {_C.COVERED} * c.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst ANTI JOIN dropped USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= {_C.TOP}
"""


@query("op11_collocations", COLLOCATION_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op6_nn_descent")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.searched(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.measured(table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
