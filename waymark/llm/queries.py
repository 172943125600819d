"""One query for each operator over its whole table, with check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import audit, collocations, decontaminate, html, language, mixing, ngram_join, quality, sharding, suffix, templates, urls, warc
from waymark.llm.common import shared_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(language.training_rows(docs))
    judged = language.identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query(rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
""")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each benchmark item found in a document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law is ``rows``: every shard is filled up to its even share, so counts are at most one apart."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")).alias("text"), sharding.text_size().alias("size"), sharding.text_crc32().alias("text_crc32"))
    placed = sharding.assign(docs)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each draw of a document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.tokens().alias("tokens"))
    return mixing.mix(docs, counted=True).select("doc_id", "source", "tokens", "epoch", "block", "place")


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


# Fixed values of the contract: (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# The tables hold no list of URLs. The list is a stable eighth of the pages' own canonical URLs, so it grows with the pages.
LISTED_ONE_IN = 8


@query(rf"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
split AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '{urls.TRACKING}'))) AS kept
  FROM parts),
named AS (
  SELECT page_id, host, path, CASE WHEN host <> '' THEN
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM split),
listed AS (SELECT DISTINCT canonical FROM named WHERE canonical IS NOT NULL AND ('0x' || substr(md5(canonical), 1, 8))::BIGINT % {LISTED_ONE_IN} = 0),
rules(verdict, h, p) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(r.verdict, length(h || p)) AS verdict
  FROM named JOIN rules r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT n.page_id, n.host, n.path, f.rule, coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  n.canonical, l.canonical IS NOT NULL AS listed
FROM named n LEFT JOIN fits f USING (page_id) LEFT JOIN listed l ON l.canonical = n.canonical
""")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    names = pages.select(urls.canonical().alias("canonical"))
    listed = names.filter(F.conv(F.substring(F.md5(F.col("canonical").cast("binary")), 1, 8), 16, 10).cast("long") % LISTED_ONE_IN == 0)
    judged = urls.judged(pages, URL_RULES, listed)
    return judged.select("page_id", "host", "path", "rule", "verdict", "canonical", "listed")


@query()
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


@query(rf"""
WITH rows AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM documents),
cut AS (
  SELECT doc_id, no, list_transform(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda t: t <> ''),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{templates.WILDCARD}' ELSE t END) AS tokens FROM rows),
long AS (SELECT *, [len(tokens)::VARCHAR] || tokens[1:{templates.LEADS}] AS leaf FROM cut WHERE len(tokens) > 0),
places AS (SELECT doc_id, no, leaf, tokens, unnest(tokens) AS token, unnest(range(len(tokens))) AS place FROM long),
stay AS (SELECT leaf, place, token FROM places GROUP BY leaf, place, token HAVING count(DISTINCT doc_id) >= {templates.MIN_DOCS}),
made AS (
  SELECT doc_id, no, p.leaf, count(*) AS size, any_value(tokens) AS tokens, count(s.token) AS same,
    list(coalesce(s.token, '{templates.WILDCARD}') ORDER BY p.place) AS general
  FROM places p LEFT JOIN stay s ON s.leaf = p.leaf AND s.place = p.place AND s.token = p.token GROUP BY doc_id, no, p.leaf),
template AS (SELECT doc_id, no, CASE WHEN same >= CASE WHEN size < {templates.SHORT} THEN size ELSE size * {templates.SIMILAR} END THEN ['~', len(tokens)::VARCHAR] || leaf || general ELSE ['='] || leaf || tokens END AS t FROM made),
recurring AS (SELECT t FROM template GROUP BY t HAVING count(DISTINCT doc_id) >= {templates.MIN_DOCS}),
dropped AS (SELECT doc_id, no FROM template JOIN recurring USING (t)),
left_lines AS (
  SELECT r.doc_id, count(*) AS n_lines, count(d.no) AS n_dropped, string_agg(CASE WHEN d.no IS NULL THEN r.line END, chr(10) ORDER BY r.no) AS clean_text
  FROM rows r LEFT JOIN dropped d ON d.doc_id = r.doc_id AND d.no = r.no GROUP BY r.doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
  CASE WHEN text IS NOT NULL THEN coalesce(clean_text, '') END AS clean_text
FROM documents LEFT JOIN left_lines USING (doc_id)
""")
def op4_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return templates.deduplicated(docs).select("doc_id", "n_lines", "n_dropped", "clean_text")


@query()
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query(r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
firsts AS (SELECT t, min(doc_id) AS least FROM texts GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
    'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w), 'C': 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t),
    'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > least, false)} AS f
  FROM words JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
masks AS (SELECT part, good, toxic, f, count(*) AS n FROM judged GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, s AS step, filter_order[s] AS x, filter_order[1:s - 1] AS before FROM orders, range(1, 6) r(s)),
failed AS (
  SELECT part, good, toxic, n, concat(CASE WHEN f.A THEN 'A' END, CASE WHEN f.B THEN 'B' END, CASE WHEN f.C THEN 'C' END, CASE WHEN f.D THEN 'D' END, CASE WHEN f.E THEN 'E' END) AS fails FROM masks),
outcomes AS (
  SELECT part, good, toxic, n, filter_order, step, x, contains(fails, x) AS hit, fails = x AS alone,
    before <> '' AND regexp_matches(fails, '[' || coalesce(nullif(before, ''), 'Z') || ']') AS gone FROM failed, steps),
counted AS (
  SELECT part, filter_order, step, any_value(x) AS x, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT gone AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM outcomes GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM counted
""")
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return audit.audited(docs, table(spark, sf_dir, "labels"))


@query(rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) lengths(k) WHERE len(w) >= k)),
f AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS a FROM grams GROUP BY lang, phrase),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 10),
longer AS (
  SELECT lang, inner_phrase, max(a) AS most FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS inner_phrase FROM candidates WHERE k = 3) GROUP BY lang, inner_phrase),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer o ON o.lang = c.lang AND o.inner_phrase = c.phrase AND c.k = 2 WHERE o.most IS NULL OR 100 * o.most < 50 * c.a),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, h.a AS l, t.a AS r, (1000000::HUGEINT * c.a * c.a) // (h.a::HUGEINT * t.a) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@query(rf"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, min(page_id) AS least FROM payloads GROUP BY payload),
digests AS (
  SELECT page_id, payload, least, strlen(payload) AS payload_bytes, list_transform(range(0, 8), lambda i: ('0x' || sha1(payload)[5 * i + 1:5 * i + 5])::BIGINT) AS bits
  FROM payloads JOIN firsts USING (payload))
SELECT page_id, payload_bytes, array_to_string(list_transform(bits, lambda b: concat(
    '{BASE32}'[(b >> 15) + 1], '{BASE32}'[(b >> 10) % 32 + 1], '{BASE32}'[(b >> 5) % 32 + 1], '{BASE32}'[b % 32 + 1])), '') AS payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> least THEN least END AS refers_to
FROM digests
""")
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages are written as archives into the shared folder, and every record is read back, its payload verified."""
    path = f"{shared_path(spark, keep=True)}.warc"
    warc.write(warc.records(table(spark, sf_dir, "pages")), path)
    found = warc.read(spark, path, F.col("record_type").isin("response", "revisit"))
    page, first = (F.col("headers")[name].cast("long") for name in ("page-id", "refers-to-page-id"))
    return found.select(page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", first.alias("refers_to"))
