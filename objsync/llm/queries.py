"""The registered queries of this subpackage, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontamination,
    host_reputation,
    host_rules,
    jaccard_join,
    language_codes,
    multi_index,
    packing,
    pii_surrogates,
    secret_scan,
    source_audit,
    substring_dedup,
    toxic_spans,
    zone_clusters,
)
from .shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHITE_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""
    WITH b AS (
        SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS size
        FROM (SELECT item_id, {_ALNUM_WORDS.format(_LOWER.format("text"))} AS w FROM benchmark)
        WHERE len(w) > 0),
    bw AS (
        SELECT DISTINCT item, size, array_to_string(w[i : i + size - 1], ' ') AS words
        FROM b, unnest(range(1, len(w) - size + 2)) AS t(i)),
    d AS (SELECT doc_id, {_ALNUM_WORDS.format(_LOWER.format("text"))} AS w FROM documents),
    dw AS (
        SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
        FROM d, (SELECT DISTINCT size FROM bw), unnest(range(1, len(w) - size + 2)) AS t(i)),
    hits AS (SELECT doc_id, item, i, size FROM dw JOIN bw USING (size, words)),
    hit_words AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM hits, unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
    hit_items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""
)
def op9_decontaminate(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontamination.mark_passages(documents, table(spark, sf_dir, "benchmark"))
    return decontamination.passage_digest(marked)


@query(
    f"""
    WITH d AS (SELECT doc_id, {_WHITE_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS words
        FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
    first AS (SELECT words, min(doc_id) AS first_id FROM windows GROUP BY words),
    gone AS (
        SELECT DISTINCT doc_id, p
        FROM windows JOIN first USING (words), unnest(range(i, i + 13)) AS t(p)
        WHERE first_id < doc_id),
    places AS (
        SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
        FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)"""
)
def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.dedup_digest(table(spark, sf_dir, "documents"))


@query(
    f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, {_WHITE_WORDS.format(_LOWER.format("text"))} AS w FROM documents),
    grams AS (
        SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS gram
        FROM d, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS t(i)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= 80 * (x.n + y.n - c)),
    reach AS (
        SELECT doc_id, doc_id AS other FROM d
        UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
    FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""
)
def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"))


@query()
def op8_pattern_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


#: The key of surrogates; a run over real data is given its own.
SURROGATE_KEY = "an example key"


@query()
def op1_pii_surrogates(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_surrogates.replace_entities(documents, SURROGATE_KEY)


def _hits(kind: str, pattern: str, group: int = 0, condition: str = "true") -> str:
    """Spans of a pattern: lengths of what is before each match, and of the matches."""
    number = list(secret_scan.KINDS).index(kind)
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
        SELECT doc_id, '{kind}' AS kind, {number} AS kind_no, place AS start, place + length(ms[i]) AS stop
        FROM (SELECT *, coalesce(list_sum(list_transform(bs[1 : i], lambda x: length(x))), 0)
                     + coalesce(list_sum(list_transform(ms[1 : i - 1], lambda x: length(x))), 0) AS place
              FROM (SELECT doc_id, regexp_split_to_array(t, {quoted}) AS bs,
                           regexp_extract_all(t, {quoted}, 0) AS ms,
                           regexp_extract_all(t, {quoted}, {group}) AS ps
                    FROM d WHERE regexp_matches(t, {quoted})),
                   unnest(range(1, len(ms) + 1)) AS u(i))
        WHERE {condition}"""


_SPANS = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, kind_no, stop)"
_SECRET = "IN ('assign', 'hex', 'weak_secret')"
_ROLE = "CASE WHEN {0}.kind " + _SECRET + " THEN 'secret' WHEN {0}.kind = 'weak_endpoint' THEN 'endpoint' ELSE 'identifier' END"


@query(
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    base AS ({_hits("assign", secret_scan.ASSIGN, 2, "length(ps[i]) >= 8")}
        UNION ALL {_hits("access", secret_scan.ACCESS)}
        UNION ALL {_hits("hex", secret_scan.HEX)}),
    parts AS ({_hits("weak_secret", secret_scan.ASSIGN, 2, "length(ps[i]) BETWEEN 4 AND 7")}
        UNION {_hits("weak_secret", secret_scan.LOOSE)}
        UNION {_hits("weak_identifier", secret_scan.IDENTIFIER)}
        UNION {_hits("weak_endpoint", secret_scan.ENDPOINT)}),
    weak AS (
        SELECT * FROM parts w WHERE NOT EXISTS (
            SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.start < w.stop AND w.start < b.stop)),
    linked AS (
        SELECT DISTINCT w.* FROM weak w JOIN (FROM weak UNION ALL FROM base) p USING (doc_id)
        WHERE {_ROLE.format("w")} <> {_ROLE.format("p")}
          AND (w.kind {_SECRET} OR p.kind {_SECRET})
          AND greatest(p.start - w.stop, w.start - p.stop) BETWEEN 0 AND {secret_scan.SCOPE}),
    counted AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex, {_SPANS} AS listed FROM base GROUP BY doc_id),
    whole AS (SELECT doc_id, {_SPANS} AS spans FROM (FROM base UNION ALL FROM linked) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(listed, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN whole USING (doc_id)"""
)
def op2_secret_links(spark, sf_dir):
    return secret_scan.secrets_digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


@query()
def op3_toxic_spans(spark, sf_dir):
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    tagger = toxic_spans.fit(toxic_spans.labelled_texts(documents, labels))
    return toxic_spans.score_documents(documents, tagger)


_Z, _MOST = host_rules.Z, host_rules.MAX_STRENGTH


@query(
    f"""
    WITH d AS (
        SELECT doc_id, source, coalesce(text, '') AS t, {_WHITE_WORDS.format("coalesce(text, '')")} AS w
        FROM documents),
    grams AS (
        SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS gram
        FROM d, unnest(range(1, len(w) - 3)) AS u(i)),
    twice AS (
        SELECT doc_id, i FROM grams JOIN (
            SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1) USING (doc_id, gram)),
    repeated AS (
        SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 5)) AS u(p) GROUP BY doc_id),
    counted AS (
        SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
               length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
        FROM (SELECT *, list_filter(string_split(t, chr(10)),
                                    lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d)
        LEFT JOIN repeated USING (doc_id)),
    judged AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               n_words < 10 OR 100 * n_repeat_words > 20 * n_words
               OR 2 * n_symbols > word_chars OR 2 * n_dup_lines > n_words AS failed FROM counted),
    hosts AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS bad FROM judged GROUP BY source),
    moments AS (
        SELECT avg(bad / n) AS m, coalesce(var_samp(bad / n), 0) AS v, avg(1 / n) AS per FROM hosts),
    strength AS (
        SELECT m, CASE WHEN v - m * (1 - m) * per > m * (1 - m) / ({_MOST} + 1)
                       THEN greatest(m * (1 - m) / (v - m * (1 - m) * per) - 1, 1.0)
                       ELSE {_MOST} END AS k FROM moments),
    beta AS (SELECT source, bad + m * k AS a, n - bad + (1 - m) * k AS b FROM hosts, strength),
    verdicts AS (
        SELECT source, round(a / (a + b) - {_Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 9)
                       <= {host_rules.HOST_LIMIT} AS host_kept FROM beta)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND host_kept AS kept
    FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source"""
)
def op4_host_rules(spark, sf_dir):
    return host_rules.judge_documents(table(spark, sf_dir, "documents"))


#: Verdict, host and path of each rule.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


@query()
def op5_host_reputation(spark, sf_dir):
    pages, labels = (table(spark, sf_dir, name) for name in ("pages", "labels"))
    return host_reputation.judge_pages(pages, labels, URL_RULES)


@query()
def op6_language_codes(spark, sf_dir):
    return language_codes.identify_languages(table(spark, sf_dir, "documents"))


@query()
def op11_multi_index(spark, sf_dir):
    return multi_index.nearest(table(spark, sf_dir, "embeddings"))


def _nearest_sql(n: int) -> str:
    """Each vector's distance to its nearest centroid of round ``n``, and that centroid."""
    return f"""
    d{n} AS (
        SELECT vec_id, c, sum((x.v - m.v) * (x.v - m.v)) AS distance
        FROM parts x JOIN m{n} m USING (i) GROUP BY vec_id, c),
    a{n} AS (
        SELECT vec_id, c, distance FROM d{n}
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) = 1)"""


def _moved_sql(n: int) -> str:
    """The centroids after round ``n``."""
    return f"""
    s{n} AS (
        SELECT c, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS k
        FROM a{n} JOIN parts USING (vec_id) GROUP BY c, i),
    m{n + 1} AS (
        SELECT m.c, m.i, CASE WHEN k IS NULL THEN m.v ELSE (s - ((s % k) + k) % k) // k END AS v
        FROM m{n} m LEFT JOIN s{n} USING (c, i))"""


@query(
    f"""
    WITH kept AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
    parts AS (SELECT vec_id, unnest(range(64)) AS i, unnest(v) AS v FROM kept),
    firsts AS (
        SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM kept
        ORDER BY c LIMIT 16),
    m0 AS (SELECT c, i, v FROM firsts JOIN parts USING (vec_id)),
    {_nearest_sql(0)}, {_moved_sql(0)}, {_nearest_sql(1)}, {_moved_sql(1)}, {_nearest_sql(2)}, {_moved_sql(2)},
    {_nearest_sql(3)},
    shas AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS sha FROM m3 GROUP BY c)
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
           CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
    FROM a3 JOIN shas USING (c)"""
)
def op12_zone_clusters(spark, sf_dir):
    return zone_clusters.clusters(table(spark, sf_dir, "embeddings"))


_P = "1 + (1000000000 * (CAST({0} AS HUGEINT) + 5)) // ({1} + 5 * {2})"


@query(
    f"""
    WITH d AS (
        SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
        FROM documents),
    numbered AS (SELECT row_number() OVER () AS k, * FROM d),
    words AS (SELECT k, lang, source, unnest(w) AS term FROM numbered),
    kept AS (
        SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term
        HAVING count(DISTINCT k) >= 30),
    langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM d),
    counts AS (
        SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term)
        GROUP BY lang, source, term),
    totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
    whole AS (
        SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
               {_P.format("coalesce(n, 0)", "coalesce(t.total, 0)", "l.v")} AS p,
               {_P.format("k.lang_n", "l.total", "l.v")} AS q
        FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
        LEFT JOIN totals t USING (lang, source)
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (
            SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
            FROM whole x JOIN whole y USING (lang, term) GROUP BY ALL) s
        ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    rows AS (
        SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL SELECT lang, source, 'term', term, abs(p - q) FROM whole WHERE n > 0 AND p > q),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
        FROM rows)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 50"""
)
def op13_source_audit(spark, sf_dir):
    return source_audit.divergence(table(spark, sf_dir, "documents"))
