"""The registered corpus queries, each over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    decontaminate,
    divergence,
    exact_dedup,
    filter_audit,
    language,
    mixing,
    near_dedup,
    quality,
    sentencepiece_codec,
    suffix,
    toxicity,
    url_filter,
)
from .frames import ship, stored, table
from .learning import remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function: Query) -> Query:
        @functools.wraps(function)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = shipped
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


@query(
    """WITH folded AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
      FROM documents),
    sizes AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM folded JOIN sizes USING (t)"""
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents by verified chunk recipes."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query(
    """WITH RECURSIVE raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    sized AS (SELECT doc_id, h, length(h) // 2 AS n_bytes FROM raw),
    starts AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w FROM sized, range(0, greatest(n_bytes - 49, 0)) t(i)),
    seen AS (SELECT w, min(doc_id) AS first_id FROM starts GROUP BY w),
    hit AS (SELECT doc_id, i FROM starts JOIN seen USING (w) WHERE first_id < doc_id),
    marked AS (SELECT doc_id, i, CASE WHEN lag(i) OVER (PARTITION BY doc_id ORDER BY i) >= i - 50 THEN 0 ELSE 1 END AS opens
      FROM hit),
    islands AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked),
    spans AS (SELECT doc_id, g, min(i) AS a, max(i) + 50 AS b FROM islands GROUP BY doc_id, g),
    pieces AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before,
      lead(a) OVER (PARTITION BY doc_id ORDER BY a) IS NULL AS last FROM spans),
    kept AS (SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
      string_agg(substr(h, 2 * before + 1, 2 * (a - before)) || CASE WHEN last THEN substr(h, 2 * b + 1) ELSE '' END, ''
        ORDER BY a) AS k FROM pieces p JOIN sized USING (doc_id) GROUP BY p.doc_id)
    SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
      sha256(unhex(coalesce(k, h))) AS kept_sha256
    FROM sized LEFT JOIN kept USING (doc_id)"""
)
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that a document with a smaller id also has, removed."""
    found = suffix.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# Fixed values of the query: (verdict, host, path), and host labels of unwanted sites.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
UNWANTED_HOSTS = r"(^|\.)(spam-farm|free-bets|adult-chat|casino-win)\."


@query(
    r"""WITH cut AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    parsed AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
    rules(v, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
      ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
    pairs AS (SELECT DISTINCT host, path FROM parsed),
    best AS (SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v FROM pairs, rules
      WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
    SELECT page_id, host, path, rule, CASE WHEN v IS NOT NULL THEN v
      WHEN regexp_matches(host, '(^|\.)(spam-farm|free-bets|adult-chat|casino-win)\.') THEN 'block' ELSE 'allow' END
      AS verdict FROM parsed LEFT JOIN best USING (host, path)"""
)
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules for hosts and paths; beyond them, the listed canonical URLs of unwanted sites are blocked."""
    pages = table(spark, sf_dir, "pages")
    unwanted = pages.where(url_filter.host_of(F.col("url")).rlike(UNWANTED_HOSTS))
    rules = url_filter.rule_table(spark, URL_RULES)
    listed = rules.unionByName(url_filter.url_table(unwanted, "url", "block"))
    return url_filter.judge(pages, listed).select("page_id", "host", "path", "rule", "verdict")


WORDS_SQL = r"""list_filter(regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


@query(
    f"""WITH d AS (SELECT doc_id, {WORDS_SQL.format(t="text")} AS w FROM documents),
    b AS (SELECT item_id, {WORDS_SQL.format(t="text")} AS w FROM benchmark),
    sizes AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
    phrases AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p
      FROM sizes, range(1, len(w) - n + 2) t(i)),
    lengths AS (SELECT DISTINCT n FROM phrases),
    windows AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
      FROM d, lengths, range(1, len(w) - n + 2) t(i)),
    hits AS (SELECT doc_id, i, n, item_id FROM windows JOIN phrases USING (n, p)),
    words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hits), range(i, i + n) t(k)
      GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""
)
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of benchmark items found in documents through an FM-index per shard."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def held_out(modulus: int, rest: int):
    return F.coalesce(remainder("doc_id", modulus) == rest, F.lit(False))


@query()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of a factorisation machine, for every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~held_out(3, 1)))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out(4, 2)))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of matched clauses, for every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out(4, 2)))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


@query()
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as piece ids, decoded again."""
    vocabulary = sentencepiece_codec.load()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentencepiece_codec.encode(docs, vocabulary, check_col="round_trip")
    return encoded.select("doc_id", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), "round_trip")


@query()
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as raw transcripts, parsed again and rendered; right: turns whose role was recovered."""
    raw = chat.raw_transcripts(table(spark, sf_dir, "conversations"))
    raw = stored(raw, "transcripts")
    parsed = chat.parse(raw, chat.train(raw))
    true = F.filter("turns", lambda t: t["lines"] > 0)
    same = F.zip_with(true, "parsed", lambda t, p: F.coalesce((t["role"] == p["role"]).cast("int"), F.lit(0)))
    return parsed.select(
        "conv_id",
        "block",
        "cut",
        F.size(true).cast("long").alias("n_turns"),
        F.size("parsed").cast("long").alias("n_parsed"),
        F.aggregate(same, F.lit(0), lambda n, x: n + x).cast("long").alias("n_right"),
        F.transform("parsed", lambda t: t["role"]).alias("roles"),
        "rendered",
    )


@query(
    r"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
      list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
    t AS (SELECT lang, source, r, unnest(w) AS term FROM d),
    counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM t GROUP BY ALL),
    kept AS (SELECT lang, term, sum(n) AS total FROM counts GROUP BY ALL HAVING sum(docs) >= 30),
    langs AS (SELECT lang, count(*) AS v, sum(total) AS nl FROM kept GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    cells AS (SELECT lang, source, term, coalesce(n, 0) AS n, total FROM g JOIN kept USING (lang)
      LEFT JOIN counts USING (lang, source, term)),
    p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p,
      1 + (1000000000 * (total + 5)) // (nl + 5 * v) AS q FROM cells JOIN langs USING (lang)),
    far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INT) AS rank FROM ranked
    WHERE part = 'pair' OR r <= 50"""
)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source's terms are from the other sources and from the language."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query(
    r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
    l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
    w AS (SELECT *, list_filter(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d JOIN firsts USING (t)),
    f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
      CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
      || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
      FROM w LEFT JOIN l USING (doc_id)),
    c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
    x(v) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
    o AS (SELECT a.v || b.v || c.v || d.v || e.v AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.v, b.v, c.v, d.v, e.v])) = 5),
    s AS (SELECT filter_order, CAST(i AS INT) AS step, filter_order[i] AS own, left(filter_order, CAST(i - 1 AS INT)) AS before
      FROM o, range(1, 6) t(i)),
    r AS (SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS fails_own,
      before <> '' AND regexp_matches(fails, '[' || before || 'x]') AS gone FROM c, s),
    out AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT fails_own), 0) AS kept,
      coalesce(sum(n) FILTER (NOT gone AND fails_own), 0) AS removed, coalesce(sum(n) FILTER (gone AND fails_own), 0) AS redundant,
      coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND fails_own), 0) AS good_lost,
      coalesce(sum(toxic) FILTER (NOT gone AND fails_own), 0) AS toxic_lost FROM r GROUP BY ALL)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
      CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
      CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM out"""
)
def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove alone, together and in every order."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    r"""WITH d AS (SELECT doc_id, source, len(list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
      lambda x: x <> '')) AS size FROM documents),
    s AS (SELECT source, sum(size) AS n, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w
      FROM d GROUP BY source),
    r AS (SELECT *, 2.0::DOUBLE * n AS most, row_number() OVER (ORDER BY n / w, source NULLS LAST) AS k FROM s),
    lev AS (SELECT *, 1.5::DOUBLE * sum(n) OVER () - coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS rest, sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w FROM r),
    cut AS (SELECT rest, open_w, k AS cut_k FROM lev WHERE most > w * rest / open_w ORDER BY k LIMIT 1),
    aims AS (SELECT source, CAST(n AS BIGINT) AS source_size, CASE WHEN k >= c.cut_k THEN w * c.rest / c.open_w ELSE most END AS target,
      CAST('0x' || substr(md5('mix' || coalesce('/' || source, '')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS shift
      FROM lev LEFT JOIN cut c ON true),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, md5(CAST(doc_id AS VARCHAR)) NULLS LAST,
      doc_id NULLS LAST) AS place FROM d),
    joined AS (SELECT doc_id, size, source_size, target, place, shift,
      CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS e
      FROM ranked JOIN aims ON ranked.source IS NOT DISTINCT FROM aims.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
      CAST(size * (floor(e * place + shift) - floor(e * (place - 1) + shift)) AS BIGINT) AS taken FROM joined"""
)
def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes from every document."""
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
