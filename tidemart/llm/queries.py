"""The operators as queries over whole tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import block_labeller, bpe_count, byte_bpe, decontaminate, filter_audit, jaccard_join, line_runs, longest_factor, mean_search, mixing, quality_rules, subtree_dedup, url_rules
from tidemart.llm.common import table

# The rules of the URL filter.
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, url_rules.rules_frame(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_table(table(spark, sf_dir, "documents"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = longest_factor.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("data", 256).alias("kept_sha256"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = subtree_dedup.without_repeated_words(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("data", 256).alias("kept_sha256"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_labeller.extract_main_text(table(spark, sf_dir, "pages"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_table(table(spark, sf_dir, "documents"))


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_search.cluster_report(table(spark, sf_dir, "embeddings"))


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(BYTE_RANKS)
    encoded = byte_bpe.encode_texts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode_ids(encoded, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": url_filter,
    "op2_decontamination": decontamination,
    "op3_mix_sources": mix_sources,
    "op4_quality_rules": quality,
    "op5_suffix_dedup": suffix_dedup,
    "op6_substring_dedup": substring_dedup,
    "op7_token_counts": token_counts,
    "op8_main_text": main_text,
    "op9_line_dedup": line_dedup,
    "op10_jaccard_join": near_duplicates,
    "op11_centroid_clusters": centroid_clusters,
    "op12_filter_audit": filter_interactions,
    "op13_byte_bpe": byte_bpe_round_trip,
}

ORACLES: dict[str, str] = {
    "op1_url_filters": r"""
        WITH p AS (
            SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS n
            FROM pages),
        r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                              ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        m AS (
            SELECT p.*, r.h || r.p AS rule, r.v,
                   row_number() OVER (PARTITION BY n ORDER BY length(r.h || r.p) DESC) AS k
            FROM p LEFT JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p))
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1""",
    "op2_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
        i AS (
            SELECT coalesce(item_id::VARCHAR, '') AS item, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
        w AS (
            SELECT DISTINCT item, least(len(ws), 13) AS n, array_to_string(list_slice(ws, s, s + least(len(ws), 13) - 1), ' ') AS win
            FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS s FROM i WHERE len(ws) > 0)),
        o AS (
            SELECT r, s, n, array_to_string(list_slice(ws, s, s + n - 1), ' ') AS win
            FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n)),
        m AS (SELECT r, s, n, item FROM o JOIN w USING (n, win)),
        h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM m) GROUP BY r),
        t AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), FALSE) AS contaminated
        FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)""",
    "op3_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13))::BIGINT AS h
            FROM documents),
        k AS (SELECT *, -ln((h::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
                        / ((size + 1)::DOUBLE / (size + 1 + 20 * symbols)::DOUBLE) AS key FROM d),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
        n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM s),
        w AS (SELECT *, CASE (nth - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM n),
        y AS (
            SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS ws,
                   coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / w, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                   coalesce(sum(w) OVER (ORDER BY source_size::DOUBLE / w, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wbefore
            FROM w),
        z AS (SELECT *, (1.5::DOUBLE * total::DOUBLE - 2.0::DOUBLE * before::DOUBLE) / (ws - wbefore)::DOUBLE AS level FROM y),
        t AS (
            SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce(
                (SELECT arg_min(level, before * 1000000 + wbefore) FROM z WHERE level * w <= 2.0::DOUBLE * source_size) * w,
                2.0::DOUBLE * source_size)) AS target FROM z),
        b AS (SELECT *, floor(target + 0.5::DOUBLE)::BIGINT AS budget FROM t),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
        o AS (
            SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.budget - e.epochs * e.source_size
                   - coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
            FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
        SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken FROM o""",
    "op6_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                          list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        w AS (SELECT r, doc_id, s, md5(array_to_string(list_slice(ws, s, s + 49), ' ')) AS h
              FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM d WHERE len(ws) >= 50)),
        f AS (SELECT h, min(doc_id) AS first FROM w GROUP BY h),
        g AS (SELECT DISTINCT r, unnest(range(s, s + 50)) AS pos FROM w JOIN f USING (h) WHERE doc_id > first),
        l AS (SELECT r, doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM d),
        k AS (SELECT l.r, count(*) FILTER (g.r IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY l.pos) FILTER (g.r IS NULL) AS kept
              FROM l LEFT JOIN g ON l.r = g.r AND l.pos = g.pos GROUP BY l.r)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (r)""",
    "op9_line_dedup": r"""
        WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls, row_number() OVER () AS r FROM documents),
        l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
        k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        x AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f USING (key))
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM x GROUP BY r""",
    "op10_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (
            SELECT DISTINCT r, array_to_string(list_slice(ws, i, i + 4), ' ') AS shingle
            FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
        n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
        p AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.r < b.r GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
        c AS (SELECT a, min(doc_id) AS component_id FROM reach JOIN d ON reach.b = d.r GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d JOIN c ON c.a = d.r LEFT JOIN n ON n.r = d.r""",
    "op11_centroid_clusters": r"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, embedding, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), embedding) - 1 AS c, e AS m
            FROM v ORDER BY c LIMIT 16),""" + "".join(rf"""
        a{n} AS MATERIALIZED (
            SELECT r, min(e) AS e, arg_min(c, d * 16 + c) AS c, min(d) AS d
            FROM (SELECT r, e, c, list_sum(list_transform(list_zip(e, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{n})
            GROUP BY r)""" + (rf""",
        s{n} AS (SELECT c, p, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, unnest(range(64)) AS p FROM a{n}) GROUP BY c, p),
        m{n} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY p) AS m FROM s{n} GROUP BY c),
        c{n + 1} AS MATERIALIZED (SELECT c, coalesce(m{n}.m, c{n}.m) AS m FROM c{n} LEFT JOIN m{n} USING (c)),""" if n < 3 else "")
        for n in range(4)) + r"""
        SELECT v.vec_id, a3.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a3.c)::BIGINT AS cluster_inertia,
               sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM a3 JOIN v USING (r) JOIN c3 ON a3.c = c3.c""",
    "op12_filter_audit": r"""
        WITH l AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        t AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        d AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
                   100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) AS c,
                   regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS e
            FROM t LEFT JOIN l USING (doc_id)),
        m AS (
            SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [a, b, c, d, e][i]) AS failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
            FROM d GROUP BY ALL),
        f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
        o AS (
            SELECT v.x || w.x || y.x || z.x || u.x AS filter_order FROM f v, f w, f y, f z, f u
            WHERE len(list_distinct([v.x, w.x, y.x, z.x, u.x])) = 5),
        s AS (
            SELECT filter_order, step, substr(filter_order, step, 1) AS x, string_split(substr(filter_order, 1, step - 1), '') AS before
            FROM o, (SELECT unnest(range(1, 6)) AS step)),
        r AS (
            SELECT part, filter_order, step, x,
                   sum(n) FILTER (NOT list_contains(failed, x) AND NOT list_has_any(failed, before)) AS kept,
                   sum(n) FILTER (list_contains(failed, x) AND NOT list_has_any(failed, before)) AS removed,
                   sum(n) FILTER (list_contains(failed, x) AND list_has_any(failed, before)) AS redundant,
                   sum(n) FILTER (failed = [x]) AS unique_fails,
                   sum(good) FILTER (list_contains(failed, x) AND NOT list_has_any(failed, before)) AS good_lost,
                   sum(toxic) FILTER (list_contains(failed, x) AND NOT list_has_any(failed, before)) AS toxic_lost
            FROM m, s GROUP BY part, filter_order, step, x)
        SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               sum(coalesce(removed, 0)) OVER (PARTITION BY part, x)::BIGINT AS shapley
        FROM r""",
}
