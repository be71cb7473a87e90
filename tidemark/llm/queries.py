"""The registered query of each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, decontam, filter_audit, html_text, jaccard, language_model, pii, prefix_trie, quality_rules, secret_scan, token_files, toxicity, warc
from .common import table


def op1_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


def op2_jaccard(spark, sf_dir):
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secret_scan.secret_scan(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))


def op4_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_language_model(spark, sf_dir):
    return language_model.score(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op8_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), where=toxicity.held_in())
    return toxicity.score(docs, model)


def op10_decontam(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_token_files(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefixes(table(spark, sf_dir, "conversations"))


def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (op1_pii, op2_jaccard, op3_secret_scan, op4_html_text, op5_warc, op6_language_model, op7_quality_rules, op8_bpe, op9_toxicity, op10_decontam,
              op11_token_files, op12_prefix_trie, op13_filter_audit)
}

#: Base 32 of a hexadecimal digest: 5 bits a digit, from 20 bytes exactly 32 digits.
_BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    CASE (i * 5) % 4 WHEN 0 THEN (nib(d, i * 5 // 4) * 2 + nib(d, i * 5 // 4 + 1) // 8)
    WHEN 1 THEN (nib(d, i * 5 // 4) % 8 * 4 + nib(d, i * 5 // 4 + 1) // 4)
    WHEN 2 THEN (nib(d, i * 5 // 4) % 4 * 8 + nib(d, i * 5 // 4 + 1) // 2)
    ELSE (nib(d, i * 5 // 4) % 2 * 16 + nib(d, i * 5 // 4 + 1)) END)::INTEGER, 1) FOR i IN range(32)], '')"""
for _at in ("i * 5 // 4 + 1", "i * 5 // 4"):
    _BASE32 = _BASE32.replace(f"nib(d, {_at})", f"(strpos('0123456789abcdef', substr(d, ({_at} + 1)::INTEGER, 1)) - 1)")

_QUALITY_WORDS = r"[w FOR w IN regexp_split_to_array(t, '[ \t-\r]+') IF w <> '']"
_RULES_SQL = " AND ".join(
    f"{metric} {op} {bound}" for _, metric, low, high in quality_rules.RULES for op, bound in ((">=", low), ("<=", high)) if bound is not None
)

ORACLE_SQL: dict[str, str] = {
    "op2_jaccard": r"""
        WITH RECURSIVE d AS (SELECT doc_id, [w FOR w IN regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+') IF w <> ''] AS w FROM documents),
        g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) AS u(i) WHERE len(w) >= 5
            UNION ALL SELECT doc_id, len(w) || chr(10) || array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (SELECT x, y FROM pair JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
        reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(reach.y), d.doc_id)) AS component_id
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id, n.n""",
    "op7_quality_rules": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT r, doc_id, t, {_QUALITY_WORDS} AS w, [l FOR l IN string_split(t, chr(10)) IF regexp_matches(l, '[^ \t-\r]')] AS lines FROM d),
        tri AS (SELECT r, i, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM w, unnest(range(len(w) - 2)) AS u(i)),
        rep AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri),
        cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, unnest(range(3)) AS u(k) WHERE n > 1 GROUP BY r),
        m AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
            (length(t) - length(translate(t, '{quality_rules.SYMBOLS}', '')))::BIGINT AS n_symbols, len(lines) AS n_lines,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
            len([x FOR x IN w IF lower(x) IN ({", ".join(f"'{x}'" for x in quality_rules.STOP_WORDS)})]) AS n_stop,
            length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters
            FROM w LEFT JOIN cov USING (r)),
        x AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word,
            CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_ratio,
            CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_ratio,
            CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
            CASE WHEN n_lines > 0 THEN n_words / n_lines ELSE 0 END AS mean_line_words,
            CASE WHEN word_chars > 0 THEN letters / word_chars ELSE 0 END AS alpha_ratio,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND {_RULES_SQL} AS kept FROM x""",
    "op5_warc": f"""
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS d FROM pages),
        g AS (SELECT d, max(page_id) AS best FROM p GROUP BY d)
        SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
            CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> best THEN best END AS refers_to
        FROM p JOIN g USING (d)""",
    "op12_prefix_trie": r"""
        WITH t AS (SELECT conv_id, list({'k': md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')),
                'w': len([w FOR w IN regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+') IF w <> ''])}
            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        h AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT],
                flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(conv_id::VARCHAR, '')])),
            lambda s, o: CASE WHEN o >= 0 THEN xor(s, o) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295) % 4 AS h FROM t),
        r AS (SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS path
            FROM h a LEFT JOIN t b ON b.conv_id = a.conv_id - ((a.conv_id % 20) + 20) % 20),
        p AS (SELECT conv_id, d, md5(array_to_string([x.k FOR x IN path[1:d]], ',')) AS k, CASE WHEN d > 0 THEN md5(array_to_string([x.k FOR x IN path[1:d - 1]], ',')) END AS up,
            CASE WHEN d > 0 THEN path[d].w ELSE 0 END AS w, d = len(path) AS ends FROM r, unnest(range(len(path) + 1)) AS u(d)),
        n AS (SELECT d, k, up, min(conv_id) AS conv_id, count(*) AS n, max(w) AS w,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS sha FROM p GROUP BY d, k, up),
        c AS (SELECT up AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
        s AS (SELECT p.k, p.d, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((n.n - 1) * n.w) AS saved
            FROM n LEFT JOIN c USING (k, d) JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d GROUP BY p.k, p.d)
        SELECT n.conv_id, n.d::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
            s.saved::BIGINT AS saved_tokens, n.sha AS ends_sha256
        FROM n JOIN s USING (k, d) LEFT JOIN c USING (k, d) LEFT JOIN n m ON m.k = n.up AND m.d = n.d - 1""",
    "op13_filter_audit": f"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, {_QUALITY_WORDS} AS w, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
        f AS (SELECT part, doc_id, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
            + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t))::INT
            + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > low, false)::INT AS mask FROM w),
        l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
            FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
        b AS (SELECT unnest(range(5)) AS i),
        o AS (SELECT [p.i, q.i, r.i, s.i, u.i] AS o FROM b p, b q, b r, b s, b u
            WHERE len(list_distinct([p.i, q.i, r.i, s.i, u.i])) = 5),
        st AS (SELECT array_to_string([substr('ABCDE', x + 1, 1) FOR x IN o], '') AS filter_order, s + 1 AS step, (1 << o[s + 1])::INT AS bit,
            coalesce(list_sum([(1 << x) FOR x IN o[1:s]]), 0)::INT AS earlier FROM o, unnest(range(5)) AS u(s)),
        r AS (SELECT part, filter_order, step, bit, sum(n) FILTER (mask & earlier = 0 AND mask & bit = 0) AS kept,
            sum(n) FILTER (mask & earlier = 0 AND mask & bit <> 0) AS removed,
            sum(n) FILTER (mask & earlier <> 0 AND mask & bit <> 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
            sum(good) FILTER (mask & earlier = 0 AND mask & bit <> 0) AS good_lost,
            sum(toxic) FILTER (mask & earlier = 0 AND mask & bit <> 0) AS toxic_lost
            FROM c, st GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
            coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
            coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley FROM r""",
}
