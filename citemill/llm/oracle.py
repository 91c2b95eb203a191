"""SQL for those operators that SQL can express, written from their definitions."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op2_line_quality": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
        windows AS (
            SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, words FROM w WHERE len(words) >= 8
        ),
        texts AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win FROM windows),
        twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM texts),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n FROM (
                SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice WHERE n > 1
            ) GROUP BY doc_id
        ),
        lines AS (
            SELECT doc_id, line,
                len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
                len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
                len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
                len(regexp_extract_all(line, '!')) AS shouts,
                len([x FOR x IN regexp_extract_all(line, '[^\x20\x09-\x0D]+')
                    IF x IN ('|', '»', '›', '·', '•', '>', '/')]) AS seps
            FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
        ),
        judged AS (
            SELECT *, (symbols * 10 > chars) OR (shouts >= 3 AND shouts * 3 > words)
                OR (words >= 10 AND NOT regexp_matches(line, '[.!?…。！？]'))
                OR (seps > 0 AND seps * 5 >= words)
                OR regexp_matches(line, '(?i)\b(accept (all )?cookies|uses? cookies|cookie (policy|settings)|privacy policy|terms of (use|service)|all rights reserved|enable javascript|lorem ipsum|licen[sc]ed under|subscribe to our|sign up for|click here|skip to content|share on (facebook|twitter))\b') AS failed
            FROM lines
        ),
        by_doc AS (
            SELECT doc_id,
                count(*) FILTER (WHERE chars > 0) - count(DISTINCT line) FILTER (WHERE chars > 0) AS dup,
                count(*) FILTER (WHERE failed) AS gone,
                coalesce(sum(chars) FILTER (WHERE failed), 0)::BIGINT AS chars_gone
            FROM judged GROUP BY doc_id
        ),
        base AS (
            SELECT w.doc_id, len(words)::BIGINT AS n_words,
                len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
                len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                by_doc.dup::BIGINT AS n_dup_lines,
                coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
                by_doc.gone::BIGINT AS lines_removed, chars_gone AS chars_removed
            FROM w JOIN by_doc USING (doc_id) LEFT JOIN covered USING (doc_id)
        )
        SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
            NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
                AND chars_removed <= 0.5 * word_chars AS kept
        FROM base
    """,
    "op3_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
            doc_id = min(doc_id) OVER g AS kept, sha256(body) AS text_sha256
        FROM (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
            FROM documents
        )
        WINDOW g AS (PARTITION BY body)
    """,
    # All given pages mark their article by a tag, which SQL can go by; the operator cannot.
    "op4_html_trees": r"""
        WITH articles AS (
            SELECT page_id, url, regexp_replace(regexp_replace(
                regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1),
                '<br>', ' ', 'g'), '</?b>', '', 'g') AS body
            FROM pages
        ),
        texts AS (
            SELECT page_id, url, array_to_string([b FOR b IN [trim(regexp_replace(
                regexp_replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'),
                    '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))
                FOR x IN string_split_regex(body, '</?(?:p|h1)>')] IF b <> ''], chr(10)) AS text
            FROM articles
        )
        SELECT page_id, url, text, length(text) AS n_chars FROM texts
    """,
    "op6_suffix_dedup": r"""
        WITH d AS (
            SELECT doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n FROM documents
        ),
        windows AS (
            SELECT doc_id, unnest(range(0, n - 199)) AS s,
                unnest([md5(substr(h, 2 * s + 1, 400)) FOR s IN range(0, n - 199)]) AS w
            FROM d WHERE n >= 200
        ),
        twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
        marked AS (
            SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before
            FROM windows SEMI JOIN twice USING (w)
        ),
        grouped AS (
            SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s > before + 200 THEN 1 ELSE 0 END)
                OVER (PARTITION BY doc_id ORDER BY s) AS g
            FROM marked
        ),
        runs AS (SELECT doc_id, min(s) AS a, max(s) + 200 AS b FROM grouped GROUP BY doc_id, g),
        gaps AS (
            SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM runs
        ),
        cut AS (
            SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
                string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a)
                    || substr(any_value(h), 2 * max(b) + 1) AS kept
            FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
            coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
        FROM d LEFT JOIN cut USING (doc_id)
    """,
    "op9_warc_revisits": r"""
        WITH parts AS (
            SELECT *, md5(coalesce(html, '')) AS tag,
                '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?' AS form
            FROM pages
        ),
        split AS (
            SELECT *, regexp_replace(lower(regexp_extract(url, form, 1)), '^www\d*\.', '') AS host,
                regexp_extract(url, form, 2) AS port,
                regexp_replace(regexp_extract(url, form, 3), '/+$', '') AS path,
                array_to_string(list_sort([x FOR x IN string_split(regexp_extract(url, form, 4), '&')
                    IF x <> '' AND NOT regexp_matches(lower(regexp_extract(x, '^([^=]*)', 1)),
                        '^(utm_[a-z]+|ref|fbclid|gclid|sessionid|jsessionid|phpsessid|sid)$')]), '&') AS params
            FROM parts
        ),
        named AS (
            SELECT *, CASE WHEN host = '' THEN trim(url) ELSE host
                || CASE WHEN port IN ('', '80', '443') THEN '' ELSE ':' || port END
                || CASE WHEN path = '' THEN '/' ELSE path END
                || CASE WHEN params = '' THEN '' ELSE '?' || params END END AS c
            FROM split
        ),
        responses AS (
            SELECT page_id, c, page_id * 60 AS t, tag, 'day ' || (page_id % 7) AS changed,
                strlen(coalesce(html, '')) AS size FROM named
        ),
        revisits AS (
            SELECT page_id, c, page_id * 60 + 30 + (page_id % 4) * 6000 AS t,
                CASE page_id % 5 WHEN 0 THEN '"' || tag || '"' WHEN 1 THEN 'W/"' || tag || '"'
                    WHEN 3 THEN '"other"' END AS etag,
                CASE WHEN page_id % 5 = 2 THEN 'day ' || (page_id % 7) END AS changed
            FROM named
        ),
        joined AS (
            SELECT r.page_id, r.c, r.etag, r.changed, s.page_id AS p, s.tag AS old_tag,
                s.changed AS old_changed, s.size,
                CASE WHEN s.page_id IS NULL THEN 'no_earlier_response'
                    WHEN r.etag IS NOT NULL AND replace(r.etag, 'W/', '') = '"' || s.tag || '"' THEN 'resolved'
                    WHEN r.etag IS NULL AND r.changed = s.changed THEN 'resolved'
                    ELSE 'validator_mismatch' END AS outcome
            FROM revisits r ASOF LEFT JOIN responses s ON r.c = s.c AND r.t > s.t
        )
        SELECT page_id * 2 AS record_id, page_id AS payload_page_id, c AS canonical_url,
            CAST(-1 AS BIGINT) AS refers_to, 'full' AS outcome,
            'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10) || 'etag: "' || tag
                || '"' || chr(10) || 'last-modified: ' || changed || chr(10) || 'server: a' AS headers,
            tag AS payload_md5
        FROM responses
        UNION ALL
        SELECT page_id * 2 + 1, CASE WHEN outcome = 'resolved' THEN p ELSE page_id END, c,
            CASE WHEN outcome = 'resolved' THEN p * 2 ELSE -1 END, outcome,
            CASE WHEN outcome = 'resolved' THEN
                'cache-control: max-age=' || (page_id % 100) || chr(10) || 'content-length: ' || size
                || chr(10) || 'content-type: text/html' || chr(10) || 'etag: '
                || coalesce(etag, '"' || old_tag || '"') || chr(10) || 'last-modified: '
                || coalesce(changed, old_changed) || chr(10) || 'server: b'
            ELSE 'cache-control: max-age=' || (page_id % 100) || chr(10) || 'connection: close' || chr(10)
                || 'content-length: 0' || coalesce(chr(10) || 'etag: ' || etag, '')
                || coalesce(chr(10) || 'last-modified: ' || changed, '') || chr(10) || 'server: b' END,
            CASE WHEN outcome = 'resolved' THEN old_tag ELSE md5('') END
        FROM joined
    """,
    "op11_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h,
                regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
            FROM documents
        ),
        drawn AS (
            SELECT doc_id, t, units, len(units)::BIGINT AS n,
                ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS c1,
                ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS c2,
                ('0x' || substr(h, 17, 8))::BIGINT % 100 AS r3,
                ('0x' || substr(h, 25, 8))::BIGINT % 100 AS r4
            FROM d
        ),
        parts AS (
            SELECT doc_id, t, n,
                CASE WHEN t = '' OR r3 >= 100 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                    THEN 'plain' WHEN r4 < 50 THEN 'spm' ELSE 'psm' END AS form,
                array_to_string(units[1:least(c1, c2)], '') AS p,
                array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
                array_to_string(units[greatest(c1, c2) + 1:], '') AS s
            FROM drawn
        )
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM parts
    """,
    "op12_hard_negatives": r"""
        WITH v AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) = 64
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ),
        pairs AS (
            SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same,
                list_inner_product(a.x, b.x)::BIGINT AS score
            FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id
        ),
        positives AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        )
        SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
            row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank
        FROM positives JOIN pairs USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 5
    """,
}
