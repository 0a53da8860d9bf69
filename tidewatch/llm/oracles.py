"""DuckDB SQL for the queries that SQL can express."""

ORACLES = {
    "op6_warc_fixity": """
        WITH fates AS (SELECT page_id, substr(md5(coalesce(url, '')), 1, 2) AS fate FROM pages)
        SELECT page_id, CASE WHEN fate IN ('00', '01') THEN 'changed' ELSE 'missing' END AS fault
        FROM fates WHERE fate IN ('00', '01', '02', '03')""",
    "op7_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS digest
            FROM documents),
        best AS (
            SELECT digest, count(*) AS group_size, first(doc_id ORDER BY points DESC, doc_id) AS keep_id
            FROM texts GROUP BY digest)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, digest AS text_sha256
        FROM texts JOIN best USING (digest)""",
    "op9_line_dedup": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS uid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (
            SELECT uid, doc_id, len(lines) AS n, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM texts),
        masked AS (
            SELECT *, regexp_replace(
                trim(regexp_replace(line, '[\x09\x0B\x0C\x0D ]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m
            FROM lines),
        votes AS (SELECT uid, string_agg(DISTINCT m, chr(10) ORDER BY m) AS vote FROM masked GROUP BY uid),
        once AS (
            SELECT DISTINCT vote, m FROM masked JOIN votes USING (uid) WHERE regexp_replace(m, '<\*>|[^\p{L}]', '', 'g') <> ''),
        voted AS (SELECT m, count(*) AS docs, string_split(m, ' ') AS t FROM once GROUP BY m),
        leaved AS (
            SELECT m, docs, t, [len(t)::VARCHAR] || t[1:least(4, len(list_filter(t, lambda x: x <> '<*>')) // 2)] AS leaf FROM voted WHERE len(t) >= 4),
        leaves AS (SELECT leaf, sum(docs) AS everyone FROM leaved GROUP BY leaf HAVING sum(docs) >= 3),
        placed AS (SELECT leaf, m, docs, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM leaved),
        constant AS (
            SELECT leaf, pos, token FROM placed JOIN leaves USING (leaf) WHERE token <> '<*>'
            GROUP BY leaf, pos, token, everyone HAVING sum(docs) >= 3 AND sum(docs) >= everyone * 0.3),
        general AS (
            SELECT p.leaf, p.m, p.docs, list((p.pos, p.token) ORDER BY p.pos) FILTER (c.token IS NOT NULL) AS fields
            FROM placed p LEFT JOIN constant c ON p.leaf = c.leaf AND p.pos = c.pos AND p.token = c.token
            WHERE p.token <> '<*>' GROUP BY p.leaf, p.m, p.docs
            HAVING count(*) - count(c.token) <= greatest(2, count(*) * 0.2) AND count(*) < 2 * count(c.token)),
        again AS (SELECT leaf, fields FROM general GROUP BY leaf, fields HAVING sum(docs) >= 3),
        dropped AS (
            SELECT m FROM voted WHERE docs >= 3 UNION SELECT m FROM general SEMI JOIN again USING (leaf, fields)),
        judged AS (
            SELECT uid, doc_id, pos, line, d.m IS NOT NULL AND bool_or(d.m IS NULL AND regexp_matches(line, '\p{L}')) OVER (PARTITION BY uid) AS gone
            FROM masked LEFT JOIN dropped d USING (m))
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
        FROM judged GROUP BY uid""",
    # crc32 bit by bit; near words meet where deleting a code point, or none, leaves the same.
    "op11_spelling_variants": r"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[a-z\x{C0}-\x{FF}]+')) AS run
            FROM documents),
        counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS bytes FROM runs WHERE length(run) >= 5 GROUP BY ALL),
        hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(1, length(bytes), 2), lambda k: ('0x' || substr(bytes, k, 2))::BIGINT)),
                lambda c, b: list_reduce(
                    list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS h
            FROM counted),
        kept AS (
            SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
            FROM hashed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        places AS (SELECT word, n, unnest(range(length(word))) AS k FROM words),
        less AS (SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest FROM places),
        pairs AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b USING (k, rest) WHERE a.word <> b.word
            UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
            UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
        near AS (
            SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n
            FROM pairs GROUP BY word),
        formed AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
            FROM words LEFT JOIN near USING (word)),
        chain AS (
            SELECT word, word AS root FROM formed
            UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
        FROM formed f JOIN chain c USING (word) JOIN formed e ON c.root = e.word WHERE e.form IS NULL""",
}
