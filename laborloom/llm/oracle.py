"""DuckDB SQL that registered queries must match."""

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
            FROM documents),
        g AS (
            SELECT sha, count(*) AS group_size,
                   first(doc_id ORDER BY chars DESC, doc_id) AS keep_id
            FROM t GROUP BY sha)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, t.sha AS text_sha256
        FROM t JOIN g USING (sha)
    """,
    "op6_substring_dedup": r"""
        WITH t AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                       lambda w: w <> '') AS words
            FROM documents),
        starts AS (
            SELECT doc_id, i, sha256(array_to_string(words[i:i + 12], ' ')) AS win
            FROM t, unnest(range(1, len(words) - 11)) AS s(i)),
        firsts AS (SELECT win, min(doc_id) AS first_id FROM starts GROUP BY win),
        gone AS (
            SELECT DISTINCT doc_id, i + j AS place
            FROM starts JOIN firsts USING (win), range(13) AS o(j)
            WHERE doc_id > first_id),
        kept AS (
            SELECT w.doc_id, count(*) FILTER (gone.place IS NOT NULL) AS n_removed,
                   string_agg(word, ' ' ORDER BY w.place) FILTER (gone.place IS NULL) AS text
            FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM t) w
            LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.place = gone.place
            GROUP BY w.doc_id)
        SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM t LEFT JOIN kept USING (doc_id)
    """,
    "op9_minhash_near_dedup": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS words
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, md5_number(array_to_string(words[i:i + 3], ' ')) AS shingle
            FROM t, unnest(range(1, greatest(len(words) - 3, least(len(words), 1)) + 1)) AS p(i)),
        n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * common >= 80 * (x.size + y.size - common)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(doc_id, other) AS (
            SELECT a, a FROM links UNION SELECT b, b FROM links
            UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON other = a),
        home AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT t.doc_id, coalesce(size, 0) AS n_shingles, coalesce(component_id, t.doc_id) AS component_id,
               t.doc_id = coalesce(component_id, t.doc_id) AS kept
        FROM t LEFT JOIN n USING (doc_id) LEFT JOIN home USING (doc_id)
    """,
    "op10_chat_formatting": r"""
        WITH c AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                             (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        e AS (
            SELECT *, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|</?SYS>>)',
                                     '\1\\\2\3', 'g') AS escaped
            FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                                 ORDER BY turn, role, text)) AS loss_sha256,
               CAST(sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1)
                    AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op11_hard_negative_mining": r"""
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id,
               positive_score, score AS negative_score
        FROM p JOIN scored USING (anchor_id)
        WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 10
    """,
}
