"""DuckDB SQL for the corpus queries that SQL can express."""

ORACLE_SQL = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op8_quality_rules": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
        twice AS (
            SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
        m AS (
            SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) AS BIGINT) AS n_lines,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(len(list_distinct(words)) AS BIGINT) AS n_distinct_words,
                   CAST(length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS BIGINT) AS n_upper,
                   CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
            FROM d LEFT JOIN covered USING (doc_id)),
        f AS (
            SELECT *, CAST(
                (n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
                + 4 * (100 * n_symbols > 50 * n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
                + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
                + 64 * (100 * n_distinct_words < 5 * n_words)::INT
                + 128 * (100 * n_upper > 70 * word_chars)::INT AS BIGINT) AS failed
            FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
               failed = 0 AS kept, failed, n_lines, n_distinct_words, n_upper FROM f""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                   CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.c) = len(b.c)),
        p AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
        SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INT) AS rank
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5""",
    "op12_prefix_trie": """
        WITH RECURSIVE own AS (
            SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        shared AS (
            -- The CRC-32 of the decimal id, bit by bit.
            SELECT conv_id, turns, conv_id - conv_id % 5 AS lender,
                   xor(list_reduce(
                       list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda crc, b: list_reduce(
                           list_concat([xor(crc, b)], range(8)),
                           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
                   ), 4294967295::BIGINT) % 9 AS h
            FROM own),
        rebuilt AS (
            SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
            FROM shared a LEFT JOIN own b ON a.lender = b.conv_id),
        prefixes AS (
            SELECT conv_id, len(turns) AS total, unnest(range(len(turns) + 1)) AS depth, turns[1:depth] AS path FROM rebuilt),
        nodes AS (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * CASE WHEN depth > 0 THEN strlen(path[depth].t) ELSE 0 END AS saved,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256
            FROM prefixes GROUP BY path, depth),
        children AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
        known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
        sums AS (
            SELECT path[1:up] AS path, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
            FROM (SELECT *, unnest(range(depth + 1)) AS up FROM known) GROUP BY ALL)
        SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children,
               CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
        FROM known k JOIN sums USING (path) LEFT JOIN nodes p ON k.depth > 0 AND p.path = k.path[1:k.depth - 1]""",
}
