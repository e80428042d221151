"""Expected results as SQL over the same tables, where SQL can say them."""

from __future__ import annotations

# words of each text, parted by ASCII white space
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY = rf"""
    WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS words
               FROM documents),
    windows AS (SELECT doc_id, i, words[i:i + 4] AS k
                FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i
                      FROM w WHERE len(words) >= 5)),
    repeated AS (SELECT doc_id, i FROM windows
                 QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
    covered AS (SELECT doc_id, count(*) AS n
                FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS p FROM repeated)
                GROUP BY doc_id),
    m AS (SELECT doc_id, lang, source, len(words) AS n_words,
                 length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                 length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 [l FOR l IN string_split(text, chr(10))
                  IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines,
                 coalesce(covered.n, 0) AS n_repeat_words
          FROM w LEFT JOIN covered USING (doc_id)),
    b AS (SELECT * EXCLUDE (lines), len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                 n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                 1000 * word_chars // greatest(n_words, 1) AS length,
                 1000 * n_symbols // greatest(word_chars, 1) AS symbols,
                 1000 * n_repeat_words // greatest(n_words, 1) AS repeats
          FROM m),
    v AS (SELECT lang, source, 'length' AS measure, length AS v FROM b WHERE NOT base_failed
          UNION ALL SELECT lang, source, 'symbols', symbols FROM b WHERE NOT base_failed
          UNION ALL SELECT lang, source, 'repeats', repeats FROM b WHERE NOT base_failed),
    s AS (SELECT *, greatest(length(bin(v)) - 6, 0) AS shift FROM v),
    sketch AS (SELECT lang, source, measure, shift * 32 + (v >> shift) AS bucket, count(*) AS n
               FROM s GROUP BY ALL),
    sums AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS seen,
                    sum(n) OVER (PARTITION BY lang, source, measure) AS total
             FROM sketch),
    q AS (SELECT lang, source, measure,
                 min(bucket) FILTER (4 * seen >= total) AS b1,
                 min(bucket) FILTER (4 * seen >= 3 * total) AS b3
          FROM sums GROUP BY ALL),
    floors AS (SELECT lang, source, measure,
                      (b1 - greatest(b1 // 32 - 1, 0) * 32) << greatest(b1 // 32 - 1, 0) AS q1,
                      (b3 - greatest(b3 // 32 - 1, 0) * 32) << greatest(b3 // 32 - 1, 0) AS q3
               FROM q),
    f AS (SELECT *, greatest(q3 - q1, CASE measure WHEN 'length' THEN 100
                                                   WHEN 'symbols' THEN 10 ELSE 25 END) AS spread
          FROM floors),
    g AS (SELECT lang, source,
                 max(q1 - 6 * spread) FILTER (measure = 'length') AS length_low,
                 max(q3 + 6 * spread) FILTER (measure = 'length') AS length_high,
                 max(q3 + 6 * spread) FILTER (measure = 'symbols') AS symbols_high,
                 max(q3 + 6 * spread) FILTER (measure = 'repeats') AS repeats_high
          FROM f GROUP BY ALL)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT coalesce(
               greatest(length - length_high, length_low - length, 0) ** 2 * n_words > 36000000
               OR symbols > symbols_high OR repeats > repeats_high, false) AS kept
    FROM b LEFT JOIN g ON b.lang IS NOT DISTINCT FROM g.lang
                      AND b.source IS NOT DISTINCT FROM g.source
"""

_REPEATS = rf"""
    WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
    windows AS (SELECT doc_id, i, words[i:i + 12] AS k
                FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i
                      FROM w WHERE len(words) >= 13)),
    later AS (SELECT doc_id, i FROM windows
              QUALIFY min(doc_id) OVER (PARTITION BY k) < doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM later),
    each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
    rest AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
             FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(rest.text, '')) AS kept_sha256
    FROM w LEFT JOIN rest USING (doc_id)
"""

_NEAR = rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    s AS (SELECT DISTINCT doc_id, words[i:i + 4] AS k
          FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i
                FROM w WHERE len(words) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
              FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
              WHERE 100 * pairs.n >= 85 * (x.n + y.n - pairs.n)),
    reach AS (SELECT doc_id, doc_id AS other FROM documents
              UNION SELECT reach.doc_id, b FROM reach JOIN links ON other = a)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id,
           doc_id = min(other) AS kept
    FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

_NEAREST = """
    WITH codes AS (SELECT vec_id, [coalesce(x, 0) > 0 FOR x IN coalesce(embedding, [])] AS signs
                   FROM embeddings),
    pairs AS (SELECT q.vec_id AS query_id, c.vec_id,
                     len([i FOR i IN range(1, 1 + greatest(len(q.signs), len(c.signs)))
                          IF coalesce(q.signs[i], false) <> coalesce(c.signs[i], false)]) AS distance
              FROM codes q, codes c WHERE q.vec_id % 20 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank
               FROM pairs)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
    FROM ranked WHERE rank <= 10
"""

# crc32 of a list of bytes
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {bytes}),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                             lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""
_ID_CRC32 = _CRC32.format(
    bytes="list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ord(d)::BIGINT)"
)

_RUNS = rf"""
    WITH w AS (SELECT doc_id, {_WORDS} AS words, {_ID_CRC32} AS h FROM documents),
    v AS (SELECT doc_id, words, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS planted,
                 (h // 10) % greatest(len(words), 1) AS a, h // 10 AS g FROM w),
    x AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM v),
    each AS (SELECT doc_id, n, i,
                    words[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS word
             FROM (SELECT *, unnest(range(n)) AS i FROM x)),
    equal AS (SELECT l.doc_id, l.i, r.i - l.i AS q
              FROM each l JOIN each r ON l.doc_id = r.doc_id AND l.word = r.word
                                     AND r.i > l.i AND 4 * (r.i - l.i) <= l.n),
    stretch AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
                FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island
                      FROM equal)
                GROUP BY doc_id, q, island),
    runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretch
             WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
    rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
             FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
    all_runs AS (SELECT doc_id, count(*) AS n_runs,
                        string_agg(start || ',' || length || ',' || period || chr(10), ''
                                   ORDER BY start, period) AS lines
                 FROM runs GROUP BY doc_id),
    best AS (SELECT * FROM runs QUALIFY row_number() OVER (
                 PARTITION BY doc_id ORDER BY length DESC, start, period) = 1)
    SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
           1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
           sha256(coalesce(rest.text, '')) AS collapsed_sha256
    FROM w LEFT JOIN all_runs USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

_NEAR_VECTORS = """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    links AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b
        FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    reach AS (SELECT vec_id, vec_id AS other FROM embeddings
              UNION SELECT reach.vec_id, b FROM reach JOIN links ON other = a),
    degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
    SELECT vec_id, coalesce(any_value(n_links), 0) AS n_links, min(other) AS component_id,
           vec_id = min(other) AS kept
    FROM reach LEFT JOIN degree USING (vec_id) GROUP BY vec_id
"""

_RUN_CRC32 = _CRC32.format(
    bytes="""flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c:
        CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
             ELSE [(192 + (unicode(c) >> 6))::BIGINT, (128 + (unicode(c) & 63))::BIGINT] END))"""
)

_VARIANTS = rf"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, run, count(*) AS times
        FROM (SELECT doc_id, unnest(regexp_extract_all(
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
              FROM documents)
        GROUP BY ALL),
    h AS (SELECT run, times, {_RUN_CRC32} AS h FROM runs),
    typed AS (SELECT times, CASE WHEN h % 199 = 0
                                 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                                 ELSE run END AS word
              FROM h),
    words AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM typed
              WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
    short AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS left_
              FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
    near AS (SELECT x.word, y.word AS other FROM short x JOIN short y
                 ON x.i = y.i AND x.left_ = y.left_ AND x.word <> y.word
             UNION SELECT short.word, words.word FROM short JOIN words ON left_ = words.word
             UNION SELECT words.word, short.word FROM short JOIN words ON left_ = words.word),
    best AS (SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near
             FROM near JOIN words ON other = words.word
             QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) = 1),
    forms AS MATERIALIZED (
              SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
                     CASE WHEN best.n >= 5 * words.n THEN other END AS form,
                     CASE WHEN best.n >= 5 * words.n THEN best.n END AS form_n
              FROM words LEFT JOIN best USING (word)),
    chain AS (SELECT word, form AS root FROM forms WHERE form IS NOT NULL
              UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON root = forms.word
              WHERE forms.form IS NOT NULL),
    ends AS (SELECT chain.word, root FROM chain JOIN forms ON root = forms.word WHERE form IS NULL)
    SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n
    FROM forms LEFT JOIN ends USING (word)
"""

ORACLE: dict[str, str] = {
    "op1_adaptive_quality_rules": _QUALITY,
    "op3_substring_dedup": _REPEATS,
    "op6_hamming_top_k": _NEAREST,
    "op7_minhash_near_dedup": _NEAR,
    "op11_periodic_runs": _RUNS,
    "op12_metric_join": _NEAR_VECTORS,
    "op13_spelling_variants": _VARIANTS,
}
