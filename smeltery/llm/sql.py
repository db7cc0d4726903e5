"""The DuckDB twins of the text queries that SQL can express."""

QUALITY = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split_ AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         string_split(text, chr(10)) AS all_lines FROM docs),
counted AS (
  SELECT *, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '\P{Lu}', '', 'g')) AS n_upper, len(all_lines) AS n_lines,
         list_filter(all_lines, lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines FROM split_),
places AS (SELECT rid, words, unnest(range(1, n_words - 6)) AS i FROM counted WHERE n_words >= 8),
windows AS (SELECT rid, i, array_to_string(list_slice(words, i, i + 7), ' ') AS w FROM places),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS c FROM windows) WHERE c > 1),
covers AS (
  SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
f AS (
  SELECT rid, doc_id, lang, source, n_words, word_chars, n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, n_upper, n_lines
  FROM counted LEFT JOIN covers USING (rid)),
r AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbol_rate,
         CASE WHEN word_chars > 0 THEN 1000 * n_upper // word_chars ELSE 0 END AS upper_rate,
         CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_size,
         CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS line_rate FROM f),
long_ AS (
  SELECT lang, source, unnest(['symbol_rate', 'upper_rate', 'word_size', 'line_rate']) AS rate,
         unnest([symbol_rate, upper_rate, word_size, line_rate]) AS v FROM r WHERE NOT base_failed),
cells AS (
  SELECT lang, source, rate, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bucket,
         count(*) AS n FROM long_ GROUP BY ALL),
levels AS (
  SELECT 0 AS level, lang, source, rate, bucket, n FROM cells
  UNION ALL SELECT 1, lang, NULL, rate, bucket, sum(n) FROM cells GROUP BY lang, rate, bucket
  UNION ALL SELECT 2, NULL, NULL, rate, bucket, sum(n) FROM cells GROUP BY rate, bucket),
seen AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY level, lang, source, rate) AS rows_ FROM levels),
q AS (
  SELECT level, lang, source, rate, any_value(rows_) AS rows_, min(bucket) FILTER (upto * 100 >= rows_ * 50) AS mid,
         min(bucket) FILTER (upto * 100 >= rows_ * 75) AS high FROM seen GROUP BY ALL),
blended AS (
  SELECT a.lang, a.source, a.rate,
         (a.rows_ * a.high + 50 * ((b.rows_ * b.high + 50 * c.high) // (b.rows_ + 50))) // (a.rows_ + 50) AS high,
         (a.rows_ * a.mid + 50 * ((b.rows_ * b.mid + 50 * c.mid) // (b.rows_ + 50))) // (a.rows_ + 50) AS mid
  FROM q a JOIN q b ON b.level = 1 AND a.lang IS NOT DISTINCT FROM b.lang AND a.rate = b.rate
  JOIN q c ON c.level = 2 AND a.rate = c.rate WHERE a.level = 0),
cut AS (
  SELECT lang, source, rate, high + 4 * (high - mid)
         + CASE rate WHEN 'symbol_rate' THEN 30 WHEN 'upper_rate' THEN 150 WHEN 'word_size' THEN 300 ELSE 500 END AS top
  FROM blended),
wide AS (
  SELECT lang, source, max(top) FILTER (rate = 'symbol_rate') AS max_symbol_rate,
         max(top) FILTER (rate = 'upper_rate') AS max_upper_rate, max(top) FILTER (rate = 'word_size') AS max_word_size,
         max(top) FILTER (rate = 'line_rate') AS max_line_rate FROM cut GROUP BY lang, source)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_lines, base_failed,
       NOT base_failed AND coalesce(symbol_rate <= max_symbol_rate, true) AND coalesce(upper_rate <= max_upper_rate, true)
       AND coalesce(word_size <= max_word_size, true) AND coalesce(line_rate <= max_line_rate, true) AS kept,
       CAST(max_symbol_rate AS BIGINT) AS max_symbol_rate, CAST(max_upper_rate AS BIGINT) AS max_upper_rate,
       CAST(max_word_size AS BIGINT) AS max_word_size, CAST(max_line_rate AS BIGINT) AS max_line_rate
FROM r LEFT JOIN wide w ON r.lang IS NOT DISTINCT FROM w.lang AND r.source IS NOT DISTINCT FROM w.source
"""

# Documents are in order of id, which the test tables hold once each.
LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
w AS (
  SELECT *, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         row_number() OVER (ORDER BY doc_id, pos) AS seq FROM l),
f AS (SELECT line, any_value(ws) AS ws, min(seq) AS seq FROM w WHERE len(ws) > 0 GROUP BY line),
long_ AS (SELECT seq, ws, len(ws) AS n, array_to_string(ws, ' ') AS full_ FROM f WHERE len(ws) >= 8),
places AS (SELECT seq, ws, n, unnest(range(1, n + 1)) AS i FROM long_),
v AS (
  SELECT seq, n, i, array_to_string(list_concat(list_slice(ws, 1, i - 1), list_slice(ws, i + 1, n)), ' ') AS rest
  FROM places),
by_place AS (SELECT n, i, rest, min(seq) AS m FROM v GROUP BY ALL),
by_rest AS (SELECT rest, min(seq) AS m FROM v GROUP BY rest),
by_full AS (SELECT full_, min(seq) AS m FROM long_ GROUP BY full_),
near AS (
  SELECT v.seq FROM v JOIN by_place a USING (n, i, rest) WHERE a.m < v.seq
  UNION SELECT v.seq FROM v JOIN by_full a ON a.full_ = v.rest WHERE a.m < v.seq
  UNION SELECT b.seq FROM long_ b JOIN by_rest a ON a.rest = b.full_ WHERE a.m < b.seq
  UNION SELECT b.seq FROM long_ b JOIN by_full a USING (full_) WHERE a.m < b.seq),
marked AS (
  SELECT w.doc_id, w.pos, w.line, len(w.ws) = 0 OR (w.seq = f.seq AND near.seq IS NULL) AS stays,
         coalesce(w.seq = f.seq AND near.seq IS NOT NULL, false) AS near_
  FROM w LEFT JOIN f ON w.line = f.line LEFT JOIN near ON near.seq = f.seq),
made AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (stays) AS n_kept, count(*) FILTER (near_) AS n_near,
         string_agg(line, chr(10) ORDER BY pos) FILTER (stays) AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_kept, 0) AS n_kept, coalesce(n_near, 0) AS n_near,
       sha256(coalesce(m.text, '')) AS text_sha256 FROM documents d LEFT JOIN made m USING (doc_id)
"""

# Levels climb in recursive steps; a proof is a list of siblings, each marked with its side.
MANIFEST = """
WITH RECURSIVE
bits AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)) AS crc),
checked AS (
    SELECT doc_id, lang, source, n_chars, text,
        xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
            lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) % 7 = 0 AS chosen
    FROM documents, bits),
parts AS (
    SELECT doc_id, lang, chosen, n_chars,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        coalesce(strlen(text) || ':' || text, '-') AS tail
    FROM checked),
leaves AS (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
        CASE WHEN chosen AND n_chars IS NOT NULL
             THEN sha256(head || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1)::VARCHAR || tail) END AS bent
    FROM parts),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS rid
    FROM leaves),
climb AS (
    SELECT lang, 0 AS level, pos, n, leaf AS h FROM placed
    UNION ALL
    SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM climb WHERE n > 1
    GROUP BY lang, level, pos // 2, n),
tops AS (
    SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM climb WHERE n = 1),
ascend AS (
    SELECT 0 AS level, pos, n, h FROM tops
    UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM ascend WHERE n > 1
    GROUP BY level, pos // 2, n),
low AS (
    SELECT p.rid, c.level, CASE WHEN (p.pos >> c.level) % 2 = 1 THEN 'L' || s.h ELSE 'R' || coalesce(s.h, '') END AS step
    FROM placed p JOIN climb c ON c.lang IS NOT DISTINCT FROM p.lang AND c.pos = p.pos >> c.level AND c.n > 1
    LEFT JOIN climb s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = c.level AND s.pos = xor(c.pos, 1)),
high AS (
    SELECT t.lang, 1000 + a.level AS level, CASE WHEN (t.pos >> a.level) % 2 = 1 THEN 'L' || s.h ELSE 'R' || coalesce(s.h, '') END AS step
    FROM tops t JOIN ascend a ON a.pos = t.pos >> a.level AND a.n > 1
    LEFT JOIN ascend s ON s.level = a.level AND s.pos = xor(a.pos, 1)),
steps AS (
    SELECT rid, level, step FROM low
    UNION ALL
    SELECT p.rid, h.level, h.step FROM placed p JOIN high h ON h.lang IS NOT DISTINCT FROM p.lang),
paths AS (SELECT rid, list(step ORDER BY level) AS path FROM steps GROUP BY rid),
ends AS (
    SELECT p.doc_id, p.leaf, t.h AS subroot, (SELECT h FROM ascend WHERE n = 1) AS root,
        coalesce(p.bent, p.leaf) AS start, coalesce(q.path, []) AS path
    FROM placed p JOIN tops t ON t.lang IS NOT DISTINCT FROM p.lang LEFT JOIN paths q USING (rid)),
folded AS (
    SELECT *, list_reduce([start] || path, lambda node, s:
        sha256(CASE WHEN s[1] = 'L' THEN substr(s, 2) || node ELSE node || substr(s, 2) END)) AS folded_root
    FROM ends)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: substr(s, 2)), '')) AS proof_sha256,
    folded_root, folded_root = root AS verified
FROM folded
"""
