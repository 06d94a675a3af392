"""DuckDB statements for the queries that SQL can express, on whole tables."""

MIXTURE = r"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS documents FROM sizes GROUP BY source
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid,
         source_size * 2 AS cap FROM per_source
), weighted AS (
  SELECT *, [3, 1, 2][((sid - 1) % 3 + 1)::INT] AS weight FROM numbered
), levels AS (
  SELECT *, row_number() OVER by_cap AS place,
         ((sum(source_size) OVER () * 150
           - 100 * coalesce(sum(cap) OVER (by_cap ROWS BETWEEN UNBOUNDED PRECEDING
                                                        AND 1 PRECEDING), 0))::DOUBLE
          / (100 * sum(weight) OVER (by_cap ROWS BETWEEN CURRENT ROW
                                                 AND UNBOUNDED FOLLOWING))::DOUBLE) AS level
  FROM weighted WINDOW by_cap AS (ORDER BY cap::DOUBLE / weight::DOUBLE, sid)
), final AS (
  SELECT min_by(level, place) AS final FROM levels WHERE cap > level * weight
), sources AS (
  SELECT source, sid, documents, source_size,
         coalesce(least(cap::DOUBLE, final * weight), cap::DOUBLE) AS target
  FROM levels CROSS JOIN final
), dealt AS (
  SELECT d.doc_id, d.source, d.size, s.sid, s.source_size, s.target,
         ('0x' || md5('mix|' || coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT AS draw,
         ('0x' || md5('mix|' || coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT
           % ceil(sqrt(s.documents))::BIGINT AS shard
  FROM sizes d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), shards AS (
  SELECT sid, shard, source_size, target, sum(size)::BIGINT AS shard_size,
         CASE WHEN sum(size) > 0
              THEN greatest(1, (2 * sum(size)::BIGINT + 32) // 64) ELSE 0 END AS blocks
  FROM dealt GROUP BY sid, shard, source_size, target
), wanted AS (
  SELECT sid, sum(blocks)::BIGINT AS source_blocks,
         CASE WHEN source_size > 0 THEN target / source_size * sum(blocks)::BIGINT ELSE 0 END AS votes
  FROM shards GROUP BY sid, source_size, target
), seats AS (
  SELECT floor(sum(votes) + 0.5)::BIGINT AS seats, sum(votes) AS all_votes, count(*) AS k FROM wanted
), source_low AS (
  SELECT sid, source_blocks, votes, seats,
         greatest(0, floor(share * seats - slack))::BIGINT AS low,
         ceil(share * seats + slack)::BIGINT AS high
  FROM (SELECT *, CASE WHEN all_votes > 0 THEN votes / all_votes ELSE 0 END AS share,
               CASE WHEN all_votes > 0 THEN votes / all_votes ELSE 0 END * k / 2 + 1.5 AS slack
        FROM wanted CROSS JOIN seats)
), source_tried AS (
  SELECT *, unnest(range(low, high + 1)) AS s FROM source_low
), source_ranked AS (
  SELECT *, row_number() OVER (ORDER BY votes / (2 * s + 1) DESC, sid, s) AS rank FROM source_tried
), per_source_seats AS (
  SELECT sid, least(low + count(*) FILTER (WHERE rank <= seats - (SELECT sum(low) FROM source_low)),
                    source_blocks * 2)::BIGINT AS seats
  FROM source_ranked GROUP BY sid, low, source_blocks
), shard_low AS (
  SELECT *, greatest(0, floor(share * seats - slack))::BIGINT AS low,
         ceil(share * seats + slack)::BIGINT AS high
  FROM (SELECT *, share * k / 2 + 1.5 AS slack
        FROM (SELECT sid, shard, shard_size, blocks, seats, count(*) OVER (PARTITION BY sid) AS k,
                     CASE WHEN sum(blocks) OVER (PARTITION BY sid) > 0
                          THEN blocks::DOUBLE / (sum(blocks) OVER (PARTITION BY sid))::DOUBLE
                          ELSE 0 END AS share
              FROM shards JOIN per_source_seats USING (sid)))
), shard_left AS (
  SELECT *, seats - sum(low) OVER (PARTITION BY sid) AS seats_left FROM shard_low
), shard_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sid
                               ORDER BY blocks::DOUBLE / (2 * s + 1) DESC, shard, s) AS rank
  FROM (SELECT *, unnest(range(low, high + 1)) AS s FROM shard_left)
), quotas AS (
  SELECT sid, shard, shard_size, blocks, low + count(*) FILTER (WHERE rank <= seats_left) AS won,
         greatest(blocks, 1) AS n,
         ('0x' || md5('mix|' || sid || '|' || shard)[1:15])::BIGINT % greatest(blocks, 1) AS first
  FROM shard_ranked GROUP BY sid, shard, shard_size, blocks, low
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY sid, shard ORDER BY draw, doc_id, size
                            ROWS UNBOUNDED PRECEDING)::BIGINT AS b FROM dealt
), runs AS (
  SELECT p.*, b - size AS a, won // n AS copies, shard_size, (first * shard_size) // n AS low,
         ((first + won % n) * shard_size) // n AS high
  FROM placed p JOIN quotas q ON p.sid = q.sid AND p.shard = q.shard
)
SELECT doc_id, size, source_size, target,
       (copies * size + greatest(least(b, high) - greatest(a, low), 0)
        + greatest(least(b + shard_size, high) - greatest(a + shard_size, low), 0))::BIGINT AS taken
FROM runs
"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), filled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM lines
  WHERE NOT regexp_full_match(line, '[\x20\x09-\x0D]*')
), windows AS (
  SELECT doc_id, pos, line AS l1, lead(line, 1) OVER w AS l2, lead(line, 2) OVER w AS l3
  FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), firsts AS (
  SELECT l1, l2, l3, min((doc_id, pos)) AS first FROM windows WHERE l3 IS NOT NULL
  GROUP BY l1, l2, l3 HAVING count(*) > 1
), later AS (
  SELECT w.doc_id, w.pos FROM windows w
  JOIN firsts f ON w.l1 = f.l1 AND w.l2 = f.l2 AND w.l3 = f.l3
  WHERE (w.doc_id, w.pos) <> f.first
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest([0, 1, 2]) AS k)
), marked AS (
  SELECT l.doc_id, l.line, l.i, f.pos IS NOT NULL AS filled, g.pos IS NOT NULL AS gone
  FROM lines l LEFT JOIN filled f ON l.doc_id = f.doc_id AND l.i = f.i
  LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.pos = g.pos
)
SELECT doc_id, count(*) FILTER (WHERE filled)::INTEGER AS n_lines,
       count(*) FILTER (WHERE gone)::INTEGER AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUALITY_RULES = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents
), words AS (
  SELECT rid, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
         generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM texts
), windows AS (
  SELECT rid, i, word, count(*) OVER (PARTITION BY rid, word, w2, w3) AS times, w3
  FROM (SELECT *, lead(word, 1) OVER w AS w2, lead(word, 2) OVER w AS w3
        FROM words WINDOW w AS (PARTITION BY rid ORDER BY i))
), covered AS (
  SELECT rid, i, word, max(CASE WHEN w3 IS NOT NULL AND times > 1 THEN 1 ELSE 0 END)
         OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS again
  FROM windows
), of_words AS (
  SELECT rid, count(*)::BIGINT AS n_words, sum(length(word))::BIGINT AS word_chars,
         sum(length(word) - length(regexp_replace(word, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         sum(again)::BIGINT AS n_repeat_words,
         count(*) FILTER (WHERE regexp_matches(word, '\p{L}'))::BIGINT AS n_letter_words,
         sum(length(word) - length(regexp_replace(word, '\p{L}', '', 'g')))::BIGINT AS n_letters,
         sum(length(word) - length(regexp_replace(word, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
         sum(length(word) - length(regexp_replace(word, '[0-9]', '', 'g')))::BIGINT AS n_digits
  FROM covered GROUP BY rid
), lines AS (
  SELECT rid, line FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), of_lines AS (
  SELECT rid, count(*)::BIGINT AS n_lines, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines,
         count(*) FILTER (WHERE regexp_matches(line, '^[\x20\x09-\x0D]*[-*•]'))::BIGINT AS n_bullet_lines,
         count(*) FILTER (WHERE regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*$'))::BIGINT AS n_ellipsis_lines
  FROM lines GROUP BY rid
), measured AS (
  SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         coalesce(n_symbols, 0) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_letter_words, 0) AS n_letter_words, coalesce(n_letters, 0) AS n_letters,
         coalesce(n_upper, 0) AS n_upper, coalesce(n_digits, 0) AS n_digits,
         coalesce(n_bullet_lines, 0) AS n_bullet_lines, coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines
  FROM texts t LEFT JOIN of_words USING (rid) LEFT JOIN of_lines USING (rid)
), judged AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN n_words > 100000 THEN 4 ELSE 0 END
    + CASE WHEN word_chars < 3 * n_words OR word_chars > 10 * n_words THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 16 ELSE 0 END
    + CASE WHEN 10 * n_dup_lines > 3 * n_lines AND n_dup_lines > 2 THEN 32 ELSE 0 END
    + CASE WHEN 10 * n_letter_words < 8 * n_words THEN 64 ELSE 0 END
    + CASE WHEN 2 * n_upper > n_letters THEN 128 ELSE 0 END
    + CASE WHEN 4 * n_digits > word_chars THEN 256 ELSE 0 END
    + CASE WHEN 10 * n_bullet_lines > 9 * n_lines THEN 512 ELSE 0 END
    + CASE WHEN 10 * n_ellipsis_lines > 3 * n_lines THEN 1024 ELSE 0 END)::BIGINT AS failures
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       (failures & ~4::BIGINT) = 0 AS kept, failures
FROM judged
"""

SPELLING = r"""
WITH RECURSIVE table_steps AS (
  SELECT b, b AS c, 0 AS k FROM (SELECT unnest(range(256)) AS b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1
  FROM table_steps WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY b) AS crc FROM table_steps WHERE k = 8
), runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run
), hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(
      string_split_regex(rtrim(regexp_replace(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)),
                                              '(..)', '\1 ', 'g')), ' '),
      lambda x: ('0x' || x)::BIGINT)),
    lambda h, byte: xor(h >> 8, crc[(xor(h, byte) & 255) + 1]))) AS h
  FROM runs CROSS JOIN crc_table
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0
      THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 2)) AS i FROM words
), skips AS (
  SELECT word, n, word[1:i - 1] || '_' || word[i + 1:] AS pattern, word[1:i - 1] || word[i + 1:] AS rest
  FROM places WHERE i <= length(word)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM skips a JOIN skips b
  ON a.pattern = b.pattern AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM skips a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM skips a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*)::BIGINT AS n_near, min((-other_n, other)) AS best FROM near GROUP BY word
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -best[1] >= 5 * n THEN best[2] END AS form,
         CASE WHEN -best[1] >= 5 * n THEN -best[1] END AS form_n
  FROM words LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL
  SELECT f.word, f.next, g.form FROM followed f JOIN forms g ON f.next = g.word
)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM forms f JOIN followed r ON f.word = r.word AND r.next IS NULL
"""

FILTER_AUDIT = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first FROM texts GROUP BY text
), marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
          100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
          regexp_matches(text, '[#$%&*|]'), coalesce(t.doc_id > first, false)] AS fails
  FROM texts t JOIN firsts USING (text) LEFT JOIN marks m ON t.doc_id = m.doc_id
), masks AS (
  SELECT part, fails, count(*) AS docs, count(*) FILTER (WHERE good) AS good,
         count(*) FILTER (WHERE toxic) AS toxic FROM judged GROUP BY part, fails
), orders AS (
  SELECT [i] AS places FROM (SELECT unnest(range(1, 6)) AS i)
  UNION ALL
  SELECT list_append(places, i) FROM orders, (SELECT unnest(range(1, 6)) AS i)
  WHERE NOT list_contains(places, i)
), steps AS (
  SELECT places, unnest(range(1, 6)) AS step FROM orders WHERE len(places) = 5
), counted AS (
  SELECT part, list_aggregate(list_transform(places, lambda p: 'ABCDE'[p]), 'string_agg', '') AS filter_order,
         step, places[step] AS filter, docs, good, toxic, fails[places[step]] AS failing,
         list_sum(list_transform(places[1:step - 1], lambda p: fails[p]::INT)) > 0 AS gone,
         list_sum(list_transform(fails, lambda f: f::INT)) = 1 AS only_one
  FROM masks CROSS JOIN steps
), summed AS (
  SELECT part, filter_order, step::INTEGER AS step, filter,
         coalesce(sum(docs) FILTER (WHERE NOT failing AND NOT coalesce(gone, false)), 0)::BIGINT AS kept,
         coalesce(sum(docs) FILTER (WHERE failing AND NOT coalesce(gone, false)), 0)::BIGINT AS removed,
         coalesce(sum(docs) FILTER (WHERE failing AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(docs) FILTER (WHERE failing AND only_one), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE failing AND NOT coalesce(gone, false)), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE failing AND NOT coalesce(gone, false)), 0)::BIGINT AS toxic_lost
  FROM counted GROUP BY part, filter_order, step, filter
)
SELECT * EXCLUDE (filter), (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM summed
"""
