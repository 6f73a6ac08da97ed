"""SQL for DuckDB that gives the rows of those corpus queries which SQL can express."""

# Weights 1, 2, 3, three readings at the most, order by MD5 of "doc_id:17".
MIX = r"""
WITH sizes AS (
    SELECT row_number() OVER () AS r, doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':17') AS k
    FROM documents
), totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
    FROM sizes GROUP BY source
), levels AS (
    SELECT *, 3 * source_size AS most,
        3 * source_size / CAST(weight AS DOUBLE) AS ratio,
        sum(3 * source_size) OVER w AS most_until, sum(weight) OVER w AS weight_until,
        sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
    FROM totals
    WINDOW w AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source NULLS LAST
                 ROWS UNBOUNDED PRECEDING)
), shares AS (
    SELECT *, CAST(total - (most_until - most) AS DOUBLE)
        / CAST(weights - (weight_until - weight) AS DOUBLE) AS level FROM levels
), targets AS (
    SELECT source, source_size, total, CASE WHEN ratio < level THEN CAST(most AS DOUBLE)
        ELSE weight * first(level ORDER BY CASE WHEN ratio < level THEN 1 ELSE 0 END, weight_until)
            OVER (ORDER BY CASE WHEN ratio < level THEN 1 ELSE 0 END, weight_until
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS target
    FROM shares
), queue AS (
    SELECT s.*, t.source_size, t.target, t.total,
        sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS until
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
    SELECT r, size, total, sum(size) OVER (
        ORDER BY (epoch * source_size + until) / target, k, doc_id, size, epoch
        ROWS UNBOUNDED PRECEDING) AS spent
    FROM queue, (VALUES (0), (1), (2)) AS e(epoch) WHERE size > 0
), taken AS (
    SELECT r, CAST(sum(size) AS BIGINT) AS taken FROM copies WHERE spent <= total GROUP BY r
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    coalesce(taken, 0) AS taken FROM queue LEFT JOIN taken USING (r)"""

_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (
    "regexp_extract_all(" + _ASCII_LOWER.format("coalesce(text, '')")
    + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

# Every place of every document is compared with the windows that begin with its word.
DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT item_id, list_slice(w, i, i + 12) AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
          FROM items WHERE len(w) > 0)
),
classes AS (
    SELECT words, words[1] AS first, len(words) AS n, list(DISTINCT item_id) AS items
    FROM windows GROUP BY words
),
places AS (
    SELECT r, w, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
),
found AS (
    SELECT p.r, p.i, c.n, c.items FROM places p JOIN classes c
    ON p.word = c.first AND list_slice(p.w, p.i, p.i + c.n - 1) = c.words
),
hits AS (
    SELECT r, count(DISTINCT h) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS h FROM found)
    GROUP BY r
),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, CAST(unnest(items) AS VARCHAR) AS item FROM found)
    WHERE item IS NOT NULL GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN named USING (r)"""

# Base32 of a SHA-1: five hexadecimal digits are four letters.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
n AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS newest FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT)
              >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
    CASE WHEN newest IS NOT NULL AND (page_id IS NULL OR page_id < newest)
         THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS NULL OR page_id < newest THEN newest END AS refers_to
FROM n"""



# Terms of at least thirty documents of their language; shares are whole billionths.
_TERMS = (
    "regexp_extract_all(" + _ASCII_LOWER.format("coalesce(text, '')")
    + r", '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
)
DIVERGENCE = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        {_TERMS} AS w FROM documents
),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS m FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v, sum(m) AS all_n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n) AS size FROM cells GROUP BY ALL),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (coalesce(s.size, 0) + 5 * v.v) AS p,
        1 + (CAST(1000000000 AS HUGEINT) * (k.m + 5)) // (v.all_n + 5 * v.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN v USING (lang)
    LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f
        FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
        GROUP BY ALL
    ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q
)
SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)
        AS INTEGER) AS rank FROM parts
) WHERE part = 'pair' OR rank <= 50"""

# The checksum of a short ASCII text, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda x, b: list_reduce(list_prepend(xor(x, b), [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))))"""

# States: 0 nothing, 1 system, 2 user, 3 assistant. The best way to each state, turn by turn.
_BEST = "min({'cost': cost, 'audit': audit, 'made': made})"
CONVERSATIONS = rf"""
WITH RECURSIVE src AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_CRC32.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")}
        % 20 AS kind FROM conversations
), hurt AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS nth
    FROM src WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
    FROM hurt
), faults AS (
    SELECT *, left(role, 1) AS r,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS met,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
             WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
             WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated'
             ELSE 'none' END AS fault
    FROM placed
), every AS (SELECT DISTINCT conv_id FROM conversations),
put(st, into_st, n, new) AS (VALUES
    (0, 0, 0, CAST([] AS VARCHAR[])), (1, 1, 0, []), (2, 2, 0, []), (3, 3, 0, []),
    (0, 2, 1, ['user:']), (1, 2, 1, ['user:']), (2, 3, 1, ['assistant:']), (3, 2, 1, ['user:']),
    (0, 3, 2, ['user:', 'assistant:']), (1, 3, 2, ['user:', 'assistant:'])
), edit(st, op, into_st, price, initial, name) AS (VALUES
    (0, 'D', 0, 2, '', ''), (1, 'D', 1, 2, '', ''), (2, 'D', 2, 2, '', ''), (3, 'D', 3, 2, '', ''),
    (0, 'K', 1, 0, 's', ''), (0, 'K', 2, 0, 'u', ''), (1, 'K', 2, 0, 'u', ''),
    (2, 'K', 3, 0, 'a', ''), (3, 'K', 2, 0, 'u', ''),
    (0, 'R', 2, 1, '', 'user'), (1, 'R', 2, 1, '', 'user'), (2, 'R', 3, 1, '', 'assistant'),
    (3, 'R', 2, 1, '', 'user')
), ways AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS st, CAST(0 AS BIGINT) AS cost, '' AS audit,
        CAST([] AS VARCHAR[]) AS made FROM every
    UNION ALL
    SELECT conv_id, i, st, best.cost, best.audit, best.made FROM (
        SELECT conv_id, i, into_st AS st, {_BEST} AS best FROM (
            SELECT w.conv_id, f.i, e.into_st,
                w.cost + 5 * p.n + e.price
                    + CASE WHEN e.op <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
                w.audit || repeat('I', p.n) || e.op AS audit,
                list_concat(list_concat(w.made, p.new), CASE e.op WHEN 'D' THEN []
                    WHEN 'K' THEN [f.role || ':' || f.text] ELSE [e.name || ':' || f.text] END) AS made
            FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
            JOIN put p ON p.st = w.st
            JOIN edit e ON e.st = p.into_st AND (e.op = 'D'
                OR f.fault NOT IN ('blank', 'duplicate') AND (e.op = 'R' OR e.initial = f.r))
        ) GROUP BY ALL
    )
), report AS (
    SELECT conv_id, count(*) AS n,
        CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (met NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
), ended AS (
    SELECT conv_id, {_BEST} AS best FROM (
        SELECT w.conv_id, w.cost + CASE w.st WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END AS cost,
            w.audit || CASE w.st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
            list_concat(w.made, CASE w.st WHEN 1 THEN ['user:', 'assistant:']
                WHEN 2 THEN ['assistant:'] ELSE [] END) AS made
        FROM ways w LEFT JOIN report r ON r.conv_id IS NOT DISTINCT FROM w.conv_id
        WHERE w.i = coalesce(r.n, 0)
    ) GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
    sha256(array_to_string(best.made, chr(10))) AS repaired_sha256
FROM every e JOIN ended ON ended.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN report r ON r.conv_id IS NOT DISTINCT FROM e.conv_id"""
