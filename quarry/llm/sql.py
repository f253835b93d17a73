"""DuckDB SQL for the operators that SQL can express, written from their contracts."""

from __future__ import annotations

WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _number(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def sharding(shards: int = 16, size: int = 2003, docs: str = "documents", columns: str = "doc_id, source, lang") -> str:
    """The lookup table is filled turn by turn in a recursive query."""
    return f"""
    WITH RECURSIVE shards AS (
        SELECT s, 'shard-' || lpad(s::VARCHAR, 2, '0') AS name FROM range({shards}) t(s)),
    prefs AS (
        SELECT s, list_transform(range({size}), lambda j: (({_number("'offset:' || name")}) + j * (({_number("'skip:' || name")}) % {size - 1} + 1)) % {size}) AS pref
        FROM shards),
    fill(turn, owner) AS (
        SELECT 0::BIGINT, list_transform(range({size}), lambda j: -1::BIGINT)
        UNION ALL
        SELECT f.turn + 1, f.owner[1:c.slot] || [p.s] || f.owner[c.slot + 2:]
        FROM fill f JOIN prefs p ON p.s = f.turn % {shards},
             LATERAL (SELECT list_filter(p.pref, lambda x: f.owner[x + 1] < 0)[1] AS slot) c
        WHERE f.turn < {size}),
    done AS (SELECT owner FROM fill WHERE turn = {size}),
    placed AS (
        SELECT *, (({_number("coalesce(doc_id::VARCHAR, '')")}) % {size})::INTEGER AS slot FROM (SELECT {columns} FROM {docs}))
    SELECT placed.*, 'shard-' || lpad((done.owner[slot + 1])::VARCHAR, 2, '0') AS shard FROM placed, done
    """


def mixing(docs: str = "documents") -> str:
    """Closed form: with one source per document each source's flow is its target, shared out by water filling."""
    return f"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
               md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS h
        FROM {docs}),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) AS k
        FROM sized GROUP BY source),
    weighted AS (SELECT *, [5, 2, 1][k % 3 + 1]::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap FROM sources),
    ranked AS (
        SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
               coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS filled,
               sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open_w
        FROM weighted),
    level AS (SELECT (total - filled) / open_w AS rate FROM ranked WHERE (total - filled) / open_w <= cap / w ORDER BY cap / w, k LIMIT 1),
    targets AS (SELECT source, source_size, least(cap, rate * w) AS target FROM ranked, level),
    placed AS (
        SELECT s.*, t.source_size, t.target,
               CASE WHEN t.source_size > 0 THEN least(floor(t.target / t.source_size), 3) ELSE 0 END AS whole,
               sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.size ROWS UNBOUNDED PRECEDING) - s.size / 2.0 AS mid
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    copied AS (
        SELECT *, (whole + CASE WHEN whole < 3 AND mid <= target - whole * source_size THEN 1 ELSE 0 END)::INTEGER AS n FROM placed)
    SELECT doc_id, source, size, source_size, round(target, 6) AS target,
           (size * n)::BIGINT AS taken, n AS copies
    FROM copied
    """


def decontamination(docs: str = "documents") -> str:
    return f"""
    WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
    item_windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
        FROM items, LATERAL (SELECT unnest(range(1, greatest(len(w) - least(len(w), 10), 0) + 2)) AS i) WHERE len(w) > 0),
    lengths AS (SELECT DISTINCT n FROM item_windows),
    docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM {docs}),
    doc_windows AS (
        SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
    found AS (SELECT d.r, d.i, d.n, x.item_id FROM doc_windows d JOIN item_windows x ON d.n = x.n AND d.t = x.t),
    marked AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
    listed AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY encode(id)) AS ids
               FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN marked USING (r) LEFT JOIN listed USING (r)
    """


def hard_negatives(vectors: str = "embeddings") -> str:
    """All anchors against all rows, ranked by windows; scores are sums of integers, exact in a double."""
    return f"""
    WITH rows AS (
        SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
        FROM {vectors}
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other,
               list_dot_product(a.q, b.q)::BIGINT AS score
        FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.r <> b.r),
    positives AS (
        SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, other NULLS LAST) AS k FROM scored WHERE same
        QUALIFY k <= 5),
    placed AS (
        SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.r, p.k ORDER BY n.score DESC, n.other NULLS LAST) AS rank
        FROM positives p JOIN scored n ON n.r = p.r AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM placed WHERE rank <= 10
    """


#: CRC-32 of an ASCII text, a bit at a time (DuckDB has no function for it).
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1), lambda i: ascii({text}[i])::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)))"""


def conversations(table: str = "conversations") -> str:
    """Suffixes of each conversation from the back, the best per grammar state as text (cost in nine digits, then the audit); then the audit is walked."""
    def put(letter: str, cost: str, rest: str) -> str:
        return f"(lpad((left({rest}, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || '{letter}' || substr({rest}, 10))"

    def row(state: int) -> str:
        keep = {0: "CASE r.initial WHEN 's' THEN d.v1 WHEN 'u' THEN d.v2 END", 1: "CASE r.initial WHEN 'u' THEN d.v2 END", 2: "CASE r.initial WHEN 'a' THEN d.v3 END", 3: "CASE r.initial WHEN 'u' THEN d.v2 END"}[state]
        to = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        return f"least({put('D', '3', f'd.v{state}')}, CASE WHEN r.fault NOT IN ('blank', 'duplicate') THEN {put('K', 'r.cut', f'({keep})')} END, CASE WHEN r.fault NOT IN ('blank', 'duplicate') THEN {put('R', '2 + r.cut', f'd.v{to}')} END)"

    key = "(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"
    return f"""
    WITH RECURSIVE marked AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format(text=key)} % 20 AS kind FROM {table}),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
        FROM marked WHERE kind <> 0),
    convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM {table})),
    placed AS (
        SELECT c, turn, role, text, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
               row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i
        FROM damaged d JOIN convs v ON d.conv_id IS NOT DISTINCT FROM v.conv_id),
    seen AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again FROM placed),
    rows AS (
        SELECT *, CASE WHEN body = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               (fault = 'truncated')::INTEGER AS cut, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair
        FROM seen),
    dp(c, i, v0, v1, v2, v3) AS (
        SELECT c, max(i) + 1, '000000000', '000000004II', '000000002I', '000000000' FROM rows GROUP BY c
        UNION ALL
        SELECT c, i, least(w0, {put('I', '2', 'x2')}), least(w1, {put('I', '2', 'x2')}), x2, x3
        FROM (SELECT *, least(w2, {put('I', '2', 'w3')}) AS x2, least(w3, {put('I', '2', 'w2')}) AS x3
              FROM (SELECT d.c, r.i, {row(0)} AS w0, {row(1)} AS w1, {row(2)} AS w2, {row(3)} AS w3
                    FROM dp d JOIN rows r ON r.c = d.c AND r.i = d.i - 1))),
    best AS (SELECT c, left(v0, 9)::BIGINT AS cost, substr(v0, 10) AS audit FROM dp WHERE i = 1),
    walk(c, k, i, state, lines) AS (
        SELECT c, 1, 1::BIGINT, 0, []::VARCHAR[] FROM best
        UNION ALL
        SELECT c, k + 1, i + (letter <> 'I')::INTEGER,
               CASE WHEN letter = 'D' THEN state WHEN letter = 'K' AND initial = 's' THEN 1 WHEN state = 2 THEN 3 ELSE 2 END,
               CASE letter WHEN 'D' THEN lines WHEN 'K' THEN lines || [role || ':' || text]
                    ELSE lines || [CASE WHEN state = 2 THEN 'assistant:' ELSE 'user:' END || CASE WHEN letter = 'R' THEN text ELSE '' END] END
        FROM (SELECT w.*, b.audit[w.k] AS letter, r.role, r.text, r.initial
              FROM walk w JOIN best b ON b.c = w.c AND w.k <= length(b.audit) LEFT JOIN rows r ON r.c = w.c AND r.i = w.i)),
    written AS (SELECT w.c, array_to_string(lines, chr(10)) AS lines FROM walk w JOIN best b ON b.c = w.c AND w.k = length(b.audit) + 1),
    sums AS (
        SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows GROUP BY c)
    SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
    FROM convs LEFT JOIN sums USING (c) LEFT JOIN best USING (c) LEFT JOIN written USING (c)
    """
