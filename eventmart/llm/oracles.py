"""The results of the operators' queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from eventmart.llm import licenses, mixing, quality


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


_ORACLES: dict[str, str] = {}

# Lower-cased alphanumeric words in order; windows of ten of them, or a whole shorter item; words hit.
_ORACLES["op10_decontaminate"] = r"""
WITH lists AS (
    SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    FROM benchmark
), phrases AS (
    SELECT DISTINCT id AS item_id, least(len(w), 10) AS size,
        array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM lists WHERE side = 'b' AND len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM phrases), windows AS (
    SELECT id AS doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS phrase
    FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM lists, sizes WHERE side = 'd' AND len(w) >= size)
), found AS (
    SELECT doc_id, item_id, i, size FROM windows JOIN phrases USING (size, phrase)
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM found))
    GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lists LEFT JOIN hits ON hits.doc_id = id LEFT JOIN items ON items.doc_id = id
WHERE side = 'd'
"""


# The rules are plain SQL already; windows of three words that a text has twice or more cover their words.
_RULE_BITS = " + ".join(
    f"CASE WHEN {fails} THEN {quality.BITS[name]} ELSE 0 END" for name, fails in quality.RULES.items()
)
_ORACLES["op7_quality_rules"] = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), windows AS (
    SELECT doc_id, i, w[i : i + 2] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts WHERE len(w) >= 3)
), repeated AS (
    SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows JOIN repeated USING (doc_id, g))
    GROUP BY doc_id
), lines AS (
    SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM texts
), measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(len(l) AS BIGINT) AS n_lines,
        coalesce(covered.n, 0) AS n_repeat_words,
        CAST(length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS BIGINT) AS n_letters
    FROM texts JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), ledger AS (
    SELECT *, CAST({_RULE_BITS} AS BIGINT) AS rule_bits FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (rule_bits & {quality.BASE.mask}) <> 0 AS base_failed,
    (rule_bits & {quality.BASE.mask | quality.POLICIES[quality.CURRENT].mask}) = 0 AS kept,
    n_lines, n_letters, rule_bits
FROM ledger
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_FORMS = ", ".join(
    f"({_quoted(name)}, [{', '.join(map(_quoted, licenses.bigrams(form)))}])"
    for name, forms in licenses.TEMPLATES.items()
    for form in forms
)
_ORACLES["op1_license_scan"] = rf"""
WITH forms(license, form) AS (VALUES {_FORMS}), texts AS (
    SELECT doc_id, translate(coalesce(text, ''), '{licenses._UPPER}', '{licenses._LOWER}') AS t FROM documents
), segments AS (
    SELECT DISTINCT doc_id, unnest(list_concat([t], string_split(t, chr(10)),
        regexp_split_to_array(t, '{licenses.SENTENCE_ENDS}'))) AS segment
    FROM texts
), lists AS (
    SELECT doc_id, list_filter(regexp_split_to_array(segment, '{licenses.SEPARATORS}'), lambda x: x <> '') AS w FROM segments
), sets AS (
    SELECT doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS own
    FROM lists WHERE len(w) >= 2
), scores AS (
    SELECT doc_id, license, max(len(list_intersect(own, form)) * 2.0 / (len(own) + len(form))) AS score
    FROM sets JOIN forms ON len(own) BETWEEN len(form) * {licenses.THRESHOLD} / (2 - {licenses.THRESHOLD})
        AND len(form) * (2 - {licenses.THRESHOLD}) / {licenses.THRESHOLD}
    GROUP BY doc_id, license
), found AS (
    SELECT doc_id, list({{'l': license, 's': CAST(score AS DOUBLE)}} ORDER BY score DESC, license) AS x
    FROM scores WHERE score >= {licenses.THRESHOLD} GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(x), 0) AS BIGINT) AS n_licenses, x[1].l AS license, coalesce(x[1].s, 0.0) AS score,
    coalesce(array_to_string(list_transform(x, lambda y: y.l), ','), '') AS licenses
FROM texts LEFT JOIN found USING (doc_id)
"""

_ORACLES["op8_mix_sources"] = rf"""
WITH documents_ AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        sha256('|' || doc_id) AS key
    FROM documents
), block AS (
    SELECT greatest({mixing.LEAST_BLOCK}, CAST(ceil(sum(size) / {float(mixing.BLOCKS)}) AS BIGINT)) AS block FROM documents_
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM documents_ GROUP BY source
), weighed AS (
    SELECT *, ({list(mixing.WEIGHTS)})[(rank - 1) % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS weight,
        source_size * {float(mixing.MOST)}::DOUBLE AS cap FROM sizes
), levels AS (
    SELECT *, cap / weight AS need,
        (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), targets AS (
    SELECT *, least(cap, coalesce((SELECT level FROM levels WHERE level <= need ORDER BY need, rank LIMIT 1) * weight, cap))
        AS target FROM levels
), wanted AS (
    SELECT *, CAST(floor(target) AS BIGINT) AS words, CAST(ceil(floor(target) / block) AS BIGINT) AS slots
    FROM targets, block
), lows AS (
    SELECT *, CAST(floor(CAST(coalesce(sum(words) OVER (ORDER BY rank
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / greatest(sum(words) OVER (), 1) * {mixing.POINTS}) AS BIGINT) AS low FROM wanted
), sources AS (
    SELECT *, coalesce(lead(low) OVER (ORDER BY rank), {mixing.POINTS}) AS high FROM lows
), hits AS (
    SELECT slot, rank, slots, row_number() OVER (PARTITION BY rank ORDER BY slot) - 1 AS b
    FROM (SELECT unnest(range((SELECT CAST(sum(slots) AS BIGINT) FROM sources))) AS slot) s
    JOIN sources ON slot * {mixing.GOLDEN} % {mixing.POINTS} >= low AND slot * {mixing.GOLDEN} % {mixing.POINTS} < high
), schedule AS (
    SELECT slot, rank, b FROM hits WHERE b < slots
    UNION ALL
    SELECT (SELECT CAST(sum(slots) AS BIGINT) FROM sources) + rank, rank, unnest(range(given, slots))
    FROM (SELECT rank, slots, (SELECT count(*) FROM hits WHERE hits.rank = sources.rank) AS given FROM sources)
    WHERE given < slots
), tapes AS (
    SELECT d.*, rank, source_size, target, words, block, coalesce(sum(size) OVER (PARTITION BY rank ORDER BY key, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
    FROM documents_ d JOIN sources ON d.source IS NOT DISTINCT FROM sources.source
), rounds AS (
    SELECT doc_id, rank, block, r * source_size + place AS lo, least(r * source_size + place + size, words) AS hi
    FROM (SELECT *, unnest(range(0, CAST(floor((words - 1) / source_size) AS BIGINT) + 1)) AS r
          FROM tapes WHERE size > 0 AND words > 0)
), pieces AS (
    SELECT doc_id, rank, b, least(hi, (b + 1) * block) - greatest(lo, b * block) AS n
    FROM (SELECT *, unnest(range(CAST(lo // block AS BIGINT), CAST((hi - 1) // block AS BIGINT) + 1)) AS b
          FROM rounds WHERE hi > lo)
), taken AS (
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS taken, CAST(min(slot) AS BIGINT) AS first_slot
    FROM pieces JOIN schedule USING (rank, b) GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot
FROM tapes LEFT JOIN taken USING (doc_id)
"""


# The checksum bit by bit; least costs from behind the last row backwards, one row a step (rows of a conversation
# are few here); then the walk forward, one edit a step.
_ORACLES["op11_repair_conversations"] = r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), drawn AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::UBIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
            lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END)), 4294967295::UBIGINT) % 20 AS h
    FROM keyed
), damaged AS (
    SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM drawn WHERE h <> 0
), placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS c,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        count(*) OVER (PARTITION BY conv_id) AS n,
        regexp_extract_all(text, '[^\x20\x09-\x0D]') AS spoken
    FROM damaged
), faults AS (
    SELECT * EXCLUDE (spoken), len(spoken) = 0 AS blank, len(spoken) > 0 AND earlier > 0 AS duplicate,
        len(spoken) > 0 AND earlier = 0 AND spoken[-1] NOT IN ('.', '!', '?') AS truncated,
        i > 1 AND previous || c NOT IN ('su', 'ua', 'au') AS illegal
    FROM (SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS previous,
        count(*) OVER (PARTITION BY conv_id, role, text ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
        FROM placed)
), moves AS (
    SELECT *, CASE WHEN blank OR duplicate THEN 1000000 WHEN truncated THEN 5 ELSE 0 END AS price FROM faults
), costs AS (
    SELECT conv_id, n + 1 AS i, 0 AS v0, 10 AS v1, 5 AS v2, 0 AS v3 FROM moves WHERE i = n
    UNION ALL
    SELECT conv_id, i, least(o0, 5 + least(o2, 5 + o3)), least(o1, 5 + least(o2, 5 + o3)), least(o2, 5 + o3), least(o3, 5 + o2)
    FROM (
        SELECT m.conv_id, m.i,
            least(2 + v0, price + 1 + v2, CASE c WHEN 's' THEN price + v1 WHEN 'u' THEN price + v2 ELSE 1000000 END) AS o0,
            least(2 + v1, price + 1 + v2, CASE c WHEN 'u' THEN price + v2 ELSE 1000000 END) AS o1,
            least(2 + v2, price + 1 + v3, CASE c WHEN 'a' THEN price + v3 ELSE 1000000 END) AS o2,
            least(2 + v3, price + 1 + v2, CASE c WHEN 'u' THEN price + v2 ELSE 1000000 END) AS o3
        FROM costs JOIN moves m ON m.conv_id IS NOT DISTINCT FROM costs.conv_id AND m.i = costs.i - 1
    )
), steps AS (
    SELECT b.conv_id, b.i, b.v0, b.v1, b.v2, b.v3, m.role, m.text, m.c, m.price, a.v0 AS a0, a.v1 AS a1, a.v2 AS a2, a.v3 AS a3
    FROM costs b
    LEFT JOIN costs a ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.i = b.i + 1
    LEFT JOIN moves m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i
), walk AS (
    SELECT conv_id, 1::BIGINT AS i, 0 AS s, '' AS audit, []::VARCHAR[] AS lines, false AS done FROM costs WHERE i = 1
    UNION ALL
    SELECT conv_id, CASE WHEN edit IN ('I', '') THEN i ELSE i + 1 END,
        CASE edit WHEN 'I' THEN next WHEN 'R' THEN next
            WHEN 'K' THEN CASE c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE s END,
        audit || edit,
        lines || CASE edit WHEN 'I' THEN [named || ':'] WHEN 'R' THEN [named || ':' || text] WHEN 'K' THEN [role || ':' || text]
            ELSE [] END,
        edit = ''
    FROM (
        SELECT w.*, role, text, c, CASE s WHEN 2 THEN 3 ELSE 2 END AS next, CASE s WHEN 2 THEN 'assistant' ELSE 'user' END AS named,
            CASE
                WHEN 2 + [a0, a1, a2, a3][s + 1] = here THEN 'D'
                WHEN 5 + CASE s WHEN 2 THEN v3 ELSE v2 END = here THEN 'I'
                WHEN role IS NULL THEN ''
                WHEN price + CASE WHEN s = 0 AND c = 's' THEN a1 WHEN s <> 2 AND c = 'u' THEN a2 WHEN s = 2 AND c = 'a' THEN a3
                    ELSE 1000000 END = here THEN 'K'
                ELSE 'R' END AS edit
        FROM (SELECT walk.*, t.* EXCLUDE (conv_id, i), [v0, v1, v2, v3][s + 1] AS here FROM walk
              JOIN steps t ON t.conv_id IS NOT DISTINCT FROM walk.conv_id AND t.i = walk.i WHERE NOT done) w
    )
), totals AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM faults GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(v0 AS BIGINT), 0) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM ids
LEFT JOIN totals ON totals.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN costs ON costs.conv_id IS NOT DISTINCT FROM ids.conv_id AND costs.i = 1
LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM ids.conv_id AND walk.done
"""
