"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .quality_rules import MAX_REPEAT_PCT, MIN_WORDS, RULES, STOP_FORMS, WINDOW
from .substring_dedup import LENGTH

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _verdict() -> str:
    tests = []
    for r in RULES:
        if r.low is not None:
            tests.append(f"{r.value} * 100 >= {r.low} * {r.per}")
        if r.high is not None:
            tests.append(f"{r.value} * 100 <= {r.high} * {r.per}")
    return " AND ".join(tests)


def op1() -> str:
    stop = ", ".join("'" + w + "'" for w in STOP_FORMS)
    keep = lambda cls: f"length(regexp_replace(coalesce(text, ''), '[^{cls}]+', '', 'g'))"
    return f"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS rid, {WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         {keep('#*$%&|<>')} AS n_symbols, {keep('A-Z')} AS n_upper, {keep('!?')} AS n_marks
  FROM documents),
win AS (
  SELECT rid, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
hit AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, win) >= 2),
rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM hit) GROUP BY rid),
counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, n_upper::BIGINT AS n_upper, n_marks::BIGINT AS n_marks,
         len(list_filter(words, lambda x: x IN ({stop})))::BIGINT AS n_stop_words, len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN rep USING (rid)),
based AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND {_verdict()} AS kept FROM based"""


def op2() -> str:
    chars = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> {k} & 31) + 1, 1)" for k in (15, 10, 5, 0))
    return f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages),
b AS (
  SELECT hex, string_agg(four, '' ORDER BY g) AS payload_digest
  FROM (SELECT hex, g, {chars} AS four
        FROM (SELECT hex, g, ('0x' || substr(hex, 5 * g + 1, 5))::INTEGER AS v
              FROM (SELECT DISTINCT hex FROM p), range(8) AS r(g)))
  GROUP BY hex),
w AS (SELECT hex, max(page_id) AS winner FROM p GROUP BY hex)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = winner THEN NULL ELSE winner END AS refers_to
FROM p JOIN b USING (hex) JOIN w USING (hex)"""


def op6() -> str:
    n = LENGTH
    return f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS rid, {WORDS} AS words FROM documents),
win AS (
  SELECT rid, i, array_to_string(words[i:i + {n - 1}], ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - {n - 2})) AS i FROM w)),
hit AS (SELECT rid, i FROM win WHERE win IN (SELECT win FROM win GROUP BY win HAVING count(*) > 1)),
gone AS (SELECT rid, list(DISTINCT p) AS gone FROM (SELECT rid, unnest(range(i, i + {n})) AS p FROM hit) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(
         CASE WHEN gone IS NULL THEN words
              ELSE list_filter(words, lambda x, k: NOT list_contains(gone, k)) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN gone USING (rid)"""


LETTERS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
#: CRC-32 by its table (polynomial 0xEDB88320), as in every implementation.
CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tab"""


def crc(value: str) -> str:
    """CRC-32 of a string's UTF-8 bytes; ``tab`` comes from ``CRC_TABLE``."""
    octets = (f"list_transform(range(octet_length(encode({value}))), "
              f"lambda i: ('0x' || substr(hex(encode({value})), 2 * i + 1, 2))::BIGINT)")
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295)"


def op11() -> str:
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {LETTERS} AS words FROM documents),
b AS (SELECT item_id, {LETTERS} AS words FROM benchmark),
iw AS (
  SELECT item_id, least(len(words), 10) AS n, unnest(list_transform(range(1, len(words) - least(len(words), 10) + 2),
         lambda i: array_to_string(words[i:i + least(len(words), 10) - 1], ' '))) AS win
  FROM b WHERE len(words) > 0),
dw AS (
  SELECT rid, n, i, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, n, words, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw))),
occ AS (SELECT rid, i, n, win FROM dw SEMI JOIN iw USING (n, win)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM occ) GROUP BY rid),
it AS (
  SELECT rid, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS name FROM occ JOIN iw USING (n, win) WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)"""


def op12() -> str:
    return f"""
WITH t0 AS ({CRC_TABLE}),
d AS (SELECT doc_id, row_number() OVER () AS rid, {LETTERS} AS words FROM documents),
dx AS (SELECT rid, unnest(words) AS word FROM d),
bx AS (SELECT unnest({LETTERS}) AS word FROM benchmark),
v AS (SELECT word, {crc('word')} % 10000 AS bucket
      FROM (SELECT DISTINCT word FROM (SELECT word FROM dx UNION ALL SELECT word FROM bx)), t0),
s AS (SELECT bucket, count(*) AS s FROM dx JOIN v USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bx JOIN v USING (word) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM dx) AS s_all, (SELECT count(*) FROM bx) AS t_all),
g AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), n),
w AS (
  SELECT rid, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM dx JOIN v USING (word) JOIN g USING (bucket) GROUP BY rid),
x AS (
  SELECT doc_id, rid, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w USING (rid)),
r AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * 10 // 100 THEN rank END AS rank FROM x LEFT JOIN r USING (rid)"""


def op13() -> str:
    role = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    after = {0: 2, 1: 2, 2: 3, 3: 2}

    def way(letter: str, price: str, then: str, row: str = "") -> str:
        rep = f"list_prepend({row}, {then}.rep)" if row else f"{then}.rep"
        return f"{{'cost': {then}.cost + {price}, 'audit': '{letter}' || {then}.audit, 'rep': {rep}}}"

    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def from_row(k: int) -> str:
        stays = "CASE fault WHEN 'truncated' THEN 1 ELSE 0 END"
        kept = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[k]
        gone = way("D", "3", f"c{k}")
        ways = [gone]
        ways += [f"CASE WHEN initial = '{q}' AND fault IN ('', 'truncated') THEN {way('K', stays, f'c{to}', 'role || chr(58) || text')} ELSE {gone} END"
                 for q, to in kept]
        rerole = way("R", f"2 + {stays}", f"c{after[k]}", f"'{role[k]}:' || text")
        ways.append(f"CASE WHEN fault IN ('', 'truncated') THEN {rerole} ELSE {gone} END")
        return least(*ways)

    insert = lambda k, then: way("I", "2", then, f"'{role[k]}:'")
    u = f"SELECT *, {least('b2', insert(2, 'b3'))} AS c2"
    a = f"SELECT *, {least('b3', insert(3, 'c2'))} AS c3, {least('b0', insert(0, 'c2'))} AS c0, {least('b1', insert(1, 'c2'))} AS c1"
    end = "{'cost': 0, 'audit': '', 'rep': []::VARCHAR[]}"
    never = "{'cost': 1000000000, 'audit': '', 'rep': []::VARCHAR[]}"
    return f"""
WITH RECURSIVE t0 AS ({CRC_TABLE}),
m AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
  FROM conversations, t0),
e AS (
  SELECT c, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM m)),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial FROM e),
f AS (
  SELECT *, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM o),
n AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY c),
p AS (
  SELECT c, n AS i, c0, c1, c2, c3 FROM ({a} FROM ({u} FROM (
    SELECT c, n, {end} AS b0, {never} AS b1, {never} AS b2, {end} AS b3 FROM n)))
  UNION ALL
  SELECT c, i - 1 AS i, c0, c1, c2, c3 FROM ({a} FROM ({u} FROM (
    SELECT p.c, p.i, {from_row(0)} AS b0, {from_row(1)} AS b1, {from_row(2)} AS b2, {from_row(3)} AS b3
    FROM p JOIN f ON p.c = f.c AND p.i = f.i)))),
z AS (SELECT c, c0 FROM p WHERE i = 0)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(c0.cost, 0)::BIGINT AS cost,
       coalesce(c0.audit, '') AS audit, sha256(coalesce(array_to_string(c0.rep, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM m) LEFT JOIN n USING (c) LEFT JOIN z USING (c)"""


def all_sql() -> dict[str, str]:
    return {"op1_quality_rules": op1(), "op2_warc": op2(), "op6_substring_dedup": op6(), "op11_decontamination": op11(),
            "op12_importance": op12(), "op13_conversation_repair": op13()}
