"""DuckDB SQL for the queries that SQL can express, over the same whole tables."""

from viewstats.llm.common import ASCII_LOWER, ASCII_UPPER
from viewstats.llm.chat import END, START

_LOWER = f"translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}')"

EXACT_DEDUP = f"""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM (SELECT doc_id, {_LOWER} AS norm FROM documents)
    WINDOW same AS (PARTITION BY norm)"""

WARC = """
    WITH body AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    digests AS (
        SELECT page_id, octet_length(encode(html)) AS size, sha1(html) AS hex,
               min(page_id) OVER (PARTITION BY html) AS first
        FROM body)
    SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((CAST('0x' || substr(hex, i * 5 // 4 + 1, 2) AS INT) >> (3 - i * 5 % 4)) & 31) + 1, 1)
               for i in range(32)], '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM digests"""

NGRAM_JACCARD = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    grams AS (
        SELECT doc_id, unnest(CASE
            WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])
            END) AS gram
        FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
        FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * common >= 90 * (x.n + y.n - common)),
    reached AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) LEFT JOIN sizes USING (doc_id)"""

_ESCAPED = r"regexp_replace({0}, '<(\\*)\|', '<\1\\|', 'g')"

CHAT = f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{END}{START}assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '{END}{START}assistant ok')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
               AS loss_sha256,
           CAST(sum({len(START) + len(END) + 2} + length({_ESCAPED.format('role')})
                    + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id"""

PIVOT_INDEX = """
    WITH vectors AS (
        SELECT row_number() OVER () AS r, vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
        FROM embeddings
        WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
        SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.r <> c.r),
    placed AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

BALL_TREE = f"""
    WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents),
    items AS (SELECT r, item_id, unnest(terms) AS term
              FROM (SELECT row_number() OVER () AS r, item_id, {_TERMS} AS terms FROM benchmark)),
    total AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS terms FROM docs WHERE len(terms) > 0),
    counts AS (
        SELECT d, doc_id, n, term, count(*) AS tf
        FROM (SELECT d, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) GROUP BY ALL),
    weights AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
        FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total),
    scored AS (
        SELECT r, item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (
            100 - 75 + (75 * n * docs) // total.terms)))) AS BIGINT) AS score
        FROM items JOIN weights USING (term) JOIN counts USING (term), total GROUP BY ALL),
    placed AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id) AS INTEGER) AS rank
        FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10"""


def _edit(letter: str, cost: str, line: str, rest: str) -> str:
    """A repair that begins with an edit: its cost, its audit, the lines it leaves."""
    return (f"CASE WHEN {rest} IS NOT NULL THEN {{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, "
            f"'t': {line} || {rest}.t}} END")


def _least(*repairs: str) -> str:
    return f"list_min([{', '.join(repairs)}])"


def _if(test: str, repair: str) -> str:
    return f"CASE WHEN {test} THEN {repair} END"


_USER, _ANSWER = (f"'{role}:' || chr(10)" for role in ("user", "assistant"))
_EMPTY = "''"
_ASKED = _edit("I", "2", _USER, "f2")  # f0 to f3: best repair from here on, by the state before it

# Rows are taken from the last to the first, and the best repair is kept for each of the four states.
REPAIR = f"""
    WITH RECURSIVE spaced AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
        FROM conversations),
    cases AS (
        SELECT * EXCLUDE (name), xor(list_reduce(
            [CAST(4294967295 AS BIGINT)] || flatten([[CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]
                                                     for c in string_split(name, '')]),
            lambda crc, bits: xor(xor(crc, bits) >> 1, (xor(crc, bits) & 1) * 3988292384)), 4294967295) % 20 AS n
        FROM spaced),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN n = 4 THEN 'user' ELSE role END AS role,
               CASE n WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(CASE WHEN n = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM cases WHERE n <> 0),
    faulty AS (
        SELECT *, left(role, 1) AS initial, row_number() OVER conv AS i,
               CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1
                    THEN 'duplicate'
                    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' END AS fault,
               left(lag(role) OVER conv, 1) || left(role, 1) AS pair
        FROM damaged WINDOW conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
        FROM faulty GROUP BY conv_id),
    opened AS (SELECT conv_id, n + 1 AS i, {{'c': 0, 'a': '', 't': ''}} AS none FROM counted),
    derived AS (
        SELECT conv_id, i, {_least('none', _ASKED)} AS f0, {_ASKED} AS f1, f2, none AS f3
        FROM (SELECT *, {_edit('I', '2', _ANSWER, 'none')} AS f2 FROM opened)
        UNION ALL
        SELECT conv_id, i, {_least('g0', _ASKED)}, {_least('g1', _ASKED)}, f2, {_least('g3', _ASKED)}
        FROM (SELECT *, {_least('g2', _edit('I', '2', _ANSWER, 'g3'))} AS f2 FROM (
            SELECT conv_id, i, {_least('d0', _if("initial = 's'", 'k1'), _if("initial = 'u'", 'k2'), 'r2')} AS g0,
                   {_least('d1', _if("initial = 'u'", 'k2'), 'r2')} AS g1,
                   {_least('d2', _if("initial = 'a'", 'k3'), 'r3')} AS g2,
                   {_least('d3', _if("initial = 'u'", 'k2'), 'r2')} AS g3
            FROM (
                SELECT r.conv_id, r.i, initial,
                       {', '.join(f"{_edit('D', '3', _EMPTY, f'f{s}')} AS d{s}" for s in range(4))},
                       {', '.join(f"{_if('sound', _edit('K', 'late', 'line', f'f{s}'))} AS k{s}" for s in (1, 2, 3))},
                       {_if('sound', _edit('R', 'late + 2', "'user:' || text || chr(10)", 'f2'))} AS r2,
                       {_if('sound', _edit('R', 'late + 2', "'assistant:' || text || chr(10)", 'f3'))} AS r3
                FROM derived JOIN (
                    SELECT *, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS sound,
                           CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS late,
                           role || ':' || text || chr(10) AS line
                    FROM faulty) r ON r.conv_id IS NOT DISTINCT FROM derived.conv_id AND r.i = derived.i - 1))))
    SELECT named.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
           coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, CAST(coalesce(f0.c, 0) AS BIGINT) AS cost, coalesce(f0.a, '') AS audit,
           sha256(coalesce(left(f0.t, length(f0.t) - 1), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) named
         LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM named.conv_id
         LEFT JOIN derived ON derived.conv_id IS NOT DISTINCT FROM named.conv_id AND derived.i = 1"""

ORACLE = {
    "op3_exact_dedup": EXACT_DEDUP,
    "op4_warc": WARC,
    "op6_ngram_jaccard": NGRAM_JACCARD,
    "op10_chat_formatting": CHAT,
    "op11_pivot_index": PIVOT_INDEX,
    "op12_ball_tree": BALL_TREE,
    "op13_repair": REPAIR,
}
