"""SQL of the queries in this folder, for DuckDB."""

from __future__ import annotations

from tablecheck.llm import licenses

ORACLE: dict[str, str] = {}

ORACLE["op1_warc_bundles"] = """
WITH pages_ AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digested AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest
  FROM pages_
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digested
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

# \x20 and \x09-\x0D part words
_WORDS = r"""
words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents
)"""

ORACLE["op3_substring_dedup"] = (
    "WITH"
    + _WORDS.format(text="text")
    + """,
windows AS (
  SELECT doc_id, p, array_to_string(list_slice(w, p, p + 19), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM words WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS r FROM windows
  ) WHERE r > 1
), covered AS (
  SELECT DISTINCT doc_id, p + o AS p FROM later CROSS JOIN (SELECT unnest(range(0, 20)) AS o)
), single AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM words
), left_over AS (
  SELECT s.doc_id, count(*) AS n, string_agg(s.x, ' ' ORDER BY s.p) AS kept
  FROM single s LEFT JOIN covered c ON s.doc_id = c.doc_id AND s.p = c.p
  WHERE c.p IS NULL GROUP BY s.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(l.n, 0) AS n_removed,
  sha256(coalesce(l.kept, '')) AS kept_sha256
FROM words w LEFT JOIN left_over l ON w.doc_id = l.doc_id
"""
)

ORACLE["op7_minhash_near_dedup"] = (
    "WITH RECURSIVE"
    + _WORDS.format(
        text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    + """,
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM words WHERE len(w) > 0)
), sized AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT u, v FROM shared JOIN sized a ON u = a.doc_id JOIN sized b ON v = b.doc_id
  WHERE 100 * shared.n >= 75 * (a.n + b.n - shared.n)
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), least AS (
  SELECT u, min(v) AS component_id FROM reach GROUP BY u
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sized ON d.doc_id = sized.doc_id JOIN least ON d.doc_id = u
"""
)

ORACLE["op8_suffix_array_dedup"] = """
WITH texts AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), starts AS (
  SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS p FROM texts
  WHERE octet_length(b) >= 200
), windows AS (
  SELECT doc_id, p, md5(b[p : p + 199]) AS s FROM starts
), counted AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS n FROM windows
), repeated AS (
  SELECT doc_id, p, p - coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1000) > 200 AS new
  FROM counted WHERE n > 1
), runs AS (
  SELECT doc_id, run, min(p) AS first, max(p) + 199 AS last FROM (
    SELECT doc_id, p, sum(new::int) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM repeated
  ) GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, run, first, last,
    lag(last, 1, 0) OVER (PARTITION BY doc_id ORDER BY run) AS before FROM runs
), pieces AS (
  SELECT t.doc_id, run, hex(b[before + 1 : first - 1]) AS piece
  FROM gaps g JOIN texts t ON g.doc_id = t.doc_id
), ends AS (
  SELECT g.doc_id, max(last) AS last, sum(last - first + 1) AS n_removed, count(*) AS n_spans
  FROM gaps g GROUP BY g.doc_id
), joined AS (
  SELECT doc_id, string_agg(piece, '' ORDER BY run) AS head FROM pieces GROUP BY doc_id
)
SELECT t.doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0)::bigint AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || hex(b[coalesce(last, 0) + 1 : octet_length(b)]))) AS kept_sha256
FROM texts t LEFT JOIN ends e ON t.doc_id = e.doc_id LEFT JOIN joined j ON t.doc_id = j.doc_id
"""


def _license_sql() -> str:
    """The canonical form of ``licenses`` as nested SQL calls."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def canonical(column: str) -> str:
        sql = f"lower(coalesce({column}, ''))"
        sql = f"regexp_replace({sql}, {quoted(licenses.COPYRIGHT_LINE)}, ' ', 'g')"
        for other, usual in licenses.SPELLINGS:
            sql = f"replace({sql}, {quoted(other)}, {quoted(usual)})"
        return f"trim(regexp_replace({sql}, {quoted(licenses.SEPARATORS)}, ' ', 'g'))"

    rows = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.KNOWN_TEXTS)
    return f"""
WITH known AS (
  SELECT sha256({canonical("text")}) AS digest, min(license) AS license
  FROM (VALUES {rows}) AS t(license, text) GROUP BY 1
), whole AS (
  SELECT doc_id, sha256({canonical("text")}) AS text_digest FROM documents
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
), found AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses
  FROM (SELECT doc_id, sha256({canonical("line")}) AS digest FROM lines WHERE trim(line, ' ') <> '')
  JOIN known USING (digest) GROUP BY doc_id
)
SELECT w.doc_id, text_digest, k.license, coalesce(line_licenses, '') AS line_licenses
FROM whole w LEFT JOIN known k ON w.text_digest = k.digest LEFT JOIN found f ON w.doc_id = f.doc_id
"""


ORACLE["op9_license_scan"] = _license_sql()

# The sum of CRC-32 (polynomial 0xEDB88320) byte by byte, then the damage, the faults, the
# programme row by row over the four states of the grammar, and the repaired rows.
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _least(*entries: str) -> str:
    return f"list_min([{', '.join(entries)}])"


def _plus(entry: str, cost: str, edit: str) -> str:
    return f"{{'c': {entry}.c + {cost}, 's': {entry}.s || '{edit}'}}"


def _closed(b: str) -> str:
    """States 0 to 3 after inserts."""
    return ", ".join(
        (
            f"{b}0 AS c0, {b}1 AS c1",
            _least(f"{b}2", *[_plus(f"{b}{i}", "5", "I") for i in (0, 1, 3)]) + " AS c2",
            _least(
                f"{b}3", _plus(f"{b}2", "5", "I"), *[_plus(f"{b}{i}", "10", "II") for i in (0, 1)]
            )
            + " AS c3",
        )
    )


def _edit(state: int, initial: str) -> str:
    """A row that is not deleted, from a state to one of this initial."""
    kept, changed = _plus(f"c{state}", "extra", "K"), _plus(f"c{state}", "extra + 1", "R")
    never = "{'c': 1000000000, 's': ''}"
    if initial == "s":
        return f"CASE WHEN NOT gone AND initial = 's' THEN {kept} ELSE {never} END"
    return (
        f"CASE WHEN gone THEN {never} WHEN initial = '{initial}' THEN {kept} ELSE {changed} END"
    )


_GONE = [_plus(f"c{i}", "2", "D") for i in range(4)]

ORACLE["op11_conversation_repair"] = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), places AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
  FROM conversations
), sums AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(range(1, length(place) + 1),
      lambda i: ascii(place[i])::BIGINT),
    lambda c, x: xor(c >> 8, steps[1 + (xor(c, x) & 255)])), 4294967295) % 20 AS fault
  FROM places, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END
      AS text, unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM sums WHERE fault <> 0
), places_ AS (
  SELECT *, row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos,
    trim(text, {_SPACE}) AS core
  FROM damaged
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1) || left(role, 1) AS pair
  FROM places_
), faults AS (
  SELECT *, core = '' AS blank, core <> '' AND again AS duplicate,
    core <> '' AND NOT again AND right(core, 1) NOT IN ('.', '!', '?') AS truncated
  FROM seen
), facts AS (
  SELECT *, blank OR duplicate AS gone, CASE WHEN truncated THEN 5 ELSE 0 END AS extra,
    left(role, 1) AS initial, coalesce(conv_id::VARCHAR, '') AS conv FROM faults
), dp AS (
  SELECT DISTINCT conv, 0::BIGINT AS pos, {{'c': 0, 's': ''}} AS b0,
    {{'c': 1000000000, 's': ''}} AS b1, {{'c': 1000000000, 's': ''}} AS b2,
    {{'c': 1000000000, 's': ''}} AS b3 FROM facts
  UNION ALL
  SELECT conv, pos, {_GONE[0]}, {_least(_GONE[1], _edit(0, "s"))},
    {_least(_GONE[2], *[_edit(i, "u") for i in (0, 1, 3)])}, {_least(_GONE[3], _edit(2, "a"))}
  FROM (
    SELECT dp.conv, facts.pos, gone, initial, extra, {_closed("b")}
    FROM dp JOIN facts ON facts.conv = dp.conv AND facts.pos = dp.pos + 1
  )
), solved AS (
  SELECT conv, (CASE WHEN c0 <= c3 THEN c0 ELSE c3 END) AS best FROM (
    SELECT conv, {_closed("b")} FROM dp
    WHERE pos = (SELECT max(pos) FROM facts WHERE facts.conv = dp.conv)
  )
), edits AS (
  SELECT conv, k, best.s[k] AS edit,
    k - length(replace(best.s[:k], 'I', '')) AS inserted,
    length(replace(best.s[:k], 'D', '')) AS place
  FROM solved, LATERAL (SELECT unnest(range(1, length(best.s) + 1)) AS k)
), laid AS (
  SELECT e.*, f.role, f.text FROM edits e
  LEFT JOIN facts f ON f.conv = e.conv AND e.edit <> 'I' AND f.pos = e.k - e.inserted
  WHERE e.edit <> 'D'
), lead AS (
  SELECT conv, max(CASE WHEN place = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END)
    AS shift FROM laid GROUP BY conv
), hashed AS (
  SELECT conv, sha256(string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (place - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS digest
  FROM laid JOIN lead USING (conv) GROUP BY conv
), figures AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
    count(*) FILTER (WHERE truncated) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM facts GROUP BY conv
), convs AS (
  SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') AS conv FROM conversations
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.s, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM convs LEFT JOIN figures USING (conv) LEFT JOIN solved USING (conv) LEFT JOIN hashed USING (conv)
"""

ORACLE["op12_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM pieces
), places AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
    lambda p: array_to_string(w[p:p + size - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3)) AS sizes(size) WHERE len(w) >= size
), phrases AS (
  SELECT lang, size, phrase, count(*) AS a FROM places GROUP BY 1, 2, 3
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS t FROM phrases WHERE size > 1 AND a >= 10
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(t[:k], ' ') AS head,
    array_to_string(t[k + 1:], ' ') AS tail
  FROM candidates JOIN (VALUES (1), (2)) AS ks(k) ON k < size
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, k, x.a AS l, y.a AS r,
    (1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = c.head
  JOIN phrases y ON y.lang = c.lang AND y.phrase = c.tail
), lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, array_to_string(t[i:i + 1], ' ') AS phrase, max(a) AS most
  FROM candidates, (VALUES (1), (2)) AS starts(i) WHERE size = 3 GROUP BY 1, 2
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN longer x USING (lang, phrase)
  WHERE most IS NULL OR 100 * most < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
