"""DuckDB SQL for the queries that SQL can express (the others are held against brute force in tests/llm)."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


# CRC-32 by bytes: the table from its rule, then a step per byte of the UTF-8 text.
_CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_tab"""


def _crc(text: str) -> str:
    byte = f"CAST(('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT)"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), "
            f"list_transform(range(CAST(octet_length(encode({text})) AS BIGINT)), lambda i: {byte})), "
            "lambda a, b: xor(a >> 8, crc_tab[CAST((xor(a, b) & 255) + 1 AS BIGINT)])), 4294967295)")


def _row(n_chars: str) -> str:
    fields = (f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", n_chars, "text"))
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')" for c in fields) + ")"


def _marked(text: str) -> str:
    """The text with a mark behind each line's end (a line break ends the line before it)."""
    ends = ("chr(10)", "'. '", "', '", "'; '", "': '", "'! '", "'? '")
    for end in ends:
        text = f"replace({text}, {end}, {end} || chr(1))"
    return f"replace({text}, chr(1) || chr(10), chr(10))"


ORACLE: dict[str, str] = {
    "op3_line_dedup": f"""
WITH lines AS MATERIALIZED (
    SELECT doc_id, i, x, rtrim(x, ' ' || chr(10)) AS bare,
           len(list_filter(regexp_split_to_array(rtrim(x, ' ' || chr(10)), '[ \\t\\r\\n]+'), lambda w: w <> '')) AS n
    FROM (SELECT doc_id, xs, unnest(range(1, len(xs) + 1)) AS i, unnest(xs) AS x
          FROM (SELECT doc_id, list_filter(string_split({_marked('text')}, chr(1)), lambda l: l <> '') AS xs FROM documents))),
sums AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM lines WHERE n > 0),
wins AS MATERIALIZED (
    SELECT a.doc_id, a.i AS s, b.i AS e FROM sums a ASOF JOIN sums b ON a.doc_id = b.doc_id AND a.upto - a.n + 20 <= b.upto
    UNION
    SELECT a.doc_id, b.i, a.i FROM sums a ASOF JOIN sums b ON a.doc_id = b.doc_id AND a.upto - 20 >= b.upto - b.n),
named AS MATERIALIZED (
    SELECT w.doc_id, w.s, w.e, string_agg(CASE WHEN l.i = w.e THEN l.bare ELSE l.x END, '' ORDER BY l.i) AS run
    FROM wins w JOIN lines l ON l.doc_id = w.doc_id AND l.i BETWEEN w.s AND w.e GROUP BY 1, 2, 3),
firsts AS MATERIALIZED (SELECT run, min({{'k': doc_id, 's': s}}) AS f FROM named GROUP BY run HAVING count(*) > 1),
copies AS (SELECT doc_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS k FROM documents) WHERE doc_id <> k
           AND doc_id IN (SELECT doc_id FROM wins)),
gone AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM named JOIN firsts USING (run)
    WHERE doc_id <> f.k OR s > f.s + e - s
    UNION
    SELECT doc_id, i FROM lines WHERE doc_id IN (SELECT doc_id FROM copies)),
counted AS (
    SELECT doc_id, count(*) FILTER (WHERE i <> coalesce(before, -1) + 1) AS chunks, sum(n) AS words
    FROM (SELECT doc_id, i, n, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM gone JOIN lines USING (doc_id, i))
    GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, '' ORDER BY i) AS t FROM lines ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN c.doc_id IS NULL THEN d.text ELSE coalesce(k.t, '') END AS text,
       CAST(coalesce(c.chunks, 0) AS INTEGER) AS removed_chunks, CAST(coalesce(c.words, 0) AS INTEGER) AS removed_words
FROM documents d LEFT JOIN counted c USING (doc_id) LEFT JOIN kept k USING (doc_id)""",
    "op2_decontamination": f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
spans AS (SELECT item_id, w, least(10, len(w)) AS n FROM iw WHERE len(w) > 0),
iwin AS (SELECT DISTINCT item_id, n, array_to_string(w[o:o + n - 1], ' ') AS win
         FROM (SELECT *, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS o FROM spans)),
dwin AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS win
         FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS p
               FROM dw, (SELECT DISTINCT n FROM iwin) WHERE len(w) >= n)),
hits AS (SELECT doc_id, p, n, item_id FROM dwin JOIN iwin USING (n, win)),
hw AS (SELECT doc_id, count(DISTINCT x) AS n_hit
       FROM (SELECT doc_id, unnest(range(p, CAST(p + n AS BIGINT))) AS x FROM hits) GROUP BY 1),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)""",
    "op12_merkle": f"""
WITH RECURSIVE t AS MATERIALIZED ({_CRC_TABLE}),
leaves AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, lang, {_row('n_chars')} AS leaf,
           CASE WHEN {_crc('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_row('(n_chars + 1)')} END AS changed
    FROM documents, t),
placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM leaves),
low(g, lvl, pos, h, size) AS (
    SELECT g, 0, pos, leaf, count(*) OVER (PARTITION BY g) FROM placed
    UNION ALL
    SELECT g, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (size + 1) // 2
    FROM low WHERE size > 1 GROUP BY g, lvl, pos // 2, size),
heads AS MATERIALIZED (SELECT g, h, lvl AS high FROM low WHERE size = 1),
high(lvl, pos, h, size) AS (
    SELECT 0, g, h, count(*) OVER () FROM heads
    UNION ALL
    SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (size + 1) // 2
    FROM high WHERE size > 1 GROUP BY lvl, pos // 2, size),
steps AS MATERIALIZED (
    SELECT p.r, l.lvl AS k, (p.pos >> l.lvl) & 1 AS side, s.h
    FROM placed p JOIN (SELECT DISTINCT g, lvl FROM low WHERE size > 1) l USING (g)
    LEFT JOIN low s ON s.g = p.g AND s.lvl = l.lvl AND s.pos = xor(p.pos >> l.lvl, CAST(1 AS BIGINT))
    UNION ALL
    SELECT p.r, e.high + l.lvl, (p.g >> l.lvl) & 1, s.h
    FROM placed p JOIN heads e USING (g) CROSS JOIN (SELECT DISTINCT lvl FROM high WHERE size > 1) l
    LEFT JOIN high s ON s.lvl = l.lvl AND s.pos = xor(p.g >> l.lvl, CAST(1 AS BIGINT))),
fold(r, k, h) AS (
    SELECT r, 0, coalesce(changed, leaf) FROM placed
    UNION ALL
    SELECT f.r, f.k + 1, sha256(CASE WHEN s.side = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END)
    FROM fold f JOIN steps s ON s.r = f.r AND s.k = f.k),
proof AS (SELECT r, string_agg(h, '' ORDER BY k) AS p, count(*) AS n FROM steps GROUP BY r)
SELECT p.doc_id, p.leaf, e.h AS subroot, top.h AS root, sha256(coalesce(q.p, '')) AS proof_sha256,
       f.h AS folded_root, f.h = top.h AS verified
FROM placed p JOIN heads e USING (g) CROSS JOIN (SELECT h FROM high WHERE size = 1) top
LEFT JOIN proof q ON q.r = p.r JOIN fold f ON f.r = p.r AND f.k = coalesce(q.n, 0)""",
    "op13_spelling": f"""
WITH RECURSIVE t AS MATERIALIZED ({_CRC_TABLE}),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS ident,
                unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS w
         FROM documents),
checked AS MATERIALIZED (
    SELECT w, k, {_crc("(ident || ':' || w)")} AS c FROM (SELECT ident, w, count(*) AS k FROM runs GROUP BY 1, 2), t),
words AS MATERIALIZED (
    SELECT CASE WHEN c % 31 = 0 THEN substr(w, 1, c % length(w)) || substr(w, c % length(w) + 2) ELSE w END AS word,
           CAST(sum(k) AS BIGINT) AS n
    FROM checked GROUP BY 1 HAVING length(word) >= 7 AND sum(k) >= 2),
gaps AS MATERIALIZED (
    SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
    SELECT x.word, y.word AS other, y.n FROM gaps x JOIN gaps y USING (a, z) WHERE x.word <> y.word
    UNION
    SELECT x.word, y.word, y.n FROM gaps x JOIN words y ON y.word = x.a || x.z
    UNION
    SELECT y.word, x.word, x.n FROM gaps x JOIN words y ON y.word = x.a || x.z),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS form, max(n) AS form_n
         FROM near GROUP BY word),
found AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
           CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)),
chain(word, root, form) AS (
    SELECT word, word, form FROM found
    UNION ALL
    SELECT c.word, f.word, f.form FROM chain c JOIN found f ON f.word = c.form)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM found f JOIN chain c ON c.word = f.word AND c.form IS NULL""",
}
