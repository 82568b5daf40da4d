"""DuckDB SQL for every registered query (the driver's correctness oracle).

Written from the semantics, not from the Spark plans: windows where Spark
uses aggregates, NOT EXISTS where Spark uses anti joins, ASOF JOIN where Spark
uses the bucketed as-of. Shared views (links, candidates, outlets, event
captures) are CTE texts put in front of each query.
"""

from __future__ import annotations

# The oracle's own reading of a link: hidden parts cut, then attribute after attribute up to href.
HIDDEN_SQL = "(?is)<!--.*?-->|<script[^>]*>.*?</script *>|<style[^>]*>.*?</style *>"
LINK_SQL = (r"""(?i)<a\s+(?:[^\s"'>=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?\s+)*?"""
            r"""href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
SCHEME = "[A-Za-z][A-Za-z0-9+.-]*"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def scheme(x):
    return f"lower(regexp_extract({x}, '^({SCHEME}):', 1))"


def netloc(x):
    return f"regexp_extract({x}, '^(?:{SCHEME}:)?//([^/?#]*)', 1)"


def fullpath(x):
    return f"regexp_extract({x}, '^(?:{SCHEME}:)?(?://[^/?#]*)?([^?#]*)', 1)"


def path(x):
    return f"regexp_replace({fullpath(x)}, ';[^/]*$', '')"


def query(x):
    return f"regexp_extract({x}, '^[^?#]*\\?([^#]*)', 1)"


def fragment(x):
    return f"regexp_extract({x}, '^[^#]*#(.*)$', 1)"


def site(x):
    return f"({scheme(x)} || '://' || {netloc(x)} || '/')"


def segs(x):
    return f"list_filter(string_split({path(x)}, '/'), lambda s: s <> '')"


def lang(x):
    return f"{segs(x)}[1]"


def valid(x):
    n = netloc(x)
    return (f"(regexp_matches({x}, '^{SCHEME}://[^/?#]+') "
            f"AND (contains({n}, '[') = contains({n}, ']')))")


def domain(x):
    return (f"nullif(regexp_replace(split_part({netloc(f'url_decode({x})')}, '&', 1), "
            f"'^www\\.', ''), '')")


LINKS = f"""
lk0 AS (SELECT page_id, url AS base,
        regexp_extract_all(regexp_replace(html, {lit(HIDDEN_SQL)}, ' ', 'g'), {lit(LINK_SQL)}, 1) AS hl FROM pages),
lk1 AS (SELECT page_id, base, unnest(hl) AS raw, CAST(unnest(range(len(hl))) AS INTEGER) AS pos FROM lk0),
lk2 AS (SELECT page_id, base, pos,
        replace(replace(replace(CASE WHEN starts_with(raw, '"') OR starts_with(raw, '''')
                     THEN substr(raw, 2, length(raw) - 2) ELSE raw END, '&#38;', '&amp;'), '&quot;', '"'),
                '&amp;', '&') AS href FROM lk1),
lk3 AS (SELECT *, {scheme('base')} AS bs, {scheme('href')} AS hs, {netloc('base')} AS bnet,
        {fullpath('base')} AS bpath, {query('base')} AS bq FROM lk2),
lk4 AS (SELECT *, CASE WHEN hs <> '' THEN regexp_extract(href, '^{SCHEME}:(.*)$', 1) ELSE href END AS rest
        FROM lk3),
lk5 AS (SELECT *, regexp_extract(rest, '^([^?#]*)', 1) AS rpath, {query('rest')} AS rq,
        {fragment('rest')} AS rf, string_split(bpath, '/') AS bparts FROM lk4),
lk6 AS (SELECT *, list_concat(CASE WHEN bparts[len(bparts)] <> '' THEN bparts[1:len(bparts) - 1]
                                   ELSE bparts END, string_split(rpath, '/')) AS merged FROM lk5),
lk7 AS (SELECT *, CASE WHEN starts_with(rpath, '/') THEN string_split(rpath, '/')
                       ELSE list_concat([merged[1]], list_filter(merged[2:len(merged) - 1], lambda s: s <> ''),
                                        [merged[len(merged)]]) END AS sg FROM lk6),
lk8 AS (SELECT *, list_reduce(sg, lambda acc, s: CASE WHEN s = '..' THEN acc[1:len(acc) - 1]
                                                      WHEN s = '.' THEN acc ELSE list_append(acc, s) END,
                              []::VARCHAR[]) AS red FROM lk7),
lk9 AS (SELECT *, array_to_string(CASE WHEN sg[len(sg)] IN ('.', '..') THEN list_append(red, '') ELSE red END,
                                  '/') AS joined FROM lk8),
links AS (SELECT page_id, {site('base')} AS website, md5({site('base')}) AS website_hash, pos, href,
  CASE WHEN base = '' THEN href
       WHEN href = '' THEN base
       WHEN hs <> '' AND hs <> bs THEN href
       WHEN starts_with(rest, '//') THEN bs || ':' || rest
       WHEN rpath = '' THEN bs || '://' || bnet || bpath
            || (CASE WHEN rq <> '' THEN '?' || rq WHEN bq <> '' THEN '?' || bq ELSE '' END)
            || (CASE WHEN rf <> '' THEN '#' || rf ELSE '' END)
       ELSE bs || '://' || bnet
            || (CASE WHEN joined = '' THEN '/' WHEN NOT starts_with(joined, '/') THEN '/' || joined
                     ELSE joined END)
            || (CASE WHEN rq <> '' THEN '?' || rq ELSE '' END)
            || (CASE WHEN rf <> '' THEN '#' || rf ELSE '' END) END AS url
  FROM lk9)"""

DLINKS = """
dlinks AS (SELECT website_hash, url, page_id, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY website_hash, url ORDER BY page_id, pos) AS rn FROM links)
  WHERE rn = 1)"""

CAND = f"""
cand AS (
  SELECT md5({site('url')}) AS website_hash, url, page_id AS feed_pos, 0 AS entry_pos, 0 AS origin FROM pages
  UNION ALL
  SELECT website_hash, url, page_id AS feed_pos, pos AS entry_pos, 1 AS origin FROM dlinks)"""

OUTLETS = f"""
o0 AS (SELECT {site('url')} AS website, {netloc('url')} AS name,
        upper(arg_min({lang('url')}, page_id)) AS state, count(*) AS n_pages,
        bool_or(contains(url, 'rss') OR contains(url, 'feed')) AS has_feed FROM pages GROUP BY 1, 2),
outlets AS (SELECT state,
        CASE regexp_extract(name, '\\.([A-Za-z]+)$', 1) WHEN 'com' THEN 'newspaper' WHEN 'net' THEN 'radio'
             WHEN 'org' THEN 'tv' ELSE 'broadcast' END AS media,
        name, website, md5(website) AS website_hash, n_pages, 200 AS website_status, has_feed FROM o0)"""

EC = """
ec AS (SELECT event_id,
        'com,example,u' || CAST(user_id AS VARCHAR) || ')/' AS urlkey,
        'https://u' || CAST(user_id AS VARCHAR) || '.example.com/' AS url,
        ts, event_type AS digest,
        CAST(floor(value * 100 + 0.5) AS BIGINT) AS length,
        CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 302 ELSE 200 END AS status,
        CASE event_type WHEN 'view' THEN 'text/html' WHEN 'click' THEN 'application/json'
             WHEN 'purchase' THEN 'text/html' WHEN 'signup' THEN 'application/javascript' END AS mime,
        'k' || json_extract_string(props, '$.k') AS collection
      FROM events)"""

ARCH = """
arch AS (SELECT event_id, url, md5(url) AS website_hash,
          CASE digest WHEN 'error' THEN '520 Server Error: Unknown Error'
                      WHEN 'signup' THEN 'Error: archive refused the URL'
                      ELSE 'https://web.archive.org/web/' || strftime(ts, '%Y%m%d%H%M%S') || '/' || url END
          AS output, ts AS called_at FROM ec),
arch_o AS (SELECT *, (output IS NULL OR trim(output) = '' OR contains(output, 'Error')) AS failed,
          coalesce(contains(output, 'Server Error'), false) AS retryable FROM arch)"""

BLANKS = "[ \\t\\n\\r\\f\\x0B]+"
ENTITY_SQL = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
              ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&mdash;", "—"),
              ("&ndash;", "–"), ("&hellip;", "…"), ("&amp;", "&"))


MARKUP_SQL = "(?is)<!--.*?-->|" + "|".join(
    f"<{tag}\\b[^>]*>.*?</{tag}\\s*>" for tag in ("script", "style", "head", "noscript")) + "|<[^>]*>"


def html_text_sql(x: str) -> str:
    t = f"regexp_replace({x}, {lit(MARKUP_SQL)}, ' ', 'g')"
    for ent, ch in ENTITY_SQL:
        t = f"replace({t}, {lit(ent)}, {lit(ch)})"
    return f"trim(regexp_replace({t}, '{BLANKS}', ' ', 'g'))"


SIZES = f"""
pt AS (SELECT page_id, url, {html_text_sql('html')} AS t FROM pages),
sizes AS (SELECT page_id, url,
          CAST(len(list_filter(string_split(t, ' '), lambda w: w <> '')) AS INTEGER) AS n_words,
          CAST(length(t) AS INTEGER) AS n_chars FROM pt)"""


def shape_sql(rule: str, sg: str = "sg") -> str:
    two = f"{sg}[1:2]"
    if rule == "depth3":
        return f"len({sg}) >= 3"
    if rule == "last_segment":
        last = f"{sg}[len({sg})]"
        some = (f"len(list_filter({two}, lambda s: regexp_matches(s, '[-_.]') "
                f"OR regexp_matches(s, '^[0-9]+$'))) > 0")
        return (f"(len({sg}) >= 1 AND (regexp_matches({last}, '^[0-9]+$') OR regexp_matches({last}, '[-_.]')) "
                f"AND (len({sg}) >= 3 OR {some}))")
    return (f"(len({sg}) >= 3 OR (len({sg}) >= 1 "
            f"AND len(list_filter({two}, lambda s: regexp_matches(s, '[-_.]'))) > 0))")


def article_sql(rule: str) -> str:
    return f"""WITH {LINKS}, {DLINKS}, {CAND},
c2 AS (SELECT *, {segs('url')} AS sg, {valid('url')} AS ok FROM cand)
SELECT website_hash, url, origin, feed_pos, entry_pos FROM c2 WHERE ok AND {shape_sql(rule)}"""


BASE_ART = f"""
art AS (SELECT * FROM (SELECT *, {segs('url')} AS sg, {valid('url')} AS ok FROM cand)
        WHERE ok AND (len(sg) >= 3 OR (len(sg) >= 1
              AND len(list_filter(sg[1:2], lambda s: regexp_matches(s, '[-_.]'))) > 0))),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY website_hash
                          ORDER BY origin, feed_pos, entry_pos, url) AS INTEGER) AS rank FROM art)"""

PAGE_CAPS = f"""
pc AS (SELECT page_id, {site('url')} AS collection, url, CAST(length(html) AS BIGINT) AS length,
       {lang('url')} AS mime FROM pages),
hosts AS (SELECT {netloc('url')} AS host, count(*) AS documents, CAST(sum(length) AS BIGINT) AS bytes
          FROM pc GROUP BY 1)"""

DOCS = """
dc AS (SELECT doc_id, source, md5(source) AS website_hash,
       'https://' || source || '.example.org/doc/' || CAST(doc_id AS VARCHAR) AS url,
       md5(text) AS digest, n_chars AS length FROM documents)"""

TODAY_BEFORE = """
lastp AS (SELECT website_hash, max(page_id) AS last_page FROM links GROUP BY 1),
tb AS (SELECT l.website_hash, l.url, l.page_id, p.last_page FROM links l JOIN lastp p USING (website_hash))"""

SITE_STATUS = """
st AS (SELECT url AS website, arg_max(status, ts) AS website_status FROM ec GROUP BY 1)"""


DOC_TEXT = f"""
d0 AS (SELECT doc_id, trim(regexp_replace(text, '{BLANKS}', ' ', 'g'), ' ') AS t FROM documents),
dt AS (SELECT doc_id, CAST(len(list_filter(string_split(t, ' '), lambda w: w <> '')) AS INTEGER) AS n_words,
       CAST(length(t) AS INTEGER) AS n_chars FROM d0)"""


def surt_sql(x: str) -> str:
    host = f"regexp_replace(lower({netloc(x)}), '^www\\.', '')"
    q = query(x)
    return (f"array_to_string(list_reverse(string_split({host}, '.')), ',') || ')' || "
            f"lower({fullpath(x)} || CASE WHEN {q} <> '' THEN '?' || {q} ELSE '' END)")


ORACLE: dict[str, str] = {
    "q_links": f"WITH {LINKS} SELECT page_id, pos, href, url FROM links",
    "q_links_distinct": f"WITH {LINKS}, {DLINKS} SELECT website_hash, url, page_id, pos FROM dlinks",
    "q_links_per_page": f"WITH {LINKS} SELECT page_id, count(DISTINCT url) AS n_links FROM links GROUP BY 1",
    "q_articles_base": article_sql("base"),
    "q_articles_last_segment": article_sql("last_segment"),
    "q_articles_depth3": f"""WITH {EC}, {ARCH},
        u AS (SELECT 'page' AS kind, page_id AS id, url FROM pages
              UNION ALL SELECT 'archive', event_id, output FROM arch)
        SELECT kind, id, url FROM u WHERE {valid('url')} AND len({segs('url')}) >= 3""",
    "q_articles_not_home": f"""WITH {LINKS}, {DLINKS}, {CAND},
        homes AS (SELECT md5({site('url')}) AS website_hash, arg_min(url, page_id) AS home FROM pages GROUP BY 1),
        c2 AS (SELECT c.*, home, {segs('url')} AS sg, {valid('url')} AS ok FROM cand c JOIN homes USING (website_hash))
        SELECT website_hash, url, origin, feed_pos, entry_pos FROM c2
        WHERE ok AND {shape_sql('base')} AND NOT (url = home OR {path('home')} = {path('url')})""",
    "q_same_site": f"""WITH {LINKS}, {EC},
        u AS (SELECT 'link' AS kind, page_id AS id, url, website FROM links
              UNION ALL SELECT 'capture', event_id, url, 'https://u1' FROM ec)
        SELECT kind, id, url FROM u WHERE starts_with({netloc('url')}, {netloc('website')})""",
    "q_crawlable": f"""WITH {LINKS},
        u AS (SELECT page_id, pos, href AS link FROM links UNION ALL SELECT page_id, pos, url FROM links)
        SELECT page_id, pos, link FROM u WHERE regexp_matches(link, '^https?://')""",
    "q_url_parts": f"""SELECT page_id, {scheme('url')} AS scheme, {netloc('url')} AS netloc, {path('url')} AS path,
        {query('url')} AS query, {fragment('url')} AS fragment, CAST(len({segs('url')}) AS INTEGER) AS depth,
        {valid('url')} AS valid FROM pages""",
    "q_domain": f"WITH {LINKS} SELECT page_id, pos, {domain('url')} AS domain FROM links",
    "q_normalized_dedup": f"""WITH {LINKS}
        SELECT website_hash, regexp_replace(lower(url), '/+$', '') AS norm_url, min(url) AS url,
               count(*) AS n_variants FROM links GROUP BY 1, 2""",
    "q_url_hash": f"""SELECT page_id, {site('url')} AS website, md5({site('url')}) AS website_hash,
        md5(url) AS url_hash FROM pages""",
    "q_archive_path": f"""SELECT page_id, concat_ws('/', 'news', upper({lang('url')}), '2025', '3', '17',
        md5({site('url')})) AS archive_path FROM pages""",
    "q_url_order": f"SELECT page_id, {surt_sql('url')} AS urlkey FROM pages ORDER BY urlkey, page_id",
    "q_html_words": f"WITH {SIZES} SELECT page_id, n_words, n_chars FROM sizes",
    "q_content_words20": f"WITH {DOC_TEXT} SELECT doc_id, n_words FROM dt WHERE n_words >= 20",
    "q_content_chars20": f"WITH {DOC_TEXT} SELECT doc_id, n_chars FROM dt WHERE n_chars > 20",
    "q_content_check": f"""WITH {LINKS}, {DLINKS}, {CAND}, {SIZES},
        sz AS (SELECT url, arg_max(n_words, page_id) AS content_size FROM sizes GROUP BY 1)
        SELECT c.website_hash, c.url, c.origin, coalesce(sz.content_size >= 20, false) AS has_content
        FROM cand c LEFT JOIN sz ON c.url = sz.url""",
    "q_cap5": f"""WITH {LINKS}, {DLINKS}, {CAND}, {BASE_ART}
        SELECT website_hash, url, origin, rank FROM ranked WHERE rank <= 5""",
    "q_cap11": f"""WITH {LINKS}, {DLINKS}, {CAND}, {BASE_ART},
        r11 AS (SELECT *, sum(CASE WHEN origin = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY website_hash) AS feed_n
                FROM ranked WHERE rank <= 11)
        SELECT website_hash, url, origin, rank FROM r11 WHERE origin = 0 OR feed_n < 10""",
    "q_union_candidates": f"""WITH {LINKS}, {DLINKS}, {CAND}
        SELECT website_hash, url, feed_pos, entry_pos, origin FROM cand""",
    "q_drop_seen": f"""WITH {LINKS}
        SELECT page_id, pos, website_hash, url FROM links l WHERE NOT EXISTS (
          SELECT 1 FROM links s WHERE s.website_hash = l.website_hash AND s.url = l.url AND s.page_id < l.page_id)""",
    "q_known_domain": f"""WITH {LINKS}, {OUTLETS}, {EC},
        reg AS (SELECT DISTINCT {domain('website')} AS d FROM outlets),
        u AS (SELECT 'link' AS kind, page_id AS id, url FROM links UNION ALL SELECT 'capture', event_id, url FROM ec)
        SELECT kind, id, url FROM u WHERE {domain('url')} IN (SELECT d FROM reg)""",
    "q_new_urls": f"""WITH {LINKS}, {TODAY_BEFORE}
        SELECT website_hash, url FROM tb WHERE page_id = last_page
        EXCEPT SELECT website_hash, url FROM tb WHERE page_id < last_page""",
    "q_kept_urls": f"""WITH {LINKS}, {TODAY_BEFORE}
        SELECT website_hash, url FROM tb WHERE page_id = last_page
        INTERSECT SELECT website_hash, url FROM tb WHERE page_id < last_page""",
    "q_expand_urls": f"""WITH {LINKS}, {DLINKS}, {CAND},
        f AS (SELECT url AS furl, arg_max(regexp_replace(url, '#.*$', ''), page_id) AS final_url
              FROM pages GROUP BY 1)
        SELECT c.website_hash, c.url, c.origin, coalesce(f.final_url, c.url) AS expanded_url
        FROM cand c LEFT JOIN f ON c.url = f.furl""",
    "q_in_scope": f"""WITH {LINKS}, {DLINKS}, {CAND},
        seeds AS (SELECT md5({site('url')}) AS website_hash, page_id AS feed_pos,
                  CASE WHEN page_id % 2 = 1 THEN {scheme('url')} || '://' || {netloc('url')}
                       ELSE {site('url')} || {lang('url')} || '/' END AS seed_url FROM pages),
        cs AS (SELECT c.*, s.seed_url FROM cand c JOIN seeds s USING (website_hash, feed_pos)),
        parts AS (SELECT *, split_part('@' || lower({netloc('url')}), '@', -1) AS uh, {fullpath('url')} AS up,
                  split_part('@' || lower({netloc('seed_url')}), '@', -1) AS sh, {fullpath('seed_url')} AS sp FROM cs)
        SELECT website_hash, url, origin, feed_pos, entry_pos,
          coalesce(regexp_matches(url, '^https?://') AND sh <> '' AND uh = sh
            AND starts_with(CASE WHEN up = '' THEN '/' ELSE up END,
                            CASE WHEN sp = '' THEN '/' ELSE left(sp, length(sp) - position('/' in reverse(sp)) + 1) END),
            false) AS in_scope
        FROM parts""",
    "q_seed_report": f"""WITH {PAGE_CAPS}
        SELECT collection, count(*) AS documents, CAST(sum(length) AS BIGINT) AS bytes FROM pc GROUP BY 1""",
    "q_host_report": f"WITH {PAGE_CAPS} SELECT host, documents, bytes FROM hosts",
    "q_type_report": f"""WITH {PAGE_CAPS}
        SELECT coalesce(mime, 'unknown') AS file_type, count(*) AS documents, CAST(sum(length) AS BIGINT) AS bytes
        FROM pc GROUP BY 1""",
    "q_top_hosts": f"WITH {PAGE_CAPS} SELECT host, documents, bytes FROM hosts ORDER BY bytes DESC, host LIMIT 5",
    "q_dedup_content": f"""WITH {DOCS}
        SELECT digest, doc_id, source FROM (
          SELECT *, row_number() OVER (PARTITION BY digest ORDER BY doc_id) AS rn FROM dc) WHERE rn = 1""",
    "q_duplicate_share": f"""WITH {DOCS},
        per AS (SELECT source, digest, count(*) AS n, sum(length) AS b, arg_min(length, doc_id) AS first_b
                FROM dc GROUP BY 1, 2)
        SELECT source, CAST(sum(n) AS BIGINT) AS captures, count(*) AS distinct_digests,
               CAST(sum(n) - count(*) AS BIGINT) AS duplicate_captures, CAST(sum(b) AS BIGINT) AS bytes,
               CAST(sum(b) - sum(first_b) AS BIGINT) AS duplicate_bytes FROM per GROUP BY 1""",
    "q_daily_quota": f"""WITH {DOCS},
        r AS (SELECT *, row_number() OVER (PARTITION BY website_hash ORDER BY doc_id) AS rank FROM dc),
        q AS (SELECT *, row_number() OVER (ORDER BY rank, website_hash, url) AS quota_rank FROM r)
        SELECT doc_id, website_hash, CAST(rank AS BIGINT) AS rank, CAST(quota_rank AS BIGINT) AS quota_rank,
               CAST(floor((quota_rank - 1) / 200) AS INTEGER) AS day_offset FROM q""",
    "q_daily_usage": f"""WITH {EC}
        SELECT CAST(ts AS DATE) AS day, collection, count(*) AS documents, CAST(sum(length) AS BIGINT) AS bytes
        FROM ec GROUP BY 1, 2""",
    "q_crawl_progress": f"""WITH {EC}
        SELECT event_id, collection,
          count(*) OVER (PARTITION BY collection ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cum_docs,
          CAST(sum(length) OVER (PARTITION BY collection ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
               AS BIGINT) AS cum_bytes
        FROM ec""",
    "q_capture_changes": f"""WITH {EC},
        l AS (SELECT event_id, urlkey, digest,
              lag(digest) OVER (PARTITION BY urlkey ORDER BY ts, event_id) AS prev_digest,
              row_number() OVER (PARTITION BY urlkey ORDER BY ts, event_id) AS nth FROM ec)
        SELECT event_id, urlkey, prev_digest,
          CASE WHEN nth = 1 THEN 'first' WHEN prev_digest IS NOT DISTINCT FROM digest THEN 'unchanged'
               ELSE 'changed' END AS change FROM l""",
    "q_capture_as_of": f"""WITH {EC},
        req AS (SELECT event_id, urlkey, ts FROM ec WHERE digest = 'view'),
        caps AS (SELECT urlkey, ts AS capture_ts, digest AS capture_digest FROM ec WHERE digest <> 'view')
        SELECT r.event_id, r.urlkey, c.capture_ts, c.capture_digest
        FROM req r ASOF LEFT JOIN caps c ON r.urlkey = c.urlkey AND r.ts >= c.capture_ts""",
    "q_sliding_usage": f"""WITH {EC},
        w AS (SELECT date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS window_start, collection, length
              FROM (SELECT *, unnest(range(7)) AS k FROM ec))
        SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, collection,
               count(*) AS documents, CAST(sum(length) AS BIGINT) AS bytes FROM w GROUP BY 1, 2, 3""",
    "q_sessions": f"""WITH {EC},
        g AS (SELECT urlkey, ts, CASE WHEN lag(ts) OVER (PARTITION BY urlkey ORDER BY ts) IS NULL
                OR ts - lag(ts) OVER (PARTITION BY urlkey ORDER BY ts) >= INTERVAL 1 HOUR THEN 1 ELSE 0 END AS new_s
              FROM ec),
        s AS (SELECT *, sum(new_s) OVER (PARTITION BY urlkey ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
        SELECT urlkey, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end, count(*) AS events
        FROM s GROUP BY urlkey, sid""",
    "q_status_report": f"""WITH {EC}, g AS (SELECT status, count(*) AS captures FROM ec GROUP BY 1)
        SELECT status, captures, round(captures / sum(captures) OVER (), 6) AS share FROM g""",
    "q_registry_flat": f"""WITH {OUTLETS}
        SELECT state, media, name, website, website_hash, n_pages, website_status, has_feed FROM outlets""",
    "q_media_counts": f"WITH {OUTLETS} SELECT media, count(*) AS n_outlets FROM outlets GROUP BY ROLLUP (media)",
    "q_coverage": f"""WITH {OUTLETS}
        SELECT state, media, count(*) AS n_outlets,
               count(*) FILTER (WHERE website_status BETWEEN 200 AND 299) AS n_alive,
               count(*) FILTER (WHERE has_feed) AS n_with_feed
        FROM outlets GROUP BY CUBE (state, media)""",
    "q_needs_feed": f"""WITH {OUTLETS}
        SELECT website_hash, website, state, media FROM outlets WHERE NOT has_feed""",
    "q_attach_status": f"WITH {EC}, {SITE_STATUS} SELECT website, website_status FROM st",
    "q_alive": f"""WITH {EC}, {SITE_STATUS}
        SELECT website, website_status FROM st WHERE website_status BETWEEN 200 AND 299""",
    "q_archive_outcome": f"""WITH {EC}, {ARCH}
        SELECT event_id, CASE WHEN failed THEN 'failed' ELSE 'archived' END AS status, retryable,
               CASE WHEN NOT failed THEN trim(output) END AS archive_url FROM arch_o""",
    "q_outcome_counts": f"""WITH {EC}, {ARCH}
        SELECT website_hash, count(*) AS found, count(*) FILTER (WHERE NOT failed) AS archived,
               count(*) FILTER (WHERE failed) AS failed, count(*) FILTER (WHERE retryable) AS server_errors
        FROM arch_o GROUP BY 1""",
    "q_record_captures": f"""WITH {EC}, {ARCH},
        lastr AS (SELECT url, arg_max(output, called_at) AS output, max(called_at) AS archived_time
                  FROM arch GROUP BY 1)
        SELECT url, trim(output) AS archive_ref, archived_time FROM lastr
        WHERE NOT (output IS NULL OR trim(output) = '' OR contains(output, 'Error'))""",
    "q_locate_block": f"""WITH {LINKS},
        k AS (SELECT page_id, pos, {surt_sql('url')} AS urlkey FROM links),
        b AS (SELECT {netloc('url')} AS block_file, min({surt_sql('url')}) AS block_from FROM pages GROUP BY 1)
        SELECT k.page_id, k.pos, k.urlkey, b.block_file, b.block_from
        FROM k ASOF LEFT JOIN b ON k.urlkey >= b.block_from""",
    "q_publication_time": """SELECT event_id,
        CASE event_type
          WHEN 'view' THEN strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' GMT'
          WHEN 'click' THEN strftime(ts + INTERVAL 5 HOUR, '%a, %d %b %Y %H:%M:%S') || ' +0500'
          WHEN 'purchase' THEN strftime(ts - INTERVAL 5 HOUR, '%a, %d %b %Y %H:%M:%S') || ' EST'
          WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS published,
        CASE WHEN event_type IN ('view', 'click', 'purchase', 'signup') THEN date_trunc('second', ts)
             ELSE TIMESTAMP '2025-03-17 00:00:00' END AS publication_date
        FROM events""",
    "q_log_summary": f"""WITH {EC},
        lg AS (SELECT CASE WHEN status >= 500 THEN 'error' ELSE 'info' END AS logLevel, digest AS context,
               coalesce(mime, 'none') AS message FROM ec)
        SELECT logLevel, context, message, count(*) AS rows FROM lg GROUP BY ROLLUP (logLevel, context, message)""",
    "q_registry_seeds": f"""WITH {OUTLETS}
        SELECT DISTINCT regexp_replace(website, '/+$', '') || '/' AS seed_url FROM outlets
        WHERE website IS NOT NULL AND website <> ''""",
    "q_exact_ok": f"""WITH {EC}
        SELECT event_id, url AS website FROM ec WHERE mime = 'text/html' AND status = 200 AND url <> ''""",
    "q_feed_like": "SELECT page_id, url FROM pages WHERE contains(url, 'rss') OR contains(url, 'feed')",
    "q_status_class": f"""WITH {EC}
        SELECT event_id, status, CASE WHEN status IS NULL THEN NULL WHEN status BETWEEN 200 AND 299 THEN '2xx'
                                      ELSE 'other' END AS status_class FROM ec""",
    "q_urlkey_host": f"""WITH {EC}
        SELECT event_id, urlkey,
          CASE WHEN NOT starts_with(urlkey, 'urn:') AND contains(urlkey, ')')
               THEN array_to_string(list_reverse(string_split(split_part(urlkey, ')', 1), ',')), '.') END AS host
        FROM ec""",
    "q_robots_urls": f"""WITH {OUTLETS}
        SELECT website_hash, website || 'robots.txt' AS robots_url, website || 'sitemap.xml' AS sitemap_url,
               website || 'sitemap_index.xml' AS sitemap_index_url FROM outlets""",
    "q_first_feed": f"""WITH f AS (
          SELECT md5({site('url')}) AS website_hash, url, page_id, CASE WHEN contains(url, 'rss') THEN 0 ELSE 1 END AS prio
          FROM pages WHERE contains(url, 'rss') OR contains(url, 'feed'))
        SELECT website_hash, url AS feed FROM (
          SELECT *, row_number() OVER (PARTITION BY website_hash ORDER BY prio, page_id) AS rn FROM f) WHERE rn = 1""",
    "q_page_resources": f"""WITH {LINKS},
        caps AS (
          SELECT 'page' AS kind, page_id, CAST(NULL AS INTEGER) AS pos, url, CAST(NULL AS VARCHAR) AS referrer,
                 {lang('url')} AS mime, page_id AS ts FROM pages
          UNION ALL
          SELECT 'link', l.page_id, l.pos, l.url, p.url, CAST(NULL AS VARCHAR), l.page_id
          FROM links l JOIN pages p ON l.page_id = p.page_id),
        lastm AS (SELECT url AS page_url, arg_max(mime, ts) AS page_mime FROM caps GROUP BY 1)
        SELECT kind, page_id, pos, url, page_mime FROM caps LEFT JOIN lastm ON caps.referrer = lastm.page_url""",
}

ORACLE["q_seed_type"] = f"""WITH s AS ({ORACLE['q_in_scope']}),
    h AS (SELECT *, CASE WHEN in_scope THEN 0 ELSE 1 END AS hops FROM s)
    SELECT website_hash, url, origin, feed_pos, entry_pos,
      coalesce((in_scope AND hops = 0) OR (hops >= 1 AND hops <= 0), false) AS standard,
      coalesce((in_scope AND hops = 0) OR (hops >= 1 AND hops <= 1), false) AS standard_plus,
      coalesce(origin = 0, false) AS one_page,
      coalesce(origin = 0 OR origin = 1, false) AS one_page_plus
    FROM h"""

ORACLE["q_collect"] = f"""WITH {LINKS}, {DLINKS}, {CAND}, {SIZES},
    c AS (SELECT website_hash, url, origin, feed_pos, entry_pos FROM
          (SELECT *, {segs('url')} AS sg, {valid('url')} AS ok FROM cand) WHERE ok AND {shape_sql('base')}),
    seen AS (SELECT md5({site('url')}) AS website_hash, url FROM pages WHERE page_id % 3 = 0),
    sz AS (SELECT url, arg_max(n_words, page_id) AS content_size FROM sizes GROUP BY 1),
    calls AS (SELECT url, arg_max(page_id, page_id) AS last_id FROM pages GROUP BY 1),
    kept AS (SELECT c.* FROM c JOIN sz USING (url) JOIN calls USING (url)
             WHERE content_size >= 20 AND last_id % 5 <> 0 AND NOT EXISTS (
               SELECT 1 FROM seen s WHERE s.website_hash = c.website_hash AND s.url = c.url))
    SELECT website_hash, url, origin, CAST(rank AS INTEGER) AS rank, 'https://web.archive.org/web/1/' || url AS archive_ref
    FROM (SELECT *, row_number() OVER (PARTITION BY website_hash ORDER BY origin, feed_pos, entry_pos, url) AS rank FROM kept)
    WHERE rank <= 5"""

ORACLE["q_discover_feeds"] = f"""SELECT page_id, {site('url')} || CASE WHEN page_id % 2 = 0
      THEN 'rss/' || CAST(page_id AS VARCHAR) || '?a=1&b=2' ELSE 'atom/' || CAST(page_id AS VARCHAR) END AS feed FROM pages"""
ORACLE["q_robots_sitemaps"] = f"""SELECT page_id, 0 AS pos, {site('url')} || 'map-' || CAST(page_id AS VARCHAR) || '.xml' AS sitemap
    FROM pages UNION ALL SELECT page_id, 1, {site('url')} || 'news.xml' FROM pages"""
ORACLE["q_sitemap_locs"] = """SELECT page_id, 0 AS pos, url || '&x=A' AS loc FROM pages
    UNION ALL SELECT page_id, 1, url FROM pages"""
ORACLE["q_feed_entries"] = """SELECT page_id, 0 AS entry_pos, url AS link, 'day ' || CAST(page_id AS VARCHAR) AS published FROM pages
    UNION ALL SELECT page_id, 2, url, 'p' || CAST(page_id AS VARCHAR) FROM pages"""
ORACLE["q_seed_metrics"] = f"""WITH {EC},
    c AS (SELECT urlkey, status, length, digest, event_id % 5 = 0 AS robots FROM ec),
    m AS (SELECT urlkey, count(*) AS documents, CAST(sum(length) AS BIGINT) AS bytes,
            count(*) FILTER (WHERE status // 100 = 2) AS ok, count(*) FILTER (WHERE status // 100 = 3) AS redirects,
            count(*) FILTER (WHERE status // 100 = 4) AS client_errors, count(*) FILTER (WHERE status // 100 = 5) AS server_errors,
            count(*) FILTER (WHERE robots AND status >= 400) AS robots_fail,
            count(*) FILTER (WHERE robots AND status >= 400) > 0
              AND count(*) FILTER (WHERE NOT robots AND status // 100 = 2) = 0 AS robots_blocked FROM c GROUP BY 1),
    s AS (SELECT urlkey, count(*) AS seeds FROM c WHERE digest = 'purchase' GROUP BY 1)
    SELECT * FROM m FULL JOIN s USING (urlkey)"""
ORACLE["q_average_usage"] = f"""WITH {EC}
    SELECT collection, count(DISTINCT CAST(ts AS DATE)) AS days,
           CAST(sum(length) // count(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS bytes_per_day FROM ec GROUP BY 1"""
ORACLE["q_page_durations"] = f"""WITH {EC},
    l AS (SELECT collection, urlkey AS page, ts, digest = 'view' AS st FROM ec WHERE digest IN ('view', 'click', 'purchase')),
    v AS (SELECT *, CAST(sum(CAST(st AS INTEGER)) OVER (PARTITION BY collection, page ORDER BY ts, st
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS visit FROM l)
    SELECT collection, page, visit, min(ts) FILTER (WHERE st) AS started, min(ts) FILTER (WHERE NOT st) AS finished
    FROM v WHERE visit > 0 GROUP BY 1, 2, 3"""
ORACLE["q_log_field"] = "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"
ORACLE["q_site_record"] = f"WITH {OUTLETS} SELECT website_hash, state, media, name, website FROM outlets"
ORACLE["q_page_captures"] = f"""WITH {PAGE_CAPS}
    SELECT p.page_id, p.collection, p.url, make_timestamp(c.page_id * 1000000) AS capture_ts,
           CASE WHEN c.page_id IS NOT NULL THEN md5(c.url) END AS digest, c.length
    FROM pc p LEFT JOIN (SELECT * FROM pc WHERE page_id % 2 = 0) c ON p.collection = c.collection AND p.url = c.url"""
ORACLE["q_expand_chain"] = """WITH RECURSIVE one AS (SELECT page_id, min(url) AS u FROM pages GROUP BY 1),
    hops AS (SELECT p.url, arg_max(CASE WHEN p.page_id % 20 = 19 AND (p.page_id // 20) % 3 = 2
                    THEN 'https://gone.example.org/' || p.page_id ELSE coalesce(o.u, '') END, p.page_id) AS nxt
             FROM pages p LEFT JOIN one o ON o.page_id = CASE WHEN p.page_id % 20 < 19 THEN p.page_id + 1
                    WHEN (p.page_id // 20) % 3 = 1 THEN p.page_id - 5 END GROUP BY 1),
    moves AS (SELECT url, nxt FROM hops WHERE nxt <> '' AND nxt <> url),
    walk(url, here, n) AS (SELECT url, nxt, 1 FROM moves
        UNION ALL SELECT w.url, m.nxt, n + 1 FROM walk w JOIN moves m ON m.url = w.here WHERE n <= 40),
    ends AS (SELECT url, here, n FROM walk WHERE here NOT IN (SELECT url FROM moves) AND n <= 30)
    SELECT p.page_id, p.url, coalesce(e.here, p.url) AS expanded_url,
           CAST(CASE WHEN e.n IS NOT NULL THEN e.n WHEN p.url IN (SELECT url FROM moves) THEN NULL ELSE 0 END AS BIGINT) AS n_hops
    FROM pages p LEFT JOIN ends e ON e.url = p.url"""

# ---- events as a crawl's lines: the answer is written from the events themselves, nothing is parsed
ORACLE["q_read_cdx"] = f"""WITH {EC}
    SELECT collection, urlkey, date_trunc('second', ts) AS ts, url || '?e=' || event_id AS url, coalesce(mime, 'unk') AS mime,
           CAST(CASE WHEN digest <> 'signup' THEN status END AS INTEGER) AS status, 'sha-256:' || digest AS digest, length,
           event_id AS "offset", 'rec-0.warc.gz' AS filename, CASE WHEN digest = 'view' THEN url END AS referrer,
           CAST(NULL AS VARCHAR) AS method FROM ec WHERE digest <> 'error'"""
ORACLE["q_read_block_index"] = f"""WITH {EC}
    SELECT collection, 'b-' || event_id || '.gz' AS filename, urlkey AS urlkey_from, date_trunc('second', ts) AS ts,
           event_id AS "offset", length, digest FROM ec WHERE event_id % 10 <> 0"""
LOG = """
lg AS (SELECT collection, event_id, digest, date_trunc('millisecond', ts) AS timestamp,
        CASE WHEN digest = 'error' THEN 'error' ELSE 'info' END AS logLevel,
        CASE WHEN digest = 'signup' THEN 'crawlStatus' ELSE 'pageStatus' END AS context,
        CASE digest WHEN 'error' THEN 'Page Load Timed Out' WHEN 'signup' THEN 'Crawl statistics' ELSE 'Page Finished' END AS message,
        CASE WHEN digest NOT IN ('signup', 'click') THEN url END AS page FROM ec WHERE event_id % 100 <> 99)"""
ORACLE["q_read_crawl_log"] = f"WITH {EC}, {LOG} SELECT collection, timestamp, logLevel, context, message, page FROM lg"
ORACLE["q_crawl_summary"] = f"""WITH {EC}, {LOG},
    g AS (SELECT collection, min(timestamp) AS started, max(timestamp) AS ended, count(*) FILTER (WHERE digest = 'error') AS errors,
          count(*) FILTER (WHERE digest = 'error') AS timeouts,
          arg_max(event_id, timestamp) FILTER (WHERE digest = 'signup') AS last FROM lg GROUP BY 1)
    SELECT collection, started, ended, errors, timeouts, last AS crawled, last + 7 AS total,
           CASE WHEN last IS NOT NULL THEN CAST(1 AS BIGINT) END AS pending, last % 3 AS failed FROM g"""
ORACLE["q_read_scraper_log"] = f"""WITH {EC}
    SELECT date_trunc('millisecond', ts) AS ts, CASE WHEN status = 500 THEN 'ERROR' ELSE 'INFO' END AS level,
           url || ' - ' || digest AS message FROM ec WHERE event_id % 7 <> 0"""
FRONTIER = """
fr AS (SELECT collection, CASE WHEN digest IN ('view', 'click') THEN 'queued' WHEN digest = 'purchase' THEN 'pending' ELSE 'done' END AS list,
        url || event_id AS url, date_trunc('millisecond', ts) AS t, event_id FROM ec),
items AS (SELECT collection, list, url, CASE WHEN list <> 'done' THEN t END AS added,
        CAST(CASE WHEN list <> 'done' THEN event_id % 4 END AS INTEGER) AS seed_id,
        CAST(CASE WHEN list <> 'done' THEN event_id % 3 END AS INTEGER) AS depth,
        CAST(CASE WHEN list <> 'done' THEN 0 END AS INTEGER) AS extra_hops FROM fr)"""
ORACLE["q_read_frontier"] = f"WITH {EC}, {FRONTIER} SELECT * FROM items"
ORACLE["q_frontier_summary"] = f"WITH {EC}, {FRONTIER} SELECT list, depth, count(*) AS urls FROM items GROUP BY 1, 2"
ORACLE["q_frontier_minutes"] = f"""WITH {EC}, {FRONTIER}
    SELECT date_trunc('minute', added) AS minute, count(*) AS added FROM items WHERE added IS NOT NULL GROUP BY 1"""
ORACLE["q_feed_for_outlet"] = f"""WITH {OUTLETS},
    own AS (SELECT website, unnest(['rss', 'feed']) AS f, unnest([0, 1]) AS pos FROM outlets WHERE length(name) % 3 = 0),
    html AS (SELECT DISTINCT {site('url')} AS website, 'atom/' || page_id % 4 AS f FROM pages WHERE page_id % 2 = 0),
    maps AS (SELECT DISTINCT {site('url')} AS website, 'map/' || page_id % 4 AS f FROM pages WHERE page_id % 5 = 0),
    a AS (SELECT website, f, pos FROM own
          UNION ALL SELECT website, f, 0 FROM html WHERE website NOT IN (SELECT website FROM own)),
    b AS (SELECT * FROM a UNION ALL SELECT website, f, 0 FROM maps WHERE website NOT IN (SELECT website FROM a))
    SELECT website, website || f AS feed, CAST(pos AS INTEGER) AS pos FROM b"""
ORACLE["q_duplicate_sketch"] = """SELECT source, count(*) AS captures, CAST(sum(n_chars) AS BIGINT) AS bytes, true AS within
    FROM documents GROUP BY 1"""
ORACLE["q_seed_of"] = f"""WITH {LINKS},
    seeds AS (SELECT DISTINCT CASE WHEN page_id % 2 = 1 THEN {scheme('url')} || '://' || {netloc('url')}
                     ELSE {site('url')} || {lang('url')} || '/' END AS seed FROM pages),
    sc AS (SELECT scope, min(seed) AS seed FROM (SELECT seed, split_part('@' || lower({netloc('seed')}), '@', -1) ||
               CASE WHEN {fullpath('seed')} = '' THEN '/' ELSE regexp_extract({fullpath('seed')}, '^(.*/)', 1) END AS scope
           FROM seeds) GROUP BY 1),
    u AS (SELECT DISTINCT url, split_part('@' || lower({netloc('url')}), '@', -1) ||
               CASE WHEN {fullpath('url')} = '' THEN '/' ELSE {fullpath('url')} END AS place FROM links
          WHERE regexp_matches(url, '^https?://')),
    best AS (SELECT url, arg_max(seed, length(scope)) AS seed_url FROM u JOIN sc ON starts_with(place, scope) GROUP BY 1)
    SELECT l.page_id, l.pos, l.url, b.seed_url FROM links l LEFT JOIN best b USING (url)"""
