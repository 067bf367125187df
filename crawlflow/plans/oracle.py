"""DuckDB SQL with the same results as the registered queries, for checking only."""

from __future__ import annotations

from crawlflow.functions.html import ENTITIES
from crawlflow.functions.text import STOP_WORDS
from crawlflow.functions.url import PUBLIC_SUFFIXES
from crawlflow.operators.dust import MAX_BUCKET, MAX_SUBSTRING, WINDOW
from crawlflow.plans.inputs import EVENT_DELAY_MS, NOW_MS, ODD_LINKS, PERIOD_MS, START_MS
from crawlflow.plans.oracle_stems import stem_ctes

NOW = f"epoch_ms({NOW_MS}::bigint)"
DATE = f"epoch_ms(({START_MS} + page_id * {PERIOD_MS})::bigint)"
NAME = "[A-Za-z][A-Za-z0-9+.-]*"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def let(value: str, var: str, body: str) -> str:
    """``body`` with ``var`` bound to ``value``."""
    return f"list_transform([{value}], lambda {var}: {body})[1]"


def host(url: str) -> str:
    return f"lower(regexp_replace(regexp_extract({url}, '^{NAME}://([^/?#]*)', 1), '^.*@|:[0-9]*$', '', 'g'))"


def path(url: str) -> str:
    return f"regexp_extract({url}, '^{NAME}://[^/?#]*([^?#]*)', 1)"


def canonical(url: str) -> str:
    raw = "p.path"
    climbed = f"""list_reduce(
        list_filter(string_split({raw}, '/'), lambda s: s NOT IN ('', '.')),
        lambda acc, s: CASE WHEN s = '..' THEN regexp_replace(acc, '/[^/]*$', '') ELSE acc || '/' || s END, '')"""
    resolved = let(
        climbed,
        "c",
        f"CASE WHEN c = '' THEN '/' WHEN regexp_matches({raw}, '/[.]{{0,2}}$') THEN c || '/' ELSE c END",
    )
    clean = f"""CASE WHEN {raw} = '' THEN '/' ELSE replace(replace(
        CASE WHEN regexp_matches({raw}, '/[.]{{1,2}}(/|$)') THEN {resolved}
        ELSE regexp_replace({raw}, '/+', '/', 'g') END, '%7E', '~'), ' ', '%20') END"""
    joined = """replace(array_to_string(list_transform(list_filter(string_split(p.query, '&'),
        lambda q: q <> '' AND lower(regexp_extract(q, '^[^=]*')) NOT IN ('jsessionid', 'phpsessid', 'aspsessionid')),
        lambda q: regexp_replace(q, '=$', '')), '&'), ' ', '%20')"""
    query = let(joined, "j", "CASE WHEN j IS NULL OR j = '' THEN '' ELSE '?' || j END")
    text = f"""CASE WHEN p.scheme <> '' AND p.host <> '' THEN p.scheme || '://' || p.host
        || CASE WHEN p.port = '' OR (p.scheme = 'http' AND p.port = '80')
                  OR (p.scheme = 'https' AND p.port = '443') THEN '' ELSE ':' || p.port END
        || {clean} || {query} END"""
    parts = f"""{{'scheme': lower(regexp_extract(t, '^({NAME})://', 1)), 'host': {host('t')},
        'port': regexp_extract(t, '^{NAME}://[^/?#]*:([0-9]+)(?:[/?#]|$)', 1), 'path': {path('t')},
        'query': regexp_extract(t, '^[^?#]*[?]([^#]*)', 1)}}"""
    return let(f"trim({url})", "t", let(parts, "p", text))


REJECTED = r"""(regexp_matches({u}, '\.(ico|css|sit|eps|wmf|zip|ppt|mpg|xls|gz|rpm|tgz|mov|exe|bmp|js)$')
    OR regexp_matches({u}, '^(file|ftp|mailto):'))"""
IS_HTML = "regexp_matches(html, '(?i)<html|<!doctype html')"
UNSEEN = r"(?is)<(?:!--.*?-->|script\b[^>]*>.*?</script\s*>|style\b[^>]*>.*?</style\s*>)"

VARIANTS = """variants AS (
    SELECT page_id, unnest(range(5))::int AS variant, unnest([
        url,
        upper(regexp_extract(url, '^[a-z]+://[^/]*')) || CASE WHEN url LIKE 'https%' THEN ':443' ELSE ':80' END
            || '/./x//y/../%7Ea b' || '?b=&PHPSESSID=' || page_id || '&a=1#f',
        regexp_extract(url, '^[a-z]+://[^/]*') || '?q=' || page_id,
        replace(url, '://', '://user@') || '/../..',
        'mailto:a@' || regexp_extract(url, '^[a-z]+://([^/]*)', 1)]) AS url
    FROM pages)"""

SAMPLES = r"""samples AS (
    SELECT unnest([url, regexp_replace(url, '://', '://www.', 'g'),
        regexp_replace(url, '[.](com|org|net)/', '.co.uk/', 'g'),
        regexp_replace(url, '://(.*)[.](com|org|net)/', '://www.\1.gov/', 'g'),
        regexp_replace(url, '[.](com|org|net)/', '.info/', 'g')]) AS url FROM pages)"""

SUFFIXES = f"""suffix_rules AS (
    SELECT DISTINCT suffix, kind FROM (
        SELECT unnest([
            {{'suffix': string_split(h, '.')[-1], 'kind': 'normal'}},
            {{'suffix': CASE WHEN h LIKE '%.net' THEN array_to_string(string_split(h, '.')[-2:], '.') END, 'kind': 'wildcard'}},
            {{'suffix': CASE WHEN h LIKE '%.net' AND page_id % 7 = 0 THEN array_to_string(string_split(h, '.')[-least(3, len(string_split(h, '.'))):], '.') END, 'kind': 'exception'}}
        ], recursive := true) FROM (SELECT *, {host('url')} AS h FROM pages))
    WHERE suffix IS NOT NULL
    UNION SELECT unnest([{quoted(PUBLIC_SUFFIXES)}]), 'normal')"""


def host_domains(source: str) -> str:
    """CTEs that end in ``host_domains(h, domain)`` for the hosts of ``source``'s URLs."""
    ip = "regexp_matches(name, '^\\[|^[0-9]{1,3}([.][0-9]{1,3}){3}$')"
    return f"""{SUFFIXES},
    host_labels AS (SELECT h, rtrim(h, '.') AS name, string_split(rtrim(h, '.'), '.') AS l
        FROM (SELECT DISTINCT {host('url')} AS h FROM {source} WHERE url IS NOT NULL)),
    host_tails AS (SELECT h, len(l) AS n, k, array_to_string(l[len(l) - k + 1:], '.') AS suffix
        FROM (SELECT *, unnest(range(1, len(l) + 1)) AS k FROM host_labels) WHERE NOT {ip}),
    host_rules AS (SELECT h, max(CASE WHEN kind = 'exception' THEN k END) AS exc,
            max(CASE WHEN kind = 'normal' THEN k WHEN kind = 'wildcard' AND k < n THEN k + 1 END) AS len_
        FROM host_tails JOIN suffix_rules USING (suffix) GROUP BY h),
    host_domains AS MATERIALIZED (SELECT h, CASE WHEN {ip} THEN name
            ELSE array_to_string(l[greatest(1, len(l) - coalesce(exc, coalesce(len_, 1) + 1) + 1):], '.') END AS domain
        FROM host_labels LEFT JOIN host_rules USING (h))"""


HOSTS = r"""hosts_ AS (
    SELECT unnest([url, regexp_replace(url, '://', '://a.b.'), regexp_replace(url, '[.](com|org|net)/', '.co.uk./', 'g'),
        'http://10.1.2.' || page_id % 250 || ':8080/x', 'http://[2001:db8::' || page_id % 10 || ']:80/',
        upper(regexp_replace(url, '[.](com|org|net)/', '.INFO:81/', 'g')), 'http://Net/', 'page ' || page_id, NULL]) AS url FROM pages)"""

WWW = r"CASE WHEN d = '' THEN 'Domain not found' ELSE d END"
FORM_A = r"regexp_extract(url, 'https?://www\.(.+?)\.[a-z]{3}', 1)"
FORM_B = r"regexp_extract(url, 'https?://www\.(.+?)\.(co[a-z]|edu|gov|net|org)', 1)"

FETCH_LOG = f"""fetch_log AS (
    SELECT CASE WHEN p.page_id % 17 = 9 THEN 'mailto:' || p.page_id ELSE p.url END AS url,
        epoch_ms(({START_MS} + p.page_id * {PERIOD_MS})::bigint) AS date,
        (p.page_id % 3 + 1)::int AS attempt,
        CASE p.page_id % 10 WHEN 1 THEN 301 WHEN 2 THEN 302 WHEN 3 THEN 303 WHEN 4 THEN 408
            WHEN 5 THEN 502 WHEN 6 THEN 404 WHEN 7 THEN 503 WHEN 8 THEN 307 ELSE 200 END AS status,
        t.url AS moved_to,
        CASE WHEN p.page_id % 7 = 0 THEN p.url || '?s=1' ELSE p.url END AS fetched_url,
        CASE WHEN p.page_id % 9 = 4 THEN NULL WHEN p.page_id % 11 = 5 THEN ''
            WHEN p.page_id % 13 = 6 THEN '%PDF-1.4 ' || p.url ELSE p.html END AS html
    FROM pages p LEFT JOIN pages t ON t.page_id = CASE
        WHEN p.page_id % 10 IN (1, 2) THEN p.page_id + 1
        WHEN p.page_id % 10 = 3 AND p.page_id // 10 % 3 = 1 THEN p.page_id + 1
        WHEN p.page_id % 10 = 3 AND p.page_id // 10 % 3 = 2 THEN p.page_id - 2 END)"""

ROBOTS = r"""bodies AS (
    SELECT host, CASE m % 3
        WHEN 0 THEN '# hello|User-agent: *|Disallow: /de/ # german|Allow: /de/4||User-agent: otherbot|Disallow: /|'
        WHEN 1 THEN 'User-agent: otherbot|Disallow: /fr/|USER-AGENT: MyCrawlflow/1.0|Disallow: /en/7*|Disallow:   /es/  |Sitemap: /map|'
        ELSE 'Disallow: /before|User-agent: *|Disallow:|allow: /en/|' END AS body
    FROM (SELECT {host} AS host, min(page_id) AS m FROM pages GROUP BY 1)),
lines AS (
    SELECT host, unnest(string_split(body, '|')) AS line, unnest(range(len(string_split(body, '|')))) AS pos
    FROM bodies),
agents AS (
    SELECT host, pos, trim(regexp_replace(line, '#.*$', '')) AS line,
        last_value(CASE WHEN regexp_matches(line, '(?i)^user-agent:')
            THEN lower(trim(regexp_replace(line, '(?i)^user-agent:', ''))) END IGNORE NULLS)
            OVER (PARTITION BY host ORDER BY pos) AS agent
    FROM lines),
rules AS (
    SELECT DISTINCT host, lower(regexp_extract(line, '(?i)^(allow|disallow):', 1)) AS kind,
        trim(regexp_replace(regexp_replace(line, '(?i)^(allow|disallow):', ''), '\*$', '')) AS prefix
    FROM agents
    WHERE (agent = '*' OR agent LIKE '%crawlflow%') AND regexp_matches(line, '(?i)^(allow|disallow): *[^ ]'))""".replace(
    "{host}", host("url")
)

LINK = r"""regexp_extract_all(seen, '(?i)<(?:a|area|link|img|iframe|frame|embed)\s[^>]*>')"""
TARGET = r"""replace(trim(regexp_replace(regexp_extract(g, '(?i)\s(?:href|src)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '["'']', '', 'g')), '&amp;', '&')"""


def links(source: str, key: str) -> str:
    """CTEs ending in ``links(key, link)``; every page link of the data is root-relative."""
    resolved = f"""CASE WHEN t LIKE '//%' THEN regexp_extract(u, '^{NAME}:') || t
        WHEN t LIKE '/%' THEN regexp_extract(u, '^{NAME}://[^/?#]*') || t
        WHEN t LIKE '?%' THEN regexp_extract(u, '^[^?#]*') || t
        WHEN t LIKE '#%' THEN regexp_extract(u, '^[^?#]*')
        WHEN regexp_matches(t, '^{NAME}:') THEN t
        ELSE regexp_extract(regexp_extract(u, '^[^?#]*'), '^.*/') || t END"""
    return f"""seen AS (
        SELECT {key}, url AS u, regexp_replace(html, '{UNSEEN}', ' ', 'g') AS seen FROM {source}),
    tags AS (SELECT {key}, u, unnest({LINK}) AS g FROM seen),
    targets AS (SELECT {key}, u, {TARGET} AS t FROM tags),
    spellings AS (
        SELECT DISTINCT {key}, t, {canonical(resolved)} AS link FROM targets
        WHERE t <> '' AND NOT regexp_matches(t, '(?i)javascript:|mailto:|@')),
    links AS (SELECT DISTINCT {key}, link FROM spellings)"""


def plain(text: str) -> str:
    for entity, char in ENTITIES:
        text = f"replace({text}, {quoted([entity])}, {quoted([char])})"
    return f"trim(regexp_replace({text}, '[ \\t\\r\\n\\f\\x{{A0}}]+', ' ', 'g'))"


WORDS = r"len(list_filter(string_split({t}, ' '), lambda w: regexp_matches(w, '[\p{L}\p{N}]')))"
ARTICLE = rf"""bodies AS (
    SELECT page_id, regexp_replace(regexp_replace(html, '{UNSEEN}', ' ', 'g'),
        '(?is)<(?:head\b[^>]*>.*?</head\s*>|/body\s*>.*)', '', 'g') AS b FROM pages),
marked AS (
    SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(b,
        '(?i)<a(?:\s[^>]*)?>', chr(1), 'g'), '(?i)</a\s*>', chr(2), 'g'),
        '(?i)</?(?:strike|u|b|i|em|strong|span|sup|sub|code|tt|var|abbr|acronym|font)(?:\s[^>]*)?>', '', 'g'),
        '<[^>]*>', chr(3), 'g') AS b FROM bodies),
raw AS (
    SELECT page_id, unnest(string_split(b, chr(3))) AS r,
        unnest(range(len(string_split(b, chr(3))))) AS n FROM marked),
texts AS (
    SELECT page_id, n, {plain("replace(replace(r, chr(1), ''), chr(2), '')")} AS text,
        {plain("array_to_string(regexp_extract_all(r, chr(1) || '([^' || chr(2) || ']*)' || chr(2), 1), ' ')")} AS anchors
    FROM raw),
blocks AS (
    SELECT page_id, n, text, {WORDS.replace('{t}', 'text')} AS words, {WORDS.replace('{t}', 'anchors')} AS linked
    FROM texts WHERE text <> ''),
judged AS (
    SELECT *, CASE WHEN words > 0 THEN linked / words ELSE 0.0 END AS ld FROM blocks),
beside AS (
    SELECT *, coalesce(lag(words) OVER w, 0) AS pw, coalesce(lag(ld) OVER w, 0.0) AS pl,
        coalesce(lead(words) OVER w, 0) AS nw
    FROM judged WINDOW w AS (PARTITION BY page_id ORDER BY n)),
content AS (
    SELECT *, ld <= 0.333333 AND CASE WHEN pl <= 0.555556
        THEN NOT (words <= 16 AND nw <= 15 AND pw <= 4)
        ELSE NOT (words <= 40 AND nw <= 17) END AS is_content FROM beside)"""



def token_rows(source: str, key: str) -> str:
    return f"""SELECT {key}, unnest(k) AS token, unnest(range(len(k)))::int AS pos FROM (
    SELECT {key}, list_filter(list_transform(
        regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+(?:[''’.][\\p{{L}}\\p{{N}}_]+)*'),
        lambda w: regexp_replace(lower(w), '[''’]s$', '')),
        lambda w: w NOT IN ({quoted(STOP_WORDS)})) AS k FROM {source})"""


SENTENCES = rf"""{ARTICLE},
placed AS (
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY n) AS n, text, words, is_content FROM content),
runs AS (
    SELECT *, count(*) FILTER (n = 1 OR NOT is_content) OVER (PARTITION BY page_id ORDER BY n) AS run FROM placed),
pieces AS (
    SELECT page_id, run, min(n) AS s, max(n) AS e, sum(words) AS w FROM runs GROUP BY ALL HAVING bool_or(is_content)),
gaps AS (
    SELECT *, s - lag(e, 1, -9) OVER (PARTITION BY page_id ORDER BY s) - 1 AS gap FROM pieces),
fused AS (
    SELECT *, count(*) FILTER (gap > 1) OVER (PARTITION BY page_id ORDER BY s) AS f FROM gaps),
largest AS (
    SELECT page_id, f FROM fused GROUP BY page_id, f
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY sum(w) DESC, f) = 1),
kept AS (
    SELECT page_id, n, text FROM runs JOIN fused USING (page_id, run) JOIN largest USING (page_id, f)
    WHERE len(list_filter(regexp_extract_all(text, '(.*?[\p{{L}}0-9])[,.:;!?]+(?:[ \n\r]+|$)', 1),
        lambda c: len(string_split(c, ' ')) >= 5)) > 0)"""


ARTICLE_LISTS = f"""{ARTICLE},
    articles AS (
        SELECT page_id, coalesce(t, '') AS text FROM pages LEFT JOIN (
            SELECT page_id, string_agg(text, chr(10) ORDER BY n) AS t FROM content WHERE is_content GROUP BY 1)
        USING (page_id)),
    toks AS ({token_rows('articles', 'page_id')}),
    {stem_ctes('toks')},
    lists AS (
        SELECT page_id, list(stem ORDER BY pos) AS tokens FROM toks JOIN stems ON w = token GROUP BY 1)"""
ARTICLE_TOKENS = f"""WITH {ARTICLE_LISTS}
    SELECT url, {DATE} AS date, text, coalesce(tokens, []) AS tokens
    FROM pages JOIN articles USING (page_id) LEFT JOIN lists USING (page_id)"""

VISITS = f"""visits AS (
    SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms,
        row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS k,
        lag(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS before
    FROM events)"""
THROTTLE_PLAN = f"""WITH {VISITS}
    SELECT event_id, user_id, (k * {EVENT_DELAY_MS} + max(ms - k * {EVENT_DELAY_MS})
        OVER (PARTITION BY user_id ORDER BY k))::bigint AS release_ms FROM visits"""

OFFERED = f"""offered AS (
    SELECT idx, url, {WWW} AS domain FROM (
        SELECT row_number() OVER (ORDER BY page_id) AS idx, url, {FORM_A} AS d FROM pages))"""

HEAD_ROWS = f"""lines AS (
    SELECT substr(url, 1, least(length(url) - 1, {MAX_SUBSTRING})) AS line, strlen(html)::int AS size FROM pages),
lens AS (SELECT line, size, unnest(range(1, least(length(line), {MAX_SUBSTRING}) + 1)) AS l FROM lines),
cuts AS (SELECT line, size, l, unnest(range(1, length(line) - l + 2)) AS a FROM lens),
envelopes AS (
    SELECT substr(line, 1, a - 1) AS prefix, substr(line, a + l) AS suffix, substr(line, a, l) AS substr, size
    FROM cuts)"""
FULL_ROWS = HEAD_ROWS.replace(
    f"substr(url, 1, least(length(url) - 1, {MAX_SUBSTRING})) AS line", "url AS line"
)
BUCKETS = f"""buckets AS (
    SELECT prefix, suffix, count(*) AS n FROM envelopes GROUP BY ALL HAVING count(*) BETWEEN 2 AND {MAX_BUCKET})"""


def likely(rows: str, similar: str) -> str:
    return f"""{rows}, {BUCKETS},
    kept AS (SELECT e.* FROM envelopes e JOIN buckets USING (prefix, suffix)),
    likely AS (
        SELECT x.substr AS alpha, y.substr AS beta, count(*)::bigint AS support
        FROM kept x JOIN kept y ON x.prefix = y.prefix AND x.suffix = y.suffix
        WHERE x.substr <> y.substr AND {similar} GROUP BY ALL)"""


LITERAL = "abs(x.size - y.size) // x.size < 0.2"
WITHIN_20 = "100 * abs(x.size - y.size) < 20 * x.size"


def ranked(direction: str = "") -> str:
    return f"""ranked AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY support {direction}, alpha, beta) - 1 AS pos, alpha, beta, support
    FROM likely)"""


def refines(a1: str, b1: str, a2: str, b2: str, literal: bool) -> str:
    parts = f"string_split({a2}, {a1})"
    at = f"(list_sum(list_transform({parts}[1:k], lambda s: length(s)))::bigint + (k - 1) * length({a1}))"
    before = f"substr({a2}, {at} + 1)" if literal else f"substr({a2}, 1, {at})"
    after = f"substr({a2}, {at} + length({a1}) + 1)"
    return f"""(contains({a2}, {a1}) AND len(list_filter(range(1, len({parts})),
        lambda k: {before} || {b1} || {after} = {b2})) > 0)"""


def pairs(literal: bool = False) -> str:
    forward = refines("x.alpha", "x.beta", "y.alpha", "y.beta", literal)
    backward = refines("y.alpha", "y.beta", "x.alpha", "x.beta", literal)
    return f"""offsets AS (SELECT unnest(range(1, {WINDOW} + 1)) AS o),
    near AS (SELECT pos, alpha, beta, support, pos + o AS other FROM ranked, offsets),
    pairs AS MATERIALIZED (
        SELECT pos_i, pos_j, kind FROM (
            SELECT x.pos AS pos_i, y.pos AS pos_j,
                CASE WHEN {forward} THEN 'fwd' WHEN {backward} THEN 'bwd' END AS kind
            FROM near x JOIN ranked y ON y.pos = x.other
            WHERE x.support - y.support <= greatest(6 - x.support, 10))
        WHERE kind IS NOT NULL)"""


def all_pairs() -> str:
    forward = refines("x.alpha", "x.beta", "y.alpha", "y.beta", False)
    backward = refines("y.alpha", "y.beta", "x.alpha", "x.beta", False)
    return f"""pairs AS MATERIALIZED (
        SELECT pos_i, pos_j, kind FROM (
            SELECT x.pos AS pos_i, y.pos AS pos_j,
                CASE WHEN {forward} THEN 'fwd' WHEN {backward} THEN 'bwd' END AS kind
            FROM ranked x JOIN ranked y ON length(y.beta) - length(y.alpha) = length(x.beta) - length(x.alpha)
            WHERE x.pos < y.pos AND (contains(x.alpha, y.alpha) AND contains(x.beta, y.beta)
                    OR contains(y.alpha, x.alpha) AND contains(y.beta, x.beta))
                AND x.support - y.support <= greatest(6 - x.support, 10))
        WHERE kind IS NOT NULL)"""


def final_rules(literal: bool = False) -> str:
    """Elimination level by level: a refinement goes up in alpha, then in beta length."""
    levels = [(a, b) for a in range(1, MAX_SUBSTRING + 1) for b in range(1, MAX_SUBSTRING + 1)]
    if not literal:
        levels = [(a, None) for a in range(1, MAX_SUBSTRING + 1)]
    parts = [
        """stops AS (SELECT pos_i, min(pos_j) AS stop FROM pairs WHERE kind = 'bwd' GROUP BY 1),
        edges AS MATERIALIZED (
            SELECT p.pos_i, p.pos_j FROM pairs p LEFT JOIN stops s USING (pos_i)
            WHERE kind = 'fwd' AND (stop IS NULL OR p.pos_j < stop)),
        dead_0 AS (SELECT pos FROM ranked WHERE false)"""
    ]
    for i, (a, b) in enumerate(levels, 1):
        level = f"length(alpha) = {a}" + (f" AND length(beta) = {b}" if b else "")
        parts.append(
            f"""dead_{i} AS MATERIALIZED (
            SELECT pos FROM dead_{i - 1} UNION ALL
            SELECT DISTINCT pos_j FROM edges JOIN ranked ON pos = pos_j
            WHERE {level} AND pos_i NOT IN (SELECT pos FROM dead_{i - 1}))"""
        )
    return ",\n".join(parts) + f"""
    SELECT alpha, beta FROM ranked WHERE pos NOT IN (SELECT pos FROM dead_{len(levels)})
        AND pos NOT IN (SELECT pos_i FROM stops)"""


def rewritten() -> str:
    rules = [
        ("#top", ""), ("?utm_source=feed", ""), (".html", ""), ("http://", "https://"),
        ("://www.", "://"), ("://m.", "://"), ("?page=2&ref=x", ""), ("spam-farm", "cheap-pills"),
    ]
    text = "url"
    for alpha, beta in rules * 2:
        text = f"replace({text}, '{alpha}', '{beta}')"
    return text


SPELLED = f"""spelled AS (
    SELECT unnest(list_distinct([url, CASE page_id % 4 WHEN 0 THEN url || '/index.html' WHEN 1 THEN url || '?sid=1'
        WHEN 2 THEN url || '#top' ELSE replace(url, '/en/', '/en-us/') END])) AS url, html FROM pages)"""


def nested(ctes: str, name: str = "final") -> str:
    """CTEs that end in a SELECT, with that as one more CTE."""
    at = ctes.rindex("\n    SELECT alpha, beta FROM ranked")
    return f"{ctes[:at]},\n    {name} AS ({ctes[at:]})"


def applied(min_support: int) -> str:
    """Rules of the spelled pages by most support, one an alpha, applied round by round until none fits."""
    rows = FULL_ROWS.replace("FROM pages", "FROM spelled")
    mined = likely(rows, WITHIN_20).replace("    likely AS (", "    every AS (")
    return f"""WITH RECURSIVE {SPELLED}, {mined},
    likely AS (SELECT * FROM every WHERE support >= {min_support}
        AND (length(beta) < length(alpha) OR length(beta) = length(alpha) AND beta < alpha)),
    {ranked('DESC')}, {pairs()}, {nested(final_rules())},
    rules AS (SELECT alpha, min({{'pos': -support, 'beta': beta}}) AS due FROM final JOIN likely USING (alpha, beta) GROUP BY 1),
    starts AS (SELECT DISTINCT url AS origin, regexp_extract(url, '^{NAME}://[^/?#]*') AS head FROM spelled),
    rounds AS (
        SELECT origin, substr(origin, length(head) + 1) AS rest, 0 AS n FROM starts
        UNION ALL
        SELECT origin, list_reduce(list_prepend({{'a': '', 'b': any_value(rest)}},
            list({{'a': alpha, 'b': due.beta}} ORDER BY due.pos, due.beta, alpha)),
            lambda x, y: {{'a': '', 'b': replace(x.b, y.a, y.b)}}).b, n + 1
        FROM rounds JOIN rules ON contains(rest, alpha) GROUP BY origin, n)
    SELECT s.url, head || last.rest AS canonical_url
    FROM spelled s JOIN starts ON origin = s.url
    JOIN (SELECT origin, max_by(rest, n) AS rest FROM rounds GROUP BY 1) last USING (origin)"""


def spread(source: str, more: str = "", workers: int = 4) -> str:
    return f"""WITH {OFFERED},
        shares AS (SELECT *, CASE WHEN idx > 1 THEN 100.0::double * count(*) OVER (PARTITION BY domain ORDER BY idx
            RANGE BETWEEN 100 PRECEDING AND 1 PRECEDING) / least(idx - 1, 100) ELSE 0.0::double END AS share FROM offered),
        sized AS (SELECT idx, url, domain, count(*) OVER (PARTITION BY domain) AS size FROM {source}),
        dealt AS (SELECT *, (row_number() OVER (ORDER BY size DESC, domain, idx) - 1) % {workers} AS w FROM sized),
        parts AS (SELECT *, count(*) OVER (PARTITION BY w, domain) AS own FROM dealt),
        tops AS (SELECT *, domain = first_value(domain) OVER (PARTITION BY w ORDER BY own DESC, size DESC, domain, idx) AS top FROM parts),
        queues AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY top DESC, size DESC, domain, idx) - 1 AS q FROM tops),
        room AS (SELECT w, count(*) FILTER (NOT top) + 1 AS most FROM queues GROUP BY w),
        kept AS (SELECT queues.*, row_number() OVER (PARTITION BY w ORDER BY q) - 1 AS k, count(*) OVER (PARTITION BY w) AS n
            FROM queues JOIN room USING (w) WHERE NOT top OR q < most)
        SELECT idx, url, domain, w::int AS worker, (CASE WHEN 2 * k < n THEN 2 * k ELSE 2 * (k - (n + 1) // 2) + 1 END)::bigint AS turn, NULL AS reason FROM kept
        UNION ALL SELECT idx, url, domain, NULL, NULL, 'no_worker' FROM queues JOIN room USING (w) WHERE top AND q >= most
        {more}"""


def frontier(seeds: str, log: str = f"{FETCH_LOG},") -> str:
    moved = "coalesce(status IN (301, 302, 303), false)"
    return f"""
        WITH {log}
        content AS (SELECT *, row_number() OVER (ORDER BY date) AS n FROM fetch_log
            WHERE NOT {moved} AND html <> '' AND {IS_HTML}),
        {links('content', 'n')},
        rows_ AS (
            {seeds} SELECT moved_to AS url, {NOW} AS date, 'redirect' AS origin, 1 AS attempt
            FROM fetch_log WHERE {moved} AND moved_to IS NOT NULL
            UNION ALL SELECT url, {NOW}, 'retry', attempt + 1 FROM fetch_log
            WHERE status IN (408, 502, 503) AND attempt < 3
            UNION ALL SELECT link, {NOW}, 'outlink', 1 FROM links WHERE link IS NOT NULL)
        SELECT url, date, origin, attempt::int AS attempt FROM (
            SELECT {canonical('url')} AS url, date, origin, attempt FROM rows_)
        WHERE url IS NOT NULL AND NOT {REJECTED.replace('{u}', 'url')}"""


def whole_flow(steps: int = 3) -> str:
    """Steps as CTEs, each from the one before; article tokens and links of a page are the same in all."""
    moved, retry = "coalesce(status IN (301, 302, 303), false)", "coalesce(status IN (408, 502, 503), false)"
    parts = [f"""{FETCH_LOG}, {ROBOTS.replace('bodies', 'files').replace('lines AS', 'file_lines AS').replace('FROM lines', 'FROM file_lines')},
    web AS MATERIALIZED (SELECT url, unnest(min({{'date': date, 'status': status, 'moved_to': moved_to, 'fetched_url': fetched_url, 'html': html, 'page_id': page_id}}))
        FROM (SELECT l.* REPLACE ({canonical('l.url')} AS url), p.page_id FROM fetch_log l JOIN (SELECT page_id, {DATE} AS date FROM pages) p USING (date))
        WHERE url IS NOT NULL GROUP BY url),
    {host_domains('pages')},
    {ARTICLE_LISTS},
    fetched AS (SELECT * FROM web WHERE html <> '' AND {IS_HTML}),
    {links('fetched', 'page_id')},
    inbox_0 AS (SELECT url, {DATE} AS date, 'seed' AS origin, 1 AS attempt FROM pages)"""]
    for k in range(steps):
        before = " UNION ALL ".join(f"SELECT url, attempt, domain, release_ms FROM planned_{j}" for j in range(k))
        before = before or "SELECT NULL AS url, NULL AS attempt, NULL AS domain, NULL::bigint AS release_ms WHERE false"
        parts.append(f"""
    canon_{k} AS MATERIALIZED (SELECT url AS given, {canonical('url')} AS url, date, origin, attempt FROM inbox_{k}),
    hits_{k} AS (SELECT url, bool_or(kind = 'disallow') AND NOT bool_or(kind = 'allow') AS denied FROM (SELECT DISTINCT url FROM canon_{k})
        JOIN rules ON host = {host('url')} AND starts_with({path('url')}, prefix) GROUP BY 1),
    judged_{k} AS MATERIALIZED (SELECT c.*, CASE WHEN url IS NULL THEN 'invalid_url' WHEN {REJECTED.replace('{u}', 'url')} THEN 'rejected'
        WHEN denied THEN 'robots_denied' END AS reason FROM canon_{k} c LEFT JOIN hits_{k} USING (url)),
    before_{k} AS ({before}),
    new_{k} AS (SELECT url, attempt, unnest(min({{'date': date, 'origin': origin}})), any_value(domain) AS domain FROM judged_{k} LEFT JOIN host_domains ON h = {host('url')}
        WHERE reason IS NULL AND NOT EXISTS (SELECT 1 FROM before_{k} b WHERE b.url = judged_{k}.url AND b.attempt = judged_{k}.attempt)
        GROUP BY url, attempt),
    ranked_{k} AS (SELECT *, epoch_ms(date) AS ms, row_number() OVER (PARTITION BY domain ORDER BY epoch_ms(date), url || '#' || attempt) AS k FROM new_{k}),
    planned_{k} AS MATERIALIZED (SELECT r.* EXCLUDE (k, ms), (k * 1000 + greatest(max(ms - k * 1000) OVER (PARTITION BY domain ORDER BY k), last))::bigint AS release_ms
        FROM ranked_{k} r LEFT JOIN (SELECT domain, max(release_ms) AS last FROM before_{k} GROUP BY 1) USING (domain)),
    log_{k} AS MATERIALIZED (SELECT p.url, p.attempt, status, moved_to, html, page_id FROM planned_{k} p LEFT JOIN web USING (url)),
    inbox_{k + 1} AS (
        SELECT moved_to AS url, {NOW} AS date, 'redirect' AS origin, 1 AS attempt FROM log_{k} WHERE {moved} AND moved_to IS NOT NULL
        UNION ALL SELECT url, {NOW}, 'retry', attempt + 1 FROM log_{k} WHERE {retry} AND attempt < 3
        UNION ALL SELECT link, {NOW}, 'outlink', 1 FROM log_{k} JOIN links USING (page_id) WHERE NOT {moved} AND html <> '' AND {IS_HTML}),
    dropped_{k} AS (SELECT given AS url, reason FROM judged_{k} WHERE reason IS NOT NULL
        UNION ALL SELECT * FROM (SELECT url, CASE WHEN {moved} AND moved_to IS NULL THEN 'moved_without_target'
            WHEN {retry} AND attempt >= 3 THEN 'retries_exhausted' WHEN {moved} THEN NULL WHEN html IS NULL THEN 'not_fetched'
            WHEN html = '' THEN 'empty_page' WHEN NOT {IS_HTML} THEN 'not_html' END AS reason FROM log_{k}) WHERE reason IS NOT NULL)""")
    nothing = {"attempt": "int", "origin": "varchar", "release_ms": "bigint", "reason": "varchar", "tokens": "varchar[]"}

    def out(k: int, sink: str, source: str, **have: str) -> str:
        cells = ", ".join(f"{have.get(c, 'NULL')}::{t} AS {c}" for c, t in nothing.items())
        return f"SELECT {k} AS step, '{sink}' AS sink, url, {cells} FROM {source}"

    return "WITH " + ",".join(parts) + " UNION ALL ".join(
        "\n" + x
        for k in range(steps)
        for x in (
            out(k, "planned", f"planned_{k}", attempt="attempt", origin="origin", release_ms="release_ms"),
            out(k, "article", f"(SELECT url, coalesce(tokens, []) AS tokens FROM log_{k} LEFT JOIN lists USING (page_id) WHERE NOT {moved} AND html <> '' AND {IS_HTML})", tokens="tokens"),
            out(k, "dropped", f"dropped_{k}", reason="reason"),
            out(k, "frontier", f"inbox_{k + 1}", attempt="attempt", origin="origin"),
        )
    )


def row_accounts(left: str) -> str:
    """Outcomes from the log and links; what the outputs hold from their own twins."""
    moved, bad = "coalesce(status IN (301, 302, 303), false)", REJECTED.replace("{u}", "url")
    at = f"(epoch_ms(date) - {START_MS}) // {PERIOD_MS}"
    log = f"""{FETCH_LOG.replace('fetch_log AS', 'plain_log AS')},
        fetch_log AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {at} % 30 = 20 THEN NULL ELSE status END AS status,
            CASE {at} % 40 WHEN 1 THEN 'mailto:x' WHEN 11 THEN regexp_extract(url, '^{NAME}://[^/?#]*') || '/moved.css'
                WHEN 21 THEN regexp_extract(url, '^{NAME}://[^/?#]*') || '/moved' ELSE moved_to END AS moved_to,
            CASE WHEN {at} % 6 = 0 THEN replace(html, '</body>', '{ODD_LINKS}') ELSE html END AS html) FROM plain_log)"""
    return f"""
        WITH {log},
        reported AS MATERIALIZED ({left}),
        back AS MATERIALIZED ({frontier('', '')}),
        content AS (SELECT *, row_number() OVER (ORDER BY date) AS n FROM fetch_log
            WHERE NOT {moved} AND html <> '' AND {IS_HTML}),
        {links('content', 'n')},
        sent AS (
            SELECT 'redirect' AS kind, {canonical('moved_to')} AS url, row_number() OVER () AS owner FROM fetch_log WHERE {moved} AND moved_to IS NOT NULL
            UNION ALL SELECT 'retry', {canonical('url')}, row_number() OVER () FROM fetch_log WHERE status IN (408, 502, 503) AND attempt < 3
            UNION ALL SELECT 'outlink', link, n FROM spellings),
        judged AS (SELECT kind, CASE WHEN url IS NULL THEN 'invalid' WHEN {bad} THEN 'rejected'
            WHEN row_number() OVER (PARTITION BY kind, owner, url) > 1 THEN 'repeated' ELSE 'admitted' END AS outcome FROM sent),
        kept AS (SELECT CASE WHEN NOT {moved} THEN 'content' ELSE 'sent_on' END AS outcome FROM fetch_log
            WHERE {canonical('url')} IS NOT NULL AND CASE WHEN {moved} THEN moved_to IS NOT NULL
                ELSE html <> '' AND {IS_HTML} AND NOT coalesce(status IN (408, 502, 503) AND attempt >= 3, false) END)
        SELECT kind, outcome, count(*) AS n, CASE WHEN kind = 'result' AND outcome <> 'sent_on' THEN count(*)
            WHEN outcome = 'admitted' THEN (SELECT count(*) FROM back WHERE origin = kind) END AS n_out
        FROM (SELECT * FROM judged UNION ALL SELECT 'result', reason FROM reported UNION ALL SELECT 'result', outcome FROM kept
            UNION ALL SELECT 'status', CASE WHEN status IS NULL THEN 'no_status' ELSE 'given' END FROM fetch_log)
        GROUP BY kind, outcome"""


def _queries() -> dict[str, str]:
    moved = "status IN (301, 302, 303)"
    retry = "status IN (408, 502, 503)"
    head, full = likely(HEAD_ROWS, LITERAL), likely(FULL_ROWS, LITERAL)
    over = f"SELECT prefix, suffix, count(*) AS n FROM envelopes GROUP BY ALL HAVING count(*) > {MAX_BUCKET}"
    feed = f"""
            SELECT seq, url, epoch_ms(({START_MS} + seq * {PERIOD_MS})::bigint) AS date FROM (
                SELECT row_number() OVER (ORDER BY page_id) - 1 + r * (SELECT count(*) FROM pages) AS seq, url
                FROM pages, range(2) t(r))""".replace("OVER (ORDER BY page_id)", "OVER (PARTITION BY r ORDER BY page_id)")
    known = f"coalesce({moved}, false)"
    left = f"""
            SELECT url, reason FROM (SELECT url, CASE WHEN {canonical('url')} IS NULL THEN 'invalid_url'
                WHEN {known} AND moved_to IS NULL THEN 'moved_without_target'
                WHEN {retry} AND attempt >= 3 THEN 'retries_exhausted'
                WHEN NOT {known} AND html IS NULL THEN 'not_fetched'
                WHEN NOT {known} AND html = '' THEN 'empty_page'
                WHEN NOT {known} AND NOT {IS_HTML} THEN 'not_html' END AS reason FROM fetch_log)
            WHERE reason IS NOT NULL"""
    return {
        "seed_scan": "SELECT url FROM pages",
        "seed_feed": feed,
        "stream_seed_feed": feed,
        "size_log": """
            WITH lines AS (SELECT CASE page_id % 6 WHEN 1 THEN url
                WHEN 2 THEN url || ', ' || strlen(html) WHEN 3 THEN url || ',+' || strlen(html)
                WHEN 4 THEN url || ',-' || strlen(html) WHEN 5 THEN url || ',' || strlen(html) || ',zzz'
                ELSE url || ',' || strlen(html) || CASE WHEN page_id % 12 = 6 THEN '0000000' ELSE '' END END AS v
                FROM pages)
            SELECT split_part(v, ',', 1) AS url, try_cast(split_part(v, ',', 2) AS int) AS size FROM lines
            WHERE regexp_matches(split_part(v, ',', 2), '^[+-]?[0-9]+$') AND try_cast(split_part(v, ',', 2) AS int) > 0""",
        "page_size_log": "SELECT url, strlen(html)::int AS size FROM pages",
        "seed_append": """
            SELECT DISTINCT url FROM (
                SELECT regexp_extract(url, '^[a-z]+://[^/]*') || '/' AS url FROM pages
                UNION ALL SELECT url FROM pages WHERE page_id % 2 = 0
                UNION ALL SELECT unnest(['www.google.com', 'www.yahoo.com']))
            WHERE url NOT IN (SELECT url FROM pages)""",
        "publish_frame": "SELECT 'urls' AS topic, url AS value, 0 AS partition FROM pages",
        "url_canonical": f"WITH {VARIANTS} SELECT page_id, variant, {canonical('url')} AS canonical_url FROM variants",
        "url_reject_filter": f"""
            SELECT url FROM (SELECT unnest([url, url || '.css', url || '.js?v=1', url || '.CSS', url || '.tgz',
                url || '.png', replace(url, 'http', 'ftp'), 'mailto:' || page_id || '@example.com',
                'file://' || page_id || '.gz']) AS url FROM pages)
            WHERE NOT {REJECTED.replace('{u}', 'url')}""",
        "domain_www": f"WITH {SAMPLES} SELECT url, {WWW} AS domain FROM (SELECT url, {FORM_A} AS d FROM samples)",
        "domain_tld": f"WITH {SAMPLES} SELECT url, {WWW} AS domain FROM (SELECT url, {FORM_B} AS d FROM samples)",
        "domain_registered": f"""
            WITH {SAMPLES}, labels_ AS (SELECT url, string_split({host('url')}, '.') AS l FROM samples)
            SELECT url, CASE WHEN array_to_string(l[-2:], '.') IN ({quoted(PUBLIC_SUFFIXES)})
                THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain FROM labels_""",
        "domain_by_suffix": f"""
            WITH {HOSTS}, {host_domains('hosts_')} SELECT url, domain FROM hosts_ LEFT JOIN host_domains ON h = {host('url')}""",
        "throttle_domains": f"""
            WITH {host_domains('pages')},
            turns AS (SELECT page_id, domain, {START_MS} + page_id * {PERIOD_MS} AS ms,
                row_number() OVER (PARTITION BY domain ORDER BY page_id) AS k FROM pages LEFT JOIN host_domains ON h = {host('url')})
            SELECT page_id, domain, (k * 1000 + max(ms - k * 1000) OVER (PARTITION BY domain ORDER BY k))::bigint AS release_ms FROM turns""",
        "robots_rules": f"WITH {ROBOTS} SELECT host, kind, prefix FROM rules",
        "robots_filter": f"""
            WITH {ROBOTS}, urls AS (SELECT page_id, {canonical('url')} AS url FROM pages),
            hits AS (SELECT page_id, bool_or(kind = 'allow') AS allowed, bool_or(kind = 'disallow') AS denied
                FROM urls JOIN rules ON host = {host('url')} AND starts_with({path('url')}, prefix) GROUP BY 1)
            SELECT page_id, url FROM urls LEFT JOIN hits USING (page_id)
            WHERE NOT coalesce(denied AND NOT allowed, false)""",
        "fetch_route": f"""
            WITH {FETCH_LOG}
            SELECT moved_to AS url, 'frontier' AS stream, {NOW} AS date, url IS DISTINCT FROM fetched_url AS redirected
            FROM fetch_log WHERE {moved} AND moved_to IS NOT NULL
            UNION ALL SELECT url, 'frontier', {NOW}, url IS DISTINCT FROM fetched_url FROM fetch_log WHERE {retry}
            UNION ALL SELECT url, 'content', date, url IS DISTINCT FROM fetched_url FROM fetch_log
            WHERE NOT {moved} AND html IS NOT NULL""",
        "redirect_resolve": f"""
            WITH RECURSIVE {FETCH_LOG},
            moves AS (SELECT url, max_by(target, {{'date': date, 'target': target}}) AS moved_to FROM (
                SELECT coalesce({canonical('url')}, url) AS url, coalesce({canonical('moved_to')}, moved_to) AS target, date
                FROM fetch_log WHERE {moved} AND moved_to IS NOT NULL) GROUP BY 1),
            chain AS (
                SELECT url, moved_to AS target, 1::bigint AS hops FROM moves
                UNION ALL
                SELECT c.url, m.moved_to, c.hops + 1 FROM chain c JOIN moves m ON m.url = c.target WHERE c.hops < 50)
            SELECT m.url, e.target AS final_url, e.hops FROM moves m LEFT JOIN (
                SELECT * FROM chain WHERE target NOT IN (SELECT url FROM moves)) e USING (url)""",
        "html_gate": f"WITH {FETCH_LOG} SELECT url FROM fetch_log WHERE html <> '' AND {IS_HTML}",
        "out_links": f"WITH {links('pages', 'page_id')} SELECT page_id, link FROM links WHERE link IS NOT NULL",
        "frontier": frontier(
            f"SELECT url, {DATE} AS date, 'seed' AS origin, 1 AS attempt FROM pages UNION ALL"
        ),
        "stream_frontier_feedback": frontier(""),
        "quarantine": f"WITH {FETCH_LOG} {left}",
        "row_accounts": row_accounts(left),
        "article_text": f"""
            WITH {ARTICLE}
            SELECT page_id, coalesce(t, '') AS text FROM pages LEFT JOIN (
                SELECT page_id, string_agg(text, chr(10) ORDER BY n) AS t FROM content WHERE is_content GROUP BY 1)
            USING (page_id)""",
        "article_sentences": f"""
            WITH {SENTENCES}
            SELECT page_id, coalesce(k, 0)::int AS paragraphs, coalesce(t, '') AS text FROM pages LEFT JOIN (
                SELECT page_id, count(*) AS k, string_agg(text, chr(10) ORDER BY n) AS t FROM kept GROUP BY 1)
            USING (page_id)""",
        "article_sentence_tokens": ARTICLE_TOKENS.replace(ARTICLE, SENTENCES, 1).replace(
            "FROM content WHERE is_content", "FROM kept", 1),
        "article_stats": f"""
            WITH {ARTICLE},
            sums AS (SELECT page_id, sum(words) AS b, sum(words) FILTER (is_content) AS a,
                count(*) FILTER (is_content) AS c FROM content GROUP BY 1),
            stats AS (SELECT page_id, coalesce(b, 0)::int AS words_before, coalesce(a, 0)::int AS words_after,
                CASE WHEN c > 0 THEN a::double / c ELSE 0.0::double END AS avg_block_words
                FROM pages LEFT JOIN sums USING (page_id))
            SELECT *, words_before < 90 OR words_after < 70 OR avg_block_words < 25 AS low_quality FROM stats""",
        "tokens": token_rows("documents", "doc_id"),
        "token_stems": f"""
            WITH toks AS ({token_rows('documents', 'doc_id')}), {stem_ctes('toks')}
            SELECT doc_id, pos, stem FROM toks JOIN stems ON w = token""",
        "crawl_pipeline": whole_flow(),
        "stream_pipeline": whole_flow(),
        "article_tokens": ARTICLE_TOKENS,
        "stream_article_tokens": ARTICLE_TOKENS,
        "throttle_gap": f"""
            WITH {VISITS}
            SELECT event_id, user_id, coalesce(greatest(0, {EVENT_DELAY_MS} - (ms - before)), 0)::bigint AS wait_ms
            FROM visits""",
        "throttle_plan": THROTTLE_PLAN,
        "stream_throttle_plan": THROTTLE_PLAN,
        "recent_domain_share": f"""
            WITH {OFFERED}, shares AS (
                SELECT idx, domain, CASE WHEN idx > 1 THEN 100.0::double * count(*) OVER (
                    PARTITION BY domain ORDER BY idx RANGE BETWEEN 100 PRECEDING AND 1 PRECEDING)
                    / least(idx - 1, 100) ELSE 0.0::double END AS share FROM offered)
            SELECT idx, domain, share, share > 15 AS overloaded FROM shares""",
        "recent_urls": f"WITH {OFFERED} SELECT idx, url FROM offered ORDER BY idx DESC LIMIT 100",
        "spread_workers": spread("offered"),
        "schedule_workers": spread("(SELECT * FROM shares WHERE share <= 15)", "UNION ALL SELECT idx, url, domain, NULL, NULL, 'overloaded' FROM shares WHERE share > 15"),
        "dust_envelopes": f"WITH {FULL_ROWS} SELECT prefix, suffix, substr, size FROM envelopes",
        "dust_buckets": f"WITH {FULL_ROWS}, {BUCKETS} SELECT prefix, suffix, n FROM buckets",
        "dust_likely_rules": f"WITH {full} SELECT alpha, beta, support FROM likely",
        "dust_likely_rules_full": f"WITH {likely(FULL_ROWS, WITHIN_20)} SELECT alpha, beta, support FROM likely",
        "dust_ranked_rules": f"WITH {full}, {ranked()} SELECT pos, alpha, beta, support FROM ranked",
        "dust_refinements": f"WITH {full}, {ranked()}, {pairs()} SELECT pos_i, pos_j, kind FROM pairs",
        "dust_final_rules": f"WITH {full}, {ranked()}, {pairs()}, {final_rules()}",
        "dust_refinements_all": f"WITH {full}, {ranked()}, {all_pairs()} SELECT pos_i, pos_j, kind FROM pairs",
        "dust_final_rules_all": f"WITH {full}, {ranked()}, {all_pairs()}, {final_rules()}",
        "dust_final_rules_head": f"WITH {head}, {ranked()}, {pairs()}, {final_rules()}",
        "dust_overflow": f"WITH {FULL_ROWS} {over}",
        "dust_overflow_head": f"WITH {HEAD_ROWS} {over}",
        "dust_final_rules_literal": f"WITH {full}, {ranked()}, {pairs(True)}, {final_rules(True)}",
        "dust_final_rules_full": f"WITH {likely(FULL_ROWS, LITERAL)}, {ranked('DESC')}, {pairs()}, {final_rules()}",
        "dust_apply_mined": applied(3),
        "dust_apply_rules": f"SELECT url, {rewritten()} AS canonical_url FROM pages",
    }


ORACLE = _queries()
