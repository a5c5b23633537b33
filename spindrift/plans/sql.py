"""Oracles: the queries in the SQL of another engine, over the same tables."""

from __future__ import annotations

from spindrift.functions import device, text, urls
from spindrift.sources import fixtures as X


def q(v: str | float | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def steps(column: str, form: list[tuple]) -> str:
    for s in form:
        column = {
            "lower": lambda c: f"lower({c})", "sub": lambda c, s=s: f"regexp_replace({c}, {q(s[1])}, {q(s[2])}, 'g')", "extract": lambda c, s=s: f"regexp_extract({c}, {q(s[1])})", "crop": lambda c, s=s: f"left({c}, {s[1]})",
        }[s[0]](column)
    return column


def has(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, {q(w)})" for w in words) + ")"


def rules(c: str, table: list[tuple[list[str], str]]) -> str:
    return "CASE " + " ".join(f"WHEN {has(c, w)} THEN " + (f"regexp_extract({c}, {q(v[1:])})" if v[0] == "~" else q(v)) for w, v in table) + " END"


def names(values: list[str]) -> str:
    return ", ".join(q(v) for v in values)


def engine(c: str) -> str:
    return f"CASE WHEN {c} = '' THEN NULL " + " ".join(f"WHEN contains(lower({c}), {q(e)}) THEN {q(e)}" for e in device.ENGINES) + " END"


def values(rows: list[tuple], columns: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows) + f") AS t({columns})"


LIGHT = steps("url", urls.AD_LIGHT)
HOST = f"split_part({LIGHT}, '/', 1)"


def labels(n: int) -> str:
    return f"array_to_string(list_slice(string_split({HOST}, '.'), -{n}, -1), '.')"


UA = "lower(user_agent)"
HITS = f"""
n AS (SELECT count(*) AS n FROM pages),
raw_hits AS (
  SELECT e.event_id, e.ts, CAST(e.ts AS DATE) AS day, CASE WHEN e.event_id % 50 = 0 THEN '' ELSE CAST(e.user_id AS VARCHAR) END AS device, p.url, e.event_type AS owner_name, e.props,
    list_extract([{names(X.AGENTS)}], 1 + CAST((e.user_id + CASE WHEN e.event_id % 17 = 0 THEN 1 ELSE 0 END) % {len(X.AGENTS)} AS INT)) AS user_agent,
    list_extract([{names(X.REFERRERS)}], 1 + CAST(e.event_id % {len(X.REFERRERS)} AS INT)) AS referrer_host,
    CASE WHEN e.event_id % 97 = 0 THEN 'x' ELSE CAST((e.user_id * 7) % 120 AS VARCHAR) END AS age,
    list_extract(['0', '1', '2', NULL], 1 + CAST(e.user_id % 4 AS INT)) AS gender
  FROM events e CROSS JOIN n JOIN pages p ON p.page_id = e.event_id % n.n),
parsed AS (
  SELECT *, {rules(UA, device.BRANDS)} AS device_brand_name, {rules(UA, device.MARKETING)} AS marketing, {rules(UA, device.SYSTEMS)} AS os_name,
    CASE {" ".join(f"WHEN contains({UA}, {q(w)}) THEN regexp_extract({UA}, {q(p)}, {g})" for w, p, g in device.VERSIONS)} END AS os_version,
    CASE WHEN contains({UA}, 'firefox') THEN 'mozilla' WHEN contains({UA}, 'mac') AND NOT {has(UA, device.NOT_SAFARI)} THEN 'safari'
      {" ".join(f"WHEN contains({UA}, {q(w)}) THEN {q(v)}" for w, v in device.BROWSERS)} WHEN {UA} IS NULL OR {UA} = '' THEN NULL ELSE 'chrome' END AS browser_name
  FROM raw_hits WHERE device <> ''),
hits AS (
  SELECT * EXCLUDE (marketing), replace(marketing, 'build', '') AS device_marketing_name, {steps("url", urls.NORMALISED)} AS url_normalized,
    coalesce({engine("referrer_host")}, {engine("url")}) AS search_engine,
    CASE WHEN os_name IN ('windows', 'macos', 'linux') THEN 'desktop'
      WHEN os_name = 'ios' OR (os_name = 'android' AND (NOT marketing IN ('ipad', 'lnv_tab', 'galaxy_tab') OR marketing IS NULL OR device_brand_name IS NULL)) THEN 'mobile'
      WHEN marketing IN ('ipad', 'lnv_tab', 'galaxy_tab') THEN 'tablet' WHEN marketing = 'smart_tv' THEN 'TV' END AS device_category
  FROM parsed)"""
FIELDS = "device_category, device_brand_name, device_marketing_name, os_name, os_version, browser_name"
ORDERED = (
    HITS
    + """,
split AS (SELECT *, floor(epoch(ts)) AS sec, CASE WHEN floor(epoch(ts)) - lag(floor(epoch(ts))) OVER (PARTITION BY device ORDER BY ts) >= 1800 THEN 1 ELSE 0 END AS s FROM hits),
numbered AS (SELECT *, CAST(sum(s) OVER (PARTITION BY device ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS ordinal FROM split),
ordered AS (SELECT *, (sec - min(sec) OVER (PARTITION BY device, ordinal)) / 60.0 AS minutes, first_value(referrer_host) OVER (PARTITION BY device, ordinal ORDER BY ts, event_id) AS referrer_first FROM numbered)"""
)
SESSIONS = (
    ORDERED
    + f""",
sessions AS (SELECT device AS user_id, ordinal, {FIELDS}, max(minutes) AS total_minutes, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events, count(DISTINCT url) AS unique_page_views,
  max(referrer_first) AS referrer_first FROM ordered GROUP BY device, ordinal, {FIELDS}),
recent AS (SELECT * FROM sessions WHERE CAST(session_start AS DATE) >= DATE '2024-01-24' AND CAST(session_start AS DATE) <= DATE '2024-01-31')"""
)
VIEWS = ORDERED + f",\nviews AS (SELECT *, device AS user_id, list_filter(regexp_split_to_array(lower(url_normalized), '[\\W_]+'), lambda w: length(w) >= 2) AS tokens, {labels(2)} AS domain FROM ordered WHERE url <> '')"
VOCABULARY = [(s, k) for s, _, ks in X.INTERESTS for k in ks]
GENERAL = sorted({(g, k) for _, g, ks in X.INTERESTS for k in ks})


def common(table: str, column: str) -> str:
    """(user_id, v): the most frequent value, the smallest of ties."""
    return f"(SELECT user_id, v FROM (SELECT user_id, {column} AS v, count(*) AS c FROM {table} WHERE {column} IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY c DESC, v) = 1)"


def last(table: str, column: str, ts: str) -> str:
    return f"(SELECT t.user_id, max(t.{column}) AS v FROM {table} t JOIN (SELECT user_id, max({ts}) AS m FROM {table} GROUP BY 1) l ON t.user_id = l.user_id AND t.{ts} = l.m GROUP BY 1)"


def affinity_tables(vocabulary: list[tuple[str, str]]) -> str:
    return f""",
voc AS (SELECT DISTINCT * FROM {values(vocabulary, "interest, token")}),
tok AS (SELECT user_id, ts, token FROM (SELECT user_id, ts, unnest(tokens) AS token FROM views) WHERE token IN (SELECT token FROM voc)),
idf AS (SELECT i.interest, ln(CAST((SELECT count(*) FROM tok) AS DOUBLE) / s.c) AS idf FROM (SELECT DISTINCT interest FROM voc) i LEFT JOIN (SELECT interest, count(*) AS c FROM tok JOIN voc USING (token) GROUP BY 1) s USING (interest)),
rar AS (SELECT interest, idf, CASE WHEN (SELECT max(idf) - min(idf) FROM idf) = 0 THEN NULL ELSE (idf - (SELECT min(idf) FROM idf)) / (SELECT max(idf) - min(idf) FROM idf) END AS share FROM idf),
sums AS (SELECT user_id, interest, CAST(count(*) AS DOUBLE) AS s FROM tok JOIN voc USING (token) GROUP BY 1, 2),
aff AS (SELECT user_id, interest, round(1 / (1 + exp(-(0.25 + 0.5 * share * s / 7) + 4 * exp(-s / 7))), 5) - 0.02298 AS affinity FROM sums JOIN rar USING (interest))"""


AFFINITY, GENERAL_AFFINITY = VIEWS + affinity_tables(VOCABULARY), VIEWS + affinity_tables(GENERAL)
USERS = (
    SESSIONS
    + f""",
svw AS (SELECT *, device AS user_id, CASE WHEN search_engine = '' THEN '' {" ".join(f"WHEN contains(search_engine, '{e}') THEN '{e}'" for e in device.GROUPED_ENGINES)} END AS engine FROM ordered WHERE url <> ''),
feat AS (SELECT u.user_id, a.v AS engine_most_common, b.v AS browser_most_common, c.v AS device_type_most_common, d.n AS n_device_categories
  FROM (SELECT DISTINCT user_id FROM sessions) u LEFT JOIN {common("svw", "engine")} a USING (user_id) LEFT JOIN {common("sessions", "browser_name")} b USING (user_id)
  LEFT JOIN {common("sessions", "device_category")} c USING (user_id) LEFT JOIN (SELECT user_id, count(DISTINCT device_category) AS n FROM sessions GROUP BY 1) d USING (user_id)),
flags AS (SELECT user_id, CAST(engine_most_common = 'seznam' AS INT) AS seznam_flag, CAST(browser_most_common = 'safari' AS INT) AS safari_flag, CAST(device_type_most_common = 'desktop' AS INT) AS desktop_flag,
  CAST(device_type_most_common = 'TV' AS INT) AS tv_flag, CAST(n_device_categories >= 2 AS INT) AS more_devices_flag FROM feat)"""
)


TRAITS = f"tr AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type || ':' || CAST(user_id % 5 AS VARCHAR) AS segment_id FROM events), pl AS (SELECT * FROM {values(X.PLACES, 'segment_id, name')})"
LOCATIONS = (
    f"{TRAITS}, places AS (SELECT user_id, count(DISTINCT name) AS n_places, coalesce(bool_or(name LIKE '%Praha%'), false) AS prague, coalesce(bool_or(name LIKE '%City%'), false) AS city FROM tr LEFT JOIN pl USING (segment_id) GROUP BY 1),"
    " located AS (SELECT *, CASE WHEN n_places >= 1 AND NOT city AND NOT prague THEN 'countryside' WHEN n_places = 2 AND city AND NOT prague THEN 'regional_town' ELSE 'none' END AS location FROM places),"
    " loc AS (SELECT user_id, n_places, location, CAST(location = 'countryside' AS INT) AS countryside_flag, CAST(location = 'regional_town' AS INT) AS regional_town_flag FROM located)"
)
#: The flags of habits with those of places, for users with habits.
USERS_PLACED = f"{USERS}, {LOCATIONS}, allflags AS (SELECT f.*, l.countryside_flag, l.regional_town_flag FROM flags f LEFT JOIN loc l USING (user_id))"
FLAGS = ["seznam_flag", "safari_flag", "desktop_flag", "tv_flag", "more_devices_flag", "countryside_flag", "regional_town_flag"]


def scores(rows: str, brackets: list[str]) -> str:
    return f"SELECT user_id, {', '.join(f'round(score_{b}, 6) AS score_{b}' for b in brackets)} FROM {rows}"


def coefficients(rows: list[tuple], key: str, brackets: list[str]) -> str:
    return values(rows, ", ".join([key, *[f"score_{b}" for b in brackets]])).replace("AS t(", "AS c(")


def url_raw(rows: list[tuple], brackets: list[str]) -> str:
    return f"""(SELECT user_id, n_urls, {", ".join(f"power(least(n_urls, 30) - 0.75, 0.25) * m_{b} AS score_{b}" for b in brackets)} FROM (
  SELECT user_id, count(*) AS n_urls, {", ".join(f"avg(coalesce(c.score_{b}, 0)) AS m_{b}" for b in brackets)} FROM views LEFT JOIN {coefficients(rows, "domain", brackets)} USING (domain) GROUP BY 1))"""


def interest_raw(rows: list[tuple], brackets: list[str]) -> str:
    return f"(SELECT user_id, {', '.join(f'sum(affinity * c.score_{b}) AS score_{b}' for b in brackets)} FROM aff LEFT JOIN {coefficients(rows, 'interest', brackets)} USING (interest) GROUP BY 1)"


def other_raw(rows: list[tuple], brackets: list[str]) -> str:
    return f"""(SELECT user_id, {", ".join(f"sum(value * c.score_{b}) AS score_{b}" for b in brackets)} FROM (UNPIVOT (SELECT user_id, {", ".join(f"coalesce({f}, 0) AS {f}" for f in FLAGS)} FROM allflags) ON COLUMNS(* EXCLUDE user_id) INTO NAME flag VALUE value)
  JOIN {coefficients(rows, "flag", brackets)} USING (flag) GROUP BY 1)"""


def squashed(rows: str, brackets: list[str]) -> str:
    """Standardised and squashed, without Box-Cox."""
    z = lambda b: f"(CASE WHEN stddev_samp(score_{b}) OVER () = 0 OR stddev_samp(score_{b}) OVER () IS NULL THEN 0 ELSE (score_{b} - avg(score_{b}) OVER ()) / stddev_samp(score_{b}) OVER () END)"
    known = " AND ".join(f"score_{b} IS NOT NULL" for b in brackets)
    return f"(SELECT user_id, {', '.join(f'z_{b} / sqrt(1 + z_{b} * z_{b}) AS score_{b}' for b in brackets)} FROM (SELECT user_id, {', '.join(f'{z(b)} AS z_{b}' for b in brackets)} FROM {rows} WHERE {known}))"


def box_cox(name: str, rows: str, columns: list[str], keys: str = "user_id", digits: int = 4) -> str:
    """Table <name> (keys, columns): the columns of <rows> after Box-Cox. Lambda's likelihood is evaluated on four grids, each
    about the best of the one before."""
    out = []
    power = "CASE WHEN abs(lam) < 1e-12 THEN ln(t) ELSE (power(t, lam) - 1) / lam END"
    for c in columns:
        n = f"{name}_{c}"
        out.append(f"{n}_t AS MATERIALIZED (SELECT CAST({c} AS DOUBLE) + (SELECT abs(min({c})) FROM {rows}) + 0.01 AS t FROM {rows} WHERE {c} IS NOT NULL)")
        for i, step in enumerate((0.1, 0.002, 0.00004, 0.0000008)):
            middle = "0" if i == 0 else f"(SELECT lam FROM {n}_b{i - 1})"
            out.append(f"{n}_g{i} AS MATERIALIZED (SELECT DISTINCT least(5.0, greatest(-5.0, {middle} + (i - 50) * {step:.7f})) AS lam FROM range(101) AS r(i))")
            out.append(f"{n}_b{i} AS MATERIALIZED (SELECT arg_max(lam, f) AS lam FROM (SELECT lam, (lam - 1) * sum(ln(t)) - count(*) / 2.0 * ln(nullif(var_pop({power}), 0)) AS f FROM {n}_g{i}, {n}_t GROUP BY lam))")
    value = lambda c: f"(SELECT any_value({power.replace('ln(t)', 'ln(tt)').replace('power(t,', 'power(tt,')}) FROM (SELECT round(coalesce((SELECT lam FROM {name}_{c}_b3), 1), {digits}) AS lam, CAST(r.{c} AS DOUBLE) + (SELECT abs(min({c})) FROM {rows}) + 0.01 AS tt)) AS {c}"
    out.append(f"{name} AS MATERIALIZED (SELECT {keys}, {', '.join(map(value, columns))} FROM {rows} r)")
    return ", ".join(out)


#: Runs of what Unicode counts as no word character, and underscores.
UNICODE_GAPS = r"(?:[^\p{L}\p{M}\p{N}\p{Pc}]|_)+"


def less(w: str, n: int) -> str:
    return f"left({w}, length({w}) - {n})"


def softened(w: str) -> str:
    return "CASE " + " ".join(f"WHEN right({w}, {n}) IN ({names(ends)}) THEN {less(w, n)} || {q(by)}" for n, ends, by in text.PALATAL) + f" ELSE {less(w, 1)} END"


def stemmed(words: str, steps: list[list[tuple]]) -> str:
    """Tables s0, s1, ... (word, s) of the distinct lower-cased words of a table with column ``w``, one a step; the last is ``stems``."""
    out = [f"s0 AS (SELECT DISTINCT w AS word, w AS s FROM {words})"]
    for i, rules_ in enumerate(steps):
        cases = " ".join(f"WHEN length(s) > {longer} AND right(s, {n}) IN ({names(ends)}) THEN {f'({softened(less("s", drop))})' if soft else less('s', drop)}" for longer, n, ends, drop, soft in rules_)
        out.append(f"s{i + 1} AS (SELECT word, CASE {cases} ELSE s END AS s FROM s{i})")
    return ", ".join(out) + f", stems AS (SELECT word, CASE WHEN lower(word) = upper(word) THEN word ELSE s END AS s FROM s{len(steps)})"


def german_stems(words: str) -> str:
    """Table gstems (word, s) of the distinct lower-cased words of a table with column ``w``."""
    v, c = f"[{text.GERMAN_VOWELS}]", f"[^{text.GERMAN_VOWELS}]"
    marked = "replace(w, 'ß', 'ss')"
    for letter in "uy":
        marked = f"regexp_replace({marked}, '({v}){letter}({v})', '\\1{letter.upper()}\\2', 'g')"
    after = lambda n: f"length(regexp_extract(w, '^({c}*{v}+{c}){{{n}}}', 0))"
    has_end = lambda w, n, ends: f"right({w}, {n}) IN ({names(list(ends))})"
    inside = lambda n, r: f"length(w) - {n} >= {r}"
    cut = lambda n, r: f"CASE WHEN {inside(n, r)} THEN {less('w', n)} ELSE w END"
    niss = lambda n: f"CASE WHEN {inside(n, 'r1')} THEN CASE WHEN {has_end(less('w', n), 4, ['niss'])} THEN {less('w', n + 1)} ELSE {less('w', n)} END ELSE w END"
    one = f"CASE WHEN {has_end('w', 3, ['ern'])} THEN {cut(3, 'r1')} WHEN {has_end('w', 2, ['em', 'er'])} THEN {cut(2, 'r1')} WHEN {has_end('w', 2, ['en', 'es'])} THEN {niss(2)} WHEN right(w, 1) = 'e' THEN {niss(1)} WHEN right(w, 1) = 's' AND {has_end(less('w', 1), 1, text.S_ENDING)} THEN {cut(1, 'r1')} ELSE w END"
    two = f"CASE WHEN {has_end('w', 3, ['est'])} THEN {cut(3, 'r1')} WHEN {has_end('w', 2, ['en', 'er'])} THEN {cut(2, 'r1')} WHEN right(w, 2) = 'st' AND {has_end(less('w', 2), 1, text.ST_ENDING)} AND length(w) >= 6 THEN {cut(2, 'r1')} ELSE w END"
    rest = lambda n, yes, no: f"CASE WHEN {inside(n, 'r2')} THEN CASE WHEN {yes} ELSE {no} END ELSE w END"
    kept = lambda n: rest(n, f"right({less('w', n)}, 1) = 'e' THEN w", less("w", n))
    three = (
        f"CASE WHEN {has_end('w', 4, ['lich', 'heit'])} THEN {rest(4, has_end(less('w', 4), 2, ['er', 'en']) + ' AND ' + inside(6, 'r1') + ' THEN ' + less('w', 6), less('w', 4))}"
        f" WHEN right(w, 4) = 'keit' THEN {rest(4, has_end(less('w', 4), 4, ['lich']) + ' AND ' + inside(8, 'r2') + ' THEN ' + less('w', 8) + ' WHEN ' + has_end(less('w', 4), 2, ['ig']) + ' AND ' + inside(6, 'r2') + ' THEN ' + less('w', 6), less('w', 4))}"
        f" WHEN right(w, 4) = 'isch' THEN {kept(4)}"
        f" WHEN {has_end('w', 3, ['end', 'ung'])} THEN {rest(3, has_end(less('w', 3), 2, ['ig']) + ' AND right(' + less('w', 5) + ', 1) <> ' + q('e') + ' AND ' + inside(5, 'r2') + ' THEN ' + less('w', 5), less('w', 3))}"
        f" WHEN {has_end('w', 2, ['ig', 'ik'])} THEN {kept(2)} ELSE w END"
    )
    return (
        f"gm AS (SELECT DISTINCT w AS word, {marked} AS w FROM {words}), gr AS (SELECT *, CASE WHEN {after(1)} > 0 THEN greatest({after(1)}, least(length(w), 3)) ELSE length(w) END AS r1, CASE WHEN {after(2)} > 0 THEN {after(2)} ELSE length(w) END AS r2 FROM gm),"
        f" g1 AS (SELECT word, r1, r2, {one} AS w FROM gr), g2 AS (SELECT word, r1, r2, {two} AS w FROM g1), gstems AS (SELECT word, translate({three}, 'UYäöü', 'uyaou') AS s FROM g2)"
    )
