"""One query for each operator or group of operators, and its oracle where SQL can express it."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrift.functions import scalars, text, urls
from spindrift.operators import assemble, behaviour, dictionary, incremental, interests, lift, models, rank, scores, stats, synonyms, targets
from spindrift.operators import sessions as S
from spindrift.plans import sql as Q
from spindrift.sources import fixtures as X
from spindrift.sources import io, landing
from spindrift.sources.session import fixed, shared_folder, ship_package
from spindrift.sources.versions import VersionedTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def r6(*columns: str) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


def epoch(column: str):
    return F.unix_timestamp(column)


def recent(s: DataFrame) -> DataFrame:
    return incremental.lookback(s, "session_date", X.AS_OF, 7, include_end=True)


# scans, projections and increments


@query(f"WITH {Q.HITS} SELECT event_id, device, url, owner_name, age, gender, hour(ts) AS hour, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM raw_hits WHERE device <> ''")
def hits_flatten(spark, sf):
    rows = X.hits(spark, sf).where("device <> ''").withColumn("event", F.struct("url", "owner_name", F.from_json("props", "k long").alias("params")))
    flat = io.flatten(rows.select("event_id", "device", "event", "age", "gender", F.hour("ts").alias("hour")))
    return flat.select("event_id", "device", "url", "owner_name", "age", "gender", "hour", "k")


@query("SELECT event_id, CASE WHEN event_id % 29 = 0 OR event_id % 13 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END AS item FROM events")
def custom_param(spark, sf):
    entry = F.array(F.struct(F.lit("k").alias("group"), F.get_json_object("props", "$.k").alias("item")))
    arr = F.when(F.col("event_id") % 29 == 0, F.lit(None)).when(F.col("event_id") % 13 == 0, F.slice(entry, 1, 0)).otherwise(entry)
    return X.table(spark, sf, "events").withColumn("params", arr).select("event_id", scalars.parameter("params", "k").alias("item"))


@query(f"WITH {Q.HITS} SELECT event_id, device, owner_name FROM raw_hits WHERE day >= DATE '2024-01-24' AND day < DATE '2024-01-31'")
def lookback_hits(spark, sf):
    return incremental.lookback(X.hits(spark, sf), "day", X.AS_OF, 7).select("event_id", "device", "owner_name")


@query(f"WITH {Q.HITS}, m AS (SELECT max(ts) AS mark FROM raw_hits WHERE event_id % 3 = 0 AND day <= DATE '2024-01-20') SELECT event_id, device FROM raw_hits, m WHERE ts > mark")
def incremental_hits(spark, sf):
    h = X.hits(spark, sf)
    mark = h.where((F.col("event_id") % 3 == 0) & (F.col("day") <= F.lit("2024-01-20").cast("date"))).agg(F.max("ts").alias("mark"))
    return incremental.since(h, "day", "ts", mark).select("event_id", "device")


@query(f"WITH {Q.ORDERED}, p AS (SELECT day, device || ' ' || url_normalized AS visited FROM ordered) SELECT DISTINCT visited FROM p WHERE visited NOT IN (SELECT visited FROM p WHERE day < DATE '2024-01-15')")
def new_urls_anti(spark, sf):
    """Pages that are new to their visitor."""
    h = X.enriched(spark, sf).select("day", F.concat_ws(" ", "device", "url_normalized").alias("visited"))
    known = h.where(F.col("day") < F.lit("2024-01-15").cast("date"))
    return incremental.new_keys(h, known, "visited").select("visited").distinct()


@query(f"WITH {Q.ORDERED} SELECT url_normalized, count(*) AS n, arg_min(owner_name, struct_pack(a := ts, b := event_id)) AS first_owner, arg_min(search_engine, struct_pack(a := ts, b := event_id)) FILTER (search_engine IS NOT NULL) AS first_engine FROM ordered GROUP BY 1")
def first_per_url(spark, sf):
    out = incremental.first_rows(X.enriched(spark, sf), "url_normalized", ["ts", "event_id"], ["owner_name", "search_engine"])
    return out.withColumnsRenamed({"owner_name": "first_owner", "search_engine": "first_engine"})


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'updated' ELSE c_mktsegment END AS segment FROM customer UNION ALL SELECT c_custkey + 1000000000, 'new' FROM customer WHERE c_custkey % 7 = 0")
def upsert(spark, sf):
    c = X.table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    updates = c.where("c_custkey % 5 = 0").withColumn("segment", F.lit("updated")).unionByName(c.where("c_custkey % 7 = 0").select((F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), F.lit("new").alias("segment")))
    return incremental.upsert(c, updates, "c_custkey")


@query(
    "WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN 'updated' ELSE c_mktsegment END AS segment FROM customer) SELECT c_custkey, CASE WHEN c_custkey % 35 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS nation, segment FROM c WHERE c_nationkey < 15 OR c_custkey % 5 = 0"
    " UNION ALL SELECT c_custkey + 1000000000, 99, 'new' FROM customer WHERE c_custkey % 7 = 0"
)
def versioned_upsert(spark, sf):
    """A table in partitions by nation, rewritten twice: rows of nations from 15 on come by updates only, some customers
    move to the next nation, and others are new. Readers see whole versions."""
    c = X.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("int").alias("nation"), F.col("c_mktsegment").alias("segment"))
    t = VersionedTable(spark, shared_folder(spark), c.schema, "nation")
    t.replace(c.where("nation < 15"))
    moved = F.when(F.col("c_custkey") % 35 == 0, F.expr("(nation + 1) % 25")).otherwise(F.col("nation"))
    t.upsert(c.where("c_custkey % 5 = 0").withColumns({"nation": moved, "segment": F.lit("updated")}), ["c_custkey"])
    t.upsert(c.where("c_custkey % 7 = 0").select((F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), F.lit(99).alias("nation"), F.lit("new").alias("segment")), ["c_custkey"])
    return t.read()


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 9 ")
def versioned_retention(spark, sf):
    """A table in partitions by day after its retention: days leave the log, no file is written."""
    e = X.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))
    t = VersionedTable(spark, shared_folder(spark), e.schema, "day")
    t.replace(e)
    t.keep_days(5, least=9)
    return t.read()


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 7")
def retention(spark, sf):
    return incremental.keep_days(X.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day")), "day", 7)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return incremental.duplicates(X.table(spark, sf, "events"), "event_type")


SERIES = {"going_on": "day >= DATE '2024-01-25'", "first": "day >= (SELECT max(day) FROM raw_hits) - 4", "short": "day >= (SELECT max(day) FROM raw_hits) - 2"}


@query(f"WITH {Q.HITS} " + " UNION ALL ".join(f"SELECT '{n}' AS series, day, count(*) AS n FROM raw_hits WHERE {w} GROUP BY 2" for n, w in SERIES.items()))
def landed_series(spark, sf):
    """Hits of the days that each kind of series reads."""
    h = X.hits(spark, sf)
    newest = io.newest_day(h)
    days = {"going_on": io.landed_days(newest, "long", reached=dt.date(2024, 1, 25)), "first": io.landed_days(newest, "long", days=3), "short": io.landed_days(newest, "short", hours=30)}
    return io.union_all([h.where(w).groupBy("day").agg(F.count("*").alias("n")).select(F.lit(n).alias("series"), "day", "n") for n, w in days.items()])


@query("SELECT COLUMNS('^o_order.*') FROM orders")
def matching_columns(spark, sf):
    o = X.table(spark, sf, "orders")
    return o.select(*assemble.columns_like(o, "o_order"))


# URLs and devices


@query(f"SELECT page_id, {Q.steps('url', urls.NORMALISED)} AS url_normalized FROM pages")
def url_normalize(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", urls.normalise("url").alias("url_normalized"))


@query(f"SELECT page_id, {Q.steps('url', urls.AD)} AS ad, {Q.LIGHT} AS light, {Q.steps('url', urls.TWO_LEVEL)} AS two_level, {Q.steps('url', urls.RTB)} AS rtb, {Q.steps('url', urls.CLEAN)} AS clean, {Q.steps('url', urls.CROPPED)} AS cropped FROM pages")
def url_adform(spark, sf):
    return X.table(spark, sf, "pages").select(
        "page_id", urls.ad_format("url").alias("ad"), urls.ad_format("url", light=True).alias("light"), urls.two_level("url").alias("two_level"),
        urls.rtb_domain("url").alias("rtb"), urls.clean("url").alias("clean"), urls.cropped("url").alias("cropped"),
    )


@query(f"SELECT page_id, {Q.HOST} AS host, {Q.labels(1)} AS level_0, {Q.labels(2)} AS level_1, {Q.labels(3)} AS level_2 FROM pages")
def url_domain_levels(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", urls.domain("url").alias("host"), *[urls.domain("url", i).alias(f"level_{i}") for i in range(3)])


@query(f"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, {Q.q('|'.join(X.GENERAL_PAGES))})")
def general_urls_removed(spark, sf):
    return X.table(spark, sf, "pages").where(~urls.is_general("url", X.GENERAL_PAGES)).select("page_id", "url")


@query("SELECT page_id, url_decode(replace(url, '/', '%2F')) AS decoded FROM pages")
def url_decoded(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", urls.decode(F.replace("url", F.lit("/"), F.lit("%2F"))).alias("decoded"))


@query(f"WITH {Q.HITS} SELECT event_id, {Q.FIELDS} FROM hits")
def device_parse(spark, sf):
    return X.enriched(spark, sf).select("event_id", *S.DEVICE_FIELDS)


@query(f"WITH {Q.HITS} SELECT event_id, search_engine FROM hits")
def search_engine(spark, sf):
    return X.enriched(spark, sf).select("event_id", "search_engine")


# sessions


@query(f"WITH {Q.ORDERED} SELECT event_id, device, ordinal, round(minutes, 6) AS minutes, referrer_first FROM ordered")
def sessionize(spark, sf):
    return S.order_into_sessions(X.enriched(spark, sf)).select("event_id", "device", "ordinal", *r6("minutes"), "referrer_first")


@query(f"WITH {Q.ORDERED} SELECT event_id, device, ordinal, round(minutes, 6) AS minutes, referrer_first FROM ordered")
def sessionize_sliced(spark, sf):
    """The same with devices of more than 20 hits cut into slices of time, numbered apart and stitched."""
    return S.order_into_sessions(X.enriched(spark, sf), hot_rows=20).select("event_id", "device", "ordinal", *r6("minutes"), "referrer_first")


@query(f"WITH {Q.SESSIONS} SELECT user_id, ordinal, {Q.FIELDS}, round(total_minutes, 6) AS total_minutes, CAST(floor(epoch(session_start)) AS BIGINT) AS started, CAST(floor(epoch(session_end)) AS BIGINT) AS ended, n_events, unique_page_views, referrer_first FROM sessions")
def session_rollup(spark, sf):
    return X.sessions(spark, sf).select("user_id", "ordinal", *S.DEVICE_FIELDS, *r6("total_minutes"), epoch("session_start").alias("started"), epoch("session_end").alias("ended"), "n_events", "unique_page_views", "referrer_first")


@query(f"WITH {Q.VIEWS} SELECT event_id, user_id, ordinal, url_normalized, domain FROM views")
def pageviews(spark, sf):
    return X.views(spark, sf).select("event_id", "user_id", "ordinal", "url_normalized", "domain")


@query(f"WITH {Q.SESSIONS} SELECT user_id, ordinal, {Q.FIELDS}, n_events FROM sessions")
def session_dims(spark, sf):
    s = X.sessions(spark, sf)
    return S.join_dimensions(s, S.dimensions(s)).select("user_id", "ordinal", *S.DEVICE_FIELDS, "n_events")


# behaviour


SHARES = ", ".join(f"round(count(*) FILTER (device_category = '{c}') / CAST(nullif(count(*) FILTER (device_category IN ('mobile', 'desktop', 'TV', 'tablet')), 0) AS DOUBLE), 1) AS {c.lower()}_share" for c in behaviour.CATEGORIES)


@query(f"WITH {Q.SESSIONS} SELECT user_id, {SHARES} FROM recent GROUP BY 1")
def device_share(spark, sf):
    return behaviour.device_shares(recent(X.sessions(spark, sf)))


@query(
    f"WITH {Q.SESSIONS} SELECT u.user_id, a.v AS device_type_most_common, b.v AS device_type_last_used, c.v AS browser_most_common, d.v AS browser_last_used, e.v AS os_most_common, f.v AS os_last_used FROM (SELECT DISTINCT user_id FROM recent) u"
    + "".join(f" LEFT JOIN {t} {x} ON u.user_id = {x}.user_id" for x, t in zip("abcdef", [g(c) for c in ("device_category", "browser_name", "os_name") for g in (lambda c: Q.common("recent", c), lambda c: Q.last("recent", c, "session_start"))], strict=True))
)
def categories_used(spark, sf):
    return behaviour.categories(recent(X.sessions(spark, sf)))


@query(f"WITH {Q.SESSIONS} SELECT user_id, count(DISTINCT device_category) AS n_device_categories, count(DISTINCT (coalesce(os_name, 'unknown'), coalesce(device_category, 'unknown'), coalesce(device_brand_name, 'unknown'))) AS n_devices FROM recent GROUP BY 1")
def device_counts(spark, sf):
    return behaviour.device_counts(recent(X.sessions(spark, sf)))


@query(f"WITH {Q.SESSIONS} SELECT user_id, round(avg(floor(epoch(session_end)) - floor(epoch(session_start)))) AS avg_seconds, 1 AS active, round(tanh(1.0 / (date_diff('day', CAST(min(session_start) AS DATE), CAST(max(session_start) AS DATE)) + 1)), 2) AS security_affinity FROM recent GROUP BY 1")
def web_stats(spark, sf):
    return behaviour.web_statistics(recent(X.sessions(spark, sf)))


PERIOD = "CASE " + " ".join(f"WHEN hour(session_start) BETWEEN {a} AND {b} THEN '{n}'" for a, b, n in scalars.PERIODS) + " ELSE 'Night' END"


@query(f"WITH {Q.SESSIONS}, p AS (SELECT user_id, {PERIOD} AS period FROM recent) SELECT user_id, v AS period_most_common FROM {Q.common('p', 'period')}")
def visit_period(spark, sf):
    return behaviour.visit_periods(recent(X.sessions(spark, sf)))


@query(
    f"WITH {Q.USERS} SELECT u.user_id, a.v AS engine_most_common, b.v AS engine_last_used, u.n_views, u.owner_names FROM (SELECT user_id, count(*) AS n_views, array_to_string(list_sort(list(DISTINCT owner_name)), ',') AS owner_names FROM svw GROUP BY 1) u"
    f" LEFT JOIN {Q.common('svw', 'engine')} a USING (user_id) LEFT JOIN {Q.last('svw', 'engine', 'ts')} b USING (user_id)"
)
def pageview_misc(spark, sf):
    return behaviour.page_view_misc(X.views(spark, sf))


@query(f"WITH {Q.VIEWS} SELECT user_id, count(DISTINCT ts) AS n_visits FROM views WHERE NOT contains(url_normalized, 'blog') GROUP BY 1")
def web_visits(spark, sf):
    return behaviour.web_visits(X.views(spark, sf))


@query(f"WITH {Q.VIEWS} SELECT user_id, CAST(min(CASE WHEN contains(url_normalized, 'blog') THEN date_diff('day', CAST(ts AS DATE), DATE '{X.AS_OF}') END) AS INT) AS days_since FROM views GROUP BY 1")
def blog_recency(spark, sf):
    return behaviour.days_since(X.views(spark, sf), X.AS_OF)


# text


STOP = Q.names(text.ENGLISH_WORDS)
TOKENS = f"list_filter(regexp_split_to_array(lower(text), '[\\W_]+'), lambda w: length(w) >= 2 AND NOT w IN ({STOP}))"


@query(f"SELECT doc_id, CAST(len({TOKENS}) AS INT) AS n_tokens, md5(array_to_string({TOKENS}, ' ')) AS digest FROM documents")
def tokens_clean(spark, sf):
    t = X.table(spark, sf, "documents").select("doc_id", text.clean_tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest"))


BIGRAMS = "list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])"


@query(f"WITH x AS (SELECT doc_id, {TOKENS} AS t FROM documents) SELECT doc_id, CAST(len({BIGRAMS}) AS INT) AS n_bigrams, md5(array_to_string({BIGRAMS}, '|')) AS digest FROM x")
def bigrams(spark, sf):
    t = X.table(spark, sf, "documents").select("doc_id", text.ngrams(text.clean_tokens("text")).alias("t"))
    return t.select("doc_id", F.size("t").alias("n_bigrams"), F.md5(F.array_join("t", "|")).alias("digest"))


@query(f"SELECT doc_id, md5(translate(text, {Q.q(text.ACCENTED)}, {Q.q(text.PLAIN)})) AS digest FROM documents")
def fold_diacritics(spark, sf):
    return X.table(spark, sf, "documents").select("doc_id", F.md5(text.fold("text")).alias("digest"))


@query("SELECT doc_id, md5(coalesce(strip_accents(text), '')) AS digest FROM documents")
def fold_marks(spark, sf):
    return X.table(spark, sf, "documents").select("doc_id", F.md5(text.fold_marks("text")).alias("digest"))


def stems_sql(steps: list, out: str) -> str:
    words = f"t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), {Q.q(Q.UNICODE_GAPS)}), lambda w: length(w) >= 2) AS t FROM documents), w AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM t)"
    found = "f AS (SELECT w.doc_id, count(DISTINCT s) AS n_stems, md5(string_agg(s, ' ' ORDER BY i)) AS digest FROM w JOIN stems ON w.w = stems.word GROUP BY 1)"
    return f"WITH {words}, {Q.stemmed('w', steps)}, {found} SELECT t.doc_id, CAST(len(t) AS INT) AS n_tokens, CAST(CASE WHEN t IS NOT NULL THEN coalesce(n_stems, 0) END AS INT) AS n_stems{out} FROM t LEFT JOIN f USING (doc_id)"


@query(stems_sql(text.LIGHT_STEPS, ", CASE WHEN t IS NOT NULL THEN coalesce(digest, md5('')) END AS digest"))
def stem_cs(spark, sf):
    t = X.table(spark, sf, "documents").select("doc_id", text.stem_czech(text.tokens("text", unicode=True)).alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_stems"), F.md5(F.array_join("t", " ")).alias("digest"))


@query(stems_sql(text.ALL_STEPS, ""))
def stem_cs_aggressive(spark, sf):
    t = X.table(spark, sf, "documents").select("doc_id", text.stem_czech(text.tokens("text", unicode=True), aggressive=True).alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_stems"))


@query(
    f"WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), {Q.q(Q.UNICODE_GAPS)}), lambda w: length(w) >= 2) AS t FROM documents), w AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM t), {Q.german_stems('w')},"
    " f AS (SELECT w.doc_id, count(DISTINCT s) AS n_stems, md5(string_agg(s, ' ' ORDER BY i)) AS digest FROM w JOIN gstems ON w.w = gstems.word GROUP BY 1)"
    " SELECT t.doc_id, CAST(len(t) AS INT) AS n_tokens, CAST(CASE WHEN t IS NOT NULL THEN coalesce(n_stems, 0) END AS INT) AS n_stems, CASE WHEN t IS NOT NULL THEN coalesce(digest, md5('')) END AS digest FROM t LEFT JOIN f USING (doc_id)"
)
def stem_de(spark, sf):
    t = X.table(spark, sf, "documents").select("doc_id", text.stem_german(text.tokens("text", unicode=True)).alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_stems"), F.md5(F.array_join("t", " ")).alias("digest"))


@query(
    f"WITH {Q.ORDERED} SELECT url_normalized, min({Q.labels(1)}) AS url_domain_full, min({Q.labels(2)}) AS url_domain_1_level, min({Q.labels(3)}) AS url_domain_2_level, min({Q.steps('url', urls.AD)}) AS url_ad_format, min({Q.steps('url', urls.TWO_LEVEL)}) AS url_two_level, count(*) AS n FROM ordered GROUP BY 1"
)
def url_dictionary(spark, sf):
    h = X.enriched(spark, sf).select("url", *urls.all_forms("url"))
    return h.groupBy("url_normalized").agg(*[F.min(c).alias(c) for c in ("url_domain_full", "url_domain_1_level", "url_domain_2_level", "url_ad_format", "url_two_level")], F.count("*").alias("n"))


#: What a page says of itself: field -> (pattern, group) over its html.
PAGE_FIELDS = {"title": (r"<title>([^<]*)", 1), "keywords": (r'<html lang="([^"]*)"', 1), "descriptions": (r"<h1>([^<]*)", 1)}
TOKEN_FIELDS = [*PAGE_FIELDS, "url_normalized"]


def url_entries(spark: SparkSession, sf: str) -> DataFrame:
    """One entry a URL, from the page of the smallest id, with the tokens of its fields."""
    pages = X.table(spark, sf, "pages").select("page_id", urls.normalise("url").alias("url_normalized"), *[F.regexp_extract("html", p, g).alias(f) for f, (p, g) in PAGE_FIELDS.items()])
    entries = incremental.first_rows(pages, "url_normalized", ["page_id"], list(PAGE_FIELDS))
    return dictionary.pooled_tokens(dictionary.field_tokens(entries, TOKEN_FIELDS), TOKEN_FIELDS)


def of_field(f: str, kind: str) -> str:
    return f"c_{f}" if kind == "cleaned" else f"list_transform(c_{f}, lambda x: m[x])"


PAIRS_OF = "list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1])"
ENTRIES = (
    f"pg AS (SELECT {Q.steps('url', urls.NORMALISED)} AS url_normalized, page_id, " + ", ".join(f"regexp_extract(html, {Q.q(p)}, {g}) AS {f}" for f, (p, g) in PAGE_FIELDS.items()) + " FROM pages),"
    f" en AS (SELECT url_normalized, {', '.join(f'arg_min({f}, page_id) AS {f}' for f in PAGE_FIELDS)} FROM pg GROUP BY 1),"
    f" cl AS (SELECT url_normalized, {', '.join('coalesce(' + TOKENS.replace('lower(text)', f'lower({f})') + f', []) AS c_{f}' for f in TOKEN_FIELDS)} FROM en),"
    f" wd AS (SELECT unnest({' || '.join(f'c_{f}' for f in TOKEN_FIELDS)}) AS w FROM cl), {Q.stemmed('wd', text.LIGHT_STEPS)}, mp AS (SELECT map(list(word), list(s)) AS m FROM stems),"
    f" st AS (SELECT url_normalized, {', '.join(f'{of_field(f, k)} AS {k}_{f}' for k in dictionary.KINDS for f in TOKEN_FIELDS)} FROM cl, mp),"
    f" po AS (SELECT url_normalized, {', '.join(' || '.join(f'{k}_{f}' for f in TOKEN_FIELDS) + f' AS {k}_all, ' + ' || '.join(PAIRS_OF.format(f'{k}_{f}') for f in TOKEN_FIELDS) + f' AS {k}_pairs' for k in dictionary.KINDS)} FROM st)"
)


def in_order(tokens: str) -> str:
    """A digest of the distinct tokens, in the order of text."""
    return f"md5(array_to_string(list_sort(list_distinct({tokens})), '|'))"


@query(f"WITH {ENTRIES} SELECT url_normalized, {', '.join(f'CAST(len({k}_all) AS INT) AS n_{k}, {in_order(f"{k}_all")} AS {k}_digest, {in_order(f"{k}_pairs")} AS {k}_bigrams_digest' for k in dictionary.KINDS)} FROM po")
def url_tokens(spark, sf):
    """Tokens of the URL dictionary, plain and stemmed, pooled over title, keywords, heading and URL."""
    digest = lambda c: F.md5(F.array_join(F.array_sort(c), "|"))
    kinds = [x for k in dictionary.KINDS for x in (F.size(f"tokens_all_{k}").alias(f"n_{k}"), digest(f"tokens_all_{k}_unique").alias(f"{k}_digest"), digest(f"tokens_all_{k}_unique_bigrams").alias(f"{k}_bigrams_digest"))]
    return url_entries(spark, sf).select("url_normalized", *kinds)


@query(f"WITH {Q.VIEWS}, {ENTRIES} SELECT event_id, user_id, CAST(len(list_distinct(stemmed_all)) + len(list_distinct(stemmed_pairs)) AS INT) AS n_tokens, {in_order('list_distinct(stemmed_all) || list_distinct(stemmed_pairs)')} AS digest FROM views LEFT JOIN po USING (url_normalized)")
def view_tokens(spark, sf):
    """Page views joined with the stemmed tokens and bigrams of their URL."""
    tokens = dictionary.chosen(url_entries(spark, sf), "stemmed_unique", bigrams=True)
    v = dictionary.with_tokens(X.views(spark, sf), tokens)
    return v.select("event_id", "user_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join(F.array_sort(F.array_distinct("tokens")), "|")).alias("digest"))


@query("SELECT role, CAST(len(list_distinct(flatten(list(string_split(text, ' '))))) AS BIGINT) AS n_words FROM conversations GROUP BY 1")
def distinct_words(spark, sf):
    rows = X.table(spark, sf, "conversations").select("role", F.explode(text.flatten_spaces("text")).alias("w"))
    return rows.groupBy("role").agg(F.count_distinct("w").alias("n_words"))


# interests


FOLDED = TOKENS.replace("lower(text)", f"lower(translate(text, {Q.q(text.ACCENTED)}, {Q.q(text.PLAIN)}))")


@query(f"SELECT DISTINCT role AS interest, unnest({FOLDED}) AS token FROM conversations")
def interest_tokens(spark, sf):
    """The vocabulary of each speaker's turns, as keywords of an interest."""
    defined = X.table(spark, sf, "conversations").select(F.col("role").alias("subinterest"), F.array("text").alias("keywords"))
    return interests.interest_tokens(defined).select("interest", "token")


@query(f"WITH p AS (SELECT quality, {FOLDED} AS x FROM documents JOIN labels USING (doc_id)) SELECT DISTINCT CAST(quality AS VARCHAR) AS interest, unnest({BIGRAMS.replace('t[', 'x[').replace('len(t)', 'len(x)')}) AS token FROM p")
def interest_bigrams(spark, sf):
    """The distinct bigrams of the texts of each quality, as an interest's dictionary."""
    d = X.table(spark, sf, "documents").join(X.table(spark, sf, "labels"), "doc_id")
    defined = d.select(F.col("quality").cast("string").alias("subinterest"), F.array().cast("array<string>").alias("keywords"), F.array("text").alias("keywords_bigrams"))
    found = interests.interest_tokens(defined, bigrams=True).select("interest", "token")
    return found.where(F.col("token").contains(" "))  # a text of one word has no bigram


@query(
    f"WITH d AS (SELECT role AS subinterest, CAST(turn % 4 AS VARCHAR) AS general_interest, {FOLDED} AS x, turn % 4 < 2 AS paired FROM conversations),"
    f" one AS (SELECT DISTINCT subinterest, general_interest, unnest(x) AS token FROM d), two AS (SELECT DISTINCT subinterest, general_interest, unnest({BIGRAMS.replace('t[', 'x[').replace('len(t)', 'len(x)')}) AS token FROM d WHERE paired),"
    " a AS (SELECT * FROM one UNION SELECT * FROM two) SELECT subinterest, general_interest, token FROM a SEMI JOIN two USING (subinterest, general_interest)"
)
def interest_pairs(spark, sf):
    """Keywords and bigrams of (speaker, turn modulo four) as interests; the later two turns have no bigrams."""
    paired = (F.col("turn") % 4 < 2) & (F.size(text.clean_tokens(text.fold("text"))) > 1)  # a text of one word has no bigram
    rows = X.table(spark, sf, "conversations").select(
        F.col("role").alias("subinterest"), (F.col("turn") % 4).cast("string").alias("general_interest"), F.array("text").alias("keywords"), F.when(paired, F.array("text")).alias("keywords_bigrams")
    )
    return interests.paired_dictionary(rows).select("subinterest", "general_interest", "token")


def vocabulary(spark: SparkSession, general: bool = False) -> DataFrame:
    return interests.interest_tokens(X.definitions(spark), general)


@query(f"WITH {Q.AFFINITY} SELECT interest, round(idf, 6) AS idf, round(share, 6) AS share FROM rar")
def interest_idf(spark, sf):
    v = vocabulary(spark)
    return interests.rarity(interests.tokens_of_interest(X.views(spark, sf), v), v).select("interest", *r6("idf", "share"))


@query(f"WITH {Q.AFFINITY} SELECT user_id, interest, round(affinity, 4) AS affinity FROM aff")
def interest_affinity(spark, sf):
    v = vocabulary(spark)
    return interests.affinities(interests.tokens_of_interest(X.views(spark, sf), v), v).select("user_id", "interest", F.round("affinity", 4).alias("affinity"))


@query(f"WITH {Q.GENERAL_AFFINITY} SELECT user_id, interest, round(affinity, 4) AS affinity FROM aff")
def general_affinity(spark, sf):
    v = vocabulary(spark, general=True)
    return interests.affinities(interests.tokens_of_interest(X.views(spark, sf), v), v).select("user_id", "interest", F.round("affinity", 4).alias("affinity"))


@query(f"WITH {Q.AFFINITY} SELECT user_id, interest, round(greatest(tanh(ln(0.5 + s)), 0), 5) AS affinity FROM sums")
def legacy_affinity(spark, sf):
    v = vocabulary(spark)
    return interests.affinities(interests.tokens_of_interest(X.views(spark, sf), v), v, variant="tanh")


@query(f"WITH {Q.AFFINITY} SELECT user_id, interest, round(round(1 / (1 + exp(-(0.25 + 0.5 * share * s) + 4 * exp(-s))), 5) - 0.02298, 6) AS affinity, round(greatest(tanh(ln(0.5 + s)), 0), 5) AS plain FROM sums JOIN rar USING (interest)")
def affinity_of_one_window(spark, sf):
    """Affinities that count all views in one window, beside the form without rarity."""
    v = vocabulary(spark)
    tokens = interests.tokens_of_interest(X.views(spark, sf), v)
    one, plain = interests.affinities(tokens, v, windows=1), interests.affinities(tokens, v, variant="tanh").withColumnRenamed("affinity", "plain")
    return one.join(plain, ["user_id", "interest"]).select("user_id", "interest", *r6("affinity"), "plain")


# ranks and statistics


@query("WITH p AS (SELECT l.doc_id, d.n_chars % 997 / 997.0 AS score, CASE WHEN l.doc_id % 11 = 0 THEN NULL ELSE d.n_chars % 13 END AS level FROM labels l JOIN documents d USING (doc_id)) SELECT doc_id, round(percent_rank() OVER (ORDER BY score), 6) AS score_rank, round(percent_rank() OVER (ORDER BY level NULLS FIRST), 6) AS level_rank FROM p")
def global_percentile(spark, sf):
    d = X.table(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 997 / 997.0).alias("score"), F.when(F.col("doc_id") % 11 != 0, F.col("n_chars") % 13).alias("level"))
    ranked = rank.percent_ranks(X.table(spark, sf, "labels").select("doc_id").join(d, "doc_id"), ["score", "level"])
    return ranked.select("doc_id", *r6("score_rank", "level_rank"))


@query("SELECT doc_id, CAST(ntile(7) OVER (ORDER BY n_chars % 97 DESC, doc_id) AS INT) AS bucket FROM documents")
def global_ntile(spark, sf):
    d = X.table(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 97).alias("score"))
    return rank.ntiles(d, "score", "doc_id", 7).select("doc_id", "bucket")


def scaled_sql(c: str) -> str:
    return f"round((b.{c} - avg(b.{c}) OVER ()) / stddev_samp(b.{c}) OVER (), 6) AS {c}"


@query(f"WITH d AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x, CAST(n_chars % 101 AS DOUBLE) AS y FROM documents), {Q.box_cox('b', 'd', ['x', 'y'], 'doc_id')} SELECT doc_id, {scaled_sql('x')}, {scaled_sql('y')} FROM b")
def boxcox_scale(spark, sf):
    d = X.table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("x"), (F.col("n_chars") % 101).cast("double").alias("y"))
    return stats.standardise(stats.box_cox_transform(d, ["x", "y"], digits=4), ["x", "y"]).select("doc_id", *r6("x", "y"))


@query("SELECT o_orderkey, round(t / (2 * (1 + abs(t))) + 0.5, 6) AS positive, round(2 * t / sqrt(1 + 4 * t * t), 6) AS sharp FROM (SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) / 100000 - 1 AS t FROM orders)")
def sigmoid(spark, sf):
    t = F.col("o_totalprice").cast("double") / 100_000 - 1
    return X.table(spark, sf, "orders").select("o_orderkey", F.round(scalars.positive_sigmoid(t), 6).alias("positive"), F.round(scalars.sigmoid(t, 2.0), 6).alias("sharp"))


@query("SELECT doc_id, 'quality' AS name, quality AS value FROM labels UNION ALL SELECT doc_id, 'toxic', toxic FROM labels")
def melt(spark, sf):
    return stats.melt(X.table(spark, sf, "labels"), ["doc_id"], ["quality", "toxic"])


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def top_n(spark, sf):
    return rank.top_n(X.table(spark, sf, "documents").select("doc_id", "n_chars"), "n_chars", 25, "doc_id")


@query("SELECT lang, CASE WHEN lang IN ('fr', 'es') THEN 'romance' ELSE lang END AS family, count(*) AS n FROM documents GROUP BY 1, 2")
def replaced_levels(spark, sf):
    return X.table(spark, sf, "documents").select("lang", stats.replace_levels("lang", ["fr", "es"], "romance").alias("family")).groupBy("lang", "family").agg(F.count("*").alias("n"))


@query("WITH o AS (SELECT n_chars, row_number() OVER (ORDER BY n_chars) AS r, count(*) OVER () AS n, avg(n_chars) OVER () AS m FROM documents WHERE n_chars IS NOT NULL) SELECT round(m, 6) AS mean, CAST(i - 1 AS INT) AS place, n_chars AS percentile FROM o, range(1, 10) AS g(i) WHERE r = (i * n + 9) // 10")
def column_percentiles(spark, sf):
    found = stats.column_stats(X.table(spark, sf, "documents"), "n_chars", 10)
    return found.select(F.round("mean", 6).alias("mean"), F.posexplode("percentiles").alias("place", "percentile"))


SHARES_ASKED = [i / 10 for i in range(1, 10)]


@query("SELECT CAST(i - 1 AS INT) AS place, (SELECT count(*) FROM events) AS n, true AS within FROM range(1, 10) AS g(i)")
def percentile_sketches(spark, sf):
    """Deciles of a number of each event from daily sketches that were stored and merged; whether the exact rank of each
    lies within three times the sketch's error."""
    e = X.table(spark, sf, "events").select(F.to_date("ts").alias("day"), (F.col("event_id") * 7919 % 10007).cast("double").alias("x"))
    daily = fixed(stats.quantile_sketches(e, ["day"], "x", k=800))
    found = stats.sketch_quantiles(stats.merged_sketches(daily), SHARES_ASKED).select("n", F.posexplode("quantiles").alias("place", "q"))
    below = e.crossJoin(F.broadcast(found)).groupBy("place", "n").agg((F.count_if(F.col("x") <= F.col("q")) / F.col("n")).alias("share"))  # nine rows
    return below.select("place", "n", (F.abs(F.col("share") - (F.col("place") + 1) / 10) <= 3 * stats.rank_error(800)).alias("within"))


# scores


def features(s: DataFrame, v: DataFrame) -> DataFrame:
    users = behaviour.categories(s).select("user_id", "browser_most_common", "device_type_most_common")
    return users.join(behaviour.device_counts(s).select("user_id", "n_device_categories"), "user_id", "left").join(behaviour.page_view_misc(v).select("user_id", "engine_most_common"), "user_id", "left")


#: (brackets, coefficients of domains, of interests and of flags) of each family of scores.
FAMILIES = {"income": (scores.INCOME, X.URL_COEFFICIENTS, X.INTEREST_COEFFICIENTS, X.FLAG_COEFFICIENTS), "education": (scores.EDUCATION, X.URL_EDUCATION, X.INTEREST_EDUCATION, X.FLAG_EDUCATION)}


def score_inputs(spark: SparkSession, sf: str, keep: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Page views, affinities and flags of users. ``keep`` writes the latter two down, for several families of scores."""
    hits, voc = fixed(X.ordered(spark, sf)), vocabulary(spark)
    s, v = X.sessions_of(hits), X.views_of(hits)
    aff = interests.affinities(interests.tokens_of_interest(v, voc), voc)
    places = scores.location_flags(X.members(spark, sf), X.literal(spark, X.PLACES, ["segment_id", "name"])).select("user_id", "countryside_flag", "regional_town_flag")
    flags = scores.web_flags(features(s, v)).join(places, "user_id", "left")
    return v, *(fixed(df) if keep else df for df in (aff, flags))


def raw_scores(spark: SparkSession, sf: str, family: str = "income", inputs: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> dict[str, DataFrame]:
    brackets, of_url, of_interest, of_flag = FAMILIES[family]
    v, aff, flags = inputs or score_inputs(spark, sf)
    return {
        "interest": scores.interest_scores(aff, X.coefficients(spark, of_interest, "interest", brackets), brackets),
        "url": scores.url_scores(v, X.coefficients(spark, of_url, "domain", brackets), brackets),
        "other": scores.other_scores(flags, X.coefficients(spark, of_flag, "flag", brackets), brackets),
    }


def score_columns(family: str) -> list[str]:
    return scores.named(FAMILIES[family][0])


SCORE_COLUMNS = score_columns("income")
RAW = {f: {"url": Q.url_raw(u, b), "interest": Q.interest_raw(i, b), "other": Q.other_raw(o, b)} for f, (b, u, i, o) in FAMILIES.items()}


@query(f"WITH {Q.VIEWS} " + Q.scores(RAW["income"]["url"], scores.INCOME))
def url_score(spark, sf):
    return raw_scores(spark, sf)["url"].select("user_id", *r6(*SCORE_COLUMNS))


@query(f"WITH {Q.VIEWS} SELECT user_id, count(*) AS n_urls, array_to_string(list_sort(list(DISTINCT domain)), ',') AS domains, CAST(floor(epoch(max(ts))) AS BIGINT) AS latest FROM views GROUP BY 1")
def url_score_monitor(spark, sf):
    v, brackets = X.views(spark, sf), scores.INCOME
    out = scores.url_scores(v, X.coefficients(spark, X.URL_COEFFICIENTS, "domain", brackets), brackets, monitor=True)
    return out.select("user_id", "n_urls", F.array_join("domains", ",").alias("domains"), epoch("latest").alias("latest"))


@query(f"WITH {Q.AFFINITY} " + Q.scores(RAW["income"]["interest"], scores.INCOME))
def interest_score(spark, sf):
    return raw_scores(spark, sf)["interest"].select("user_id", *r6(*SCORE_COLUMNS))


@query(f"WITH {Q.USERS_PLACED} " + Q.scores(RAW["income"]["other"], scores.INCOME))
def other_score(spark, sf):
    return raw_scores(spark, sf)["other"].select("user_id", *r6(*SCORE_COLUMNS))


@query(f"WITH {Q.USERS_PLACED} " + Q.scores(RAW["education"]["other"], scores.EDUCATION))
def education_other_score(spark, sf):
    return raw_scores(spark, sf, "education")["other"].select("user_id", *r6(*score_columns("education")))


@query(f"WITH {Q.USERS} SELECT * FROM flags")
def web_flags(spark, sf):
    hits = X.ordered(spark, sf)
    return scores.web_flags(features(X.sessions_of(hits), X.views_of(hits)))


def family_scores(spark: SparkSession, sf: str, family: str, normalise: bool, inputs: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> DataFrame:
    """Scores of users with all three parts; ranked where they are normalised."""
    raw, brackets = raw_scores(spark, sf, family, inputs), FAMILIES[family][0]
    parts = {n: scores.transformed(raw[n], brackets, normalise=normalise and n != "other") for n in raw}
    return scores.blended(parts, brackets, ranked=normalise)


VIEWS_AND_USERS = Q.USERS_PLACED + Q.VIEWS[len(Q.ORDERED) :] + Q.affinity_tables(Q.VOCABULARY)


def blend(family: str, raw: dict[str, str] | None = None) -> str:
    """Tables <family>_blend and <family> (user_id, score_<bracket>): plain scores of all three parts."""
    b, raw = FAMILIES[family][0], raw or RAW[family]
    parts = ", ".join(f"(3 * i.score_{x} + 5 * u.score_{x} + 4 * o.score_{x}) / 12.0 AS x_{x}" for x in b)
    joined = f"{Q.squashed(raw['interest'], b)} i JOIN {Q.squashed(raw['url'], b)} u USING (user_id) JOIN {Q.squashed(raw['other'], b)} o USING (user_id)"
    return f", {family}_blend AS (SELECT i.user_id, {parts} FROM {joined}), {family} AS (SELECT user_id, {', '.join(f'x_{x} / (2 * (1 + abs(x_{x}))) + 0.5 AS score_{x}' for x in b)} FROM {family}_blend)"


@query(f"WITH {VIEWS_AND_USERS}{blend('income')} " + Q.scores("income", scores.INCOME))
def income_score_plain(spark, sf):
    return family_scores(spark, sf, "income", normalise=False).select("user_id", *r6(*SCORE_COLUMNS))


@query(f"WITH {VIEWS_AND_USERS}{blend('education')} " + Q.scores("education", scores.EDUCATION))
def education_score_plain(spark, sf):
    return family_scores(spark, sf, "education", normalise=False).select("user_id", *r6(*score_columns("education")))


NORMAL = ", ".join(f"{p}_raw AS MATERIALIZED (SELECT * FROM {RAW['income'][p]} AS raw_of), {Q.box_cox(f'{p}_bc', f'{p}_raw', SCORE_COLUMNS)}" for p in ("interest", "url"))
RANKED = ", ".join(f"round({c}, 6) AS {c}, round(percent_rank() OVER (ORDER BY round({c}, 9)), 6) AS {c}_rank" for c in SCORE_COLUMNS)


@query(f"WITH {VIEWS_AND_USERS}, {NORMAL}{blend('income', {'interest': 'interest_bc', 'url': 'url_bc', 'other': RAW['income']['other']})} SELECT user_id, {RANKED} FROM income")
def income_score(spark, sf):
    return family_scores(spark, sf, "income", normalise=True).select("user_id", *r6(*SCORE_COLUMNS, *[f"{c}_rank" for c in SCORE_COLUMNS]))


PAIRS = {f"{i}_{e}": f"(i.score_{i} + 0.7 * e.score_{e})" for i in scores.INCOME for e in scores.EDUCATION}
LETTERS = ", ".join(f"greatest({', '.join(PAIRS[k] for k in ks)}) AS {letter}" for letter, ks in scalars.BRACKETS.items())


@query(f"WITH {VIEWS_AND_USERS}{blend('income')}{blend('education')}, x AS (SELECT user_id, {LETTERS} FROM income i JOIN education e USING (user_id)) SELECT user_id, " + ", ".join(f"round({c}, 6) AS {c}, round(percent_rank() OVER (ORDER BY round({c}, 12)), 4) AS {c}_rank" for c in scalars.BRACKETS) + " FROM x")
def abcde(spark, sf):
    """Letters of users with both income and education scores."""
    inputs = score_inputs(spark, sf, keep=True)
    both = [family_scores(spark, sf, f, normalise=False, inputs=inputs).select("user_id", *[F.round(f"score_{b}", 12).alias(f"{f}_{b}") for b in FAMILIES[f][0]]) for f in FAMILIES]
    out = scores.abcde(both[0].join(both[1], "user_id"))
    return out.select("user_id", *[x for c in scalars.BRACKETS for x in (F.round(c, 6).alias(c), F.round(f"{c}_rank", 4).alias(f"{c}_rank"))])


@query(f"WITH {Q.LOCATIONS} SELECT user_id, n_places, location, countryside_flag, regional_town_flag FROM loc")
def location_flags(spark, sf):
    return scores.location_flags(X.members(spark, sf), X.literal(spark, X.PLACES, ["segment_id", "name"]))


# targets and segments


AGE = "CASE WHEN TRY_CAST(age AS INT) BETWEEN 0 AND 100 THEN CAST(TRY_CAST(age AS INT) AS VARCHAR) ELSE 'unknown' END"
GENDER = "CASE gender WHEN '1' THEN '2' WHEN '2' THEN '1' ELSE 'unknown' END"


@query(f"WITH {Q.HITS} SELECT event_id, {AGE} AS age, {GENDER} AS gender FROM raw_hits")
def age_gender_clean(spark, sf):
    return targets.declared(X.hits(spark, sf)).select("event_id", "age", "gender")


BAND = "CASE " + " ".join(f"WHEN TRY_CAST(age AS INT) BETWEEN {a} AND {b} THEN '{i}'" for i, (a, b) in enumerate(scalars.AGE_BANDS)) + " ELSE 'unknown' END"


@query(
    f"WITH {Q.HITS}, d AS (SELECT device AS user_id, CASE WHEN owner_name IN ('click', 'view') THEN {AGE} ELSE 'unknown' END AS age, CASE WHEN owner_name IN ('click', 'view') THEN {GENDER} ELSE 'unknown' END AS gender FROM raw_hits WHERE device <> ''),"
    f" l AS (SELECT user_id, nullif({BAND}, 'unknown') AS a, CASE gender WHEN '1' THEN '0' WHEN '2' THEN '1' END AS g FROM d)"
    " SELECT user_id, CASE WHEN min(a) = max(a) THEN min(a) ELSE 'unknown' END AS target_age, CASE WHEN min(g) = max(g) THEN min(g) ELSE 'unknown' END AS target_gender FROM l GROUP BY 1"
)
def sociodemo_target(spark, sf):
    h = targets.declared(X.hits(spark, sf).where("device <> ''")).withColumnsRenamed({"device": "user_id"})
    return targets.resolved(targets.trusted(h, ["click", "view"], "owner_name"))


@query(
    f"WITH {Q.HITS}, d AS (SELECT device AS user_id, CASE WHEN owner_name = 'click' THEN {AGE} ELSE 'unknown' END AS age, CASE WHEN owner_name = 'click' THEN {GENDER} ELSE 'unknown' END AS gender FROM raw_hits WHERE device <> '' AND event_id % 3 = 0),"
    f" l AS (SELECT user_id, nullif({BAND}, 'unknown') AS a, CASE gender WHEN '1' THEN '0' WHEN '2' THEN '1' END AS g FROM d), t AS (SELECT user_id, CASE WHEN min(a) = max(a) THEN min(a) ELSE 'unknown' END AS target_age, CASE WHEN min(g) = max(g) THEN min(g) ELSE 'unknown' END AS target_gender FROM l GROUP BY 1)"
    " SELECT c_custkey AS customer, target_age, target_gender FROM customer LEFT JOIN t ON t.user_id = CAST(c_custkey AS VARCHAR)"
)
def sociodemo_target_of_users(spark, sf):
    """Targets of given users; NULL for those who declared nothing."""
    h = targets.declared(X.hits(spark, sf).where("device <> '' AND event_id % 3 = 0")).withColumnsRenamed({"device": "user_id"})
    users = X.table(spark, sf, "customer").select(F.col("c_custkey").alias("customer"), F.col("c_custkey").cast("string").alias("user_id"))
    return targets.resolved(targets.trusted(h, ["click"], "owner_name"), users).select("customer", "target_age", "target_gender")


MODELS = [("buyers", "purchase:0, signup:1"), ("readers", "view:2"), ("none", "absent")]


@query(
    f"WITH {Q.TRAITS}, u AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id FROM events) SELECT u.user_id, "
    + ", ".join(f"CAST(count(*) FILTER (segment_id IN ({Q.names([s.strip() for s in ids.split(',')])})) > 0 AS INT) AS {Q.q(m)[1:-1] if m != 'none' else '"none"'}" for m, ids in MODELS)
    + ", concat_ws(',', " + ", ".join(f"CASE WHEN count(*) FILTER (segment_id IN ({Q.names([s.strip() for s in ids.split(',')])})) > 0 THEN {Q.q(m)} END" for m, ids in MODELS) + ") AS models FROM u LEFT JOIN tr USING (user_id) GROUP BY 1"
)
def lookalike_target(spark, sf):
    users = X.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user_id")).distinct()
    return targets.lookalike_targets(users, X.members(spark, sf), X.literal(spark, MODELS, ["model", "segment_ids"]), [m for m, _ in MODELS])


@query("SELECT DISTINCT trim(s) AS segment_id FROM (SELECT unnest(string_split(event_type || ', ' || CAST(user_id AS VARCHAR), ',')) AS s FROM events)")
def segment_ids(spark, sf):
    e = X.table(spark, sf, "events").select(F.concat_ws(", ", "event_type", F.col("user_id").cast("string")).alias("segment_ids"))
    return targets.segment_ids(e)


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type AS segment_id FROM events")
def segment_members(spark, sf):
    pages = X.table(spark, sf, "events").groupBy(F.col("event_type").alias("segment_id"), F.expr("event_id div 100").alias("page"))  # a response has a hundred events at most
    return targets.ingest_members(pages.agg(F.collect_list(F.struct(F.col("user_id").cast("string").alias("userId"))).alias("events")))


@query("SELECT c.c_custkey AS id, c.c_name AS name, CASE WHEN c.c_custkey % 3 = 0 THEN c.c_mktsegment END AS model FROM customer c")
def catalogue_sync(spark, sf):
    c = X.table(spark, sf, "customer")
    catalogue = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("stale").alias("model"))
    return targets.synced_catalogue(catalogue, c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("model")))


# models


SCHEMA = T.StructType([T.StructField("n_device_categories", T.LongType()), T.StructField("example_flag", T.IntegerType()), T.StructField("browser_most_common", T.StringType()), T.StructField("engine_most_common", T.StringType()), T.StructField("label", T.IntegerType())])


def model_inputs(spark: SparkSession, sf: str) -> DataFrame:
    hits = X.ordered(spark, sf)
    v = X.views_of(hits)
    collected = v.groupBy("user_id").agg(F.collect_set("domain").alias("urls"))
    joined, _ = models.with_urls(features(X.sessions_of(hits), v), collected)
    flagged = models.with_url_flags(joined, {"example_flag": "example.com"})
    return models.prepared(flagged, models.fields_of(SCHEMA), {"browser_most_common": ["chrome", "safari"]})


@query(
    f"WITH {VIEWS_AND_USERS}, w AS (SELECT user_id, CAST(bool_or(domain = 'example.com') AS INT) AS e FROM views GROUP BY 1) SELECT user_id, coalesce(n_device_categories, 0) AS n_device_categories, coalesce(e, 0) AS example_flag,"
    " CASE WHEN browser_most_common IN ('chrome', 'safari') THEN browser_most_common ELSE 'None' END AS browser_most_common, coalesce(engine_most_common, 'None') AS engine_most_common FROM feat LEFT JOIN w USING (user_id)"
)
def sociodemo_inputs(spark, sf):
    return model_inputs(spark, sf).select("user_id", "n_device_categories", "example_flag", "browser_most_common", "engine_most_common")


def fitted(spark: SparkSession, sf: str, label: str, steps: int = 20):
    """A logistic model of all components of the embeddings, fitted to four fifths of the rows."""
    from pyspark.ml.classification import LogisticRegression

    rows = embedded(spark, sf).withColumn("label", F.expr(label).cast("double"))
    return LogisticRegression(maxIter=steps, regParam=0.01).fit(rows.where("user_id % 5 <> 0"))


def embedded(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return X.table(spark, sf, "embeddings").select(F.col("vec_id").alias("user_id"), F.col("label").alias("group"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query()
def lookalike_score(spark, sf):
    return models.score_all(embedded(spark, sf), {"first": fitted(spark, sf, "`group` = 0"), "second": fitted(spark, sf, "`group` = 1"), "untrained": None})


AGE_MODELS = [f"age_{i}" for i in range(len(scalars.AGE_BANDS))]


@query()
def sociodemo_score(spark, sf):
    """A model for each age band (the last one fails to load) and one of gender, with its complement."""
    bands = {m: fitted(spark, sf, f"`group` = {i}", steps=5) for i, m in enumerate(AGE_MODELS[:-1])}
    failed = models.load({AGE_MODELS[-1]: f"{sf}/no_such_model"}, optional=True)
    return models.score_all(embedded(spark, sf), bands | failed | {"male": fitted(spark, sf, "`group` < 5")}, complement={"female": "male"}, missing=None)


@query()
def feature_importance(spark, sf):
    model = fitted(spark, sf, "`group` = 0")
    return models.importances(spark, model, [f"x{i}" for i in range(model.numFeatures)])


#: What a document's quality is told from, as a model's input.
QUALITY_FIELDS = {"numbers": ["n_chars", "n_words"], "flags": ["blank_flag"], "categories": ["lang", "source"]}


def quality_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = X.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", F.size(F.split(F.coalesce("text", F.lit("")), " ")).alias("n_words"), F.coalesce(F.trim("text") == "", F.lit(True)).cast("int").alias("blank_flag"))
    rows = d.join(X.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
    return models.prepared(rows, QUALITY_FIELDS, {})


def quality_model(spark: SparkSession, sf: str):
    from pyspark.ml.classification import GBTClassifier

    return models.pipeline(QUALITY_FIELDS, GBTClassifier(maxIter=5, maxDepth=3, seed=3)).fit(quality_rows(spark, sf).where("doc_id % 5 <> 0"))


@query()
def saved_model_score(spark, sf):
    """Documents' quality by a boosted tree with its preparation steps, saved and loaded again; ``same``: whether the
    loaded model says what the fitted one does."""
    path, rows, model = shared_folder(spark), quality_rows(spark, sf), quality_model(spark, sf)
    models.save(model, path)
    loaded = models.load({"quality": path})
    scored = models.score_all(rows, loaded, key="doc_id")
    fitted_ = models.probability(rows, model, "p").select("doc_id", "p")
    return scored.join(fitted_, "doc_id").select("doc_id", "quality_probability", "quality_percentile", (F.col("p") == F.col("quality_probability")).alias("same"))


@query()
def saved_model_importance(spark, sf):
    return models.column_importances(spark, quality_model(spark, sf), quality_rows(spark, sf))


@query()
def word_synonyms(spark, sf):
    """The three words nearest to each of the three most frequent ones, by vectors that were fitted, saved and loaded."""
    path = shared_folder(spark)
    d = X.table(spark, sf, "documents").select(text.tokens("text", unicode=True).alias("tokens"))
    synonyms.save(synonyms.fit(d, "tokens", size=32, least=20), path)
    model = synonyms.load(path)
    asked = [r[0] for r in d.select(F.explode("tokens").alias("w")).groupBy("w").count().orderBy(F.desc("count"), "w").limit(3).collect()]
    return io.union_all([synonyms.synonyms(model, [w], 3).select(F.lit(w).alias("asked"), "word", "score") for w in asked])


# evaluation


LIFT = """
b AS (SELECT ntile(10) OVER (ORDER BY score DESC, doc_id) AS bucket, score, hit FROM p),
g AS (SELECT bucket, count(*) AS n, sum(hit) AS hits, avg(score) AS avg_score FROM b GROUP BY 1),
c AS (SELECT *, avg(hits) OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS cum_avg_hits FROM g)"""


def lift_sql(target: str, positive: int = 1, where: str = "true") -> str:
    return f"WITH p AS (SELECT l.doc_id, d.n_chars % 997 / 997.0 AS score, CAST(l.{target} = {positive} AS INT) AS hit FROM labels l JOIN documents d USING (doc_id) WHERE {where}), {LIFT}"


LIFT_OUT = " SELECT CAST(bucket AS INT) AS bucket, n, CAST(hits AS BIGINT) AS hits, round(avg_score, 6) AS avg_score, round(cum_avg_hits, 6) AS cum_avg_hits, round(cum_avg_hits / last_value(cum_avg_hits) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 6) AS cum_lift FROM c"


def lifted(df: DataFrame) -> DataFrame:
    return df.select("bucket", "n", "hits", *r6("avg_score", "cum_avg_hits", "cum_lift"))


@query(lift_sql("quality") + LIFT_OUT)
def lift_curve(spark, sf):
    return lifted(lift.curve(X.predictions(spark, sf), "score", "quality", "doc_id"))


@query(lift_sql("toxic", 0) + LIFT_OUT)
def lift_generalized(spark, sf):
    return lifted(lift.curve(X.predictions(spark, sf), "score", "toxic", "doc_id", positive=0))


def lift_half(remainder: int) -> str:
    return f"(WITH p AS (SELECT l.doc_id, d.n_chars % 997 / 997.0 AS score, CAST(l.quality = 1 AS INT) AS hit FROM labels l JOIN documents d USING (doc_id) WHERE l.doc_id % 2 = {remainder}), {LIFT} {LIFT_OUT})"


@query(f"SELECT a.bucket, a.cum_lift AS cum_lift_train, b.cum_lift AS cum_lift_test FROM {lift_half(0)} a JOIN {lift_half(1)} b USING (bucket)")
def lift_train_test(spark, sf):
    p = X.predictions(spark, sf)
    out = lift.train_test(p.where("doc_id % 2 = 0"), p.where("doc_id % 2 = 1"), "score", "quality", "doc_id")
    return out.select("bucket", *r6("cum_lift_train", "cum_lift_test"))


@query(
    f"WITH {Q.VIEWS}, r AS (SELECT user_id, CAST(owner_name = 'purchase' AS INT) AS target, tokens FROM views), nn AS (SELECT count(DISTINCT user_id) AS a, count(DISTINCT user_id) FILTER (target = 1) AS f FROM r),"
    " t AS (SELECT hits, user_id, max(target) AS t FROM (SELECT user_id, target, unnest(tokens) AS hits FROM r) GROUP BY 1, 2), k AS (SELECT hits, count(*) AS users, sum(t) AS fu FROM t GROUP BY 1 HAVING count(*) >= 30),"
    " s AS (SELECT hits, users, coalesce(fu / CAST(nullif(f, 0) AS DOUBLE) * 100, 0) AS fg, users / CAST(a AS DOUBLE) * 100 AS bg FROM k, nn) SELECT hits, users, round(fg, 6) AS foreground, round(bg, 6) AS background, round(fg / bg * (fg - bg), 6) AS jlh FROM s"
)
def jlh_tokens(spark, sf):
    rows = X.views(spark, sf).select("user_id", (F.col("owner_name") == "purchase").cast("int").alias("target"), "tokens")
    return lift.token_significance(rows, "user_id").select("hits", "users", *r6("foreground", "background", "jlh"))


@query(
    f"WITH {Q.VIEWS}, r AS (SELECT unnest(tokens) AS hits, owner_name FROM views), k AS (SELECT hits, sum(CAST(owner_name = 'click' AS INT)) AS oi, count(*) AS oa FROM r GROUP BY 1 HAVING count(*) > 10), g AS (SELECT sum(oi) / CAST(sum(oa) AS DOUBLE) AS rate FROM k)"
    " SELECT hits, CAST(oi AS BIGINT) AS occurrence_in, oa AS occurrence_all, round(oi / CAST(oa AS DOUBLE), 6) AS hitrate, round(oi / CAST(oa AS DOUBLE) - rate, 6) AS direction, round(oi / CAST(oa AS DOUBLE) / rate, 6) AS improvement FROM k, g"
)
def word_lift(spark, sf):
    rows = X.views(spark, sf).select(F.explode("tokens").alias("hits"), "owner_name")
    return lift.word_lift(rows, F.col("owner_name") == "click").select("hits", "occurrence_in", "occurrence_all", *r6("hitrate", "direction", "improvement"))


@query(
    "WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), s AS (SELECT w.vec_id AS word, sum(list_cosine_similarity(w.e, q.e)) AS score, count(*) AS n_queries FROM v w JOIN v q ON q.vec_id < 5 AND q.vec_id <> w.vec_id GROUP BY 1)"
    " SELECT word, round(score, 6) AS score, n_queries FROM s ORDER BY s.score DESC, word LIMIT 20"
)
def related_words(spark, sf):
    v = X.table(spark, sf, "embeddings").select(F.col("vec_id").alias("word"), F.col("embedding").alias("vector"))
    return lift.related(v, v.where("word < 5"), 20).select("word", *r6("score"), "n_queries")


# assembly


def stage(spark: SparkSession, sf: str) -> DataFrame:
    when = F.lit(X.AS_OF).cast("date").alias("timestamp")
    hits = X.ordered(spark, sf)
    s, v = recent(X.sessions_of(hits)), X.views_of(hits)
    a = behaviour.device_counts(s).select("user_id", when, "n_device_categories")
    b = behaviour.web_visits(v).select("user_id", when, "n_visits")
    return assemble.assemble([a, b], {"n_{what}": 0})


STAGE = f"{Q.SESSIONS}{Q.VIEWS[len(Q.ORDERED):]}, a AS (SELECT user_id, count(DISTINCT device_category) AS n_device_categories FROM recent GROUP BY 1), b AS (SELECT user_id, count(DISTINCT ts) AS n_visits FROM views WHERE NOT contains(url_normalized, 'blog') GROUP BY 1), stage AS (SELECT user_id, coalesce(n_device_categories, 0) AS n_device_categories, coalesce(n_visits, 0) AS n_visits FROM a FULL JOIN b USING (user_id))"


@query(f"WITH {STAGE} SELECT * FROM stage")
def stage1_assemble(spark, sf):
    return stage(spark, sf).select("user_id", "n_device_categories", "n_visits")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def latest_snapshot(spark, sf):
    return assemble.latest(X.table(spark, sf, "events").select("user_id", "event_id", "event_type"), ts="event_id")


@query(f"WITH {STAGE} SELECT user_id, 'frequent' AS segment FROM stage WHERE n_visits > 20 AND n_device_categories >= 1")
def segment_sql(spark, sf):
    return assemble.segment(stage(spark, sf), "n_visits > 20 AND n_device_categories >= 1", "frequent")[0]


@query("SELECT doc_id, CAST(NULL AS BIGINT) AS page_id, lang AS kind FROM documents UNION ALL SELECT NULL, page_id, NULL FROM pages")
def union_by_name(spark, sf):
    d = X.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("kind"))
    return io.union_all([d, X.table(spark, sf, "pages").select("page_id")]).select("doc_id", "page_id", "kind")


@query("SELECT vec_id, round(len(list_filter(embedding, lambda x: x > 0)) / CAST(len(embedding) AS DOUBLE), 6) AS share, embedding[1] + embedding[2] + embedding[3] AS total FROM embeddings")
def list_shares(spark, sf):
    signs = F.transform("embedding", lambda x: F.when(x > 0, "p").otherwise("n"))
    e = F.col("embedding")
    return X.table(spark, sf, "embeddings").select("vec_id", F.round(scalars.share_in(signs, ["p"]), 6).alias("share"), scalars.total([e[0], e[1], e[2]]).alias("total"))


@query(
    "SELECT CAST(event_id % 5 AS INT) AS part, NULL AS reason, event_id, user_id, CAST(json_extract(props, '$.k') AS SMALLINT) AS k, event_type AS item FROM events WHERE event_id % 5 IN (0, 1)"
    " UNION ALL SELECT 3, 'type of user_id: STRING, not bigint', NULL, NULL, NULL, NULL UNION ALL SELECT 4, 'not JSON', NULL, NULL, NULL, NULL"
)
def landed_files(spark, sf):
    """The events as JSON in five drops, of which one has users as texts, one has broken lines and one has been loaded
    before: rows of the good new files, and the reasons of the others."""
    part = F.col("event_id") % 5
    e = X.table(spark, sf, "events").select(part.alias("part"), "event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "event_type")
    user = F.when(F.col("part") == 3, F.concat(F.lit('"u'), F.col("user_id").cast("string"), F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    entry = F.to_json(F.array(F.struct(F.lit("kind").alias("group"), F.col("event_type").alias("item"))))
    line = F.concat(F.lit('{"events": [{"event_id": '), F.col("event_id").cast("string"), F.lit(', "user_id": '), user, F.lit(', "k": '), F.coalesce(F.col("k").cast("string"), F.lit("null")), F.lit(', "params": '), entry, F.when(F.col("part") == 4, "").otherwise("}]}"))
    folder = shared_folder(spark)
    e.select("part", line.alias("value")).write.partitionBy("part").text(folder)
    fields = {"event_id": "bigint", "user_id": "bigint", "k": "smallint", "params": "entry"}
    number = F.regexp_extract("source_file", "/part=([0-9]+)/", 1).cast("int").alias("part")
    known = landing.lines(spark, f"{folder}/part=2").select("source_file").distinct()
    rows, faults = landing.load(spark, folder, fields, ["event_id"], known=known)
    why = faults.select(number, F.explode("reasons").alias("reason")).distinct()
    return io.union_all([rows.select(number, F.lit(None).cast("string").alias("reason"), "event_id", "user_id", "k", F.col("params.item").alias("item")), why])


@query("SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS price, o_orderstatus AS status FROM orders")
def jdbc_ranges(spark, sf):
    """Orders written to a database twice (the second empties the table first) and read back in eight measured ranges.
    The database is Derby inside the driver's process, so this query is for a session on one machine."""
    url, table = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", "ORDERS_COPY"
    o = X.table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"), F.col("o_orderstatus").alias("status"))
    o = o.coalesce(4)  # connections that write at a time
    io.write_jdbc(o.where("o_orderkey % 2 = 0"), url, table)
    io.write_jdbc(o, url, table, mode="overwrite")
    return io.read_jdbc(spark, url, table, '"o_orderkey"', parts=8)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def day_numbers(spark, sf):
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("long")
    return X.table(spark, sf, "orders").select("o_orderkey", scalars.day_number_to_date(number).alias("day"))


@query(f"WITH {Q.ORDERED} SELECT device, CAST(min(sec) AS BIGINT) AS started, CAST(max(sec) AS BIGINT) AS ended, count(*) AS n_events FROM ordered GROUP BY device, ordinal")
def stream_sessions(spark, sf):
    from spindrift.streaming.sessions import stream_sessions as closed

    return closed(X.hits(spark, sf)).select("device", epoch("session_start").alias("started"), epoch("session_end").alias("ended"), "n_events")


@query(f"WITH {Q.ORDERED} SELECT event_id, device, ordinal, round(minutes, 6) AS minutes, CAST(min(sec) OVER (PARTITION BY device, ordinal) AS BIGINT) AS started, referrer_first FROM ordered")
def open_sessions(spark, sf):
    """The hits delivered in three batches, an eleventh of them two days late: sessions go on from batch to batch."""
    from spindrift.streaming.open_sessions import OpenSessions

    h = X.hits(spark, sf).where("device <> ''").select("event_id", "device", "ts", "referrer_host")
    arrival = F.to_date("ts") + F.when(F.col("event_id") % 11 == 0, 2).otherwise(0)
    batch = sum((arrival >= F.lit(day).cast("date")).cast("int") for day in ("2024-01-10", "2024-01-20"))
    store = OpenSessions(spark, shared_folder(spark), h.schema, lateness=dt.timedelta(days=3))
    for n in range(3):
        store.advance(h.where(batch == n), last=n == 2)
    return store.read().select("event_id", "device", "ordinal", *r6("minutes"), epoch("started").alias("started"), "referrer_first")


LISTS = [("men", "primary", "example.com"), ("men", "secondary", "example.net"), ("women", "primary", "example.org"), ("women", "secondary", "example.com")]


@query(f"WITH {Q.VIEWS} SELECT user_id, band, count(*) FILTER (tier = 'primary') AS n_primary, count(*) FILTER (tier = 'secondary') AS n_secondary FROM views JOIN {Q.values(LISTS, 'band, tier, domain')} USING (domain) GROUP BY 1, 2")
def list_matches(spark, sf):
    return targets.list_matches(X.views(spark, sf), X.literal(spark, LISTS, ["band", "tier", "domain"]))


@query(f"WITH {Q.USERS_PLACED}{Q.VIEWS[len(Q.ORDERED) :]} SELECT 'url' AS part, * FROM ({Q.scores(RAW['income']['url'], scores.INCOME)}) UNION ALL SELECT 'other', * FROM ({Q.scores(RAW['income']['other'], scores.INCOME)})")
def partial_scores(spark, sf):
    """The parts of a run's income scores that are not stored yet: interests are, so URLs and flags are built."""
    raw, run = raw_scores(spark, sf), F.lit(X.AS_OF).cast("date")
    stored = raw["interest"].select(F.lit("income").alias("family"), F.lit("interest").alias("part"), run.alias("timestamp"))
    built = scores.missing_parts(stored, "income", run, {n: (lambda n=n: raw[n]) for n in raw})
    return io.union_all([df.select(F.lit(n).alias("part"), "user_id", *r6(*SCORE_COLUMNS)) for n, df in built.items()])
