"""The checking SQL: for each named query, the same result in another engine's SQL.

Every statement starts from the ``events`` table through the adapter's own expressions and then
states the operator independently.
"""

from __future__ import annotations

from editengine.plans.catalog import AS_OF, BIG_CHANGE, CENTROIDS, CUTOFF, RECORD, SILVER, _REPORT_NAMES
from editengine.sources.events import BLANKED, RAW_COLUMNS, TRUNCATED
from editengine import schema as S

_TYPES = {
    "eventTime": "TIMESTAMP", "ingestionTime": "TIMESTAMP", "latencyMs": "BIGINT", "isAnon": "BOOLEAN",
    "editSizeCategory": "VARCHAR", "commentLen": "INTEGER", "hourOfDay": "INTEGER", "dayOfWeek": "INTEGER",
    "wikiLang": "VARCHAR", "langCode": "VARCHAR",
}


def _names(columns, prefix=""):
    return ", ".join(f'{prefix}"{c}"' for c in columns)


def _adapter() -> str:
    shaped = ",\n      ".join(
        f"{e.replace('STR', 'varchar')} as {n}" for n, e in RAW_COLUMNS.items() if n != "arrival_ms"
    )
    return f"""
  named as (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k, epoch(ts) as epoch_s from events),
  shaped as (select event_id, {shaped} from named),
  raw as (
    select id, type, wiki, title, '/page/' || title as title_url, namespace, usr as "user", bot, minor,
      ts_s as "timestamp", comment, wiki || '.example.org' as server_name,
      cast({RAW_COLUMNS['arrival_ms']} as bigint) as ingestion_ts, coalesce(bot, false) as is_bot,
      case namespace when 0 then 'article' when 1 then 'talk' when 2 then 'user' when 3 then 'user_talk'
        when 4 then 'wikipedia' when 6 then 'file' when 10 then 'template' when 14 then 'category'
        else 'ns_' || coalesce(namespace, -1) end as namespace_str,
      byte_delta, cast(length(coalesce(title, '')) as integer) as title_len
    from shaped),
  bronze as (select * from raw where wiki is not null),
  derived as (
    select *, make_timestamp("timestamp" * 1000000) as "eventTime",
      make_timestamp((ingestion_ts // 1000) * 1000000) as "ingestionTime",
      ingestion_ts - "timestamp" * 1000 as "latencyMs",
      regexp_matches("user", '{S.IPV4_TEXT}') as "isAnon",
      case when byte_delta is null then 'unknown' when byte_delta > 5000 then 'large_add'
        when byte_delta > 500 then 'small_add' when byte_delta >= 0 then 'tiny'
        when byte_delta > -500 then 'small_del' else 'large_del' end as "editSizeCategory",
      cast(length(coalesce(comment, '')) as integer) as "commentLen",
      cast(hour(make_timestamp("timestamp" * 1000000)) as integer) as "hourOfDay",
      cast(dayofweek(make_timestamp("timestamp" * 1000000)) + 1 as integer) as "dayOfWeek",
      regexp_extract(wiki, '{S.WIKI_LANG}', 1) as "wikiLang",
      regexp_extract(wiki, '{S.LANG_CODE}', 1) as "langCode"
    from bronze),
  silver as (
    select {_names(SILVER)} from derived
    where "timestamp" > 0 and type in ('edit', 'new', 'categorize', 'log'))"""


_STORE = """,
  store as (
    select coalesce(nullif(wiki, ''), 'unknown') as wiki, coalesce(nullif("wikiLang", ''), 'unknown') as wiki_lang,
      "eventTime" as event_time, coalesce(id, 0) as event_id, coalesce(ingestion_ts, 0) as ingestion_ts, type,
      coalesce(title, '') as title, coalesce(title_url, '') as title_url, coalesce(namespace, 0) as namespace,
      coalesce(nullif("user", ''), 'anonymous') as user_name, coalesce(bot, false) as is_bot,
      coalesce(minor, false) as is_minor, coalesce("isAnon", false) as is_anon, coalesce(byte_delta, 0) as byte_delta,
      coalesce(title_len, 0) as title_len, coalesce("commentLen", 0) as comment_len, coalesce(comment, '') as comment,
      coalesce("hourOfDay", 0) as hour_of_day, coalesce("dayOfWeek", 1) as day_of_week,
      coalesce("latencyMs", 0) as latency_ms, "editSizeCategory" as edit_size_cat,
      coalesce(server_name, '') as server_name
    from silver where "eventTime" is not null),
  edits as (select * from store where type = 'edit')"""

_GOLD = """,
  article as (select * from silver where type = 'edit' and namespace = 0),
  totals as (
    select time_bucket(interval '5 minutes', "eventTime") as "windowStart", wiki, count(*) as "totalEdits",
      cast(sum(cast(bot as int)) as bigint) as "botEdits", cast(sum(cast("isAnon" as int)) as bigint) as "anonEdits",
      cast(sum(byte_delta) as double) / count(byte_delta) as "avgByteDelta",
      count(distinct "user") as "uniqueEditors",
      cast(sum("commentLen") as double) / count("commentLen") as "avgCommentLen"
    from article group by all),
  gold as (
    select *, "windowStart" + interval '5 minutes' as "windowEnd",
      cast("botEdits" as double) / "totalEdits" as "botRatio", cast("anonEdits" as double) / "totalEdits" as "anonRatio",
      cast("anonEdits" as double) / "totalEdits" > 0.3 and "totalEdits" > 5 as "vandalismFlag"
    from totals),
  closed as (
    select * from gold
    where "windowEnd" <= (select max("eventTime") from article) - interval '1 minute')"""

_FEATURES = """,
  features as (
    select id, wiki, "user", bot, cast("isAnon" as int) as "isAnon", coalesce(byte_delta, 0) as byte_delta,
      coalesce(title_len, 0) as title_len, coalesce("commentLen", 0) as "commentLen", minor,
      coalesce("hourOfDay", 0) as "hourOfDay", coalesce("dayOfWeek", 1) as "dayOfWeek", "editSizeCategory", "wikiLang",
      coalesce("latencyMs", 0) as "latencyMs", cast(bot as int) as "isBot", cast(minor as int) as "isMinor",
      cast(abs(coalesce(byte_delta, 0)) as bigint) as "absDelta"
    from silver where type = 'edit' and namespace = 0 and bot is not null)"""

_MINUTES = """,
  minutes as (
    select *, cast(hour("windowStart") as integer) as "hourOfDay",
      cast(dayofweek("windowStart") + 1 as integer) as "dayOfWeek"
    from (
      select wiki, date_trunc('minute', "eventTime") as "windowStart", count(*) as "editCount",
        coalesce(cast(sum(byte_delta) as double) / count(byte_delta), 0.0) as "avgDelta",
        cast(coalesce(sum(cast(bot as int)), 0) as bigint) as "botEdits",
        cast(coalesce(sum(cast("isAnon" as int)), 0) as bigint) as "anonEdits"
      from silver where namespace = 0 group by all))"""


def _lags(source: str) -> str:
    lag = {f"editLag{k}": f'lag("editCount", {k})' for k in (1, 2, 3)}
    lag |= {"deltaLag1": 'lag("avgDelta", 1)', "botLag1": 'lag("botEdits", 1)'}
    columns = ", ".join(f'{e} over (partition by wiki order by "windowStart") as "{n}"' for n, e in lag.items())
    return f',\n  lagged as (select * from (select *, {columns} from {source}) where "editLag3" is not null)'


_DENSE = """,
  grid as (
    select wiki, unnest(generate_series(min("windowStart"), max("windowStart"), interval '1 minute')) as "windowStart"
    from minutes group by wiki),
  dense as (
    select g.wiki, g."windowStart", coalesce("editCount", 0) as "editCount", coalesce("avgDelta", 0.0) as "avgDelta",
      coalesce("botEdits", 0) as "botEdits", coalesce("anonEdits", 0) as "anonEdits",
      cast(hour(g."windowStart") as integer) as "hourOfDay",
      cast(dayofweek(g."windowStart") + 1 as integer) as "dayOfWeek"
    from grid g left join minutes m on g.wiki = m.wiki and g."windowStart" = m."windowStart")"""

_SCORED = f""",
  scored as (
    select id, "isBot" as label, 1.0::double / (1.0::double + "commentLen") as score,
      cast(1.0::double / (1.0::double + "commentLen") >= {CUTOFF} as int) as prediction
    from features),
  cells as (
    select count(*) filter (label = 0 and prediction = 0) as c00, count(*) filter (label = 0 and prediction = 1) as c01,
      count(*) filter (label = 1 and prediction = 0) as c10, count(*) filter (label = 1 and prediction = 1) as c11
    from scored),
  ranked as (
    select score, pos, neg, sum(pos) over w as cp, sum(neg) over w as cn, sum(pos) over () as p, sum(neg) over () as n
    from (select score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg from scored group by score)
    window w as (order by score desc))"""


def _clusters() -> str:
    distance = "\n      union all\n      ".join(
        f"select id, {i} as cluster, "
        + " + ".join(f'pow("{c}" - ({v}), 2)' for c, v in zip(S.CLUSTER_FEATURES, centroid))
        + " as distance from features"
        for i, centroid in enumerate(CENTROIDS)
    )
    return f""",
  clustered as (
    select id, cast(min_by(cluster, (distance, cluster)) as integer) as cluster from (
      {distance})
    group by id)"""


def _reports() -> dict[str, tuple[str, str, int]]:
    """key -> (body, order, rows in the report)."""
    half_even = "round_even({0} * 100, 0) / 100"
    mean_delta = "(cast(sum(byte_delta) as double) / count(byte_delta))"
    mean_abs = "(cast(sum(abs(byte_delta)) as double) / count(byte_delta))"
    sizes = ", ".join(f"count(*) filter (edit_size_cat = '{c}') as {c}" for c in S.SIZE_CATEGORIES)
    return {
        "q1": (
            """select title, "editCount" from (
                 select title, count(*) as "editCount", avg(count(*)) over () as mean from edits group by title)
               where "editCount" > 2 * mean""",
            '"editCount" desc, title', 20),
        "q2": (
            'select wiki, quantile_cont(byte_delta, 0.5) as "medianByteDelta" from edits group by wiki',
            '"medianByteDelta" desc, wiki', 20),
        "q3": (
            """select title, date_trunc('hour', event_time) as "hourBucket", count(distinct user_name) as "uniqueUsers",
                 count(*) as "totalEdits" from edits group by 1, 2 having count(distinct user_name) >= 3""",
            '"uniqueUsers" desc, title, "hourBucket"', 20),
        "q4": (
            'select user_name, title, count(*) as "editCount" from edits group by 1, 2 having count(*) >= 3',
            '"editCount" desc, user_name, title', 20),
        "q5": (
            """select user_name, count(distinct wiki_lang) as "languageCount" from store group by 1
               having count(distinct wiki_lang) >= 2""",
            '"languageCount" desc, user_name', 20),
        "q6": (
            """select user_name, cast(session as bigint) as "sessionId", count(*) as "sessionEdits",
                 min(event_time) as "sessionStart", max(event_time) as "sessionEnd",
                 cast(epoch_us(max(event_time)) - epoch_us(min(event_time)) as double) / 1000000 / 60 as "durationMin"
               from (
                 select user_name, event_time, sum(fresh) over (
                     partition by user_name order by event_time, event_id rows unbounded preceding) as session
                 from (
                   select user_name, event_time, event_id, case when event_time - lag(event_time) over (
                       partition by user_name order by event_time, event_id) <= interval '30 minutes' then 0 else 1
                     end as fresh from edits))
               group by user_name, session""",
            '"sessionEdits" desc, user_name, "sessionId"', 20),
        "q7": (
            """select user_name, strftime(event_time, '%Y-%m-%d') as "date", count(*) as "editsInDay"
               from edits group by 1, 2""",
            '"editsInDay" desc, user_name, "date"', 20),
        "q8": (
            f"""select user_name, count(*) as "totalEdits", {half_even.format(mean_abs)} as "avgAbsDelta",
                 cast(sum(byte_delta) as bigint) as "totalBytes"
               from edits where not is_bot group by user_name having count(*) >= 2""",
            '"avgAbsDelta" desc, user_name', 20),
        "q9": (
            f"""select case bin when 0 then '0-10' when 1 then '10-30' when 2 then '30-60' when 3 then '60-100'
                 else '100+' end as "commentBin", count(*) as "count", {half_even.format(mean_delta)} as "avgByteDelta",
                 {half_even.format(mean_abs)} as "avgAbsDelta", cast(bin as integer) as "binOrder"
               from (select *, case when comment_len between 1 and 10 then 0 when comment_len between 11 and 30 then 1
                   when comment_len between 31 and 60 then 2 when comment_len between 61 and 100 then 3
                   when comment_len between 101 and 500 then 4 end as bin from edits)
               where bin is not null group by bin""",
            '"binOrder"', 5),
        "q10": (f"select wiki_lang, {sizes} from edits group by wiki_lang", "wiki_lang", 15),
        "q11": (
            """select title, count(distinct user_name) as "uniqueEditors" from edits group by title
               having count(distinct user_name) >= 3""",
            '"uniqueEditors" desc, title', 20),
        "q12": (
            """select wiki, title, user_name, byte_delta, comment_len, is_bot, is_anon, event_time, event_id as _id from edits
               where abs(byte_delta) > (select quantile_cont(abs(byte_delta), 0.95) from edits)""",
            "byte_delta desc, event_time, _id", 20),
    }


def oracle() -> dict[str, str]:
    base = _adapter()
    store, gold, feats = base + _STORE, base + _GOLD, base + _FEATURES
    minutes = base + _MINUTES
    scored = feats + _SCORED
    clustered = feats + _clusters()
    sql: dict[str, str] = {}

    def put(name: str, ctes: str, body: str) -> None:
        sql[name] = f"with {ctes.strip()}\n{body}"

    # Sources
    readable = f"not ({BLANKED}) and not ({TRUNCATED})"
    new_length = "5000 + byte_delta"
    put("read_raw_events", base,
        f'select id, wiki, title, "timestamp", {new_length} as "newLength" from raw where {readable}')
    put("read_kafka_stream", base, f"select {_names(RECORD)} from bronze")
    put("read_silver", base, 'select count(*) as "rows", count(*) < 500 as few from silver')
    put("read_silver_union", base,
        "select id, title, case when substr(md5('42:' || id), 1, 8) < '80000000' then comment end as comment from silver")
    put("scan_edit_store", store, f"select {_names(S.STORE_COLUMNS)} from store")

    # Ingest
    put("ingest_filter_wiki", base, "select id, wiki from raw where wiki = 'enwiki'")
    put("ingest_filter_types", base, "select id, type from raw where type in ('edit', 'new')")
    for name, column in (("namespace_label", "namespace_str"), ("byte_delta", "byte_delta"), ("title_len", "title_len"),
                         ("is_bot_default", "is_bot")):
        put(name, base, f"select id, {column} from raw")
    put("ingestion_ts", base, 'select count(*) as "rows", cast(1 as bigint) as stamps from raw')
    put("event_key", base, "select id, coalesce(wiki, 'unknown') as key from raw")
    put("serialize_events", base, f"select coalesce(wiki, 'unknown') as key, {_names(RECORD)} from raw")
    extended = f"""select coalesce(wiki, 'unknown') as key, {_names(RECORD)}, cast(id as varchar) as extra, '/x/1' as other,
      '{{"a":[1,{{"b":"}}"}}]}}' as deep, true as kept_null from raw where {readable}"""
    put("publish", base, extended)
    put("publish_stream", base, extended)
    counters = f"""
      select count(*) filter ({readable} and keep) as published,
        count(*) filter ({readable} and not keep) as filtered_out,
        count(*) filter ({TRUNCATED} and not ({BLANKED})) as parse_errors, count(*) filter ({BLANKED}) as blank
      from (select id, coalesce(wiki = 'enwiki', false) and type in ('edit', 'new') as keep from raw)"""
    put("ingest_counters", base, counters)
    put("stream_counters", base, counters)
    put("key_ordered_partitions", base, "select coalesce(wiki, 'unknown') as key, ingestion_ts, id, true as in_order from raw")

    # Bronze
    put("parse_to_bronze", base, f"""
      select id, type, wiki, title, namespace, "user", bot, minor, "timestamp", comment, ingestion_ts,
        {new_length} as "newLength"
      from bronze where {readable}""")
    put("bronze_rejects", base, f"""
      select cause, count(*) as records from (
        select case when {BLANKED} then 'blank' when {TRUNCATED} then 'malformed' when wiki is null then 'no_wiki' end as cause
        from raw)
      where cause is not null group by cause""")

    # Silver
    for name, column in (
        ("silver_event_time", "eventTime"), ("silver_ingestion_time", "ingestionTime"), ("silver_latency_ms", "latencyMs"),
        ("silver_is_anon", "isAnon"), ("silver_edit_size", "editSizeCategory"), ("silver_comment_len", "commentLen"),
        ("silver_hour", "hourOfDay"), ("silver_dow", "dayOfWeek"), ("silver_wiki_lang", "wikiLang"),
        ("silver_lang_code", "langCode"),
    ):
        put(name, base, f'select id, "{column}" from derived')
    put("silver_valid_time", base, f"""
      select * from (select id, "timestamp" - cast(epoch(timestamp '{AS_OF}') as bigint) + 691200 as "timestamp" from raw)
      where "timestamp" > 0""")
    put("silver_known_type", base, "select id, type from raw where type <> 'external'")
    put("silver", base, f"select {_names(SILVER)} from silver")
    put("write_parquet_stream", base, f"select {_names(SILVER)} from silver")

    # Serving
    every = _names(S.STORE_COLUMNS)
    put("serving_rows", store, f"select {every} from store")
    put("write_batch", store, f"select {every} from store")
    put("store_restart", store, f"select {every} from store")
    put("serving_rejects", base, """select id, type, "timestamp" * 1000000 as "timestamp" from bronze where type = 'new'""")
    put("upsert_latest", store, f"""
      , first as (select * replace (case when type = 'categorize' then 0 else event_id end as event_id) from store),
      feed as (
        select * from first union all by name
        select * replace (ingestion_ts + 60000 as ingestion_ts, 'again' as comment, 5 as comment_len) from first
        where type in ('new', 'log'))
      select {every} from feed
      qualify row_number() over (partition by wiki, wiki_lang, event_time, event_id
        order by ingestion_ts desc, type desc, title desc, user_name desc, byte_delta desc, comment desc) = 1""")
    put("store_newest_first", store, """
      select * from (
        select wiki, wiki_lang, event_time, event_id, cast(row_number() over (
          partition by wiki, wiki_lang order by event_time desc, event_id desc) as integer) as position from store)
      where position <= 10""")
    put("retention_7d", store, f"""
      select event_id, event_time, ingestion_ts from store
      where ingestion_ts > epoch_ms(timestamp '{AS_OF}') - 604800000""")
    put("batch_summary", base, """
      select count(*) as written, count(*) filter (type = 'edit') as edits, count(*) filter (bot) as bots from silver""")
    put("hourly_summary_stream", store, """
      select wiki, wiki_lang, date_trunc('hour', event_time) as hour_bucket, count(*) as total_edits from edits
      where date_trunc('hour', event_time) + interval '1 hour' <= (select max(event_time) from edits) - interval '1 minute'
      group by all""")
    put("compact_store", store, f"""
      , first as (select * replace (case when type = 'categorize' then 0 else event_id end as event_id) from store),
      feed as (
        select *, 0 as batch from store union all by name select *, 1 as batch from first union all by name
        select * replace (ingestion_ts + 60000 as ingestion_ts, 'again' as comment, 5 as comment_len), 1 as batch
        from first where type in ('new', 'log'))
      select {every} from (
        select * from feed
        qualify row_number() over (partition by wiki, wiki_lang, event_time, event_id
          order by batch desc, ingestion_ts desc, type desc, title desc, user_name desc, byte_delta desc, comment desc) = 1)
      where ingestion_ts > epoch_ms(timestamp '{AS_OF}') - 604800000""")
    put("scan_keyed_store", store, f"""
      , first as (select * replace (case when type = 'categorize' then 0 else event_id end as event_id) from store),
      feed as (
        select *, 0 as batch from store union all by name select *, 1 as batch from first union all by name
        select * replace (ingestion_ts + 60000 as ingestion_ts, 'again' as comment, 5 as comment_len), 1 as batch
        from first where type in ('new', 'log'))
      select {every} from feed
      qualify row_number() over (partition by wiki, wiki_lang, event_time, event_id
        order by batch desc, ingestion_ts desc, type desc, title desc, user_name desc, byte_delta desc, comment desc) = 1""")
    put("compact_layer", store, f"select {_names(S.STORE_COLUMNS)} from store")
    put("expire_layer", store, f"""
      select event_id, event_time, ingestion_ts from store
      where ingestion_ts > epoch_ms(timestamp '{AS_OF}') - 604800000""")
    put("hourly_summary", store, """
      select wiki, wiki_lang, date_trunc('hour', event_time) as hour_bucket, count(*) as total_edits from edits group by all""")

    # Gold
    span = '"windowStart", "windowEnd", wiki'
    numbers = '"totalEdits", "botEdits", "anonEdits", "avgByteDelta", "avgCommentLen"'
    put("gold_filter", gold, "select id, type, namespace from article")
    put("gold_watermark", gold, f'select {span}, "totalEdits" from closed')
    put("gold_tumbling", gold, f'select {span}, "totalEdits" from gold')
    put("gold", gold, f'select {span}, {numbers}, "uniqueEditors", "botRatio", "anonRatio", "vandalismFlag" from gold')
    put("gold_unique_editors", gold, f'select {span}, "uniqueEditors" from gold')
    put("gold_ratios", gold, f'select {span}, "botRatio", "anonRatio" from gold')
    put("gold_vandalism_flag", gold, f'select {span}, "vandalismFlag" from gold')
    put("gold_flatten_window", gold, f"select {span} from gold")
    for name in ("gold_stream", "gold_late_rows"):
        put(name, gold, f'select {span}, {numbers}, "botRatio", "anonRatio", "vandalismFlag" from closed')
    put("stream_multi_sink", base + _STORE + _GOLD, """
      select 'bronze' as layer, count(*) as "rows" from bronze union all select 'silver', count(*) from silver
      union all select 'gold', count(*) from closed union all select 'store', count(*) from store""")

    # Reports
    reports = _reports()
    for key, name in _REPORT_NAMES.items():
        body, order, top = reports[key]
        shown = "* exclude (_id)" if "_id" in order.split(", ") else "*"
        put(name, store, f"select {shown} from (select * from ({body}) order by {order} limit {top})")
        if key != "q9":
            put(f"{name}_all", store, f"select {shown} from ({body})")
    put("q6_sessions_stream", store, f"""
      select * exclude ("sessionId") from ({reports['q6'][0]})
      where "sessionEnd" + interval '30 minutes' <= (select max(event_time) from edits) - interval '1 minute'""")
    from editengine.plans.registry import REPORTS

    put("query_registry", store, "\nunion all\n".join(
        f"select '{k}' as key, '{REPORTS[k].label}' as label, least(count(*), {top}) as \"rows\" from ({body})"
        for k, (body, _, top) in reports.items()
    ))
    put("x1_negative_latency", store, """
      select wiki, count(*) as events, min(latency_ms) as "minLatencyMs" from store where latency_ms < 0 group by wiki""")
    dominant = """
      select title, user_name, n as "userEdits", cast(total as bigint) as "totalEdits", n::double / total::double as share
      from (
        select title, user_name, count(*) as n, sum(count(*)) over (partition by title) as total,
          row_number() over (partition by title order by count(*) desc, user_name) as place
        from edits group by title, user_name)
      where place = 1 and total >= 3"""
    put("x2_dominant_editors", store, dominant + '\norder by share desc, "totalEdits" desc, title limit 20')
    put("x2_dominant_editors_all", store, dominant)
    put("x3_time_profile", store, """
      select user_name, hour_of_day, count(*) as edits, first_value(hour_of_day) over (
        partition by user_name order by count(*) desc, hour_of_day) as "peakHour"
      from edits group by user_name, hour_of_day""")
    put("x4_comment_size_corr", store, """
      select coalesce(wiki, 'ALL') as wiki, count(*) as edits,
        round(corr(comment_len::double, abs(byte_delta)::double), 6) as correlation
      from edits group by rollup (wiki)""")
    streak = """
      select user_name, max(days) as "longestStreak" from (
        select user_name, island, count(*) as days from (
          select user_name, day - cast(row_number() over (partition by user_name order by day) as int) as island
          from (select distinct user_name, cast(event_time as date) as day from edits))
        group by user_name, island)
      group by user_name"""
    put("x5_day_streak", store, streak + '\norder by "longestStreak" desc, user_name limit 20')
    put("x5_day_streak_all", store, streak)

    # Trends
    bots = 'cast(coalesce(sum(cast(bot as int)), 0) as bigint) as "botEdits"'
    put("top_pages", gold, f"""
      select title, count(*) as "editCount", cast(sum(coalesce(byte_delta, 0)) as bigint) as "totalDelta", {bots}
      from article where title is not null group by title order by "editCount" desc, title limit 15""")
    put("top_pages_all", gold, f"""
      select title, count(*) as "editCount", cast(sum(coalesce(byte_delta, 0)) as bigint) as "totalDelta", {bots}
      from article where title is not null group by title""")
    put("top_wikis_all", gold, f"""
      select "wikiLang", count(title) as "editCount", {bots} from article group by 1""")
    put("bot_ratio_by_wiki_all", gold, f"""
      select *, "botEdits"::double / "totalEdits"::double as "botRatio" from (
        select "wikiLang", count(title) as "totalEdits", {bots} from article group by 1)""")
    put("hourly_edits", gold, 'select "hourOfDay", count(*) as "editCount" from article group by 1')
    put("top_wikis", gold, f"""
      select "wikiLang", count(title) as "editCount", {bots} from article group by 1 order by 2 desc, 1 limit 10""")
    put("size_distribution", gold, 'select "editSizeCategory", count(*) as "editCount" from article group by 1')
    put("bot_ratio_by_wiki", gold, f"""
      select *, "botEdits"::double / "totalEdits"::double as "botRatio" from (
        select "wikiLang", count(title) as "totalEdits", {bots} from article group by 1)
      order by "botRatio" desc, "wikiLang" limit 10""")

    # Overview
    put("kpi_silver", base, f"""
      select count(*) as "totalRows", count(*) filter (type = 'edit') as edits,
        cast({len(SILVER)} as bigint) as "columnCount", count(distinct wiki) as wikis from silver""")
    put("kpi_store", store, """
      select count(*) as "totalRows", count(*) filter (type = 'edit') as edits, count(distinct wiki) as wikis,
        count(distinct user_name) as users, count(distinct title) as pages from store""")
    spark_type = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp"}
    record_types = dict(zip(RECORD, (
        "BIGINT", "VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR", "INTEGER", "VARCHAR", "BOOLEAN", "BOOLEAN", "BIGINT",
        "VARCHAR", "VARCHAR", "BIGINT", "BOOLEAN", "VARCHAR", "INTEGER", "INTEGER")))
    put("schema_table", base, "\nunion all\n".join(
        f"""select '{c}' as "column", '{spark_type[(record_types | _TYPES)[c]]}' as type, count("{c}") as present from silver"""
        for c in SILVER
    ))
    put("sample_rows", base, f"select {_names(S.DISPLAY_COLUMNS)} from silver order by id limit 50")
    put("sample_store_rows", store, f"select {_names(S.STORE_DISPLAY_COLUMNS)} from store order by event_id limit 50")
    put("class_distribution", feats, """
      select "isBot", (select count(*) from features f where f."isBot" = c."isBot") as edits
      from (values (0), (1)) c("isBot")""")

    def histogram(kind, bins, where):
        return f"""
      select '{kind}' as kind, cast(b as integer) as bin, low + b * ((high - low) / {bins}) as "binStart",
        coalesce(edits, 0) as edits, coalesce(edits, 0)::double / (n::double * ((high - low) / {bins})) as density
      from range({bins}) r(b)
      cross join (select min(v) as low, max(v) as high, count(*) as n from (
        select greatest(-3000, least(3000, byte_delta))::double as v from features where {where}))
      left join (
        select least({bins - 1}, floor((v - low) / ((high - low) / {bins}))) as at, count(*) as edits
        from (select greatest(-3000, least(3000, byte_delta))::double as v from features where {where})
        cross join (select min(v) as low, max(v) as high from (
          select greatest(-3000, least(3000, byte_delta))::double as v from features where {where}))
        group by 1) h on h.at = b"""

    put("delta_histogram", feats,
        histogram("normal", 50, f'"absDelta" <= {BIG_CHANGE}') + "\nunion all by name"
        + histogram("anomaly", 20, f'"absDelta" > {BIG_CHANGE}'))
    put("chart_top_n", gold, f"""
      select substr(title, 1, 6) as title, "editCount", "totalDelta", "botEdits" from (
        select title, count(*) as "editCount", cast(sum(coalesce(byte_delta, 0)) as bigint) as "totalDelta", {bots}
        from article group by title order by "editCount" desc, title limit 15)""")
    put("scatter_points", feats, f"""
      select id, byte_delta, "commentLen", cast("absDelta" > {BIG_CHANGE} as int) as anomaly from features""")

    # Features
    put("ml_features", feats, "select * from features")
    put("feature_stats", feats, """
      select count(*) as "totalEdits", cast(sum(byte_delta) as bigint) as "totalBytes",
        count(*) filter ("isBot" = 1) as "botEdits",
        (count(*) filter ("isBot" = 1))::double * 100.0::double / count(*)::double as "botPercent",
        max(byte_delta) as "maxDelta", min(byte_delta) as "minDelta" from features""")
    put("assemble_vector", feats, "select id, " + ", ".join(
        f'"{c}"::double as f{i}' for i, c in enumerate(S.BOT_FEATURES)) + " from features")
    for name, deviation in (("standard_scale", "stddev_samp"), ("standard_scale_population", "stddev_pop")):
        put(name, feats, "select id, " + ", ".join(
            f"""round(case when (select {deviation}("{c}") from features) > 0 then
              ("{c}" - (select avg("{c}") from features)) / (select {deviation}("{c}") from features) else 0 end, 6) as "{c}" """
            for c in S.BOT_FEATURES) + " from features")
    put("minmax_scale", feats, "select id, " + ", ".join(
        f"""round(case when max("{c}") over () > min("{c}") over () then ("{c}" - min("{c}") over ())::double
          / (max("{c}") over () - min("{c}") over ()) else 0.5::double end, 6) as "{c}" """
        for c in S.CLUSTER_FEATURES) + " from features")
    put("train_test_split", feats, """
      select id, case when substr(md5('42:' || id), 1, 8) < '33333333' then 'test' else 'train' end as side from features""")
    put("minute_series", minutes, "select * from minutes")
    put("lag_features", minutes + _lags("minutes"), "select * from lagged")
    put("lag_features_dense", minutes + _DENSE + _lags("dense"), "select * from lagged")

    # Models and evaluation
    put("nearest_centroid", clustered, "select id, cluster from clustered")
    put("cluster_profiles", clustered, """
      select cluster, count(*) as "count", sum(byte_delta)::double / count(*) as "avgDelta",
        sum("commentLen")::double / count(*) as "avgComment", sum("isAnon")::double / count(*) as "anonRatio",
        sum("isMinor")::double / count(*) as "minorRatio"
      from features join clustered using (id) group by cluster""")
    put("roc_auc", scored, """
      select sum(neg::double * (2.0::double * (cp - pos)::double + pos::double)) / (2.0::double * sum(pos)::double * sum(neg)::double)
        as "areaUnderROC", cast(sum(pos) as bigint) as positives, cast(sum(neg) as bigint) as negatives from ranked""")
    put("roc_curve", scored, """
      select cast(null as double) as threshold, 0.0::double as fpr, 0.0::double as tpr
      union all select score, cn::double / n::double, cp::double / p::double from ranked""")
    put("confusion_matrix", scored, """
      select 0 as actual, 0 as predicted, c00 as "rows" from cells union all select 0, 1, c01 from cells
      union all select 1, 0, c10 from cells union all select 1, 1, c11 from cells""")
    put("classification_report", scored, """
      , two as (
        select 0 as position, 'Human' as line, c00::double as hit, c10::double as wrong, c01::double as missed from cells
        union all select 1, 'Bot', c11, c01, c10 from cells),
      per as (
        select position, line, coalesce(hit / nullif(hit + wrong, 0), 0) as precision,
          coalesce(hit / nullif(hit + missed, 0), 0) as recall,
          coalesce(2 * hit / nullif(2 * hit + wrong + missed, 0), 0) as f1, cast(hit + missed as bigint) as support from two)
      select * from per
      union all select 2, 'accuracy', a, a, a, s from (
        select (c00 + c11)::double / (c00 + c01 + c10 + c11)::double as a, c00 + c01 + c10 + c11 as s from cells)
      union all select 3, 'macro avg', sum(precision) / 2, sum(recall) / 2, sum(f1) / 2, cast(sum(support) as bigint) from per
      union all select 4, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), cast(sum(support) as bigint) from per""")
    put("regression_metrics", minutes + _lags("minutes"), """
      select round(sqrt(avg(error * error)), 6) as rmse, round(1 - sum(error * error) / (var_pop(y) * count(*)), 6) as r2,
        count(*) as "rows"
      from (select "editCount"::double as y,
        "editCount" - ("editLag1" + "editLag2" + "editLag3") / 3.0::double as error from lagged)""")
    # Models: what follows from the data
    test = "substr(md5('42:' || id), 1, 8) < '33333333'"
    for name in ("bot_rf", "bot_lr", "bot_dt", "bot_model_selection", "save_model"):
        put(f"{name}_checked", feats, f'select id, "isBot", true as sane from features where {test}')
    put("edit_clusters_checked", feats, "select id, true as sane from features")
    put("isolation_forest_checked", feats, """
      select count(*) as "rows", true as share_as_asked, true as scores_in_range, true as signs_agree from features""")
    put("volume_forecast_checked", minutes + _lags("minutes"), """
      select wiki, "windowStart", "editCount", "hourOfDay", true as sane from lagged
      where substr(md5('42:' || wiki || '|' || cast(cast(epoch("windowStart") as bigint) as varchar)), 1, 8) < '33333333'""")
    for name in ("feature_importances", "load_model"):
        put(f"{name}_checked", feats, f"select cast({len(S.BOT_FEATURES)} as bigint) as features, true as sum_to_one, true as none_negative")
    put("prediction_sample_checked", feats, f"""
      select "user", "isBot", byte_delta, "commentLen", true as sane from (
        select * from features where {test} order by id limit 10)""")
    names = [f'"{c}"' for c in S.CLUSTER_FEATURES]
    square = " + ".join(f"x.{c}::double * x.{c}::double" for c in names)
    product = " + ".join(f"x.{c}::double * c.s{k}" for k, c in enumerate(names))
    totals = ", ".join(f"sum(x.{c}::double) as s{k}" for k, c in enumerate(names))
    put("silhouette_checked", clustered, f"""
      , members as (select f.*, k.cluster from features f join clustered k using (id)),
      sums as (select x.cluster, count(*)::double as n, {totals}, sum({square}) as q from members x group by x.cluster),
      far as (
        select x.id, x.cluster as own, c.cluster, c.n, {square} - 2 * ({product}) / c.n + c.q / c.n as distance
        from members x cross join sums c),
      sides as (
        select id, max(case when cluster = own then n end) as n, max(case when cluster = own then distance end) as inside,
          min(case when cluster <> own then distance end) as outside from far group by id),
      widths as (
        select case when n = 1 then 0 else (outside - inside * n / (n - 1)) / greatest(outside, inside * n / (n - 1)) end as width from sides)
      select round(avg(width), 6) as silhouette from widths""")
    sql["auc_comparison_checked"] = """
      select model, 'auc' as metric, true as sane from (values ('LogisticRegression'), ('DecisionTree'), ('RandomForest')) t(model)"""
    sql["training_summary_checked"] = sql["auc_comparison_checked"] + """
      union all select * from (values ('bot', 'best_name', true), ('bot', 'best_auc', true), ('clusters', 'silhouette', true),
        ('isolation_forest', 'anomalies', true), ('trends', 'top_page', true), ('volume', 'rmse', true), ('volume', 'r2', true)) t(model, metric, sane)"""
    put("gold_unique_editors_approx_checked", gold, f'select {span}, "uniqueEditors", true as sane from gold')
    hourly = """
      select time_bucket(interval '1 hour', "eventTime") as "windowStart", wiki, count(*) as "totalEdits",
        count(distinct "user") as "uniqueEditors", true as sane from article"""
    put("gold_rollup_editors_checked", gold, f"{hourly} group by all")
    put("gold_rollup_editors_stream_checked", gold, f"""{hourly}
      where time_bucket(interval '5 minutes', "eventTime") + interval '5 minutes'
        <= (select max("eventTime") from article) - interval '1 minute' group by all""")
    put("q2_size_sketches_checked", store, """
      select wiki, count(*) as edits, true as median_near, true as p95_near from store where type = 'edit' group by wiki""")
    # Models: floors
    for name in ("bot_rf", "bot_lr", "bot_dt", "bot_model_selection"):
        put(f"{name}_floor_checked", feats, f"""
          select cast(sum("isBot") as bigint) as positives, cast(sum(1 - "isBot") as bigint) as negatives, true as above_floor
          from features where {test}""")
    put("edit_clusters_floor_checked", feats, 'select count(*) as "rows", cast(5 as bigint) as clusters, true as tight from features')
    put("isolation_forest_floor_checked", feats, """
      select count(*) as planted, true as caught, true as others_left from features where id % 100 = 0""")
    put("volume_forecast_floor_checked", minutes + _lags("minutes"), """
      select count(*) as "rows", true as beats_lags from lagged
      where substr(md5('42:' || wiki || '|' || cast(cast(epoch("windowStart") as bigint) as varchar)), 1, 8) < '33333333'""")
    sql["volume_forecast_by_time_checked"] = "select true as finite, true as all_late, true as a_fifth"
    sql["save_metrics_checked"] = """
      select model, true as sane from (values ('LogisticRegression'), ('DecisionTree'), ('RandomForest')) t(model)"""
    sql["percentile_quantity"] = """
      select l_returnflag, round(quantile_cont(cast(l_extendedprice as decimal(15,2))::double, 0.95), 4) as p95 from lineitem group by l_returnflag"""
    return sql
