"""The SQL each query is checked against, on the same tables."""

from __future__ import annotations

from barframe.fixed_values import (
    ERROR_MESSAGE,
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    PREDICTION_MESSAGE,
    STATUS_MESSAGE,
)
from barframe.operators.commands import default_replies
from suite import tables as t


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def bars(unit: str = "minute") -> str:
    return f"""
bars as materialized (
  select e.event_type as symbol, date_trunc('{unit}', e.ts) as ts,
         first(e.value order by e.ts, e.event_id) as open, max(e.value) as high, min(e.value) as low,
         last(e.value order by e.ts, e.event_id) as close, count(*)::double as volume
  from events e group by e.event_type, date_trunc('{unit}', e.ts)),
n as materialized (select *, row_number() over (partition by symbol order by ts) - 1 as rn from bars)"""


BARS = bars()

INDICATORS = BARS + """,
moves as materialized (
  select symbol, ts, rn, close, coalesce(close - lag(close) over (partition by symbol order by rn), 0) as d from n),
ind as materialized (
  select symbol, rn, case when d > 0 then d else 0::double end as up, case when d < 0 then -d else 0::double end as dn,
         close as ef, close as es, null::double as sig
  from moves where rn = 0
  union all
  select symbol, rn, up, dn, ef, es,
         case when rn < 25 then null when rn = 25 then ef - es else 0.2::double * (ef - es) + 0.8::double * sig end
  from (
    select m.symbol, m.rn,
      (1::double / 14) * (case when m.d > 0 then m.d else 0::double end) + (13::double / 14) * i.up as up,
      (1::double / 14) * (case when m.d < 0 then -m.d else 0::double end) + (13::double / 14) * i.dn as dn,
      (2::double / 13) * m.close + (11::double / 13) * i.ef as ef,
      (2::double / 27) * m.close + (25::double / 27) * i.es as es, i.sig
    from ind i join moves m on m.symbol = i.symbol and m.rn = i.rn + 1)),
frames as (
  select n.*, close / nullif(lag(close, 1) over w, 0) - 1 as ret, close / nullif(lag(close, 60) over w, 0) - 1 as ret60,
         case when lead(close, 60) over w / nullif(close, 0) - 1 > 0 then 1 else 0 end as target,
         case when count(close) over f = 30 then stddev_samp(close) over f end as vol
  from n window w as (partition by symbol order by ts), f as (partition by symbol order by ts rows 29 preceding)),
feats as materialized (
  select frames.*, case when rn < 13 then null when dn = 0 then 100 else 100 - 100 / (1 + up / dn) end as rsi,
         case when rn >= 33 then ef - es - sig end as macd, ef
  from frames join ind using (symbol, rn))"""

HEADLINES = """
anchors as (select page_id, regexp_extract_all(html, '(?is)<a(?:\\s[^>]*)?>(.*?)</a\\s*>', 1) as list from pages),
heads as (
  select page_id, (i - 1)::integer as pos,
    replace(replace(replace(replace(replace(replace(regexp_replace(list[i], '(?s)<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&') as text
  from anchors, unnest(range(1, least(len(list), 10) + 1)) as u(i))"""


def word_score(text: str, positive: list[str], negative: list[str]) -> str:
    def any_of(words):
        return "(" + " or ".join(f"contains(lower({text}), {quoted(w)})" for w in words) + ")"

    return f"(case when {any_of(positive)} then 1 when {any_of(negative)} then -1 else 0 end)"


SCORE = f"score as (select coalesce(sum({word_score('text', POSITIVE_WORDS, NEGATIVE_WORDS)}), 0)::integer as sentiment from heads)"

SERIES = {"n": "click", "b": "view", "s": "purchase", "v": "error"}
FEATURES = f"""with recursive {INDICATORS}, {HEADLINES}, {SCORE},
f as (
  select n.ts, n.close as n_close, n.ret as n_ret, n.ret60 as n_ret60, b.close as b_close, b.ret as b_ret,
    b.ret60 as b_ret60, s.ret as s_ret, v.close as v_close, v.ret as v_ret, n.rsi as n_rsi, n.macd as n_macd,
    n.vol as n_vol, b.rsi as b_rsi, b.macd as b_macd, b.vol as b_vol, n.target
  from (select * from feats where symbol = 'click') n
  left join (select * from feats where symbol = 'view') b using (rn)
  left join (select * from feats where symbol = 'purchase') s using (rn)
  left join (select * from feats where symbol = 'error') v using (rn))
select ts, round(n_close, 6) as "N_Close", round(n_ret, 9) as "N_Return", round(n_ret60, 9) as "N_Return_1h",
  round(b_close, 6) as "B_Close", round(b_ret, 9) as "B_Return", round(b_ret60, 9) as "B_Return_1h",
  round(s_ret, 9) as "SNP_Return", round(v_close, 6) as "VIX_Close", round(v_ret, 9) as "VIX_Return",
  round(n_rsi, 6) as "NSEI_RSI", round(n_macd, 6) as "NSEI_MACD", round(n_vol, 6) as "NSEI_Volatility",
  round(b_rsi, 6) as "NSEBANK_RSI", round(b_macd, 6) as "NSEBANK_MACD", round(b_vol, 6) as "NSEBANK_Volatility",
  hour(ts)::integer as "Hour", minute(ts)::integer as "Minute", (isodow(ts) - 1)::integer as "DayOfWeek",
  (select sentiment from score) as "Sentiment", target::integer as "Target"
from f"""

COMPLETE = """
where n_close is not null and n_ret is not null and n_ret60 is not null and b_close is not null and b_ret is not null
  and b_ret60 is not null and s_ret is not null and v_close is not null and v_ret is not null and n_rsi is not null
  and n_macd is not null and n_vol is not null and b_rsi is not null and b_macd is not null and b_vol is not null"""

FOLDS = f"with {BARS}, c as (select symbol, ts, row_number() over (partition by symbol order by ts) - 1 as rn, count(*) over (partition by symbol) as total from bars)"

TRADES = """
trades as (select 'P' || l_partkey as symbol, l_extendedprice as price, l_quantity as qty, l_shipdate as ts, l_returnflag
           from lineitem),
active as (select symbol, sum(price * qty) as value, sum(qty) as volume from trades group by symbol),
closes as (select symbol, ts, max(price) as close from trades group by symbol, ts),
pairs as (select symbol, ts, close, close / nullif(lag(close) over (partition by symbol order by ts), 0) - 1 as change,
                 row_number() over (partition by symbol order by ts desc) as r from closes),
changes as (select symbol, close, change from pairs where r = 1 and change is not null)"""

SCREENS = f"""{TRADES},
by_month as (select symbol, date_trunc('month', ts) as period, sum(qty) as volume from trades group by all),
grown as (select * from (select symbol, sum(volume) filter (period = (select max(period) from by_month)) as volume,
    avg(volume) filter (period <> (select max(period) from by_month)) as mean_volume from by_month group by symbol)
  where volume is not null and mean_volume is not null),
screens as (
  select * from (select symbol, round(value, 2) as value, 'Most Active by Value' as "Reason" from active order by active.value desc, symbol limit 10)
  union all by name
  select * from (select symbol, round(volume, 2) as volume, 'Most Active by Volume' as "Reason" from active order by active.volume desc, symbol limit 10)
  union all by name
  select * from (select symbol, round(volume / mean_volume, 6) as gain, 'Volume Gainers' as "Reason" from grown
    order by grown.volume / grown.mean_volume desc, symbol limit 10)
  union all by name
  select * from (select symbol, close, round(change, 6) as change, 'Top Gainers' as "Reason" from changes order by changes.change desc, symbol limit 10)
  union all by name
  select * from (select symbol, close, round(change, 6) as change, 'Top Losers' as "Reason" from changes order by changes.change, symbol limit 10))"""

MEMBERS = """
members as (select distinct n_name as "Index", l_partkey as "Stock" from lineitem
  join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
flags as (select "Stock", bool_or(regexp_matches("Index", 'NATION_1$')) as in_mid,
                 bool_or(regexp_matches("Index", 'NATION_2$')) as in_small, count(*) as rows from members group by "Stock"),
classed as (select m."Index", m."Stock",
  case when in_mid then 'Mid Cap' when in_small then 'Small Cap' else 'Large Cap' end as cap_class
  from members m join flags f on m."Stock" = f."Stock")"""

DOCS = """
docs as (
  select o_orderkey, o_orderstatus, '{"symbol":"C' || o_custkey || '","price":' || o_totalprice || '}' as record,
    '{"symbol":"O' || o_orderkey || '","qty":' || o_custkey || ',"meta":{"name":"' || o_orderpriority || '"}}' as other,
    o_custkey, o_totalprice
  from orders)"""

EXTRACTED = """
extracted as (
  select o_orderkey, 'Volume Gainers' as category, 0 as pos, record as raw from docs where o_orderstatus = 'F'
  union all select o_orderkey, 'Volume Gainers', 1, other from docs where o_orderstatus = 'F'
  union all select o_orderkey, 'Top Losers', 0, record from docs where o_orderstatus = 'O'),
parts as (
  select o_orderkey, 'Bulk Deals Data' as category, 0 as pos, record as raw from docs where o_orderstatus not in ('F', 'O')
  union all select o_orderkey, 'Short Deals Data', 0, other from docs where o_orderstatus not in ('F', 'O')
  union all select o_orderkey, 'Short Deals Data', 1, record from docs where o_orderstatus not in ('F', 'O'))"""

CONSTITUENTS = """
base as (
  select case n_regionkey when 0 then 'nifty midcap ' when 1 then 'nifty smallcap ' else 'nifty ' end || n_nationkey as idx, *
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
records as (
  select idx as index_name, 0 as pos, case when o_orderstatus = 'F' then upper(idx) else 'C' || o_custkey end as symbol,
         o_totalprice as "lastPrice", null::bigint as open from base
  union all
  select idx, 1, case when o_orderstatus = 'P' then idx else 'C' || c_nationkey end, null, o_orderkey from base),
kept as (select * from records where not (pos = 0 and upper(symbol) = upper(index_name)))"""

UPDATE_TEXT = """case event_type when 'view' then '//ping' when 'click' then '/PING@bot a b' when 'signup' then 'hello /ping'
  when 'purchase' then '/Status  x' || user_id else '/foo' || chr(9) || '1 2' end"""
IDS = "(" + ", ".join(map(str, t.CHAT_IDS)) + ")"
MESSAGES = f"""
messages as (select event_id + 1 as update_id, user_id as chat_id, event_type as "user", {UPDATE_TEXT} as text from events),
commands as (
  select *, split_part(regexp_replace(lower(regexp_extract(text, '^(\\S+)', 1)), '^/+', ''), '@', 1) as command,
         regexp_replace(trim(regexp_replace(text, '^\\S+', ''), ' ' || chr(9)), '\\s+', '|', 'g') as args
  from messages where chat_id in {IDS} and starts_with(text, '/'))"""


def reply_case(replies: dict[str, str]) -> str:
    known = " ".join(f"when {quoted(k)} then {quoted(v)}" for k, v in replies.items())
    return f"case command {known} else '❓ Unknown command: /' || command end"


def filled(text: str, values: dict[str, str]) -> str:
    out = quoted(text)
    for name, expression in values.items():
        out = f"replace({out}, '{{{name}}}', {expression})"
    return out


def status_text(last: str) -> str:
    return filled(STATUS_MESSAGE, {"authorized": quoted(str(len(t.CHAT_IDS))), "commands": "'4'", "last_update_id": last})


def change_cell(col: str, text: str) -> str:
    return f"""(case when abs({col}) >= 10 then '⚡ <b><u>' || case when {col} > 0 then '+' else '' end || {text} || '</u></b>'
      when {col} > 0 then '🟢 +' || {text} when {col} < 0 then '🔴 ' || {text} else '⚪ ' || {text} end)"""


SHORT_SYMBOL = """case when p_size < 20 then 'BN ' || lpad(p_partkey::varchar, 5, '0') || ' ' || side
  when p_size < 40 then 'NF ' || lpad(p_partkey::varchar, 5, '0') || ' ' || side
  else 'STOCK-' || lpad(p_partkey::varchar, 5, '0') || side end"""
SIDE = "case when p_type = 'ECONOMY' then 'CE' else 'PE' end as side"

LABELS = "lab as (select quality as y, (length(text) > 500)::integer as yhat from labels join documents using (doc_id))"
CELLS = """cells as (select count(*) filter (y = 1 and yhat = 1) as tp1, count(*) filter (y = 0 and yhat = 0) as tp0,
  count(*) filter (yhat = 1) as pr1, count(*) filter (yhat = 0) as pr0, count(*) filter (y = 1) as su1,
  count(*) filter (y = 0) as su0, count(*) as total from lab),
m as (select *, coalesce(tp0 / nullif(pr0, 0), 0) as p0, coalesce(tp1 / nullif(pr1, 0), 0) as p1,
  coalesce(tp0 / nullif(su0, 0), 0) as r0, coalesce(tp1 / nullif(su1, 0), 0) as r1, (tp0 + tp1) / total as acc from cells),
g as (select *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) as f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) as f1 from m)"""

CHUNK_ROWS = """select {id}, {more} i::integer as part, substring({text}, i * 4096 + 1, 4096) as text
from {source}, unnest(range(0, greatest((length({text}) + 4095) // 4096, 1))) as u(i)"""

ORACLES: dict[str, str] = {
    "bars_hourly": f"with {bars('hour')} select * from bars",
    "bars_minute": f"with {BARS} select * from bars",
    "named_bars": f"""with {BARS} select * replace (case symbol when 'click' then 'NSEI' when 'view' then 'NSEBANK'
      when 'purchase' then 'SNP' else 'INDIA_VIX' end as symbol) from bars where symbol <> 'signup'""",
    "recent_bars": """select event_type as symbol, ts, value as open, value as high, value as low, value as close, value as volume
      from events where event_type in ('click', 'view')
      and ts >= (select max(ts) from events where event_type in ('click', 'view')) - interval 7 days""",
    "row_ordinal": f"with {BARS} select symbol, ts, rn from n",
    "pct_change_1": f"with {BARS} select symbol, ts, round(close / nullif(lag(close) over (partition by symbol order by ts), 0) - 1, 9) as change from n",
    "pct_change_60": f"with {BARS} select symbol, ts, round(close / nullif(lag(close, 60) over (partition by symbol order by ts), 0) - 1, 9) as change from n",
    "forward_target": f"""with {BARS} select symbol, ts,
      (case when lead(close, 60) over (partition by symbol order by ts) / nullif(close, 0) - 1 > 0 then 1 else 0 end)::integer as target from n""",
    "rolling_std_30": f"""with {BARS} select symbol, ts, round(case when count(close) over f = 30 then stddev_samp(close) over f end, 6) as volatility
      from n window f as (partition by symbol order by ts rows 29 preceding)""",
    "ewma_span12": f"with recursive {INDICATORS} select symbol, ts, round(case when rn >= 11 then ef end, 6) as mean from feats",
    "rsi_14": f"with recursive {INDICATORS} select symbol, ts, round(rsi, 6) as rsi from feats",
    "macd_diff": f"with recursive {INDICATORS} select symbol, ts, round(macd, 6) as macd_diff from feats",
    "returns_and_indicators": f"""with recursive {INDICATORS} select symbol, ts, target::integer as target, round(ret, 9) as return,
      round(ret60, 9) as return_1h, round(rsi, 6) as rsi, round(macd, 6) as macd, round(vol, 6) as volatility from feats""",
    "session_parts": """select event_id, ts, hour(ts)::integer as "Hour", minute(ts)::integer as "Minute",
      (isodow(ts) - 1)::integer as "DayOfWeek" from events""",
    "align_position": f"""with {BARS} select c.rn, c.ts, c.close as c_close, v.close as v_close, p.close as p_close
      from (select * from n where symbol = 'click') c left join (select * from n where symbol = 'view') v using (rn)
      left join (select * from n where symbol = 'purchase') p using (rn)""",
    "align_time": f"""with {bars('hour')} select c.ts, c.close as c_close, v.close as v_close, p.close as p_close
      from (select * from bars where symbol = 'click') c left join (select * from bars where symbol = 'view') v using (ts)
      left join (select * from bars where symbol = 'purchase') p using (ts)""",
    "align_asof": f"""with {BARS} select c.ts, c.close as c_close,
      case when v.ts >= c.ts - interval 20 minutes then v.close end as v_close,
      case when p.ts >= c.ts - interval 20 minutes then p.close end as p_close
      from (select * from bars where symbol = 'click') c
      asof left join (select * from bars where symbol = 'view') v on c.ts >= v.ts
      asof left join (select * from bars where symbol = 'purchase') p on c.ts >= p.ts""",
    "feature_table_raw": FEATURES,
    "feature_table_complete": FEATURES + COMPLETE,
    "last_fold": f"{FOLDS} select symbol, ts, rn, 4 as fold, case when rn < total - total // 6 then 'train' else 'test' end as part from c",
    "all_folds": f"""{FOLDS}, s as (select symbol, ts, rn, f::integer as fold, total - (5 - f) * (total // 6) as start, total // 6 as k
      from c, unnest(range(0, 5)) as u(f))
      select symbol, ts, rn, fold, case when rn < start - 60 then 'train' else 'test' end as part from s
      where rn < start - 60 or (rn >= start and rn < start + k)""",
    "latest_row": f"with {BARS} select symbol, ts, open, high, low, close, volume from (select *, row_number() over (partition by symbol order by ts desc) as r from bars) where r = 1",
    "latest_row_overall": "select event_id, ts, event_type from events order by ts desc, event_id desc limit 1",
    "data_points": "select count(*) as data_points from events where event_id is not null and ts is not null and user_id is not null and event_type is not null and value is not null and props is not null",
    "scalar_on_all_rows": f"with {HEADLINES}, {SCORE} select event_id, sentiment from events, score",
    "streamed_bars": f"with {bars('hour')} select * from bars",
    "streamed_bars_so_far": f"with {bars('hour')} select * from bars where ts + interval 1 hour <= (select max(ts) from events) - interval 2 hours",
    "headlines": f"with {HEADLINES} select page_id, pos, text from heads",
    "headlines_by_pattern": f"with {HEADLINES} select page_id, pos, text from heads",
    "headlines_of_class": f"""with {HEADLINES.replace("<a(?:\\s[^>]*)?>", '<a (?-i:href="/t)[^>]*>')} select page_id, pos, text from heads""",
    "row_ordinal_gaps": """with recursive o as materialized (select event_type as symbol, event_id, value,
        row_number() over (partition by event_type order by ts, event_id) - 1 as rn from events where event_id % 7 <> 0),
      m as (select symbol, event_id, rn, value as mean from o where rn = 0
        union all select o.symbol, o.event_id, o.rn, 0.5::double * o.value + 0.5::double * m.mean from m join o on o.symbol = m.symbol and o.rn = m.rn + 1)
      select symbol, event_id, rn, round(mean, 6) as mean from m""",
    "headline_sentiment": f"with {HEADLINES}, {SCORE} select sentiment from score",
    "sentiment_score": f"select source, sum({word_score('text', POSITIVE_WORDS, NEGATIVE_WORDS)})::integer as sentiment from documents group by source",
    "sentiment_words": f"select source, sum({word_score('text', ['ing', 'positive'], ['sell-off', 'ent', 'st'])})::integer as sentiment from documents group by source",
    "class_report": f"""with {LABELS}, {CELLS}
      select '0' as label, round(p0, 6) as precision, round(r0, 6) as recall, round(f0, 6) as f1_score, su0 as support from g
      union all select '1', round(p1, 6), round(r1, 6), round(f1, 6), su1 from g
      union all select 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), total from g
      union all select 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), total from g
      union all select 'weighted avg', round((p0 * su0 + p1 * su1) / total, 6), round((r0 * su0 + r1 * su1) / total, 6),
        round((f0 * su0 + f1 * su1) / total, 6), total from g""",
    "class_measures": f"""with {LABELS}, {CELLS} select round(acc, 6) as accuracy, round(p0, 6) as precision_0, round(p1, 6) as precision_1,
      round(r0, 6) as recall_0, round(r1, 6) as recall_1, round(f0, 6) as f1_0, round(f1, 6) as f1_1, su0 as support_0,
      su1 as support_1 from g""",
    "trend_bands": """select l_orderkey, l_linenumber, l_partkey, case when l_discount * 10 > 0.6::double then '📈 Uptrend'
      when l_discount * 10 < 0.4::double then '📉 Downtrend' else '➡️ Sideways' end as trend from lineitem""",
    "union_screens": f"with {SCREENS} select * from screens",
    "reasons_by_stock": f"""with {SCREENS} select symbol, string_agg(distinct "Reason", ', ' order by "Reason") as reasons,
      count(distinct "Reason") as reason_count from screens group by symbol""",
    "ranked_screen_value": f"with {TRADES} select symbol, round(value, 2) as value, round(volume, 2) as volume from active order by active.value desc, symbol limit 20",
    "ranked_screen_by_flag": f"""with {TRADES}, by_flag as (select l_returnflag, symbol, sum(price * qty) as value, sum(qty) as volume
      from trades group by all), r as (select *, row_number() over (partition by l_returnflag order by volume desc, symbol) as r from by_flag)
      select l_returnflag, symbol, round(value, 2) as value, round(volume, 2) as volume from r where r <= 5""",
    "volume_gainers": f"""with {TRADES}, p as (select symbol, date_trunc('month', ts) as period, sum(qty) as volume from trades group by all),
      g as (select symbol, sum(volume) filter (period = (select max(period) from p)) as volume,
                   avg(volume) filter (period <> (select max(period) from p)) as mean_volume from p group by symbol)
      select symbol, round(volume, 6) as volume, round(mean_volume, 6) as mean_volume, round(volume / mean_volume, 6) as gain from g
      where volume is not null and mean_volume is not null order by g.volume / g.mean_volume desc, symbol limit 10""",
    "top_gainers": f"with {TRADES} select symbol, close, round(change, 6) as change from changes order by changes.change desc, symbol limit 10",
    "top_losers": f"with {TRADES} select symbol, close, round(change, 6) as change from changes order by changes.change, symbol limit 10",
    "record_key_list": "select event_id, array_to_string(json_keys(props), ', ') as relavant_columns from events",
    "extracted_records": f"with {DOCS}, {EXTRACTED} select * from extracted",
    "split_documents": f"with {DOCS}, {EXTRACTED} select * from parts",
    "activity_csv": f"""with {DOCS}, {EXTRACTED}, all_records as (select * from extracted union all select * from parts)
      select raw ->> '$.symbol' as symbol, (raw ->> '$.price')::double::varchar as price, raw ->> '$.qty' as qty,
        null::varchar as meta, category as "Reason", array_to_string(json_keys(raw), ', ') as relavant_columns from all_records""",
    "activity": f"""with {DOCS}, {EXTRACTED}, all_records as (select * from extracted union all select * from parts)
      select raw ->> '$.symbol' as symbol, (raw ->> '$.price')::double as price, (raw ->> '$.qty')::bigint as qty,
        null::varchar as meta, category as "Reason", array_to_string(json_keys(raw), ', ') as relavant_columns from all_records""",
    "membership_rows": """select c_custkey as "Stock", 'INDEX' as "Index Type", r_name as "Index", c_custkey as symbol, c_name
      from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "cap_class": f'with {MEMBERS} select upper("Index") as "Index", "Stock", cap_class from classed',
    "memberships_by_index": f"""with {MEMBERS} select "Stock", "Index" from members where regexp_matches("Index", 'NATION_1$')""",
    "cap_summary": f"""with {MEMBERS} select count(distinct "Stock") as unique_stocks, count(*) filter (cap_class = 'Large Cap') as large_cap,
      count(*) filter (cap_class = 'Mid Cap') as mid_cap, count(*) filter (cap_class = 'Small Cap') as small_cap from classed""",
    "membership_flags": f'with {MEMBERS} select "Stock", in_mid, in_small, rows from flags',
    "unique_stocks": f'with {MEMBERS} select count(distinct "Stock") as unique_stocks from members',
    "distinct_members": f"""with {MEMBERS} select distinct "Stock" from members where regexp_matches("Index", 'NATION_1$')""",
    "index_coverage": """select (select count(distinct s_nationkey) from supplier) as successful_indices,
      (select count(*) + 1 from nation) as configured_indices""",
    "self_row": f"with {CONSTITUENTS} select index_name, pos, symbol from kept",
    "constituents": f"""with {CONSTITUENTS}, f as (select symbol, bool_or(contains(upper(index_name), 'MIDCAP')) as mid,
        bool_or(contains(upper(index_name), 'SMALLCAP')) as small from kept group by symbol)
      select k.symbol as "Stock", 'INDEX' as "Index Type", upper(k.index_name) as "Index", k.symbol, k."lastPrice", k.open,
        case when mid then 'Mid Cap' when small then 'Small Cap' else 'Large Cap' end as "Market Cap Classification"
      from kept k join f on k.symbol = f.symbol""",
    "option_symbol": f"select p_partkey as ord, {SHORT_SYMBOL} as short from (select *, {SIDE} from part)",
    "strike_band": "select p_partkey, case when p_size = 25 then 'atm' when p_size < 25 then 'itm' else 'otm' end as band from part",
    "cell_band": f"""with {BARS}, c as (select symbol, ts,
        round((close / nullif(lag(close) over (partition by symbol order by ts), 0) - 1) * 100, 2) as x from n)
      select symbol, ts, case when abs(x) >= 10 then 'high_change' when x > 0 then 'positive' when x < 0 then 'negative'
          when x = 0 then 'zero' end as band,
        case when x is null then '' when abs(x) >= 10 then '⚡ <b><u>' || case when x > 0 then '+' else '' end || x::varchar || '</u></b>'
          when x > 0 then '+ +' || x::varchar when x < 0 then '🔴 ' || x::varchar else '⚪ ' || x::varchar end as cell from c""",
    "pattern_marker": """select p_partkey, mk as marker, coalesce(mk || ' ', '') || p_name as cell from (select *,
      case when contains(lower(p_name), 'widget') then 'W' when contains(lower(p_name), 'ring') then 'R'
      when contains(lower(p_name), 'small') then 'S' end as mk from part)""",
    "number_text": """select l_orderkey, l_linenumber, l_partkey, (l_extendedprice * 1000)::varchar as price,
      (l_discount / 1024)::varchar as tiny, printf('%.2f', l_tax) as tax, printf('%.1f%%', l_discount * 100) as discount,
      strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as shipped from lineitem""",
    "table_report": f"""with o as (select *, {SIDE}, round(p_retailprice - 1000, 2) as change from part),
      r as (select *, row_number() over (partition by p_brand order by p_partkey) as r from o),
      lines as (select p_brand, p_partkey,
        case when p_size = 25 then '🎯 <b>25</b>' when p_size < 25 then '🟡 ' || p_size else '🔵 ' || p_size end
        || ' | OI: ' || p_partkey * 100 || chr(10) || '   ' || ({SHORT_SYMBOL}) || chr(10) || '   3min: '
        || {change_cell("round(change / 10, 2)", "round(change / 10, 2)::varchar")}
        || case when p_size <> 7 then ' | Change: ' || {change_cell("change", "change::varchar")} else '' end as line
        from r where r <= 20)
      select p_brand as report_id, '<b>📊 Options</b>' || chr(10) || chr(10) || '<code>' || chr(10)
        || string_agg(line, chr(10) || repeat('─', 40) || chr(10) order by p_partkey) || chr(10) || '</code>' as text
      from lines group by p_brand""",
    "first_rows": "select o_orderkey, o_totalprice from orders order by o_orderkey limit 20",
    "prediction_text": f"""with {LABELS}, {CELLS} select case when acc > 0.6::double then 'success' when acc < 0.4::double then 'warning' else 'info' end as type,
      {filled(PREDICTION_MESSAGE, {
          "timestamp": "'2024-01-31 15:30:00'",
          "trend": "case when acc > 0.6::double then '📈 Uptrend' when acc < 0.4::double then '📉 Downtrend' else '➡️ Sideways' end",
          "probability": "printf('%.1f%%', acc * 100)", "accuracy": "printf('%.1f%%', acc * 100)",
          "precision_0": "printf('%.2f', p0)", "precision_1": "printf('%.2f', p1)", "recall_0": "printf('%.2f', r0)",
          "recall_1": "printf('%.2f', r1)", "data_points": "total::varchar", "features_used": "'17'"})} as text from g""",
    "error_text": f"""select event_id, '❌ <b>' || {filled(ERROR_MESSAGE, {"timestamp": "strftime(ts, '%Y-%m-%d %H:%M:%S')", "error": "props"})}
      || '</b>' as text from events""",
    "alert_style": """select *, icon || ' <b>' || message || '</b>' as text from (select event_id, props as message,
      case event_type when 'purchase' then 'profit' when 'click' then 'trade' else event_type end as type,
      case event_type when 'purchase' then '💰' when 'click' then '📊' when 'error' then '❌' else 'ℹ️' end as icon,
      case event_type when 'purchase' then 'green' when 'click' then 'blue' when 'error' then 'red' else 'blue' end as color from events)""",
    "chunks": CHUNK_ROWS.format(id="doc_id", more="", text="documents.text", source="documents"),
    "previews": """select doc_id, substring(text, 1, 50) || '...' as preview,
      trim(lang || ' ' || coalesce(nullif(source, 'src1'), '')) as name from documents""",
    "fan_out": """select event_id as alert_id, n_nationkey::bigint as chat_id, props as text from events
      join nation on event_type in ('error', 'signup') or user_id = 0 or user_id = n_nationkey""",
    "fan_out_listed": f"""with r as (select unnest([{', '.join(map(str, t.CHAT_IDS))}])::bigint as chat_id)
      select event_id as alert_id, chat_id, 0 as part, props as text, false as silent from events
      join r on event_type in ('error', 'signup') or user_id = 0 or user_id = chat_id""",
    "rejected_alerts": f"""with a as (select event_id as alert_id, case event_type when 'error' then null when 'signup' then 0 else user_id end::bigint as chat_id,
        event_id % 11 = 0 or props is null as no_text from events)
      select alert_id, chat_id, case when no_text then 'no text' else 'chat not authorized' end as reason from a
      where no_text or (chat_id is not null and chat_id <> 0 and chat_id not in {IDS})""",
    "alert_status": """with a as (select event_id as alert_id, case event_type when 'error' then null when 'signup' then 0 else user_id end as chat_id,
        event_id % 11 = 0 or props is null as no_text from events),
      c as (select *, case when no_text then 0 when chat_id is null or chat_id = 0 then (select count(*) from nation)
        when chat_id in (select n_nationkey from nation) then 1 else 0 end as recipients from a)
      select alert_id, recipients, recipients > 0 as success from c""",
    "landed_updates": f"with {MESSAGES} select * from messages where update_id % 9 <> 0",
    "dead_letters": "select event_id + 1 as update_id, 'message without chat id' as error from events where (event_id + 1) % 9 = 0",
    "trend_model_facts": f"""with f as ({FEATURES + COMPLETE}), n as (select *, row_number() over (order by ts) as r, count(*) over () as total from f)
      select any_value(total) as data_points, 17 as features_used, count(*) filter (r > total - total // 6 and "Target" = 0) as support_0,
        count(*) filter (r > total - total // 6 and "Target" = 1) as support_1, timestamp '2024-01-31 00:00:00' as timestamp from n""",
    "trend_job_failure": f"""select 0::bigint as alert_id, chat_id, 0 as part, '❌ <b>' || {filled(ERROR_MESSAGE, {
          "timestamp": "'2024-01-31 00:00:00'", "error": "'🚨 Pipeline failed: too few complete rows for training'"})} || '</b>' as text, false as silent
      from (select unnest([{', '.join(map(str, t.CHAT_IDS))}])::bigint as chat_id)""",
    "stored_outbox": f"""with r as (select unnest([{', '.join(map(str, t.CHAT_IDS))}])::bigint as chat_id)
      select event_id as alert_id, chat_id, 0 as part, props as text, silent from events
      join r on event_type in ('error', 'signup') or user_id = 0 or user_id = chat_id
      cross join (values (false), (true)) as s(silent)""",
    "outbox_once": f"""with r as (select unnest([{', '.join(map(str, t.CHAT_IDS))}])::bigint as chat_id),
      s(run, k, m) as (values ('even', 2, 0), ('again', 6, 1), ('repeated', 6, 3))
      select run, event_id as alert_id, chat_id, 0 as part, props as text from events join s on event_id % k = m
      join r on event_type in ('error', 'signup') or user_id = 0 or user_id = chat_id""",
    "split_authorized": "select event_id, user_id as chat_id, user_id in (select n_nationkey from nation) as authorized from events",
    "is_authorized": f"select event_id, user_id in {IDS} as authorized from events",
    "parse_commands": f"with {MESSAGES} select * from commands",
    "unauthorized_messages": f"with {MESSAGES} select * from messages where chat_id not in {IDS}",
    "dispatch": f"with {MESSAGES} select update_id, chat_id, command, {reply_case(default_replies(t.CHAT_IDS, 0))} as reply from commands",
    "command_list": f"with {MESSAGES} select string_agg(distinct '/' || command, chr(10) order by '/' || command) as commands from commands where command in ('status', 'help', 'ping', 'info')",
    "next_batch": f"with {MESSAGES} select update_id, text from messages where update_id > 50 order by update_id limit 10",
    "log_status": f"""select {len(t.CHAT_IDS)} as authorized, 4 as commands, max(event_id) + 1 as last_update_id, count(*) as processed,
      {status_text("(max(event_id) + 1)::varchar")} as text from events""",
    "command_replies": f"""with {MESSAGES}, before as (select event_id + 1 as update_id,
        coalesce(lag(event_id + 1) over (order by event_id), 0) as last from events),
      replies as (select update_id, chat_id, case when command = 'status' then {status_text("last::varchar")}
        else {reply_case({k: v for k, v in default_replies(t.CHAT_IDS, 0).items() if k != "status"})} end as reply
        from commands join before using (update_id))
      {CHUNK_ROWS.format(id="update_id", more="chat_id,", text="reply", source="replies")}""",
}
ORACLES["command_replies_lost_state"] = f"""with {MESSAGES}, cut as (select (min(update_id) + max(update_id)) // 2 as half from messages),
  halves as (select update_id, 1 as h from messages, cut where update_id <= half union all select update_id, 2 from messages, cut where update_id >= half),
  before as (select update_id, h, coalesce(lag(update_id) over (partition by h order by update_id), 0) as last from halves),
  replies as (select update_id, chat_id, case when command = 'status' then {status_text("last::varchar")}
    else {reply_case({k: v for k, v in default_replies(t.CHAT_IDS, 0).items() if k != "status"})} end as reply
    from commands join before using (update_id))
  {CHUNK_ROWS.format(id="update_id", more="chat_id,", text="reply", source="replies")}"""
PULLS = """log as (select s_suppkey * 3 + 3 as update_id, s_nationkey::bigint as chat_id, s_suppkey % 3 as kind,
  coalesce(lag(s_suppkey * 3 + 3) over (order by s_suppkey), 0) as last, row_number() over (order by s_suppkey) - 1 as n from supplier)"""
ORACLES["pulled_updates_by_ten"] = f"with {PULLS} select update_id, n // 10 as pull from log"
ORACLES["pulled_replies"] = f"""with {PULLS} select update_id, chat_id, 0 as part, case kind when 0 then {status_text("last::varchar")}
  when 1 then {quoted(default_replies(t.CHAT_IDS, 0)["ping"])} else '❓ Unknown command: /foo' end as text from log where chat_id in {IDS}"""
ORACLES["processed_updates"] = f"""with {PULLS} select min(last) as batch_id, count(*) as processed, max(update_id) as last_update_id,
  '2024-01-31' as last_save from log group by n // 40"""
ORACLES["function_replies"] = f"""with {MESSAGES} select update_id, chat_id, 0 as part,
  case when chat_id % 3 = 0 then '❌ Error: no answer for ' || chat_id else chat_id || ': ' || replace(args, '|', '-') end as text
  from commands where command = 'ping' and (chat_id % 3 = 0 or args <> '')"""
ORACLES["unique_stocks_by_sketch"] = f"""with {MEMBERS} select "Index", count(distinct "Stock") as exact, true as near from members group by "Index"
  union all select 'all', count(distinct "Stock"), true from members"""
ORACLES["trend_job_outbox"] = f"""with f as ({FEATURES + COMPLETE}), n as (select *, row_number() over (order by ts) as r, count(*) over () as total from f),
  s as (select any_value(total) as data_points, count(*) filter (r > total - total // 6 and "Target" = 0) as support_0,
    count(*) filter (r > total - total // 6 and "Target" = 1) as support_1 from n)
  select unnest([{', '.join(map(str, t.CHAT_IDS))}])::bigint as chat_id, 0 as part, data_points, 17 as features_used, true as measured,
    '2024-01-31 00:00:00' as at, 1::bigint as runs, support_0, support_1 from s"""
ORACLES["trend_learned"] = """with o as (select o_orderkey, ((o_totalprice > 200000) <> (o_custkey % 5 = 3))::integer as y,
    row_number() over (order by o_orderkey) as r, count(*) over () as n from orders), s as (
  select any_value(n) as data_points, count(*) filter (r > n - n // 6 and y = 0) as support_0, count(*) filter (r > n - n // 6 and y = 1) as support_1,
    arg_max(y, o_orderkey) as latest from o)
  select latest, case latest when 1 then '📈 Uptrend' else '📉 Downtrend' end as trend, support_0, support_1, true as accurate, true as sharp,
    timestamp '2024-01-31 00:00:00' as timestamp, data_points, 3 as features_used from s"""
ORACLES["landed_snapshots"] = f"""with {DOCS}, {EXTRACTED}, r as (select category, o_orderkey, pos, raw from extracted
    union all select category, o_orderkey, pos, raw from parts where category = 'Bulk Deals Data'
    union all select unnest(['Volume Gainers', 'Top Losers', 'Bulk Deals Data']), -1, -1, 'null'),
  placed as (select category, (row_number() over (partition by category order by o_orderkey, pos) - 1)::integer as pos, raw from r)
  select * from placed union all select 'Short Deals Data', 0, '7'"""
ORACLES["landed_constituents"] = f"""with {CONSTITUENTS}, r as (
    select idx, '{{"symbol":"' || case when o_orderstatus = 'F' then upper(idx) else 'C' || o_custkey end || '","lastPrice":' || o_totalprice || '}}' as raw from base
    union all select idx, '{{"symbol":"' || case when o_orderstatus = 'P' then idx else 'C' || c_nationkey end || '","Index":"' || o_orderpriority
      || '","open":' || o_orderkey || '}}' from base
    union all select distinct idx, 'null' from base)
  select idx as index_name, raw from r where (starts_with(idx, 'nifty midcap ') or regexp_matches(idx, '^nifty [0-9]')) and split_part(idx, ' ', -1)::integer % 2 = 0"""
ORACLES["bar_table_recent"] = f"""with {BARS} select * from bars where symbol in ('click', 'view')
  and ts >= (select max(ts) from bars where symbol in ('click', 'view')) - interval 7 days"""
ORACLES["bar_table_ordinals"] = f"with {BARS} select symbol, ts, rn, lag(close) over (partition by symbol order by ts) as before from n"
ORACLES["streamed_bars_closing"] = ORACLES["streamed_bars"]
ORACLES["activity_discovered"] = ORACLES["activity"]
ORACLES["command_replies_restart"] = ORACLES["command_replies"]
for _name in ("pct_change_60", "forward_target", "rolling_std_30", "ewma_span12", "rsi_14", "macd_diff", "returns_and_indicators"):
    ORACLES[f"{_name}_blocks"] = ORACLES[_name]
ORACLES["feature_table_blocks"] = ORACLES["feature_table_complete"]
