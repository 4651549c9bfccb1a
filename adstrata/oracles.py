"""The registered queries as DuckDB SQL over the given tables, written apart from the Spark code."""

from __future__ import annotations

_RELATIONS = {
    "creative_stats": """
select 'AR'||lpad(cast(o.o_custkey as varchar),20,'0') advertiser_id, 'CR'||lpad(cast(o.o_orderkey as varchar),20,'0') creative_id,
  'https://ads.example.com/advertiser/AR'||lpad(cast(o.o_custkey as varchar),20,'0')||'/creative/CR'||lpad(cast(o.o_orderkey as varchar),20,'0') creative_page_url,
  o.o_orderpriority ad_format_type, c.c_name advertiser_disclosed_name, case when o.o_custkey%7=0 then null else c.c_name end advertiser_legal_name,
  r.r_name advertiser_location, o.o_orderstatus advertiser_verification_status, c.c_mktsegment topic, (o.o_orderkey%10=0) is_funded_by_google_ad_grants,
  st.region_stats, {'approach':o.o_orderstatus} audience_selection_approach_info
from orders o join customer c on o.o_custkey=c.c_custkey join nation n on c.c_nationkey=n.n_nationkey join region r on n.n_regionkey=r.r_regionkey
left join (
  select l_orderkey, list_sort(list({'region_code':region_code,'first_shown':first_shown,'last_shown':last_shown})) region_stats from (
    select l.l_orderkey, rr.r_name region_code, strftime(min(l.l_shipdate),'%Y-%m-%d') first_shown, strftime(max(l.l_shipdate),'%Y-%m-%d') last_shown
    from lineitem l join supplier s on l.l_suppkey=s.s_suppkey join nation nn on s.s_nationkey=nn.n_nationkey join region rr on nn.n_regionkey=rr.r_regionkey
    group by l.l_orderkey, rr.r_name) per_region
  group by l_orderkey) st on st.l_orderkey=o.o_orderkey""",
    "market": """
select cast(strptime(e.first_shown,'%Y-%m-%d') as date) first_day, cast(strptime(e.last_shown,'%Y-%m-%d') as date) last_day,
  advertiser_id, creative_id, ad_format_type,
  cast(to_json({'advertiser_id':advertiser_id,'creative_id':creative_id,'creative_page_url':creative_page_url,'ad_format_type':ad_format_type,
    'advertiser_disclosed_name':advertiser_disclosed_name,'advertiser_legal_name':advertiser_legal_name,'advertiser_location':advertiser_location,
    'advertiser_verification_status':advertiser_verification_status,'topic':topic,'is_funded_by_google_ad_grants':is_funded_by_google_ad_grants,
    'region_stats':entries,'audience_selection_approach_info':audience_selection_approach_info}) as varchar) raw_data
from (select *, list_filter(region_stats, lambda x: x.region_code='EUROPE') entries, (list_filter(region_stats, lambda x: x.region_code='EUROPE'))[1] e
  from creative_stats where advertiser_location='EUROPE') m
where len(entries)>0""",
    "tracking": "select 'AR'||lpad(cast(c_custkey as varchar),20,'0') advertiser_id from customer where c_custkey%3=0",
    "segment": "select 'AR'||lpad(cast(c_custkey as varchar),20,'0') advertiser_id from customer where c_mktsegment='BUILDING'",
    "urgent": "select 'CR'||lpad(cast(o_orderkey as varchar),20,'0') creative_id from orders where o_orderpriority='1-URGENT'",
    "history": """
select first_day, date '2024-01-01' loaded, advertiser_id, creative_id,
  case when cast(right(creative_id,6) as int)%4=0 then raw_data else replace(raw_data,'"topic":"','"topic":"old-') end raw_data
from market where cast(right(creative_id,6) as int)%2=0""",
    "fresh": """
select m.* from market m where not exists (
  select 1 from history h where h.advertiser_id=m.advertiser_id and h.creative_id=m.creative_id and h.raw_data=m.raw_data)""",
    "versions": """
select first_day, loaded, advertiser_id, creative_id, raw_data from history
union all select first_day, date '2024-02-01', advertiser_id, creative_id, raw_data from fresh where advertiser_id in (select advertiser_id from tracking)""",
    "creative_pages": """
select page_id, 'AR'||lpad(cast(page_id%20 as varchar),20,'0') advertiser_id, 'CR'||lpad(cast(page_id as varchar),20,'0') creative_id,
  case when page_id%17=0 then null else url end creative_page_url,
  case page_id%5 when 0 then html when 1 then html||'<iframe src="https://www.youtube.com/embed/v'||cast(page_id as varchar)||'?rel=0"></iframe>'
  when 2 then html||'<iframe src="https://player.example.com/x"></iframe><iframe src="https://www.youtube.com/embed/w'||cast(page_id as varchar)||'"></iframe>'
  when 3 then html||'<iframe src="https://www.youtube.com/watch?v=q"></iframe>' else null end html from pages""",
    "outcomes": r"""
select advertiser_id, creative_id, creative_page_url, youtube_video_url, youtube_watch_url,
  case when creative_page_url='' then 'skipped' when html is null then 'timeout' when youtube_video_url is null then 'no_video'
  when youtube_watch_url is null then 'convert_failed' else 'video' end outcome
from (select *, 'https://www.youtube.com/watch?v='||nullif(regexp_extract(youtube_video_url,'/embed/([^?&]+)',1),'') youtube_watch_url
  from (select *, case when creative_page_url='' or html is null then null when contains(creative_page_url,'youtube.com') then creative_page_url
      else nullif(replace(regexp_extract(regexp_replace(html,'<!--.*?-->','','gs'),'(?i:<iframe[^>]*\ssrc\s*=\s*)["'']([^"'']*youtube\.com[^"'']*)["'']',1),'&amp;','&'),'') end youtube_video_url
    from creative_pages where creative_page_url is not null) a) b""",
    "codes": """
select event_id code_id, 'user'||cast(user_id as varchar)||'@example.com' email, cast(1000+event_id%9000 as varchar) verification_code, ts created_at
from events where event_type='signup'""",
    "attempts": """
select event_id attempt_id, case when event_id%11=0 then 'ghost' else 'user' end||cast(user_id as varchar)||'@example.com' email,
  case when event_id%3=0 then '0000' else cast(1000+event_id%9000 as varchar) end verification_code, ts + to_minutes(cast(event_id%20 as int)) attempted_at
from events where event_type='signup'""",
    "staged": """
select advertiser_id, creative_id, loaded, json_extract_string(raw_data,'$.creative_page_url') creative_page_url, json_extract_string(raw_data,'$.ad_format_type') ad_format_type,
  json_extract_string(raw_data,'$.advertiser_legal_name') advertiser_legal_name, json_extract_string(raw_data,'$.topic') topic,
  case json_extract_string(raw_data,'$.is_funded_by_google_ad_grants') when 'true' then 1 when 'false' then 0 end funded,
  json_extract_string(raw_data,'$.region_stats[0].first_shown') first_shown, json_extract_string(raw_data,'$.region_stats[0].last_shown') last_shown,
  json_extract_string(raw_data,'$.audience_selection_approach_info.approach') approach,
  json_extract_string(raw_data,'$.advertiser_disclosed_name') advertiser_disclosed_name,
  json_extract_string(raw_data,'$.advertiser_location') advertiser_location,
  json_extract_string(raw_data,'$.advertiser_verification_status') advertiser_verification_status,
  cast(json_extract(raw_data,'$.region_stats') as varchar) region_stats
from versions""",
}

_NEEDS = {
    "creative_stats": [],
    "market": ["creative_stats"],
    "tracking": [],
    "segment": [],
    "urgent": [],
    "history": ["market"],
    "fresh": ["market", "history"],
    "versions": ["history", "fresh", "tracking"],
    "creative_pages": [],
    "outcomes": ["creative_pages"],
    "codes": [],
    "attempts": [],
    "staged": ["versions"],
}

_RAW = "cast(first_day as varchar) data_modified, advertiser_id, creative_id, raw_data"
_IN_TRACKING = "advertiser_id in (select advertiser_id from tracking)"
_IN_SEGMENT = "advertiser_id in (select advertiser_id from segment)"
_IN_1998 = "between date '1998-01-01' and date '1998-12-31'"
_THREE_MONTHS = "last_day between date '1999-10-02' and date '1999-12-31'"

# What each job of `run_status` loads: the day of the daily run counts only when its gate is open.
_RUNS = f"""
, t as (select *, {_IN_TRACKING} tracked, {_IN_SEGMENT} in_segment from market),
g as (select
  (select count(*) from t where tracked and first_day=date '1998-07-01') daily_gate,
  (select count(*) from t where tracked and first_day {_IN_1998}) year_gate,
  (select count(*) from t where in_segment and first_day between date '1999-10-02' and date '1999-12-31') quarter_gate,
  (select count(*) from t where in_segment and last_day {_IN_1998}) known_gate),
s as (select t.*, g.*,
  tracked and last_day=date '1998-07-01' and daily_gate>0 by_daily,
  tracked and last_day {_IN_1998} and year_gate>0 by_year,
  in_segment and {_THREE_MONTHS} and quarter_gate>0 by_quarter from t cross join g),
n as (select
  max(daily_gate) daily_gate, max(year_gate) year_gate, max(quarter_gate) quarter_gate, max(known_gate) known_gate,
  count(*) filter (by_daily) daily_rows, count(*) filter (by_year and not by_daily) year_rows,
  count(*) filter (by_quarter and not by_year and not by_daily) quarter_rows,
  count(*) filter (tracked and not by_year and not by_daily and not by_quarter) rest,
  count(*) filter (in_segment and not tracked and not by_quarter) targeted from s)
select job, cast(rows_added as bigint) rows_added, case when gate=0 then 'NO_DATA_AVAILABLE' when rows_added>0 then 'DATA_INSERTED' else otherwise end status from (
  select 'daily' job, daily_gate gate, daily_rows rows_added, 'INCOMPLETE_INSERTION' otherwise from n
  union all select 'backfill', year_gate, year_rows, 'INCOMPLETE_INSERTION' from n
  union all select 'backfill_again', year_gate, 0, 'INCOMPLETE_INSERTION' from n
  union all select 'backfill_empty', 0, 0, 'INCOMPLETE_INSERTION' from n
  union all select 'three_months', quarter_gate, quarter_rows, 'INCOMPLETE_INSERTION' from n
  union all select 'refresh_all', 1, rest, 'NO_NEW_UPDATES' from n
  union all select 'refresh_targeted', 1, targeted, 'NO_NEW_UPDATES' from n
  union all select 'backfill_known', known_gate, 0, 'INCOMPLETE_INSERTION' from n) r"""

_CODE_CHECK = """select attempt_id, email, case when stored_code is null then 'unknown_email' when stored_code<>verification_code then 'invalid_code'
  when attempted_at > created_at + interval 10 minutes then 'expired' else 'verified' end status from (
  select a.*, c.verification_code stored_code, c.created_at, row_number() over (partition by a.attempt_id order by c.created_at desc, c.code_id desc) rn
  from attempts a left join codes c on a.email=c.email and c.created_at<=a.attempted_at) j where rn=1"""

_MISSING = ["advertiser_id", "creative_id", "advertiser_legal_name", "region_stats"]

# Query name -> (relations it starts from, SQL). SQL that starts with a comma continues the WITH list.
_QUERIES = {
    "market_projection": (["market"], f"select {_RAW} from market"),
    "not_shown_in_market": (
        ["creative_stats"],
        "select creative_id, coalesce(len(region_stats),0) regions from creative_stats "
        "where not coalesce(len(list_filter(region_stats, lambda x: x.region_code='EUROPE'))>0, false)",
    ),
    "repeated_entries": (
        ["creative_stats"],
        """select creative_id, len(e) entries, case when len(e)=1 then e[1].first_shown end first_shown from (
  select creative_id, list_filter(case when is_funded_by_google_ad_grants then list_concat(region_stats, region_stats) else region_stats end,
    lambda x: x.region_code='EUROPE') e from creative_stats where advertiser_location='EUROPE') m where len(e)>0""",
    ),
    "unusable_records": (
        ["creative_stats"],
        """select * from (select advertiser_id, creative_id, case when is_funded_by_google_ad_grants then 'more than one entry'
    when s='F' and contains(e.first_shown,'-0') then 'first_shown' when s='P' then 'last_shown' end reason
  from (select *, advertiser_verification_status s, (list_filter(region_stats, lambda x: x.region_code='EUROPE'))[1] e
    from creative_stats where advertiser_location='EUROPE') m where e is not null) r where reason is not null""",
    ),
    "unusable_for_refresh": (
        ["creative_stats"],
        """select * from (select advertiser_id, creative_id, case when is_funded_by_google_ad_grants then 'more than one entry'
    when s='F' and contains(e.first_shown,'-0') then 'first_shown' end reason
  from (select *, advertiser_verification_status s, (list_filter(region_stats, lambda x: x.region_code='EUROPE'))[1] e
    from creative_stats where advertiser_location='EUROPE') m where e is not null) r where reason is not null""",
    ),
    "refresh_lenient": (
        ["creative_stats"],
        """select e.first_shown data_modified, advertiser_id, creative_id
  from (select *, advertiser_verification_status s, (list_filter(region_stats, lambda x: x.region_code='EUROPE'))[1] e
    from creative_stats where advertiser_location='EUROPE') m
  where e is not null and not is_funded_by_google_ad_grants and not (s='F' and contains(e.first_shown,'-0'))""",
    ),
    "parsed_days": (
        [],
        """select o_orderkey, day_text, case when regexp_matches(day_text,'^[0-9]{4}-[0-9]{2}-[0-9]{2}$') then cast(try_cast(day_text as date) as varchar) end parsed,
  cast(coalesce(regexp_matches(day_text,'^[0-9]{4}-[0-9]{2}-[0-9]{2}$'), false) as int) shaped from (
  select o_orderkey, case o_orderkey%6 when 0 then d when 1 then year(o_orderdate)||'-'||month(o_orderdate)||'-'||day(o_orderdate)
    when 2 then d||' ' when 3 then d[1:5]||'13'||d[8:] when 4 then d||'T00' end day_text
  from (select o_orderkey, o_orderdate, strftime(o_orderdate,'%Y-%m-%d') d from orders) o) t""",
    ),
    "ingest_tracked_all": (["fresh", "tracking"], f"select {_RAW} from fresh where {_IN_TRACKING}"),
    "ingest_by_environment": (["market", "tracking"], f"select {_RAW} from market where {_IN_TRACKING} and last_day {_IN_1998}"),
    "refresh_status": (
        ["market", "tracking"],
        f"""select 'refresh_all' job, 'DATA_INSERTED' status, count(*) rows_added from market where {_IN_TRACKING}
union all select unnest(['refresh_all','refresh_targeted','table','table','table']),
  unnest(['NO_NEW_UPDATES','NO_NEW_UPDATES','0-TABLE_CREATED','1-TABLE_EXISTS','2-TABLE_CREATION_FAILED']), 0""",
    ),
    "raw_layout": (
        ["versions"],
        "select cast(cast(date_trunc('month', first_day) as date) as varchar) as month, count(*) row_count, cast(0 as bigint) misplaced from versions group by all",
    ),
    "ingest_indexed": (["fresh", "tracking"], f"select {_RAW} from fresh where {_IN_TRACKING}"),
    "stream_ingest": (["fresh", "tracking"], f"select {_RAW} from fresh where {_IN_TRACKING}"),
    "ingest_window_last_shown": (
        ["fresh", "tracking"],
        f"select {_RAW} from fresh where {_IN_TRACKING} and last_day {_IN_1998}",
    ),
    "gate_first_shown": (
        ["market", "tracking"],
        f"select count(*) n from market where {_IN_TRACKING} and first_day {_IN_1998}",
    ),
    "ingest_id_list": (["fresh", "segment"], f"select {_RAW} from fresh where {_IN_SEGMENT} and last_day {_IN_1998}"),
    "ingest_three_month": (["fresh", "segment"], f"select {_RAW} from fresh where {_IN_SEGMENT} and {_THREE_MONTHS}"),
    "ingest_targeted": (
        ["fresh"],
        f"select {_RAW} from fresh where advertiser_id in ('AR00000000000000000003','AR00000000000000000010') "
        "or creative_id='CR00000000000000000007'",
    ),
    "ingest_targeted_tables": (
        ["fresh", "segment", "urgent"],
        f"select {_RAW} from fresh where {_IN_SEGMENT} or creative_id in (select creative_id from urgent)",
    ),
    "batch_repeats": (
        ["fresh", "tracking"],
        "select 'kept' repeats, advertiser_id, 2*count(*) n from fresh where "
        + _IN_TRACKING
        + " group by advertiser_id union all select 'dropped', advertiser_id, count(*) from fresh where "
        + _IN_TRACKING
        + " group by advertiser_id",
    ),
    "run_status": (["market", "tracking", "segment"], _RUNS),
    "raw_row_count": (
        ["versions"],
        "select strftime(first_day,'%Y-%m-01') as \"month\", count(*) row_count from versions group by 1",
    ),
    "media_outcomes": (["outcomes"], "select * from outcomes"),
    "media_links": (["outcomes"], "select * exclude (outcome) from outcomes where outcome='video'"),
    "media_timeouts": (["outcomes"], "select * exclude (outcome) from outcomes where outcome='timeout'"),
    "media_routed": (
        ["outcomes"],
        """select creative_id, case when outcome='video' then youtube_watch_url end youtube_watch_url, case when outcome='video' then 'links' else 'timeouts' end routed_to,
  (select count(*) from outcomes where outcome in ('video','convert_failed')) found from outcomes where outcome in ('video','timeout')""",
    ),
    "media_of_advertiser": (["outcomes"], "select * from outcomes where advertiser_id='AR00000000000000000007'"),
    "media_frames": (
        [],
        """select 'CR'||lpad(cast(page_id as varchar),20,'0') creative_id, u||case when page_id%12=3 then '?a=1&b=2' else '' end youtube_video_url,
  case when u is not null then 'https://www.youtube.com/watch?v=f'||cast(page_id as varchar) end youtube_watch_url,
  case when page_id%12=11 then 'skipped' when u is not null then 'video' else 'no_video' end outcome
from (select page_id, case when page_id%12 in (0,1,2,3,4,7,8) then 'https://www.youtube.com/embed/f'||cast(page_id as varchar) end u from pages) p""",
    ),
    "media_loads": (
        ["outcomes"],
        "select advertiser_id, case when outcome='video' then 'links' else 'timeouts' end routed_to, count(*) n, cast(1 as bigint) loads "
        "from outcomes where outcome in ('video','timeout') and advertiser_id <> 'AR00000000000000000002' group by all",
    ),
    "media_counters": (
        ["outcomes"],
        "select advertiser_id, count(*) total_rows, count(*) total_urls_processed, "
        "count(*) filter (outcome in ('video','convert_failed')) successful_scrapes, "
        "count(*) filter (outcome='timeout') timeouts_inserted from outcomes group by advertiser_id",
    ),
    "advertiser_from_url": (
        ["creative_stats"],
        "select creative_page_url url, string_split(creative_page_url,'/')[5] advertiser_id from creative_stats",
    ),
    "lowercase_columns": ([], "select * replace (upper(c_name) as c_name) from customer"),
    "valid_email": (
        [],
        r"""select c_custkey, email, cast(regexp_matches(email,'^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.-]+$') as int) valid from (
  select c_custkey, case c_custkey%6 when 0 then plain||'@example.com' when 1 then plain||'@example' when 2 then c_name||'@example.com'
    when 3 then plain||'@exa mple.com' when 4 then plain||'+tag@mail.example-site.co.uk' else plain end email
  from (select c_custkey, c_name, replace(c_name,'#','.') plain from customer) p) e""",
    ),
    "code_latest": (
        ["codes"],
        "select email, code_id, verification_code from (select *, row_number() over "
        "(partition by email order by created_at desc, code_id desc) rn from codes) c where rn=1",
    ),
    "code_check": (["codes", "attempts"], _CODE_CHECK),
    "code_check_partial": (
        ["codes", "attempts"],
        """, partial_ as (select attempt_id, attempted_at, case attempt_id%9 when 1 then '' when 2 then null else email end email,
  case attempt_id%9 when 3 then '' when 4 then null else verification_code end verification_code from attempts)
select attempt_id, email, case when coalesce(email,'')='' or coalesce(verification_code,'')='' then 'missing_input' else status end status from ("""
        + _CODE_CHECK.replace("from attempts a", "from partial_ a").replace("email, case", "email, verification_code, case")
        + ") checked",
    ),
    "code_lookup": (["codes"], "select code_id, email, verification_code from codes where email='user7@example.com'"),
    "account_lookup": ([], "select c_custkey account_id, c_name as name, 'user7@example.com' email from customer where c_custkey%50=7"),
    "code_stored": (
        ["codes"],
        """select email, count(*) n, count(*) filter (verification_code='0000') late, 'True,True,False' stored from (
  select email, verification_code from codes union all select 'user7@example.com', '0000') c group by email""",
    ),
    "stream_code_check": (["codes", "attempts"], _CODE_CHECK),
    "stream_code_join": (["codes", "attempts"], _CODE_CHECK),
    "code_delete": (
        ["codes"],
        "select code_id, email, verification_code from codes where email not in (select 'user'||cast(user_id as varchar)||'@example.com' "
        "from events where event_type='error' and ts>=timestamp '2024-01-30 00:00:00')",
    ),
    "code_forgotten": (
        ["codes"],
        "select email, count(*) stored, case when email in (select 'user'||cast(user_id as varchar)||'@example.com' "
        "from events where event_type='error' and ts>=timestamp '2024-01-30 00:00:00') then 0 else count(*) end n_left from codes group by email",
    ),
    "required_columns_quarantine": (
        ["creative_stats"],
        "select advertiser_id, creative_id, missing from (select *, concat_ws(',',"
        + ",".join(f"case when {c} is null then '{c}' end" for c in _MISSING)
        + ") missing from creative_stats) q where missing<>''",
    ),
    "stg_creatives": (
        ["staged"],
        "select * exclude (loaded), cast(loaded as varchar) loaded from staged",
    ),
    "latest_version": (
        ["versions"],
        f"select {_RAW}, cast(loaded as varchar) metadata_time from (select *, row_number() over "
        "(partition by advertiser_id, creative_id order by loaded desc, raw_data) rn from versions) v where rn=1",
    ),
    "version_history": (
        ["versions"],
        """select advertiser_id, creative_id, cast(loaded as varchar) metadata_time, row_number() over w version_no,
  cast(coalesce(digest <> lag(digest) over w, false) as int) changed, copies, digest from (
  select advertiser_id, creative_id, loaded, first_day, sha256(raw_data) digest, count(*) copies from versions group by all) v
window w as (partition by advertiser_id, creative_id order by loaded, digest, first_day)""",
    ),
    "published_models": (
        ["staged"],
        "select advertiser_id, ad_format_type, count(*) versions, count(*) staged from staged group by advertiser_id, ad_format_type",
    ),
    "stg_second_source": (
        [],
        """select case when bad or conv_id%5=0 then null else cast(conv_id as bigint) end conv_id, case when bad or turn%3=2 then null else cast(turn as int) end turn,
  case when not bad and turn%2=0 then role end as role, case when not bad and conv_id%5=0 then '"c'||cast(conv_id as varchar)||'"' end other_id,
  case when not bad and turn%3=2 then cast(turn as varchar)||'.5' end other_turn, case when not bad and turn%2<>0 then '"'||role||'"' end speaker,
  case when bad then 'no record' end unparsed
from (select *, conv_id%11=0 and turn=0 bad from conversations) c""",
    ),
    "mart_creatives": (
        ["staged"],
        """select advertiser_id, ad_format_type, count(distinct creative_id) creatives, count(*) versions, min(first_shown) first_shown_date, max(last_shown) last_shown_date,
  date_diff('day', cast(min(first_shown) as date), cast(max(last_shown) as date)) + 1 active_days from staged group by advertiser_id, ad_format_type""",
    ),
}


def _closure(names: list[str]) -> list[str]:
    wanted: list[str] = []
    for name in names:
        wanted += [n for n in _closure(_NEEDS[name]) + [name] if n not in wanted]
    return wanted


def _full(names: list[str], sql: str) -> str:
    relations = ",\n".join(f"{name} as ({_RELATIONS[name].strip()})" for name in _closure(names))
    return f"with {relations}\n{sql.strip()}" if relations else sql


def oracle_sql() -> dict[str, str]:
    # Tables kept up to date load by load hold what a full computation gives.
    same = {"version_history_extended": "version_history", "mart_creatives_merged": "mart_creatives"}
    written = {**_QUERIES, **{name: _QUERIES[other] for name, other in same.items()}}
    return {name: _full(names, sql) for name, (names, sql) in written.items()}
