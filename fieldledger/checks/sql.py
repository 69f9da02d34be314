"""SQL forms of the proxies, written out by hand as common table expressions."""

INCIDENTS_RAW = """
incidents_raw as (
  select cast(year(l_shipdate) as varchar) as iyear, n_name as country_txt,
    case when p_type = 'PROMO' then 'Unknown' when p_type = 'SMALL' then null else p_type end as attacktype1_txt,
    nullif(l_returnflag, 'N') as targtype1_txt, nullif(l_linestatus, 'F') as weaptype1_txt,
    case when l_quantity > 48 then null when l_quantity > 46 then 'n/a'
         else cast(cast(l_quantity as int) % 13 as varchar) end as nkill,
    cast(cast(round(l_discount * 100) as int) % 4 as varchar) as nwound,
    case when p_size % 5 = 0 then ' Unknown ' when p_size % 7 = 0 then null else p_brand end as gname
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
    join part on l_partkey = p_partkey)
"""

ACTIVITY_RAW = """
activity_raw as (
  select cast(o_orderkey as varchar) as c0, strftime(o_orderdate, '%Y%m%d') as c1,
    case when c_nationkey >= 20 then null when c_nationkey >= 18 then 'X'
         else 'N' || lpad(cast(c_nationkey as varchar), 2, '0') end as c7
  from orders join customer on o_custkey = c_custkey)
"""

LOOKUP = """
country_lookup as (
  select 'N' || lpad(cast(n_nationkey as varchar), 2, '0') as code, n_name as name from nation where n_nationkey < 15)
"""

INCIDENTS = (
    INCIDENTS_RAW
    + """,
incidents as (
  select cast(trunc(try_cast(iyear as double)) as int) as year, country_txt as country, attacktype1_txt as attack_type,
    targtype1_txt as target_type, weaptype1_txt as weapon_type, coalesce(try_cast(nkill as double), 0.0) as kills,
    coalesce(try_cast(nwound as double), 0.0) as wounds, gname as group_name
  from incidents_raw
  where iyear is not null and country_txt is not null and attacktype1_txt <> 'Unknown')
"""
)

LOG_ROWS = (
    ACTIVITY_RAW
    + """,
log_rows as (
  select try_cast(substr(c1, 1, 4) as int) as g_year, c7 as g_code from activity_raw
  where length(c7) = 3 and try_cast(substr(c1, 1, 4) as int) in (1996, 1997, 1998))
"""
)

ACTIVITY = (
    LOG_ROWS
    + ","
    + LOOKUP
    + """,
activity as (
  select g_year, name as g_country, cast(count(*) as bigint) as evt_count
  from log_rows join country_lookup on upper(trim(g_code)) = code group by all)
"""
)

ENRICHED = (
    INCIDENTS
    + ","
    + ACTIVITY
    + """,
enriched as (
  select i.*, coalesce(evt_count, 0) as evt_count
  from incidents i left join activity on year = g_year and country = g_country)
"""
)

REPORTS = (
    ENRICHED
    + """,
reports as (
  select *,
    'You are an analyst who combines incident records with event activity.' as system,
    'Summarise the ' || attack_type || ' incident recorded in ' || country || ' in ' || year || '.' as instruction,
    'INCIDENT REPORT — ' || upper(attack_type) || ' | ' || country || ' | ' || year || chr(10) || chr(10)
    || 'A ' || attack_type || ' incident was recorded in ' || country || ' in ' || year || ', '
    || case when kills > 0 or wounds > 0 then 'with ' || cast(trunc(kills) as bigint) || ' '
         || case when kills = 1 then 'death' else 'deaths' end || ' and ' || cast(trunc(wounds) as bigint) || ' wounded'
       else 'with no casualties' end || '.' || chr(10)
    || coalesce('Its target was ' || nullif(target_type, '') || '.', '') || chr(10)
    || coalesce('The weapon was ' || nullif(weapon_type, '') || '.', '') || chr(10)
    || case when trim(group_name) not in ('', 'Unknown') then 'It was attributed to ' || group_name || '.' else '' end
    || chr(10) || chr(10) || 'CONTEXT: '
    || case when evt_count > 0 then 'The activity log holds ' || format('{:,}', evt_count) || ' events for ' || country || ' in ' || year || '.'
       else 'The activity log holds no events for ' || country || ' in ' || year || '.' end
    || chr(10) || chr(10) || 'ASSESSMENT: The severity is '
    || case when kills >= 10 then 'high' when kills >= 3 then 'moderate' else 'low' end
    || '; keep watching ' || country || '.' as output
  from enriched)
"""
)


def split_of(key: str) -> str:
    """SQL of the split that the content hash of a text assigns."""
    bucket = f"(('0x' || substr(md5('42:' || {key}), 1, 8))::bigint % 10000)"
    return f"case when {bucket} < 8000 then 'train' when {bucket} < 9000 then 'val' else 'test' end"


SPLIT_REPORTS = (
    REPORTS
    + f""",
split_reports as (
  select *, {split_of("(instruction || chr(31) || output)")} as split from reports)
"""
)


def words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '\\S+'))"


def title(text: str) -> str:
    runs = f"regexp_extract_all(lower({text}), '\\p{{L}}+|\\P{{L}}+')"
    return f"array_to_string(list_transform({runs}, lambda x: upper(x[1]) || x[2:]), '')"


TAGGED = (
    SPLIT_REPORTS
    + f""",
tagged as (
  select split, cast({words("instruction || ' ' || output")} as int) as token_len, {title("attack_type")} as label
  from split_reports)
"""
)

DAMAGED = f"""
damaged as (
  select doc_id, cast(n_chars % 11 as int) as kind, 'Describe a text from ' || source as instruction,
    'TEXT — ' || upper(source) || '/' || upper(lang) || ' | x' || chr(10) || text as output, text, source, lang
  from documents),
decoded as (
  select doc_id, kind,
    case when kind in (0, 1, 2, 4, 7) then null when kind = 3 then '' else instruction end as instruction,
    case when kind in (0, 1, 7) then null when kind = 6 then '' when kind = 5 then text else output end as output,
    case when kind in (0, 1, 7) or kind = 6 then null
         when kind = 5 then null else {title("source || '/' || lang")} end as label
  from damaged)
"""

DOC_SPLITS = f"""
doc_splits as (select *, {split_of("cast(doc_id as varchar)")} as split from documents)
"""
