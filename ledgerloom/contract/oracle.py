"""Independent SQL for the registered queries (DuckDB dialect), one SELECT each."""

from __future__ import annotations

DAY_1, DAY_2 = "2024-01-01", "2024-01-02"

_TRIAL = f"""
per_order as (
  select l_orderkey, max(l_shipdate) as last_ship, cast(sum(l_quantity) as bigint) as quantity,
         string_agg(distinct p_name, ', ' order by p_name) as names
  from lineitem left join part on l_partkey = p_partkey
  group by l_orderkey
),
trial as (
  select 'NCT' || lpad(cast(o_orderkey as varchar), 8, '0') as nct_id,
         ' ' || c_name || ' / ' || o_orderpriority || ' ' as brief_title,
         case when o_orderstatus = 'F' then 'Completed'
              when o_orderstatus = 'O' then ' recruiting '
              when o_orderstatus = 'P' and o_orderkey % 7 = 0 then 'on_hold'
              when o_orderstatus = 'P' then 'Active_Not_Recruiting' end as overall_status,
         case o_orderpriority when '1-URGENT' then 'PHASE1' when '2-HIGH' then 'PHASE2'
              when '3-MEDIUM' then 'PHASE3' when '5-LOW' then 'PHASE2, PHASE3' end as phase,
         case when o_orderkey % 97 = 0 then null
              when o_orderkey % 5 = 0 then strftime(o_orderdate, '%Y-%m')
              else strftime(o_orderdate, '%Y-%m-%d') end as start_date,
         strftime(last_ship, '%Y-%m-%d') as completion_date,
         strftime(o_orderdate, '%Y-%m-%d') as last_update_date,
         case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'Observational'
              else 'Interventional' end as study_type,
         case when o_orderkey % 101 = 0 then -quantity else quantity end as enrollment_count,
         names as conditions,
         d.text as brief_summary,
         case when o_custkey % 25 = 0 then null else c_name || ' ' end as lead_sponsor,
         '{DAY_1} 00:00:00' as ingestion_ts,
         c_mktsegment as query_term,
         'tables' as source
  from orders join customer on o_custkey = c_custkey
  left join per_order on o_orderkey = l_orderkey
  left join documents d on d.doc_id = o_orderkey
)"""


def _date(c: str) -> str:
    return (
        f"try_cast(case length({c}) when 7 then {c} || '-01' when 4 then {c} || '-01-01' "
        f"else {c} end as date)"
    )


def _clean(name: str, raw: str, day: str, carry: str = "") -> str:
    """Two CTEs: typed columns, then the derived ones."""
    return f"""
{name}_typed as (
  select nct_id, trim(brief_title, ' ') as brief_title, upper(trim(overall_status, ' ')) as overall_status, phase,
         upper(trim(study_type, ' ')) as study_type, enrollment_count, conditions,
         {_date('start_date')} as start_date, {_date('completion_date')} as completion_date,
         {_date('last_update_date')} as last_update_date, brief_summary,
         trim(lead_sponsor, ' ') as lead_sponsor, query_term, source, ingestion_ts
  from {raw}
),
{name} as (
  select * exclude (source, ingestion_ts),
         overall_status = 'RECRUITING' as is_recruiting,
         overall_status = 'COMPLETED' as is_completed,
         study_type = 'INTERVENTIONAL' as is_interventional,
         cast(date_diff('day', start_date, completion_date) as integer) as duration_days,
         md5(concat_ws('|', nct_id, overall_status, cast(enrollment_count as varchar),
             cast(completion_date as varchar), lead_sponsor)) as _record_hash,
         '{day}' as created_on, '{day}' as updated_on, 0 as _update_count{carry}
  from {name}_typed
)"""


_DAYS = """
day_1 as (select * from trial where last_update_date < '2000-07-01'),
day_2 as (
  select nct_id,
         case when query_term = 'BUILDING' then trim(brief_title, ' ') || ' v2' else brief_title end as brief_title,
         case when query_term = 'AUTOMOBILE' then 'TERMINATED' else overall_status end as overall_status,
         phase, start_date, completion_date, last_update_date, study_type,
         case when query_term = 'HOUSEHOLD' then enrollment_count + 10 else enrollment_count end as enrollment_count,
         conditions, brief_summary,
         case when query_term = 'FURNITURE' then trim(lead_sponsor, ' ') || ' Group' else lead_sponsor end as lead_sponsor,
         '2024-01-02 00:00:00' as ingestion_ts, query_term, source
  from trial where last_update_date >= '1995-07-01'
)"""

RAW = f"with {_TRIAL}"
SILVER = f"with {_TRIAL}, {_clean('silver', 'trial', DAY_1)}"
BOTH_RAW = f"with {_TRIAL}, {_DAYS}"
BOTH = f"with {_TRIAL}, {_DAYS}, {_clean('old', 'day_1', DAY_1)}, {_clean('fresh', 'day_2', DAY_2)}"

COLUMNS = (
    "nct_id", "brief_title", "overall_status", "phase", "study_type", "enrollment_count",
    "conditions", "start_date", "completion_date", "last_update_date", "brief_summary",
    "lead_sponsor", "query_term", "is_recruiting", "is_completed", "is_interventional",
    "duration_days", "_record_hash", "created_on", "updated_on", "_update_count",
)
DATES = ("start_date", "completion_date", "last_update_date")


def _out(leave: tuple[str, ...] = (), prefix: str = "") -> str:
    return ", ".join(
        f"cast({prefix}{c} as varchar) as {c}" if c in DATES else f"{prefix}{c} as {c}"
        for c in COLUMNS
        if c not in leave
    )


_ACTION = """case when o.nct_id is null then 'inserted' when n.nct_id is null then 'target_only'
  when o._record_hash <> n._record_hash then 'updated' else 'unchanged' end"""
_PAIRS = "old o full outer join fresh n on o.nct_id = n.nct_id"

_ALWAYS_NEW = ("_record_hash", "updated_on")
_ALWAYS_OLD = ("nct_id", "created_on", "_update_count")
_WIDE = ("brief_title", "overall_status", "phase", "enrollment_count", "completion_date",
         "last_update_date", "is_recruiting", "is_completed", "duration_days")
_NARROW = ("overall_status", "enrollment_count", "completion_date", "last_update_date",
           "is_recruiting", "is_completed", "duration_days")


def _after(c: str, listed: tuple[str, ...] | None) -> str:
    if c == "_update_count":
        return "o._update_count + 1"
    fresh = c in _ALWAYS_NEW or (c not in _ALWAYS_OLD if listed is None else c in listed)
    return f"{'n' if fresh else 'o'}.{c}"


def merged_cte(listed: tuple[str, ...] | None = None) -> str:
    cols = ", ".join(
        f"case action when 'inserted' then n_{c} when 'updated' then u_{c} else o_{c} end as {c}"
        for c in COLUMNS
    )
    sources = ", ".join(
        f"o.{c} as o_{c}, n.{c} as n_{c}, {_after(c, listed)} as u_{c}" for c in COLUMNS
    )
    return f"paired as (select {_ACTION} as action, {sources} from {_PAIRS}), merged as (select action, {cols} from paired)"


def _merge(listed=None, leave=()):
    return f"{BOTH}, {merged_cte(listed)} select {_out(leave)} from merged"


_KNOWN = """('RECRUITING', 'COMPLETED', 'TERMINATED', 'SUSPENDED', 'WITHDRAWN', 'NOT_YET_RECRUITING',
  'ACTIVE_NOT_RECRUITING', 'ENROLLING_BY_INVITATION', 'UNKNOWN')"""
_RULES = (
    ("nct_id_not_null", True, "nct_id is not null"),
    ("nct_id_format_valid", True, "starts_with(nct_id, 'NCT')"),
    ("brief_title_not_null", True, "length(brief_title) > 5"),
    ("status_is_known", False, f"overall_status in {_KNOWN}"),
    ("enrollment_non_negative", False, "coalesce(enrollment_count, 0) >= 0"),
    ("completion_after_start", False, "coalesce(completion_date >= start_date, true)"),
)
_RULES_ALT = (
    ("nct_id_not_null", True, "nct_id is not null"),
    ("nct_id_format", True, "starts_with(nct_id, 'NCT')"),
    ("title_not_null", True, "brief_title is not null"),
    ("enrollment_positive", False, "coalesce(enrollment_count, 0) >= 0"),
    ("valid_status", False, f"overall_status in {_KNOWN}"),
)


def _report(rules, source: str = SILVER) -> str:
    parts = [
        f"""select '{name}' as rule, {str(critical).lower()} as is_critical,
            count(*) filter (where {cond}) as passing_rows, count(*) as total from silver"""
        for name, critical, cond in rules
    ]
    return f"""{source} select rule, passing_rows = total as passed, is_critical, passing_rows,
        total - passing_rows as failing_rows,
        coalesce(round(passing_rows / nullif(total, 0) * 100, 2), 0.0) as pass_rate
        from ({' union all '.join(parts)})"""


_DIRTY = f"""with {_TRIAL}, {_clean('kept', 'trial', DAY_1)}, numbered as (
  select *, cast(substr(nct_id, 4) as bigint) as n from kept),
silver as (
  select * exclude (n) replace (
    case when n % 17 = 0 then null when n % 19 = 0 then substr(nct_id, 4) else nct_id end as nct_id,
    case when n % 23 = 0 then 'short' when n % 29 = 0 then null else brief_title end as brief_title,
    case when n % 31 = 0 then start_date - 1 else completion_date end as completion_date) from numbered)"""

_BOARD = """select lead_sponsor, count(*) as total_trials,
  count(*) filter (where is_recruiting) as recruiting_trials,
  count(*) filter (where is_completed) as completed_trials,
  count(*) filter (where is_interventional) as interventional_trials,
  cast(sum(enrollment_count) as bigint) as total_enrollment,
  round(avg(enrollment_count), 0) as avg_enrollment_per_trial,
  round(count(*) filter (where is_completed) / count(*) * 100, 1) as completion_rate
  from silver where lead_sponsor is not null group by lead_sponsor"""

_STATUS = """select overall_status, phase, study_type, count(*) as trial_count,
  round(avg(enrollment_count), 0) as avg_enrollment,
  cast(sum(enrollment_count) as bigint) as total_enrollment,
  count(distinct lead_sponsor) as unique_sponsors,
  count(duration_days) as trials_with_duration,
  round(avg(duration_days), 0) as avg_duration_days
  from silver group by all"""

_YEARS = """select cast(year(start_date) as integer) as start_year, count(*) as trials_started,
  count(*) filter (where is_interventional) as interventional_trials,
  cast(sum(enrollment_count) as bigint) as total_enrollment,
  round(avg(enrollment_count), 0) as avg_enrollment
  from silver where year(start_date) between 1996 and 2000 group by 1"""

# The table after both deliveries.
_UP_TO_DATE = f"{BOTH}, {merged_cte()}, silver as (select * from merged)"

_CONDITIONS = """select condition, count(*) as trial_count,
  count(*) filter (where is_recruiting) as recruiting_now,
  cast(sum(enrollment_count) as bigint) as total_patients_enrolled,
  round(avg(enrollment_count), 0) as avg_enrollment
  from (select trim(unnest(string_split(conditions, ', ')), ' ') as condition, is_recruiting, enrollment_count
        from silver)
  where length(condition) > 2 group by condition"""


def _kpis(sponsors: str) -> str:
    return f"""select count(*) as total_trials,
      count(*) filter (where is_recruiting) as recruiting_now,
      count(*) filter (where is_completed) as completed_trials,
      cast(coalesce(sum(enrollment_count), 0) as bigint) as total_enrollment,
      {sponsors} as unique_sponsors,
      cast(trunc(coalesce(avg(duration_days), 0)) as bigint) as avg_duration,
      round(count(*) filter (where is_recruiting) / count(*) * 100, 1) as recruitment_rate,
      round(count(*) filter (where is_completed) / count(*) * 100, 1) as completion_rate
      from silver"""


def _hit(keyword: str, columns: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"coalesce(contains(lower({c}), '{keyword}'), false)" for c in columns) + ")"


_TEXTS = ("brief_title", "conditions", "brief_summary")
_CARD = """nct_id, substr(brief_title, 1, 80) as title, overall_status as status,
  coalesce(phase, 'N/A') as phase, coalesce(enrollment_count, 0) as enrollment,
  lead_sponsor as sponsor, coalesce(cast(start_date as varchar), 'N/A') as start,
  substr(coalesce(conditions, ''), 1, 100) as conditions,
  case when length(brief_summary) > 0 then substr(brief_summary, 1, 300) || '...' end as summary,
  'https://clinicaltrials.gov/study/' || nct_id as link"""

_FALLBACK_PART = """select '{name}' as question, nct_id, brief_title from (
  select nct_id, brief_title from silver
  where {hit} or not exists (select 1 from silver where {hit})
  order by nct_id limit 8)"""

ORACLE: dict[str, str] = {
    "silver_normalise": f"{SILVER} select {_out()} from silver",
    "record_fingerprint": f"""{SILVER} select nct_id, _record_hash as hash_5,
        md5(concat_ws('|', nct_id, overall_status, cast(enrollment_count as varchar),
            cast(completion_date as varchar))) as hash_4,
        md5(nct_id || '|' || coalesce(overall_status, '') || '|' ||
            coalesce(cast(enrollment_count as varchar), '') || '|' ||
            coalesce(cast(completion_date as varchar), '') || '|' || coalesce(lead_sponsor, '')) as hash_5_null_kept
        from silver""",
    "stream_columns": f"""with {_TRIAL}, {_clean('silver', 'trial', DAY_1, ', source, ingestion_ts')}
        select {_out(('created_on', 'updated_on', '_update_count', '_record_hash'))},
        source, ingestion_ts,
        md5(concat_ws('|', nct_id, overall_status, cast(enrollment_count as varchar),
            cast(completion_date as varchar))) as _record_hash,
        '{DAY_2} 00:00:00' as _silver_ts from silver""",
    "unparsed_values": f"""{RAW} select 0 as enrollment_count,
        count(*) filter (where trim(start_date) <> '' and {_date('start_date')} is null) as start_date,
        count(*) filter (where trim(completion_date) <> '' and {_date('completion_date')} is null) as completion_date,
        count(*) filter (where trim(last_update_date) <> '' and {_date('last_update_date')} is null) as last_update_date
        from trial""",
    "value_profile": f"""{RAW}
        select 'overall_status' as column_name, overall_status as value, count(*) as row_count from trial group by 2
        union all select 'phase', phase, count(*) from trial group by 2
        union all select 'lead_sponsor', lead_sponsor, count(*) from trial where lead_sponsor is not null group by 2""",
    "status_summary": f"{SILVER} {_STATUS}",
    "status_summary_plain": f"""{SILVER} select overall_status, phase, study_type, count(*) as trial_count,
        avg(enrollment_count) as avg_enrollment, cast(sum(enrollment_count) as bigint) as total_enrollment,
        count(distinct lead_sponsor) as unique_sponsors from silver group by all""",
    "status_rollup": f"""{SILVER} select overall_status, cast(sum(trial_count) as bigint) as total
        from ({_STATUS}) group by overall_status""",
    "sponsor_leaderboard": f"{SILVER} {_BOARD}",
    "sponsor_leaderboard_plain": f"""{SILVER} select lead_sponsor, count(*) as total_trials,
        count(*) filter (where is_recruiting) as active_trials,
        count(*) filter (where is_completed) as completed_trials,
        cast(sum(enrollment_count) as bigint) as total_enrollment
        from silver where lead_sponsor is not null group by lead_sponsor""",
    "active_sponsors": f"""{SILVER} select lead_sponsor, count(*) as total_trials,
        count(*) filter (where is_recruiting) as active_trials
        from silver where lead_sponsor is not null group by lead_sponsor
        order by total_trials desc, lead_sponsor limit 10""",
    "condition_analytics": f"{SILVER} {_CONDITIONS}",
    "yearly_trend": f"{SILVER} {_YEARS}",
    "profile_by_sketches": f"""{BOTH}, every as (select overall_status, lead_sponsor, enrollment_count from old
          union all select overall_status, lead_sponsor, enrollment_count from fresh)
        select 'overall_status' as column_name, count(*) as row_count, count(*) filter (where overall_status is null) as nulls,
          true as distinct_close, cast(null as boolean) as median_close, true as top_exact from every
        union all select 'lead_sponsor', count(*), count(*) filter (where lead_sponsor is null), true, null, null from every
        union all select 'enrollment_count', count(*), count(*) filter (where enrollment_count is null), true, true, null from every""",
    "incremental_status": f"{_UP_TO_DATE} {_STATUS}",
    "incremental_leaderboard": f"{_UP_TO_DATE} {_BOARD}",
    "incremental_conditions": f"{_UP_TO_DATE} {_CONDITIONS}",
    "incremental_yearly": f"{_UP_TO_DATE} {_YEARS}",
    "incremental_kpis": f"{_UP_TO_DATE} {_kpis('count(distinct lead_sponsor)')}",
    "chart_sponsors": f"""{SILVER} select lead_sponsor, total_trials, recruiting_trials, completion_rate
        from ({_BOARD}) order by total_trials desc, lead_sponsor limit 10""",
    "chart_conditions": f"""{SILVER} select condition, trial_count, recruiting_now
        from ({_CONDITIONS}) order by trial_count desc, condition limit 15""",
    "platform_kpis": f"{SILVER} {_kpis('count(distinct lead_sponsor)')}",
    "platform_kpis_null_sponsor": f"""{SILVER} {_kpis("count(distinct coalesce(lead_sponsor, '<none>'))")}""",
    "dashboard_kpis": f"""{SILVER} select total_trials, recruiting_now, recruitment_rate, completed_trials,
        completion_rate, unique_sponsors, total_enrollment from ({_kpis('count(distinct lead_sponsor)')})""",
    "distributions": f"""{SILVER}
        select * from (select 'status' as chart, overall_status as label, count(*) as row_count from silver
          where overall_status is not null group by 2 order by 3 desc, 2 limit 8)
        union all select * from (select 'sponsor', lead_sponsor, count(*) from silver
          where lead_sponsor is not null group by 2 order by 3 desc, 2 limit 10)
        union all select * from (select 'phase', coalesce(nullif(trim(phase), ''), 'Unknown'), count(*)
          from silver group by 2)""",
    "silver_counts": f"""{BOTH}, {merged_cte()} select count(*) as total_trials,
        count(*) filter (where is_recruiting) as recruiting, count(*) filter (where is_completed) as completed,
        count(*) filter (where is_interventional) as interventional,
        count(*) filter (where _update_count > 0) as updated from merged""",
    "rule_report": _report(_RULES),
    "rule_report_alt": _report(_RULES_ALT),
    "rule_report_dirty": _report(_RULES, _DIRTY),
    "expect_drop_dirty": f"""{_DIRTY} select nct_id, brief_title, overall_status from silver
        where starts_with(nct_id, 'NCT') and length(brief_title) > 5""",
    "quarantine": f"""{SILVER} select nct_id, concat_ws(',',
        {', '.join(f"case when coalesce({c}, false) then null else '{n}' end" for n, _, c in _RULES)}) as failed_rules
        from silver""",
    "expect_drop": f"""{SILVER} select nct_id, overall_status, enrollment_count from silver
        where starts_with(nct_id, 'NCT') and length(brief_title) > 5 and overall_status in {_KNOWN}""",
    "raw_validation": f"""{RAW} select count(*) as total_rows, cast(15 as bigint) as column_count,
        count(*) filter (where phase is null) as null_keys,
        count(*) filter (where phase in ('PHASE2', 'PHASE3', 'PHASE2, PHASE3')) as malformed_keys from trial""",
    "duplicate_count": f"""{BOTH_RAW} select count(*) - count(distinct nct_id) as duplicates
        from (select nct_id from day_1 union all select nct_id from day_2)""",
    "dedupe_latest": f"""with {_TRIAL}, {_DAYS},
        both_days as (select * from day_1 union all by name select * from day_2),
        {_clean('silver', 'both_days', DAY_2, ', ingestion_ts')}
        select {_out()}, ingestion_ts from silver
        qualify row_number() over (partition by nct_id order by ingestion_ts desc, last_update_date desc nulls last,
          _record_hash desc) = 1""",
    "cdc_merge": _merge(),
    "cdc_merge_wide": _merge(_WIDE),
    "cdc_merge_narrow": _merge(_NARROW),
    "cdc_change_feed": f"""{BOTH}, {merged_cte()}
        select {_out()},
          case action when 'inserted' then 'insert' else 'update_postimage' end as _change_type
        from merged where action in ('inserted', 'updated')
        union all
        select {_out((), 'o.')}, 'update_preimage' from {_PAIRS}
        where o._record_hash <> n._record_hash""",
    "cdc_merge_late": f"""with {_TRIAL}, {_DAYS}, {_clean('silver', 'day_1', DAY_1)}
        select {_out()}, '2024-01-03 00:00:00' as ingestion_ts from silver""",
    "cdc_stats": f"{BOTH} select {_ACTION} as action, count(*) as row_count from {_PAIRS} group by 1",
    "updated_rows": f"""{BOTH} select count(*) as updated_records from old o join fresh n on o.nct_id = n.nct_id
        where o._record_hash <> n._record_hash""",
    "facet_search": f"""{SILVER} select nct_id, brief_title, overall_status, phase, conditions from silver
        where overall_status = 'RECRUITING' and phase in ('PHASE2', 'PHASE3')
        and {_hit('widget', ('brief_title', 'conditions'))}""",
    "keyword_search": f"{SILVER} select nct_id, conditions from silver where {_hit('red widget', _TEXTS)}",
    "keyword_regex": f"""{SILVER} select nct_id, conditions from silver
        where {' or '.join(f"coalesce(regexp_matches({c}, '(red|blue) (widget|ring)', 'i'), false)" for c in _TEXTS)}""",
    "keyword_index": f"{SILVER} select nct_id, conditions from silver where {_hit('red widget', _TEXTS)}",
    "keyword_index_regex": f"""{SILVER} select nct_id, conditions from silver
        where {' or '.join(f"coalesce(regexp_matches({c}, '(red|blue) (widget|ring)', 'i'), false)" for c in _TEXTS)}""",
    "term_counts": f"""{SILVER}, terms as (
          select lower(p_name) as term from part union select lower(unnest(string_split(p_name, ' '))) from part
          union select lower(n_name) from nation union select lower(r_name) from region),
        texts as (select nct_id, lower(brief_title) as text from silver union all select nct_id, lower(conditions) from silver
          union all select nct_id, lower(brief_summary) from silver)
        select nct_id, term, cast(sum((length(text) - length(replace(text, term, ''))) / length(term)) as bigint) as occurrences
        from texts, terms where contains(text, term) group by 1, 2""",
    "condition_labels": """select label, count(*) as trial_count from (
          select distinct l_orderkey, p_name || ', type ' || (p_partkey % 3) as label
          from lineitem join part on l_partkey = p_partkey) group by 1""",
    "summary_preview": f"{SILVER} select nct_id, substr(coalesce(brief_summary, ''), 1, 300) as summary from silver",
    "keyword_fallback": f"""{SILVER} {' union all '.join(
        _FALLBACK_PART.format(name=n, hit=_hit(k, _TEXTS))
        for n, k in (('hit', 'red widget'), ('miss', 'no such words anywhere')))}""",
    "any_keyword": f"""{SILVER} select nct_id, brief_title, overall_status from silver
        where {_hit('the', ('brief_summary',))} or {_hit('license', ('brief_summary',))}""",
    "facet_values": f"{SILVER} select distinct overall_status from silver where overall_status is not null",
    "display_cards": f"{SILVER} select {_CARD} from silver",
    "listing_page": f"""{SILVER} select {_CARD} from (select * from silver
        where overall_status = 'RECRUITING' and {_hit('gear', ('brief_title', 'conditions'))}
        order by nct_id limit 20)""",
}
