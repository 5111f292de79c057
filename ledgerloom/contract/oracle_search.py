"""Independent SQL for landing, stream, vector and context queries."""

from __future__ import annotations

from ledgerloom.contract.oracle import (
    _CONDITIONS,
    BOTH,
    BOTH_RAW,
    DAY_1,
    RAW,
    SILVER,
    _hit,
    _out,
    merged_cte,
)

_FLAT = """nct_id, brief_title, overall_status, phase, start_date, completion_date, last_update_date,
  study_type, enrollment_count, conditions, brief_summary, lead_sponsor"""

# The newest delivery wins in the merged table; a stream has the same columns.
_MERGED = f"{BOTH}, {merged_cte()} select {_out()} from merged"


def _counts(source: str, key: str, text: str) -> str:
    """CTE of (key, bucket, n): word hash buckets of a text."""
    return f"""
words as (
  select {key}, unnest(regexp_split_to_array(lower({text}), '[^a-z]+')) as word from {source}
),
counts as (
  select {key}, cast('0x' || substr(md5(word), 1, 8) as bigint) % 64 as bucket, cast(count(*) as double) as n
  from words where word <> '' group by 1, 2
),
weights as (
  select {key}, bucket, cast(n / sqrt(sum(n * n) over (partition by {key})) as float) as weight from counts
)"""


_DOCUMENT = """coalesce(brief_title, '') || ' | ' || coalesce(conditions, '') || ' | ' || coalesce(phase, '')
  || ' | ' || coalesce(overall_status, '') || ' | ' || brief_summary"""
_CORPUS = f"corpus as (select *, {_DOCUMENT} as document from silver where brief_summary is not null)"


def _vectors(name: str, source: str, key: str, text: str) -> str:
    """CTEs ending in ``name``(key, v): 64 weights per text, zeros included."""
    return f"""
{name}_words as (
  select {key}, unnest(regexp_split_to_array(lower({text}), '[^a-z]+')) as word from {source}
),
{name}_n as (
  select {key}, cast('0x' || substr(md5(word), 1, 8) as bigint) % 64 as bucket, cast(count(*) as double) as n
  from {name}_words where word <> '' group by 1, 2
),
{name}_w as (
  select {key}, bucket, cast(cast(n / sqrt(sum(n * n) over (partition by {key})) as float) as double) as w from {name}_n
),
{name} as (
  select s.{key}, list(coalesce(w, 0.0) order by b.bucket) as v
  from {source} s cross join (select unnest(range(64)) as bucket) b
  left join {name}_w on {name}_w.{key} = s.{key} and {name}_w.bucket = b.bucket group by 1
)"""


def _hits(k: int) -> str:
    """CTE hits(query_id, nct_id, cosine, rank) of every user turn."""
    return f"""
questions as (
  select cast(conv_id as varchar) || '-' || cast(turn as varchar) as query_id, text as question
  from conversations where role = 'user'
),
{_CORPUS},
{_vectors('item', 'corpus', 'nct_id', 'document')},
{_vectors('asked', 'questions', 'query_id', 'question')},
scored as (
  select query_id, nct_id, round(coalesce(list_dot_product(asked.v, item.v) /
      nullif(sqrt(list_dot_product(asked.v, asked.v)) * sqrt(list_dot_product(item.v, item.v)), 0), 0), 10) + 0.0 as cosine
  from asked cross join item
),
hits as (
  select *, row_number() over (partition by query_id order by cosine desc, nct_id) as rank
  from scored qualify rank <= {k}
),
records as (
  select query_id, cast(rank as integer) as rank, nct_id, substr(coalesce(brief_title, ''), 1, 200) as brief_title,
    coalesce(overall_status, '') as overall_status, coalesce(phase, '') as phase,
    substr(coalesce(conditions, ''), 1, 200) as conditions, substr(coalesce(lead_sponsor, ''), 1, 100) as lead_sponsor,
    cast(coalesce(enrollment_count, 0) as integer) as enrollment_count, coalesce(is_recruiting, false) as is_recruiting,
    round(cosine * 100, 1) + 0.0 as similarity, cosine * 100 as similarity_raw, substr(document, 1, 500) as document
  from hits join corpus using (nct_id)
)"""


def _asked(k: int) -> str:
    return f"{SILVER}, {_hits(k)}"


_FULL_ENTRY = """chr(10) || 'TRIAL ' || rank || ' (Relevance: ' || similarity || '%)' || chr(10) ||
  'NCT ID     : ' || nct_id || chr(10) || 'Title      : ' || brief_title || chr(10) ||
  'Status     : ' || overall_status || chr(10) ||
  'Recruiting : ' || case when is_recruiting then 'YES - Currently Recruiting' else 'No' end || chr(10) ||
  'Phase      : ' || phase || chr(10) || 'Conditions : ' || conditions || chr(10) ||
  'Sponsor    : ' || lead_sponsor || chr(10) ||
  'Enrollment : ' || format('{:,}', enrollment_count) || ' patients' || chr(10) ||
  'Summary    : ' || substr(document, 1, 400) || chr(10)"""
_TRACKED_ENTRY = """'TRIAL ' || rank || ' (' || similarity || '% match)' || chr(10) || 'NCT ID: ' || nct_id || chr(10) ||
  'Title: ' || brief_title || chr(10) || 'Status: ' || overall_status || chr(10) || 'Phase: ' || phase || chr(10) ||
  'Enrollment: ' || format('{:,}', enrollment_count) || chr(10) || 'Sponsor: ' || lead_sponsor || chr(10)"""
_MATCH_ENTRY = """'NCT ID: ' || nct_id || chr(10) || 'Title: ' || brief_title || chr(10) ||
  'Status: ' || overall_status || ' | Phase: ' || phase || chr(10) ||
  'Enrollment: ' || format('{:,}', enrollment_count) || ' | Sponsor: ' || lead_sponsor || chr(10) ||
  'Match: ' || similarity || '%'"""
_JOINER = "chr(10) || '---' || chr(10)"


def _context(entry: str) -> str:
    return f"""select query_id, array_to_string(list({entry} order by rank), {_JOINER}) as context
      from records group by query_id"""


_METRICS = """select query_id, round(max(similarity_raw), 2) + 0.0 as top1_similarity,
  round(avg(similarity_raw), 2) + 0.0 as avg_similarity, round(min(similarity_raw), 2) + 0.0 as min_similarity,
  count(*) filter (where is_recruiting) as recruiting_trials_found, count(*) as trials_retrieved
  from records group by query_id"""

_CENTROIDS = """
cells as (select label, unnest(range(len(embedding))) as place, unnest(embedding) as value from embeddings),
means as (select label, place, round(avg(cast(value as double)), 6) as mean from cells group by 1, 2),
centroids as (select label as query_id, list(mean order by place) as v from means group by label),
items as (select vec_id as id, label, cast(embedding as double[]) as v from embeddings),
label_hits as (
  select query_id, id, label, round(list_dot_product(c.v, i.v) /
      (sqrt(list_dot_product(c.v, c.v)) * sqrt(list_dot_product(i.v, i.v))), 10) + 0.0 as cosine,
    cast(row_number() over (partition by query_id order by round(list_dot_product(c.v, i.v) /
      (sqrt(list_dot_product(c.v, c.v)) * sqrt(list_dot_product(i.v, i.v))), 10) desc, id) as integer) as rank
  from centroids c cross join items i qualify rank <= 10
)"""

_EXPECTED = """marked as (
  select cast(substr(nct_id, 4) as bigint) % 11 <> 0 as has_id, cast(substr(nct_id, 4) as bigint) % 13 <> 0 as has_title,
    coalesce(enrollment_count >= 0, true) as positive from landed)
select 'valid_nct_id' as rule, count(*) filter (where not has_id) as row_count from marked
union all select 'has_title', count(*) filter (where not has_title) from marked
union all select 'positive_enrollment', count(*) filter (where not positive) from marked
union all select 'kept', count(*) from marked where has_id and has_title
union all select 'set_aside', count(*) from marked where not (has_id and has_title)"""

_FIFTIETHS = """
items as (select vec_id as id, cast(embedding as double[]) as v from embeddings),
scored as (
  select q.id as query_id, i.id, round(list_dot_product(q.v, i.v) /
      (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(i.v, i.v))), 10) + 0.0 as cosine
  from items q cross join items i where q.id % 50 = 0
)"""

ORACLE: dict[str, str] = {
    "vector_top_k_pivots": f"""with {_FIFTIETHS} select query_id, id, round(cosine * 100, 1) + 0.0 as similarity,
        cast(row_number() over (partition by query_id order by cosine desc, id) as integer) as rank
        from scored qualify rank <= 10""",
    "vector_recall_ivf": """select count(*) filter (where vec_id % 50 = 0) as queries, true as recall_reached,
        count(embedding) as coded from embeddings""",
    "page_flatten": f"""{RAW} select {_FLAT}, 'orders' as query_term, ingestion_ts, source, nct_id as raw_id
        from trial""",
    "page_terms": f"""{RAW} select query_term, count(*) as row_count, count(conditions) as with_conditions,
        cast(sum(enrollment_count) as bigint) as total_enrollment from trial group by query_term""",
    "condition_arrays": f"{SILVER} {_CONDITIONS}",
    "bronze_append": f"""{BOTH_RAW}, both_days as (select * from day_1 union all by name select * from day_2),
        labelled as (select substr(ingestion_ts, 1, 10) as ingestion_date, * exclude (ingestion_ts) from both_days
          union all by name select 'later' as ingestion_date, * exclude (ingestion_ts) from day_2)
        select ingestion_date, count(*) as row_count, cast(sum(enrollment_count) as bigint) as total_enrollment,
          count(*) as with_raw, cast(sum(length(brief_summary)) as bigint) as summary_chars,
          cast(sum(length(brief_summary)) as bigint) as raw_summary_chars,
          cast(sum(length(conditions)) as bigint) as raw_condition_chars from labelled group by 1""",
    "silver_load": _MERGED,
    "gold_refresh": f"""{BOTH}, {merged_cte()}
        select 'trial_status_summary' as table_name, count(*) as row_count
          from (select distinct overall_status, phase, study_type from merged)
        union all select 'sponsor_leaderboard', count(distinct lead_sponsor) from merged
        union all select 'condition_analytics', count(distinct c)
          from (select trim(unnest(string_split(conditions, ', '))) as c from merged) where length(c) > 2
        union all select 'yearly_trend', count(distinct year(start_date)) from merged
          where year(start_date) between 2000 and 2025""",
    "stream_silver": f"""{SILVER} select {_out(('created_on', 'updated_on', '_update_count', '_record_hash'))}, 'tables' as source,
        '{DAY_1} 00:00:00' as ingestion_ts,
        md5(concat_ws('|', nct_id, overall_status, cast(enrollment_count as varchar),
            cast(completion_date as varchar))) as _record_hash
        from silver where starts_with(nct_id, 'NCT') and length(brief_title) > 5""",
    "stream_gold": f"""{SILVER} select overall_status, phase, study_type, count(*) as trial_count,
        avg(enrollment_count) as avg_enrollment, cast(sum(enrollment_count) as bigint) as total_enrollment,
        count(distinct lead_sponsor) as unique_sponsors from silver group by all""",
    "stream_cdc": _MERGED,
    "stream_cdc_existing": _MERGED,
    "stream_latest": f"""{BOTH} select coalesce(f.nct_id, o.nct_id) as nct_id,
        case when f.nct_id is null then o._record_hash else f._record_hash end as _record_hash,
        f.nct_id is not null and o.nct_id is not null as had_late,
        cast(length(case when f.nct_id is null then o.brief_summary else f.brief_summary end) as integer) as summary_chars
        from fresh f full outer join old o on f.nct_id = o.nct_id""",
    "stream_expectation_counts": f"{RAW}, landed as (select * from trial), {_EXPECTED}",
    "stream_restart_counts": f"{BOTH_RAW}, landed as (select * from day_1 union all select * from day_2), {_EXPECTED}",
    "stream_type_widening": f"""{BOTH_RAW}, landed as (
          select query_term, enrollment_count, brief_summary, false as late from day_1
          union all select query_term, enrollment_count, brief_summary, true from day_2)
        select query_term, count(*) as row_count,
          cast(sum(enrollment_count) filter (where not (late and query_term = 'BUILDING')) as bigint) as total_enrollment,
          count(enrollment_count) filter (where late and query_term = 'BUILDING') as rescued,
          count(*) filter (where late) as with_study_type, cast(sum(length(brief_summary)) as bigint) as summary_chars
        from landed group by 1""",
    "named_tables": f"""{RAW} select true as found, false as found_missing, 3 as previewed, count(*) as row_count,
        cast(sum(length(brief_summary)) as bigint) as summary_chars from trial""",
    "page_quarantine": f"""{RAW}, pages as (
          select query_term, floor(cast(substr(nct_id, 4) as bigint) / 1000) as page, count(*) as studies from trial group by all)
        select query_term, cast(coalesce(sum(studies) filter (where page % 3 <> 0), 0) as bigint) as studies_read,
          count(*) filter (where page % 3 = 0) as broken_pages from pages group by 1""",
    "stream_schema_widening": f"""{BOTH_RAW} select * from (
        select cast(null as varchar) as registry_note, count(*) as row_count,
          cast(sum(enrollment_count) as bigint) as total_enrollment, count(*) as with_source_file,
          cast(sum(length(conditions)) as bigint) as condition_chars, cast(sum(length(brief_summary)) as bigint) as summary_chars from day_1
        union all select upper(study_type), count(*), cast(sum(enrollment_count) as bigint), count(*),
          cast(sum(length(conditions)) as bigint), cast(sum(length(brief_summary)) as bigint)
          from day_2 group by 1)""",
    "search_texts": f"""{SILVER}, {_CORPUS} select nct_id,
        coalesce(brief_title, '') || ' | ' || coalesce(conditions, '') || ' | ' || coalesce(phase, '') || ' | ' ||
          coalesce(overall_status, '') || ' | ' || substr(brief_summary, 1, 500) as long_text,
        coalesce(brief_title, '') || ' | ' || coalesce(conditions, '') || ' | ' || substr(brief_summary, 1, 400) as short_text,
        cast(length(document) as integer) as whole_chars from corpus""",
    "embed_text": f"""with {_counts('documents', 'doc_id', 'text')}
        select doc_id, cast(bucket as integer) as bucket, round(cast(weight as double), 6) as weight from weights""",
    "vector_items": f"""{SILVER}, {_CORPUS} select nct_id as id, nct_id,
        substr(coalesce(brief_title, ''), 1, 200) as brief_title, coalesce(overall_status, '') as overall_status,
        coalesce(phase, '') as phase, substr(coalesce(conditions, ''), 1, 200) as conditions,
        substr(coalesce(lead_sponsor, ''), 1, 100) as lead_sponsor,
        cast(coalesce(enrollment_count, 0) as integer) as enrollment_count,
        coalesce(is_recruiting, false) as is_recruiting, cast(length(document) as integer) as chars from corpus""",
    "collection_info": """select count(*) as collection_size, cast(min(len(embedding)) as integer) as min_dims,
        cast(max(len(embedding)) as integer) as max_dims from embeddings""",
    "vector_top_k": f"""with {_CENTROIDS} select query_id, id, rank, round(cosine * 100, 1) + 0.0 as similarity
        from label_hits""",
    "label_precision": f"""with {_CENTROIDS} select query_id,
        round(avg(case when label = query_id then 1.0 else 0.0 end), 4) as precision, count(*) as hits
        from label_hits group by query_id""",
    "retrieved_records": f"{_asked(10)} select * exclude (similarity_raw) from records",
    "keyword_vs_semantic": f"""{SILVER}, {_CORPUS}, {_vectors('item', 'corpus', 'nct_id', 'document')},
        questions as (select 1 as query_id, max(p_name) as question from part),
        {_vectors('asked', 'questions', 'query_id', 'question')},
        semantic as (select nct_id, row_number() over (order by round(list_dot_product(asked.v, item.v) /
            (sqrt(list_dot_product(asked.v, asked.v)) * sqrt(list_dot_product(item.v, item.v))), 10) desc, nct_id) as rank
          from asked cross join item qualify rank <= 10),
        keyword as (select nct_id from corpus
          where {_hit('widget', ('conditions',))} or {_hit('ring', ('conditions',))} order by nct_id limit 10)
        select coalesce(k.nct_id, s.nct_id) as nct_id,
          case when k.nct_id is null then 'semantic_only' when s.nct_id is null then 'keyword_only' else 'both' end as found_by,
          cast(s.rank as integer) as semantic_rank
        from keyword k full outer join semantic s on k.nct_id = s.nct_id""",
    "rag_context": f"{_asked(10)} {_context(_FULL_ENTRY)}",
    "rag_context_tracked": f"{_asked(10)} {_context(_TRACKED_ENTRY)}",
    "rag_prompt": f"""{_asked(8)} select q.query_id, 'Question: ' || question || chr(10) || chr(10) ||
        'Relevant trials:' || chr(10) || coalesce(context, '') as prompt
        from questions q left join ({_context(_MATCH_ENTRY)}) c on q.query_id = c.query_id""",
    "ask_prompts": f"""{_asked(10)}, full_context as ({_context(_FULL_ENTRY)}), tracked_context as ({_context(_TRACKED_ENTRY)})
        select 'full' as form, q.query_id,
          'Please answer this clinical research question using the trial data below.' || chr(10) || chr(10) ||
          'QUESTION: ' || question || chr(10) || chr(10) ||
          'RELEVANT TRIALS FROM OUR DATABASE:' || chr(10) || coalesce(context, '') || chr(10) || chr(10) ||
          'Please provide a clear, cited answer.' as prompt
          from questions q left join full_context c on q.query_id = c.query_id
        union all select 'tracked', q.query_id, 'Question: ' || question || chr(10) || chr(10) || 'Trials:' || chr(10) || coalesce(context, '')
          from questions q left join tracked_context c on q.query_id = c.query_id""",
    "corpus_with_long_summaries": f"""{SILVER} select nct_id, coalesce(brief_title, '') || ' | ' || coalesce(conditions, '') || ' | ' ||
        substr(brief_summary, 1, 400) as document from silver where length(brief_summary) > 10""",
    "keyword_context": f"""{SILVER} select 1 as query_id, array_to_string(list(
        'NCT ID: ' || nct_id || chr(10) || 'Title: ' || brief_title || chr(10) ||
        'Status: ' || overall_status || ' | Phase: ' || coalesce(phase, '') || chr(10) ||
        'Enrollment: ' || format('{{:,}}', coalesce(enrollment_count, 0)) || ' | Sponsor: ' || coalesce(lead_sponsor, '') || chr(10) ||
        'Summary: ' || substr(coalesce(brief_summary, ''), 1, 300) order by nct_id), {_JOINER}) as context
        from (select * from silver where {_hit('red widget', ('brief_title', 'conditions', 'brief_summary'))}
          order by nct_id limit 8)""",
    "retrieval_metrics": f"{_asked(10)} {_METRICS}",
    "retrieval_tags": f"""{_asked(10)} select query_id, substr(any_value(question), 1, 100) as query,
        bool_or(is_recruiting) as recruiting_found, max(similarity_raw) > 60 as high_confidence
        from records join questions using (query_id) group by query_id""",
    "retrieval_eval": f"""{_asked(5)} select count(*) as queries_tested, round(avg(top1), 1) as avg_top1_similarity,
        round(avg(recruiting), 1) as avg_recruiting_found from (select query_id, max(similarity) as top1,
        count(*) filter (where is_recruiting) as recruiting from records group by query_id)""",
    "run_comparison": f"""{_asked(10)}, metrics as ({_METRICS})
        select query_id, substr(question, 1, 44) as query, top1_similarity, avg_similarity,
          cast(recruiting_trials_found as double) as recruiting_trials_found from metrics join questions using (query_id)
        union all select null, 'Averages', round(avg(top1_similarity), 1), round(avg(avg_similarity), 1),
          round(avg(recruiting_trials_found), 1) from metrics""",
    "run_log": f"""{_asked(10)}, metrics as ({_METRICS})
        select 'user-turns' as run_name, query_id, question, 'hashed-words-64' as encoder, 10 as top_k,
          cast(length(question) as integer) as question_length, (select count(*) from corpus) as collection_size,
          top1_similarity, avg_similarity, min_similarity, recruiting_trials_found, trials_retrieved,
          recruiting_trials_found > 0 as recruiting_found,
          (select max(similarity_raw) from records r where r.query_id = metrics.query_id) > 60 as high_confidence
        from metrics join questions using (query_id)""",
    "citation_check": f"""{_asked(10)} select query_id, 3 as cited, 2 as supported, round(2 / 3, 4) as supported_share
        from records group by query_id""",
    "incremental_reembed": f"""{BOTH}, {merged_cte()}, silver as (select * from merged), {_CORPUS}, {_counts('corpus', 'nct_id', 'document')}
        select nct_id as id, count(*) as places, 
          cast(sum(cast(round(round(cast(weight as double), 6) * 1000000) as bigint)) as bigint) as weight_millionths
        from weights group by 1""",
}
