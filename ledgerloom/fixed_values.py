"""Names, lists and text formats that results depend on.

Everything here is a value a user of the toolkit expects to find unchanged in
the output. Nothing in this module computes anything.
"""

# Statuses the registry is known to send.
KNOWN_STATUSES = (
    "RECRUITING",
    "COMPLETED",
    "TERMINATED",
    "SUSPENDED",
    "WITHDRAWN",
    "NOT_YET_RECRUITING",
    "ACTIVE_NOT_RECRUITING",
    "ENROLLING_BY_INVITATION",
    "UNKNOWN",
)

# Search terms an ingest run covers when none are named.
QUERY_TERMS = (
    "cardiovascular",
    "heart failure",
    "coronary artery disease",
    "atrial fibrillation",
    "hypertension",
)

# Identifier format and the public page of one registry record.
ID_PREFIX = "NCT"
ID_PATTERN = r"NCT\d{8}"
STUDY_PAGE = "https://clinicaltrials.gov/study/"

# Tag of the registry interface the records came from.
SOURCE_TAG = "clinicaltrials_gov_v2"

# Raw record, in column order; every field is text except the count.
RAW_COLUMNS = (
    "nct_id",
    "brief_title",
    "overall_status",
    "phase",
    "start_date",
    "completion_date",
    "last_update_date",
    "study_type",
    "enrollment_count",
    "conditions",
    "brief_summary",
    "lead_sponsor",
    "raw_json",
    "ingestion_ts",
    "query_term",
    "source",
)

# Clean record (batch), in column order.
SILVER_COLUMNS = (
    "nct_id",
    "brief_title",
    "overall_status",
    "phase",
    "study_type",
    "enrollment_count",
    "conditions",
    "start_date",
    "completion_date",
    "last_update_date",
    "brief_summary",
    "lead_sponsor",
    "query_term",
    "is_recruiting",
    "is_completed",
    "is_interventional",
    "duration_days",
    "_record_hash",
    "_silver_created_at",
    "_silver_updated_at",
    "_update_count",
)

# Clean record (stream), in column order.
STREAM_SILVER_COLUMNS = (
    "nct_id",
    "brief_title",
    "overall_status",
    "phase",
    "study_type",
    "enrollment_count",
    "conditions",
    "start_date",
    "completion_date",
    "last_update_date",
    "brief_summary",
    "lead_sponsor",
    "query_term",
    "source",
    "ingestion_ts",
    "is_recruiting",
    "is_completed",
    "is_interventional",
    "duration_days",
    "_record_hash",
    "_silver_ts",
)

# Fields whose change makes a new version of a record.
HASH_COLUMNS = (
    "nct_id",
    "overall_status",
    "enrollment_count",
    "completion_date",
    "lead_sponsor",
)
STREAM_HASH_COLUMNS = HASH_COLUMNS[:4]

# Columns a merge may overwrite, besides the audit columns.
WIDE_UPDATE_COLUMNS = (
    "brief_title",
    "overall_status",
    "phase",
    "enrollment_count",
    "completion_date",
    "last_update_date",
    "is_recruiting",
    "is_completed",
    "duration_days",
)
NARROW_UPDATE_COLUMNS = (
    "overall_status",
    "enrollment_count",
    "completion_date",
    "last_update_date",
    "is_recruiting",
    "is_completed",
    "duration_days",
)

# Context layouts. Placeholders name columns of the hit record.
CONTEXT_SEPARATOR = "\n---\n"

FULL_LAYOUT = (
    "\nTRIAL {rank} (Relevance: {similarity}%)\n"
    "NCT ID     : {nct_id}\n"
    "Title      : {brief_title}\n"
    "Status     : {overall_status}\n"
    "Recruiting : {recruiting_label}\n"
    "Phase      : {phase}\n"
    "Conditions : {conditions}\n"
    "Sponsor    : {lead_sponsor}\n"
    "Enrollment : {enrollment_text} patients\n"
    "Summary    : {document_text}\n"
)

TRACKED_LAYOUT = (
    "TRIAL {rank} ({similarity}% match)\n"
    "NCT ID: {nct_id}\n"
    "Title: {brief_title}\n"
    "Status: {overall_status}\n"
    "Phase: {phase}\n"
    "Enrollment: {enrollment_text}\n"
    "Sponsor: {lead_sponsor}\n"
)

MATCH_LAYOUT = (
    "NCT ID: {nct_id}\n"
    "Title: {brief_title}\n"
    "Status: {overall_status} | Phase: {phase}\n"
    "Enrollment: {enrollment_text} | Sponsor: {lead_sponsor}\n"
    "Match: {similarity}%"
)

SUMMARY_LAYOUT = (
    "NCT ID: {nct_id}\n"
    "Title: {brief_title}\n"
    "Status: {overall_status} | Phase: {phase}\n"
    "Enrollment: {enrollment_text} | Sponsor: {lead_sponsor}\n"
    "Summary: {summary_text}"
)

RECRUITING_YES = "YES - Currently Recruiting"
RECRUITING_NO = "No"

# Prompt layouts. Placeholders: question, context.
FULL_PROMPT = (
    "Please answer this clinical research question using the trial data below.\n\n"
    "QUESTION: {question}\n\n"
    "RELEVANT TRIALS FROM OUR DATABASE:\n{context}\n\n"
    "Please provide a clear, cited answer."
)
TRACKED_PROMPT = "Question: {question}\n\nTrials:\n{context}"
DASHBOARD_PROMPT = "Question: {question}\n\nRelevant trials:\n{context}"
