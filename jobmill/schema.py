"""Table schemas as DDL text."""

#: one canonical posting, as every adapter returns it; ``source_rank`` is added per run
POSTING = (
    "source string, source_id string, title string, company string, location string, "
    "remote boolean, is_usa boolean, url string, description string, salary_min int, "
    "salary_max int, experience_level string, roles array<string>, posted_at timestamp, "
    "dedup_hash string, ingest_seq bigint"
)

#: the persisted posting: canonical columns plus the merge state
JOB = f"{POSTING}, id string, scraped_at timestamp, is_active boolean, embedding array<float>"

#: one landed response body per row
RAW_PAYLOAD = (
    "source string, run_id string, fetch_seq bigint, request_key string, status int, "
    "content_type string, body string"
)

PROFILE = (
    "id string, email string, tier string, job_alerts_enabled boolean, "
    "target_roles array<string>, target_levels array<string>, resume_text string, "
    "resume_embedding array<float>"
)

APPLICATION = (
    "user_id string, job_id string, status string, applied_at timestamp, interview_count int"
)

JOB_SCORE = "user_id string, job_id string, similarity double, grade string, computed_at timestamp"

ALERT_SENT = "user_id string, job_id string"

PROBE_STATE = (
    "company string, zero_count int, last_attempt date, wd_version string, slug string, "
    "known_targets map<string, struct<wd_version: string, slug: string>>"
)
