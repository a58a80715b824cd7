"""DataFrame operators for feeds of job postings and similar short documents."""
