from riskloom.sources.applicant import APPLICANT_SCHEMA
from riskloom.sources.readers import (
    object_uri,
    parse_records,
    read_applications,
    read_object,
    read_records,
    rejected_records,
    rejected_requests,
    rejected_rows,
)
from riskloom.sources.writers import append_run, read_runs, versioned_name, write_versioned

__all__ = [
    "APPLICANT_SCHEMA",
    "append_run",
    "object_uri",
    "parse_records",
    "read_applications",
    "read_object",
    "read_records",
    "read_runs",
    "rejected_records",
    "rejected_requests",
    "rejected_rows",
    "versioned_name",
    "write_versioned",
]
