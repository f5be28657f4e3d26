"""Readers and writers: JSON Lines tables and CSV reports."""

from evalspark.sources.files import (
    find_judgements,
    list_files,
    literal,
    read_found_parquet,
    read_instructions,
    read_judgements,
    read_jsonl,
    tagged,
    write_jsonl,
    write_key_value,
    write_report,
)
from evalspark.sources.tables import bucket_count, read_runs, write_bucketed, write_run, write_runs

__all__ = [
    "find_judgements",
    "list_files",
    "literal",
    "read_found_parquet",
    "read_instructions",
    "read_judgements",
    "read_jsonl",
    "read_runs",
    "tagged",
    "write_bucketed",
    "write_jsonl",
    "write_key_value",
    "write_report",
    "write_run",
    "write_runs",
]
