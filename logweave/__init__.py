"""logweave: log files to tables on Spark.

Directory (or stream) of plain/gzip text → exactly numbered lines → records (grok, JSON, DNS,
multi-line) → documents ``{id, fields}`` → batches / tables / delivery, plus run statistics.
Every step is a DataFrame → DataFrame function; Spark plans and runs them.
"""

from .functions.grok import PatternLibrary, compile_grok, default_library
from .operators.documents import explode_documents, preview_documents, to_documents
from .operators.extract import (dns_log, grok_extract, grok_job, json_lines, normalize_timestamp,
                                raw_lines)
from .operators.multiline import assemble_records, classify_xml, xml_field_docs
from .operators.normalize import (collapse_whitespace, ignore_before, normalize_lines, prune_empty,
                                  route_unmatched, split_unmatched, swap_delimiter)
from .operators.routing import route_lines
from .operators.solr import explode_params, solr_log, solr_request_fields, unpack_mdc
from .operators.stats import endpoint_stats, file_stats, line_status, multiline_file_stats, run_stats
from .plans.jobs import index_directory
from .session import get_session, prepare, release
from .sinks.batches import batch_documents, batch_documents_by_key
from .sinks.deliver import deliver, update_manifest, write_documents
from .sinks.outbox import deliver_once
from .sinks.tombstones import apply_tombstones, write_tombstones
from .sources.files import after_offsets, from_line, list_sources, read_log_lines, read_manifest, skip_processed
from .streaming.progress import ProgressListener, ProgressLog, read_progress
from .streaming.settled import watch_settled
from .streaming.tail import tail_once
from .streaming.watch import watch_directory

__all__ = [
    "PatternLibrary", "compile_grok", "default_library",
    "explode_documents", "preview_documents", "to_documents",
    "dns_log", "grok_extract", "grok_job", "json_lines", "normalize_timestamp", "raw_lines",
    "assemble_records", "classify_xml", "xml_field_docs",
    "collapse_whitespace", "ignore_before", "normalize_lines", "prune_empty", "route_unmatched",
    "split_unmatched", "swap_delimiter",
    "explode_params", "solr_log", "solr_request_fields", "unpack_mdc",
    "endpoint_stats", "file_stats", "line_status", "multiline_file_stats", "run_stats",
    "get_session", "prepare", "index_directory",
    "batch_documents", "batch_documents_by_key",
    "deliver", "update_manifest", "write_documents",
    "after_offsets", "from_line", "read_log_lines", "read_manifest", "skip_processed",
    "tail_once", "watch_directory", "watch_settled",
    "route_lines", "release", "deliver_once", "apply_tombstones", "write_tombstones", "list_sources",
    "ProgressListener", "ProgressLog", "read_progress",
]
