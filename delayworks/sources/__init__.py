"""Readers."""

from delayworks.sources.files import (
    dated_path,
    infer_stream_schema,
    read_batch,
    read_new_paths,
    read_stream,
    renew_old_files,
    schema_groups,
    united_schemas,
)

__all__ = ["dated_path", "infer_stream_schema", "read_batch", "read_new_paths", "read_stream", "renew_old_files", "schema_groups", "united_schemas"]
