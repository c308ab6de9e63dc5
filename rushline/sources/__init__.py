from rushline.sources.documents import flatten_documents, leaf_paths, read_document_paths
from rushline.sources.mounts import mount
from rushline.sources.observations import (
    RAW_SCHEMA,
    first_available,
    join_uri,
    read_observations,
    read_report_csv,
    read_report_json,
)

__all__ = [
    "RAW_SCHEMA", "first_available", "flatten_documents", "join_uri", "leaf_paths", "mount",
    "read_document_paths", "read_observations", "read_report_csv", "read_report_json",
]
