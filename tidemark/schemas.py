"""Fixed table shapes. Unknown sizes, hashes and dimensions are NULL, never 0 or ''."""

from __future__ import annotations

FILES = (
    "dataset_id string, relative_path string, size_bytes bigint, content_type string, "
    "width int, height int, sha256 string"
)
CLASSES = "dataset_id string, class_id int, class_name string"
LABEL_LINES = "dataset_id string, path string, line bigint, raw string"
ANNOTATIONS = "dataset_id string, path string, line bigint, class_id bigint, coords array<double>"
FINDINGS = (
    "dataset_id string, severity string, code string, path string, line bigint, class_id bigint, "
    "expected_label_path string, message string"
)
IMPORT_STATE = (
    "project_id string, import_id string, source string, format string, task_key string, "
    "completed boolean, state_path string, mtime timestamp"
)
IMPORT_FILES = (
    "project_id string, import_id string, relative_path string, uploaded boolean, "
    "streamed boolean, object_key string, sha256 string, size_bytes bigint, width int, height int"
)
PROGRESS = (
    "struct<phase:string,status:string,image_count:bigint,file_count:bigint,items_total:bigint>"
)
SERVER_IMPORTS = (
    "project_id string, import_id string, status string, source string, format string, "
    "file_count bigint, image_count bigint, created_at string, updated_at string, "
    f"progress {PROGRESS}"
)
TRANSFER_EVENTS = (
    "run_id bigint, batch_id bigint, event_id bigint, ts timestamp, name string, "
    "duration_sec double, file_count bigint, byte_count bigint, http_status int, attempt int"
)

FORMATS = ("yolo", "coco", "imagenet")
