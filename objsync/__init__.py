"""Object data in and out of Spark: landed query results to typed rows, and rows to
upload batches, keyed updates and published datasets."""

from objsync.functions.text import (
    csv_header,
    csv_line,
    csv_value,
    encode_fields,
    form_encode,
    row_bytes,
)
from objsync.operators.batches import (
    batch_count,
    batch_payloads,
    cut_batches,
    cut_payloads,
    estimate_bytes,
    estimate_bytes_sampled,
    plan_batches,
)
from objsync.operators.outcomes import (
    error_summary,
    failed_rows,
    insert_results,
    insert_rows,
    job_status,
    result_summary,
    update_by_key,
    update_results,
)
from objsync.operators.positions import paginate, row_positions
from objsync.operators.schema import (
    align,
    apply_schema,
    cast_rejects,
    infer_schema,
    infer_types,
)
from objsync.plans.load import load_object, typed_rows
from objsync.plans.manifest import dataset_manifest, field_table, manifest_fields
from objsync.plans.publish import (
    publish_dataset,
    published_manifests,
    published_parts,
)
from objsync.plans.stage import (
    check_staged,
    payloads,
    read_staged,
    stage_batches,
    staged_totals,
    write_payloads,
    write_result_set,
)
from objsync.plans.tables import (
    create_empty_table,
    register_extract,
    replace_extract,
    save_extract,
    save_table,
)
from objsync.sources.objects import query_objects
from objsync.sources.pages import page_records, page_status, read_pages
from objsync.plans.versions import (
    WriteConflict,
    commit_extract,
    extract_vacuum,
    extract_versions,
    read_extract,
    update_files,
)
from objsync.sources.result_sets import read_result_sets
from objsync.sources.split_sets import read_result_sets_split

__all__ = [
    "align",
    "apply_schema",
    "batch_count",
    "batch_payloads",
    "cast_rejects",
    "check_staged",
    "create_empty_table",
    "csv_header",
    "csv_line",
    "csv_value",
    "cut_batches",
    "cut_payloads",
    "dataset_manifest",
    "encode_fields",
    "error_summary",
    "estimate_bytes",
    "estimate_bytes_sampled",
    "failed_rows",
    "field_table",
    "form_encode",
    "infer_schema",
    "infer_types",
    "insert_results",
    "insert_rows",
    "job_status",
    "load_object",
    "manifest_fields",
    "page_records",
    "page_status",
    "paginate",
    "payloads",
    "plan_batches",
    "publish_dataset",
    "published_manifests",
    "published_parts",
    "query_objects",
    "read_pages",
    "read_result_sets",
    "read_result_sets_split",
    "WriteConflict",
    "commit_extract",
    "extract_vacuum",
    "extract_versions",
    "read_extract",
    "update_files",
    "read_staged",
    "register_extract",
    "replace_extract",
    "result_summary",
    "row_bytes",
    "row_positions",
    "save_extract",
    "save_table",
    "stage_batches",
    "staged_totals",
    "typed_rows",
    "update_by_key",
    "update_results",
    "write_payloads",
    "write_result_set",
]
