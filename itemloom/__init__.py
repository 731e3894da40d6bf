"""Item tables on Spark: keyed, typed, schemaless items as DataFrames."""

from .errors import ItemTableError, TableNotFound, ValidationError
from .functions.codec import decode_columns, decode_items, encode_items, read_row_types, validate_nested_sets
from .functions.exprs import bind, bind_names, condition, json_path, predicate
from .operators.read import (
    GetRequest,
    Page,
    all_columns,
    batch_get,
    batch_get_many,
    count_by_partition,
    count_items,
    get_item,
    keyset_page,
    missing_keys,
    project,
    project_with_keys,
    query,
    query_index,
    query_page,
    query_pages,
    scan,
    transact_get,
)
from .operators.statements import delete_where, execute_statement, insert_value, select, update_where
from .operators.transact import Check, Delete, Put, TransactResult, Update, condition_check, transact_write
from .operators.write import (
    BatchWriteResult,
    WriteResult,
    batch_delete,
    batch_put,
    batch_write,
    batch_write_many,
    delete_items,
    last_write_wins,
    merge_images,
    put_items,
    put_nested,
    update_items,
)
from .session import build_session, scratch, scratch_dir
from .sources.files import read_items_json, read_items_tsv, write_items_json, write_items_tsv
from .sources.schema import (
    evolve_schema,
    index_metadata,
    infer_item_schema,
    register_from_metadata,
    restore_columns,
    sanitize_columns,
    schema_diff,
    schema_metadata,
    struct_from_metadata,
    table_metadata,
)
from .sources.snapshots import SnapshotStore, write_snapshot
from .streaming.changes import change_feed, changes_between, sequenced, stream_enabled
from .streaming.mutations import MutationLog, apply_mutation_stream
from .table import Catalog, Index, ItemTable

__all__ = [name for name in dir() if not name.startswith("_")]
