from twinledger.sources.ledger import (
    append_outcomes,
    compact_outcomes,
    completed_ids,
    current_outcomes,
    done_keys,
    ledger_union,
    mark_done,
    params_hash,
    read_ledger,
    read_outcomes,
)
from twinledger.sources.markers import grow_markers, read_markers
from twinledger.sources.readers import (
    ID_HEADERS,
    KEY_COUNT_HEADERS,
    KEY_HEADERS,
    locate_lines,
    parse_list,
    read_dedup,
    read_id_list,
    read_index,
    read_key_list,
    read_stage,
)
from twinledger.sources.sinks import (
    create_dedup_table,
    failed_batches,
    repair_table,
    run_summary,
    write_flat,
    write_partitioned,
    write_quadrimester,
    write_report,
    write_routed,
)

__all__ = [
    "ID_HEADERS",
    "KEY_COUNT_HEADERS",
    "KEY_HEADERS",
    "append_outcomes",
    "compact_outcomes",
    "completed_ids",
    "create_dedup_table",
    "current_outcomes",
    "done_keys",
    "failed_batches",
    "grow_markers",
    "ledger_union",
    "locate_lines",
    "mark_done",
    "params_hash",
    "parse_list",
    "read_dedup",
    "read_id_list",
    "read_index",
    "read_key_list",
    "read_ledger",
    "read_markers",
    "read_outcomes",
    "read_stage",
    "repair_table",
    "run_summary",
    "write_flat",
    "write_partitioned",
    "write_quadrimester",
    "write_report",
    "write_routed",
]
