from cartwheel.sources.events import (  # noqa: F401
    RAW_CSV_SCHEMA, RAW_COLUMNS, DEDUP_COLUMNS, read_events, require_input,
    head_sample, prefix_run, with_ingest_seq, load_result, require_columns,
)
from cartwheel.sources.adapter import shop_events, read_table  # noqa: F401
from cartwheel.sources.sinks import (  # noqa: F401
    write_clean, write_funnel, write_summary, cut_lineage,
)
