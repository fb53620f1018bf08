from rillworks.streaming.changelog import changelog_stream  # noqa: F401
from rillworks.streaming.late import enrich_late  # noqa: F401
from rillworks.streaming.lookups import choose_provider_stream, resolve_attempts_stream  # noqa: F401
from rillworks.streaming.runs import (  # noqa: F401
    COUNTS,
    IDS,
    LAST,
    append_stream,
    drain,
    index_stream,
    last_documents_stream,
    last_values_stream,
    line_index_stream,
    lookup_ids_stream,
    rocksdb_state,
    topic_index_stream,
    total_counts_stream,
)
from rillworks.streaming.metrics import (  # noqa: F401
    DeliveryListener,
    delivery_totals,
    feed_stream,
    read_deliveries,
)
from rillworks.streaming.stores import last_store_stream, read_store  # noqa: F401
