from rillworks.sinks.committed import committed_units, publish_units, read_units  # noqa: F401
from rillworks.sinks.index import (  # noqa: F401
    index_rows,
    inventory,
    read_index,
    truncate_index,
    write_index,
)
from rillworks.sinks.manifest import read_manifest, write_index_once  # noqa: F401
from rillworks.sinks.topic import as_topic, publish, write_topic_stream  # noqa: F401
