from rillworks.sources.lines import drop_headers, raw_lines, read_lines  # noqa: F401
from rillworks.sources.offsets import note_positions, read_offsets, stream_offsets  # noqa: F401
from rillworks.sources.responses import read_responses  # noqa: F401
from rillworks.sources.topics import read_pages, read_topic, stream_topic  # noqa: F401
