"""Sources and sinks (S1-S10) and adapters over the driver tables."""

from cuecards.sources.adapters import (  # noqa: F401
    lines_from_conversations, preds_from_embeddings, ranked_from_events, truth_from_embeddings,
)
from cuecards.sources.files import (  # noqa: F401
    read_lines, read_predictions, read_ranked, write_table,
)
from cuecards.sources.stages import materialise, pending  # noqa: F401
from cuecards.sources.template import fill_template, template_report  # noqa: F401
from cuecards.sources.vectors import lookup_vectors, read_vectors  # noqa: F401
