from grovelift.operators.batching import (
    assign_batches,
    batch_log,
    counted_log,
    first_batch,
    number_rows,
    running_total,
)
from grovelift.operators.evolve import add_column
from grovelift.operators.keys import key_violations, require_key
from grovelift.operators.progress import (
    queue_view,
    resume_state,
    run_started_at,
    steps_completed,
    without_run,
)
from grovelift.operators.scope import in_scope, scope_ids
from grovelift.operators.steps import (
    children,
    direct_parents,
    fetch_rows,
    label_rows,
    missing_parents,
    roots,
)
from grovelift.operators.upsert import upsert

__all__ = [
    "add_column",
    "assign_batches",
    "batch_log",
    "children",
    "counted_log",
    "direct_parents",
    "fetch_rows",
    "first_batch",
    "in_scope",
    "key_violations",
    "label_rows",
    "missing_parents",
    "number_rows",
    "queue_view",
    "require_key",
    "resume_state",
    "roots",
    "run_started_at",
    "running_total",
    "scope_ids",
    "steps_completed",
    "upsert",
    "without_run",
]
