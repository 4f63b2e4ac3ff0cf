from .latest import latest_by  # noqa: F401
from .funnel import stage_sessions  # noqa: F401
from .rank import with_global_rank, quantile_bins, quantile_scores, rows_at  # noqa: F401
from .stats import describe_by, exact_quantiles, histogram, box_summary  # noqa: F401
from .fold import guarded_fold, skipped_changes, fold_run, ewm_state  # noqa: F401
from .upsert import append_dedup, upsert  # noqa: F401
from .grid import densify, int_axis  # noqa: F401
from .smoothing import ewm_levels  # noqa: F401
from .lookup import lookup  # noqa: F401
