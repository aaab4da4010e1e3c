"""Column-level building blocks shared by every operator."""

from tidemark.functions.core import (  # noqa: F401
    favg,
    flag,
    fsum,
    money,
    money_avg,
    money_sum,
    nan_to_zero,
    pct_change,
    ratio,
    safe_div,
    scalar_join,
    share_pct,
    summarise,
)
from tidemark.functions.calendar import (  # noqa: F401
    month_diff,
    month_label,
    month_spine,
    month_start,
)
from tidemark.functions.ranking import (  # noqa: F401
    cut_right,
    exact_quantiles,
    global_rank,
    qcut_rank,
    qcut_value,
)
