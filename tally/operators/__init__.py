from tally.operators.charts import (
    bar_series,
    dropped_note,
    heatmap_cells,
    heatmap_range,
    likert_segments,
    line_series,
    rank_stack,
    sankey_frame,
    upset_combo_names,
    upset_connectors,
    upset_key,
    upset_matrix,
    upset_set_names,
    upset_totals_axis,
)
from tally.operators.counts import (
    COMBINED_LABEL,
    MultiCount,
    SingleCount,
    counts_multi,
    counts_multi_family,
    counts_multi_long,
    counts_single,
    counts_single_family,
    flags_from_long,
    set_totals,
)
from tally.operators.crosstabs import CrossTab, crosstab, crosstab_family, crosstab_multi
from tally.operators.flows import (
    UPGRADE_STAGES,
    Flow,
    Stages,
    flow_links,
    flow_nodes,
    funnel_nodes,
    name_collisions,
    staged_funnel,
)
from tally.operators.position import with_position
from tally.operators.ranks import (
    RankCount,
    borda_scores,
    rank_distribution,
    rank_distribution_family,
    rank_distribution_long,
)
from tally.operators.sets import (
    combination_sizes,
    combinations_dropped,
    set_combinations,
    totals_of_sizes,
)

__all__ = [name for name in dir() if not name.startswith("_")]
