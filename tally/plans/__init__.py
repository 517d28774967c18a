from tally.plans.report import (
    Chart,
    Combinations,
    Funnel,
    Likert,
    Report,
    ReportRow,
    ReportSection,
    TraitTab,
    build_report,
    chart_options,
    merged_counts,
    report_counts,
    report_of_counts,
)

__all__ = [name for name in dir() if not name.startswith("_")]
