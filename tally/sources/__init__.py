from tally.sources.catalog import (
    bind_questions,
    catalog_faults,
    choice_mismatches,
    header_forms,
    header_frame,
    load_catalog,
    match_headers,
    missing_questions,
    question_catalog,
)
from tally.sources.reports import (
    parse_reports,
    publish_run,
    published,
    published_frame,
    published_reports,
    read_reports,
    report_index,
    report_page,
    write_frames,
    write_report,
)
from tally.sources.responses import Survey, land_responses, read_responses
from tally.sources.sections import (
    attach_commentary,
    load_commentary,
    rows_without_commentary,
    sections,
    split_sections,
)

__all__ = [name for name in dir() if not name.startswith("_")]
