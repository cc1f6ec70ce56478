"""DataFrame operators: ``f(df, ...) -> df``."""

from feedlake.operators.arrivals import arrival_counts, completeness, mark_fresh, pending
from feedlake.operators.envelope import (
    attach_header,
    demux,
    feed_details,
    feed_header,
    first_lines,
    is_single_type,
    prepend_literal,
    record_types,
    snapshot_from_name,
    stamp_snapshot,
    strip_header_contains,
    strip_header_type,
    tag_lines,
    tag_multi,
    tag_single,
)
from feedlake.operators.runs import latest_status, ledger_rows, with_elapsed
from feedlake.operators.losses import lost_amount, lost_date, lost_lines, lost_values, summarise_losses
from feedlake.operators.typing_rules import (
    apply_formats,
    bad_amounts,
    coerce_dates,
    date_choice,
    format_ok,
    money_columns,
    parse_dates_column,
    parse_doubles,
)
from feedlake.operators.unpack import WidthError, split_width, unpack, width_guard, width_ok

__all__ = [
    "WidthError",
    "apply_formats",
    "arrival_counts",
    "attach_header",
    "bad_amounts",
    "coerce_dates",
    "completeness",
    "date_choice",
    "demux",
    "feed_details",
    "feed_header",
    "first_lines",
    "format_ok",
    "is_single_type",
    "latest_status",
    "ledger_rows",
    "lost_amount",
    "lost_date",
    "lost_lines",
    "lost_values",
    "mark_fresh",
    "money_columns",
    "parse_dates_column",
    "parse_doubles",
    "pending",
    "prepend_literal",
    "record_types",
    "snapshot_from_name",
    "split_width",
    "stamp_snapshot",
    "strip_header_contains",
    "strip_header_type",
    "summarise_losses",
    "tag_lines",
    "tag_multi",
    "tag_single",
    "unpack",
    "width_guard",
    "width_ok",
    "with_elapsed",
]
