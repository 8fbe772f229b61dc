"""quartier: Spark-native sensor analytics (batch and Structured Streaming).

Public entry points (all take and return DataFrames):

    from quartier import parse_lines, rollup, stats_last, slot_classes, \
        frequent_top, carpet, calendar_cells, tsquery
"""

from .functions.parse import format_line, parse_lines, rejected_lines
from .operators.calendar import calendar_cells, classify, thresholds
from .operators.carpet import carpet, carpet_scaled, carpet_stats
from .operators.enrich import with_coordinates, with_municipality_names
from .operators.frequent import (frequent_per_batch, frequent_points, frequent_theta,
                                 frequent_top)
from .operators.points import last_write_wins, raw_points, retain, serving_union, to_document
from .operators.rollup import avg_from_rollups, reaggregate, rollup
from .operators.stats import slot_classes, slot_rollup, stats_last
from .operators.tsquery import tsquery
from .session import get_session

__all__ = [
    "avg_from_rollups", "calendar_cells", "carpet", "carpet_scaled", "carpet_stats", "classify",
    "format_line", "frequent_per_batch", "frequent_points", "frequent_theta", "frequent_top",
    "get_session", "last_write_wins", "parse_lines", "raw_points", "reaggregate",
    "rejected_lines", "retain", "rollup", "serving_union", "slot_classes", "slot_rollup",
    "stats_last", "thresholds", "to_document", "tsquery", "with_coordinates",
    "with_municipality_names",
]
