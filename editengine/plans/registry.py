"""The analytical reports by key, with what a chart of each needs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editengine.operators import edits


@dataclass(frozen=True)
class Report:
    key: str
    label: str
    description: str
    run: Callable[..., DataFrame]
    x: str | None = None
    y: str | None = None


REPORTS = {
    r.key: r
    for r in (
        Report("q1", "Edit spikes", "Pages edited more than twice as often as the mean page.",
               edits.edit_spikes, "title", "editCount"),
        Report("q2", "Median edit size", "Exact median size change per wiki.",
               edits.median_edit_size, "wiki", "medianByteDelta"),
        Report("q3", "Busy shared pages", "Pages with three or more users in a calendar hour.",
               edits.multi_user_pages, "title", "uniqueUsers"),
        Report("q4", "Repeated edits", "A user's repeated edits of one page.",
               edits.repeated_edits, "user_name", "editCount"),
        Report("q5", "Cross-language users", "Users active in two or more languages.",
               edits.cross_language, "user_name", "languageCount"),
        Report("q6", "Edit sessions", "Runs of edits without a pause of over 30 minutes.",
               edits.edit_sessions, "user_name", "sessionEdits"),
        Report("q7", "Busiest days", "Edits per user and day.",
               edits.max_edits_per_day, "user_name", "editsInDay"),
        Report("q8", "High impact", "Human users by mean absolute size change.",
               edits.high_impact, "user_name", "avgAbsDelta"),
        Report("q9", "Comment length and size", "Mean size change per comment-length bin.",
               edits.comment_bins, "commentBin", "avgByteDelta"),
        Report("q10", "Sizes by language", "Edits per language and size category.",
               edits.size_by_language),
        Report("q11", "Collaboration", "Pages with three or more editors.",
               edits.collaboration, "title", "uniqueEditors"),
        Report("q12", "Outlier edits", "Edits beyond the 95th percentile of absolute size change.",
               edits.outlier_edits, "title", "byte_delta"),
    )
}


def run_report(store: DataFrame, key: str, **options) -> DataFrame:
    return REPORTS[key].run(store, **options)


def run_all(store: DataFrame) -> dict[str, DataFrame]:
    """Every report as a plan of its own; nothing runs until one is read."""
    return {key: report.run(store) for key, report in REPORTS.items()}


def report_sizes(store: DataFrame) -> DataFrame:
    """(key, label, rows) of all reports in one plan."""
    sizes = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(key).alias("key"), F.lit(REPORTS[key].label).alias("label"), "rows"
        )
        for key, df in run_all(store).items()
    ]
    return reduce(DataFrame.unionByName, sizes)
