"""curbline: yearly counts and trends of address events per street segment, on Spark.

Events carrying a borough, a street and a house number are matched to street
segments that carry left/right house-number ranges; matches are counted per
segment and year and a least-squares trend is fitted per segment. Every step
is a DataFrame operator, so Catalyst plans it and it scales with the cluster.

Typical use::

    from curbline import read_violations_csv, read_segments_csv, trend_report
    report = trend_report(read_violations_csv(spark, events_dir),
                          read_segments_csv(spark, segments_csv))
    report.write.csv(out)
"""

__version__ = "0.1.0"

from curbline.operators import match, segment_sides  # noqa: E402
from curbline.plans.reports import (  # noqa: E402
    count_id_year, top_by_id, trend_clean_segments, trend_matched_segments,
    trend_report, trend_report_r3, yearly_counts,
)
from curbline.session import apply_settings, scale_settings  # noqa: E402
from curbline.sources.csv import (  # noqa: E402
    read_report_csv, read_segments_csv, read_violations_csv, write_report_csv,
)
from curbline.sources.staging import read_staged_violations, stage_violations  # noqa: E402
from curbline.streaming import ingest_violation_csvs  # noqa: E402

__all__ = [
    "apply_settings", "count_id_year", "ingest_violation_csvs", "match",
    "read_report_csv", "read_segments_csv", "read_staged_violations",
    "read_violations_csv", "scale_settings", "segment_sides", "stage_violations",
    "top_by_id", "trend_clean_segments", "trend_matched_segments", "trend_report",
    "trend_report_r3", "write_report_csv", "yearly_counts",
]
