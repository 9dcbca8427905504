"""Print the physical plan of registered queries.

Usage: python scripts/show_plans.py [--tree] [sf_dir] [key ...]
(default: the headline queries of bench.py on /root/testdata/sf0.1).
``--tree`` prints the compact physical plan (``explain()``), lines cut at 160
characters.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from curbline.plans import registry, reports  # noqa: E402
from curbline.session import local_session  # noqa: E402
from curbline.sources import fixtures  # noqa: E402


def plan_text(df, tree_only: bool) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain() if tree_only else df.explain("formatted")
    text = buf.getvalue()
    if tree_only:   # the physical plan, one operator per line, long lines cut
        text = "\n".join(line[:160] for line in text.splitlines())
    return text.rstrip()


def main() -> None:
    args = sys.argv[1:]
    tree = "--tree" in args
    args = [a for a in args if a != "--tree"]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    keys = args[1:] or HEADLINE
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    for key in keys:
        print(f"### {key}\n\n```\n{plan_text(registry.QUERIES[key](spark, sf_dir), tree)}\n```\n")
    if not args[1:]:
        v, s = fixtures.violations(spark, sf_dir), fixtures.segments(spark, sf_dir)
        y = fixtures.FIXTURE_YEARS
        for title, df in [
            ("trend report, join first", reports.trend_report(v, s, y, strategy="join_first")),
            ("trend report, no broadcast (sort-merge, salt 4)",
             reports.trend_report(v, s, y, broadcast=False, salt=4)),
        ]:
            print(f"### {title}\n\n```\n{plan_text(df, tree)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
