"""Write the operator skeleton of each headline query's final physical plan.

Usage: python tools/plan_report.py [sf_dir] > docs/PLANS.md
Each query is run once (noop sink) so the adaptive plan is final; lines keep
the operator, join/exchange strategy and the scans' read schema and filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from cdrflow.plans.reports import QUERIES  # noqa: E402
from cdrflow.session import build_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|Aggregate|FileScan|Scan |Generate|Window|Union|Sort\b|"
                  r"InMemory|BroadcastExchange|AQEShuffleRead|ShuffleQueryStage|BroadcastQueryStage|"
                  r"Filter|Expand|Limit|TakeOrdered)")


def skeleton(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        if not KEEP.search(line):
            continue
        m = re.match(r"^([\s:+\-|]*)(.*)$", line)
        indent, body = m.group(1), m.group(2)
        if "FileScan" in body:
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", body)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", body)
            name = re.search(r"FileScan (\w+)", body).group(1)
            loc = re.search(r"Location: \w+ \[([^\]]*)\]", body)
            body = (f"FileScan {name} {os.path.basename(loc.group(1)) if loc else ''} "
                    f"ReadSchema={schema.group(1) if schema else '?'} "
                    f"PushedFilters={pushed.group(1) if pushed else '[]'}")
        elif "Filter" in body and "Exchange" not in body:
            body = "Filter"
        else:
            body = re.sub(r"\[plan_id=\d+\]", "", body)
            body = re.sub(r"#\d+L?", "", body)
            if len(body) > 150:
                body = body[:150] + " ..."
        out.append(indent + body)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("OFF")
    print(f"# Physical plans of the headline queries ({os.path.basename(sf_dir)}, local[8])\n")
    print("Final adaptive plans, reduced to operators; generated by `tools/plan_report.py`.\n")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```")
        print("\n".join(skeleton(plan)))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
