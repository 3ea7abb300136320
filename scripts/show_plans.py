"""Print the physical plans of the main operators (operator tree plus the
scan, filter and exchange details): python scripts/show_plans.py [sf_dir]."""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowlens.operators import reports, views  # noqa: E402
from flowlens.operators.windows import window_metrics  # noqa: E402
from flowlens.plans.batch_queries import flows  # noqa: E402
from flowlens.schemas import NORMALIZED_PARTITIONS, WINDOW_PARTITIONS  # noqa: E402
from flowlens.session import local_session, new_work_dir  # noqa: E402
from flowlens.sinks.writers import write_partitioned  # noqa: E402
from flowlens.sources.tables import register_tables  # noqa: E402

KEEP = re.compile(r"^(\(\d+\) \S.*|\s*[+*-].*|[A-Za-z].*)$")
DETAIL = ("ReadSchema", "PushedFilters", "PartitionFilters", "Arguments", "Keys", "Functions")


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    out = []
    for line in buf.getvalue().splitlines():
        if line.startswith(DETAIL):
            out.append("    " + line[:160])
        elif line.startswith("(") or line.startswith(("+-", " ", "*", "==")) or line[:1].isalpha():
            if not line.startswith(("Input", "Output", "Batched", "Location", "Condition",
                                    "Results", "Aggregate Attributes")):
                out.append(line[:160])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    norm = flows(spark, sf)
    work = new_work_dir(spark, "plans")
    write_partitioned(norm, f"{work}/n", NORMALIZED_PARTITIONS)
    write_partitioned(window_metrics(norm, width="1 day", events_threshold=3), f"{work}/w",
                      WINDOW_PARTITIONS)
    register_tables(spark, f"{work}/n", f"{work}/w", database="plans_db", location=f"{work}/cat")
    table = spark.table("plans_db.normalized_logs")
    wtable = spark.table("plans_db.aggregations_5min")
    shown = {
        "window_metrics (5 minutes, exact distinct)": window_metrics(norm),
        "behavioral_profiles (top 10,000)": reports.behavioral_profiles(norm),
        "attack_distribution": reports.attack_distribution(norm),
        "benign_baseline over normalised rows (a filter on the computed category)": reports.benign_baseline(norm),
        "benign_baseline over the partitioned table": reports.benign_baseline(table),
        "recent_attacks over the partitioned table": views.recent_attacks(table, as_of="2024-01-30"),
        "active_alerts over the partitioned window table": views.active_alerts(wtable, as_of="2024-01-30"),
        "hourly_traffic over the partitioned table": views.hourly_traffic(table),
    }
    for title, df in shown.items():
        print(f"### {title}\n\n```\n{plan_text(df)}\n```\n")
    # the streaming window aggregation (J2) over a message folder
    from flowlens.plans import stream_queries as sq
    from flowlens.sources.streams import stream_source
    from flowlens.streaming.jobs import window_stream

    src = f"{work}/stream-src"
    sq._unified_messages(spark.read.parquet(f"{sf}/events.parquet").limit(10)) \
        .select("value").write.text(f"{src}/a")
    stream = window_stream(stream_source(spark, fmt="text", path=f"{src}/*"))
    print("### window_stream (J2, streaming, before start)\n\n```")
    buf = io.StringIO()
    with redirect_stdout(buf):
        stream.explain(True)
    text = buf.getvalue()
    physical = text[text.index("== Physical Plan =="):]
    print("\n".join(line[:160] for line in physical.splitlines()))
    print("```\n")


if __name__ == "__main__":
    main()
