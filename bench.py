"""Times the headline queries: one JSON line on standard output.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores. The inputs (topics and landing
table) are stored before the clock starts; every query then runs twice and its faster run counts.
"""

from __future__ import annotations

import json
import os
import time

from letterlake.catalog import inputs
from letterlake.catalog.queries import QUERIES
from letterlake.session import build_session

HEADLINES = (
    "decode_envelope",
    "route_customer",
    "cdc_to_canonical",
    "ddb_to_operational",
    "ops_enrich",
    "contract_violations",
    "stg_events",
    "fct_daily_delivery",
    "delivery_daily_metrics",
    "campaign_performance",
    "template_performance",
    "layer_campaign_performance",
    "internal_mail_tracking",
    "fct_mail_lifecycle",
    "incremental_upsert",
    "dedup_events",
    "volume_over_time",
    "top_tenants",
    "provider_sla",
    "offset_gaps",
)
INPUTS = (
    inputs.landing_events,
    inputs.lifecycle_topic,
    inputs.operational_topic,
    inputs.change_topic,
    inputs.attribute_topic,
    inputs.contract_topic,
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for build in INPUTS:
        build(spark, sf_dir)
    seconds = {}
    for name in HEADLINES:
        runs = []
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
