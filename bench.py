"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of the sample tables, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shiftroll.plans import registry  # noqa: E402
from shiftroll.session import clear_scratch, local_session  # noqa: E402

HEADLINE = [
    "routing_summary",
    "stage_employees",
    "mint_users",
    "build_employees",
    "build_status",
    "import_catalogue",
    "stage_amounts",
    "route_earnings",
    "route_balances",
    "route_deprecated",
    "quarantine_orphans",
    "refresh_salary",
    "export_import_rows",
    "import_alpha",
    "import_thirdparty",
    "import_bank_details",
    "build_tax_status",
    "build_periods",
    "carry_run_history",
    "carry_run_history_amounts",
    "carry_settings_report_calcs",
    "tenant_earnings",
    "tenant_routing_summary",
    "schema_drift",
    "as_of_snapshot",
    "payable_employees",
    "ytd_basis",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    every = registry.registered()

    def run(name: str) -> float:
        start = time.perf_counter()
        every[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("routing_summary", "mint_users"):  # class loading is not measured
        run(name)
    times = {name: round(run(name), 3) for name in HEADLINE}
    clear_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
