"""What the amounts of companies that share tenants are read from."""

import shutil
from pathlib import Path

from shiftroll.functions import joins as J
from shiftroll.functions.joins import measured_once
from shiftroll.plans import registry
from shiftroll.sources.standins import Standins
from tests.conftest import SMALL


def test_large_lookups_do_not_join_the_lines_again(spark, tmp_path, monkeypatch, rows):
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path)
    plain = registry.registered()["tenant_shared_summary"](spark, SMALL)
    monkeypatch.setattr(J, "BROADCAST_MAX_ROWS", 10)
    with measured_once():
        s = Standins(spark, str(tmp_path))
        large = registry.tenant_shared_summary(s)
        codes = s.shared_codes()
    read = {Path(f).name for f in large.inputFiles()}
    assert not read & {"lineitem.parquet", "orders.parquet"}
    assert not [f for f in codes.inputFiles() if f.endswith("lineitem.parquet")]
    assert rows(large, *plain.columns) == rows(plain)
