"""Parameters of one migration run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunParams:
    """Values stamped on the rows of a run.

    With one tenant per run the route's values are set here.  With many
    tenants in one job each row carries its route: ``row_values`` names the
    values to take from columns of the same name, and ``scope`` the columns
    that separate tenants, so that keys and generated ids are per scope.
    """

    cutover: str
    system_user_id: int = 1
    tenant: str = ""
    target_payroll_id: int = 1
    payroll_number: int = 1
    row_values: tuple[str, ...] = ()
    scope: tuple[str, ...] = ()

    def col(self, name: str) -> Column:
        return F.col(name) if name in self.row_values else F.lit(getattr(self, name))
