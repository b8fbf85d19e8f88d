"""Plan-level helpers: two-level ordered scans, loop lineage, plan checks."""

from stratum.plans.inspect import physical_plan
from stratum.plans.joins import join_on_group, spread
from stratum.plans.loops import Lineage
from stratum.plans.prefix import ordered_scan

__all__ = ["ordered_scan", "join_on_group", "spread", "Lineage", "physical_plan"]
