"""The 36 report functions called from SQL."""

from __future__ import annotations

from innsight.functions import sql
from registry import learning, reports
from registry.common import AS_OF, END, START

QUERIES: dict = {}
ORACLE: dict = {}

_READY: set = set()
_RANGE = f"'{START}', '{END}'"
CALLS = {
    "get_revenue_by_period": f"{_RANGE}, 'week'", "get_customer_ltv": f"{_RANGE}, as_of => '{AS_OF}'", "get_pricing_by_destination": f"'Nation_1', as_of => '{AS_OF}'",
    **{n: "" for n in ("get_demand_predictions", "get_conversion_predictions", "get_pricing_recommendations", "get_customer_ltv_predictions", "get_vip_customers",
                       "get_high_demand_properties", "get_customer_segment_distribution", "get_ml_predictions_summary")},
}


def call(c, name):
    key = (c.spark.sparkContext.applicationId, c.root)
    if key not in _READY:
        _READY.clear()  # views belong to one folder at a time
        sql.register(c.spark, c.table, {
            "demand_predictions": learning.demand(c), "conversion_predictions": learning.conversion(c), "pricing_recommendations": learning.pricing(c),
            "customer_ltv_predictions": learning.ltv(c)})
        _READY.add(key)
    return c.spark.sql(f"SELECT * FROM {name}({CALLS.get(name, _RANGE)})")


for _name in sql.FUNCTIONS:
    QUERIES[f"sql_{_name}"] = lambda c, n=_name: call(c, n)
    ORACLE[f"sql_{_name}"] = {**reports.ORACLE, **learning.ORACLE}[_name]
