"""Alert rules read the tables of their own figures only."""

import pytest

from innsight.plans import alerts

DAY = "2001-08-02"
RULES = {r.alert_id: r for r in alerts.RULES}


@pytest.mark.parametrize(
    "alert_id, read",
    [
        ("HOST-001-CRIT", {"dim_host"}),
        ("HOST-004-INFO", {"dim_host"}),
        ("HOST-002-WARN", {"dim_host", "dim_property", "fact_booking_daily"}),
        ("PROP-002-WARN", {"dim_property"}),
        ("PROP-004-INFO", {"dim_host", "dim_property"}),
        ("ENG-003-WARN", {"dim_property", "fact_property_engagement"}),
        ("CUST-001-CRIT", {"dim_user"}),
    ],
)
def test_rule_reads_only_what_its_figures_need(catalog, alert_id, read):
    seen = set()
    alerts.run_rule(RULES[alert_id], lambda name: seen.add(name) or catalog.table(name), DAY)
    assert seen == read


def test_one_rule_says_the_same_as_all_together(catalog):
    together = {r.alert_id: tuple(r) for r in alerts.evaluate(alerts.RULES, catalog.table, DAY).collect()}
    alone = {i: tuple(alerts.evaluate([RULES[i]], catalog.table, DAY).first()) for i in ("HOST-001-CRIT", "HOST-003-WARN", "PROP-004-INFO", "CUST-004-INFO")}
    assert alone == {i: together[i] for i in alone}
