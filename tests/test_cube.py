"""P-20: the KPI cube against sums over plain rows, and its edge cases."""

import itertools

from campanula.operators import cube as CU

CELL = "month string, channel string, region string, " + ", ".join(f"{m} decimal(30,2)" for m in CU.MEASURES)


def cell(month, channel, region, **m):
    from decimal import Decimal
    return (month, channel, region, *[Decimal(m.get(k, 0)) for k in CU.MEASURES])


def test_every_slice_is_the_sum_of_its_cells(spark):
    cells = [cell(m, c, r, leads=3 * i + 1, conversions=i, orders=i % 4, revenue=10 * i)
             for i, (m, c, r) in enumerate(itertools.product(["2024-01", "Unknown"], ["Email", "SEO", "Unknown"], ["all", "North"]))]
    got = CU.kpi_cube(spark.createDataFrame(cells, CELL)).collect()
    assert len(got) == 3 * 4 * 3 and len({(r.month, r.channel, r.region, r.level) for r in got}) == len(got)
    whole = sum(c[4] for c in cells) / sum(c[3] for c in cells)
    for r in got:
        free = [r.level & 4, r.level & 2, r.level & 1]  # a member named 'all' is still told apart by the level
        mine = [c for c in cells if all(f or v == w for f, v, w in zip(free, (r.month, r.channel, r.region), c))]
        leads, conv, orders = sum(c[3] for c in mine), sum(c[4] for c in mine), sum(c[8] for c in mine)
        assert (r.leads, r.conversions, r.orders) == (leads, conv, orders)
        assert abs(r.lcr - float(conv / leads)) < 1e-12 and (r.aov is None) == (orders == 0)
        assert r.band == ("green" if conv / leads >= whole else "amber" if float(conv / leads) >= 0.9 * float(whole) else "red")


def test_no_leads_no_band_and_empty(spark):
    rows = CU.kpi_cube(spark.createDataFrame([cell("2024-01", "SEO", "North", sessions=4, checkouts=1)], CELL)).collect()
    assert len(rows) == 8 and all(r.lcr is None and r.band is None and r.checkout_rate == 0.25 for r in rows)
    assert CU.kpi_cube(spark.createDataFrame([], CELL)).collect() == []


def test_cells_keep_rows_without_keys(spark):
    leads = spark.sql("SELECT * FROM VALUES ('1', DATE'2024-01-05', 'North', true, 5.0D), (null, null, null, null, null) "
                      "AS t(campaign_id, lead_date, observed_region, converted_30d, acquisition_cost_usd)")
    sessions = spark.sql("SELECT DATE'2024-01-09' AS session_date, 'SEO' AS channel_group, cast(null as string) AS geo_region, true AS checkout_started")
    tx = spark.sql("SELECT * FROM VALUES ('c', DATE'2024-01-02', 'Email', 2.0D, 7.5D, true), (null, DATE'2024-01-02', 'Email', null, null, null) "
                   "AS t(customer_id, order_date, marketing_channel_last_touch, units, revenue_usd, returned_flag)")
    campaigns = spark.sql("SELECT * FROM VALUES ('1', 'Email'), (null, 'SEO') AS t(campaign_id, channel)")
    customers = spark.sql("SELECT 'c' AS customer_id, 'North' AS region")
    got = {(r.month, r.channel, r.region): [float(r[m]) for m in CU.MEASURES]
           for r in CU.kpi_cells(leads, sessions, tx, campaigns, customers).collect()}
    assert got == {("2024-01", "Email", "North"): [1, 1, 5, 0, 0, 1, 2, 7.5, 1],
                   ("Unknown", "Unknown", "Unknown"): [1, 0, 0, 0, 0, 0, 0, 0, 0],
                   ("2024-01", "SEO", "Unknown"): [0, 0, 0, 1, 1, 0, 0, 0, 0],
                   ("2024-01", "Email", "Unknown"): [0, 0, 0, 0, 0, 1, 0, 0, 0]}
