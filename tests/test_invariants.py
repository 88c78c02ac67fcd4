"""Invariants every mart must satisfy (checked on the driver data)."""

from decimal import Decimal

import pytest

from lodgeflow.plans import marts as M
from lodgeflow.plans.driver_star import analogue_star

from .conftest import SMALL_SF


@pytest.fixture(scope="module")
def star(spark):
    return analogue_star(spark, SMALL_SF)


@pytest.mark.parametrize("keys", [M.NEIGHBOURHOOD_KEYS, M.PROPERTY_KEYS])
def test_listing_mart_invariants(star, keys):
    mart = M.listing_mart(star, keys)
    rows = mart.collect()
    assert rows
    g = keys + ["year_month"]
    assert mart.select(*g).distinct().count() == len(rows)            # key unique
    for r in rows:
        assert Decimal(0) < r.active_listing_rate < Decimal(100)       # >=1 unavailable row
        assert Decimal(0) < r.superhost_rate <= Decimal(100)           # >=1 superhost
        assert r.distinct_host_id >= 1
        assert r.min_price is None or r.min_price <= r.max_price
        assert all(getattr(r, k) is not None for k in g)
        # decimal scales of the warehouse
        assert r.active_listing_rate.as_tuple().exponent == -6
        assert r.med_price is None or r.med_price.as_tuple().exponent == -3


def test_host_mart_invariants(star):
    rows = M.host_mart(star).collect()
    assert rows
    assert len({(r.host_neighbourhood_lga, r.year_month) for r in rows}) == len(rows)
    for r in rows:
        if r.total_rev is not None and r.num_distinct_host:
            expect = (Decimal(r.total_rev) / Decimal(r.num_distinct_host)).quantize(Decimal("0.000001"))
            assert r.avg_rev_per_host == expect


def test_host_mart_revenue_is_k_squared_multiple(spark):
    """Per (listing, LGA, month) the self-join contributes n * s with n = sum(k):
    for an LGA whose k is constant, total_rev is a multiple of k^2 (sf0.01 has
    several suppliers, i.e. suburbs, per nation)."""
    star = analogue_star(spark, "/root/testdata/sf0.01")
    k = M.lga_suburb_counts(star.dim_lga_code).collect()
    kmap = {r.lga_name: r.k for r in k}
    rev, _ = M.host_mart_parts(star)
    assert min(kmap.values()) >= 1 and max(kmap.values()) > 1
    for r in rev.collect():
        kk = kmap[r.lga_name]
        if r.total_rev is not None:
            assert int(r.total_rev) % (kk * kk) == 0
