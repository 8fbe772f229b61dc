"""Plan-shape guards: no plan regresses into a pattern that breaks at scale."""

import pytest

from quartier.plans import audit, verify
from quartier.plans.catalog import QUERIES, load_all

load_all()
SF = "/root/testdata/sf0.01"
# queries that write/stream at construction time are covered by test_oracle
BATCH = sorted(n for n in QUERIES
               if not n.startswith(("stream_", "store_")) and n not in ("points_sink_roundtrip",
                                                            "series_csv_calendar"))
ALLOWED = {"sort-based aggregate"}   # struct-valued arg-row buffers, see PLANS.md


@pytest.mark.parametrize("name", BATCH)
def test_no_scale_red_flags(spark, name):
    r = audit.audit(QUERIES[name](spark, SF))
    assert set(r["flags"]) <= ALLOWED, (name, r)


def test_enrichment_broadcasts_only_fixed_dimensions(spark):
    r = audit.audit(QUERIES["municipality_enriched"](spark, SF))
    assert r["shuffles"] == 0 and r["broadcasts"] == 2


def test_topk_uses_window_group_limit(spark):
    assert audit.audit(QUERIES["frequent_topk"](spark, SF))["window_limit"]


def test_parquet_verify_mode(spark):
    con = verify.duck(SF)
    res = verify.compare_via_parquet(spark, "calendar_dupes", SF, con)
    assert res["status"] == "match", res


@pytest.mark.parametrize("name", ["rollup_sum", "rollup_count", "rollup_avg"])
def test_sums_and_counts_hash(spark, name):
    assert "sort-based aggregate" not in audit.audit(QUERIES[name](spark, SF))["flags"]
