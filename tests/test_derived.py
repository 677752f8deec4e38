"""The sources derived from order tables: amenity lists, and how often they are derived."""

from __future__ import annotations

import json

import __spark_entry__ as entry
from roostline.session import tune
from roostline.sources.derived import _amenity_lists, derived_sources

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_names_with_an_even_sum_of_line_numbers_are_kept(spark):
    frames = {
        "part": spark.createDataFrame([(1, "SMALL"), (2, "PROMO"), (3, None), (4, "ANY")], "p_partkey long, p_type string"),
        "lineitem": spark.createDataFrame(
            [
                (7, 1, 1), (7, 1, 3), (7, 2, 2), (7, 2, 1), (7, 3, 4), (7, 4, -2),  # odd for PROMO
                (8, 1, None),  # a line without a number adds nothing
                (9, 3, -1), (9, 4, 1), (9, 1, None), (9, 1, 2),
                (10, 99, 2),  # an unknown part
            ],
            "l_suppkey long, l_partkey long, l_linenumber int",
        ),
    }
    lists = _amenity_lists(frames.__getitem__, k="l_suppkey")
    got = {r["k"]: json.loads(r["amenities"]) for r in lists.collect()}
    assert got == {7: [" Pool", "Lockbox"], 8: [], 9: [" Pool", "Lockbox"]}


def test_amenity_lists_group_their_lines_once(spark):
    changelog = plan(derived_sources(tune(spark), SF_DIR).amenities_changelog)
    assert changelog.count("Exchange hashpartitioning") == 1
    assert "collect_set" not in changelog and "SortAggregate" not in changelog


def test_reservations_are_dealt_to_their_months_once(spark):
    nights = plan(derived_sources(tune(spark), SF_DIR).calendar)
    # Listings by month and reservations; nothing moves between the lines and their months.
    assert nights.count("Exchange hashpartitioning") == 2


def test_the_log_is_derived_once(spark):
    """Names are looked up in the written log, and the fact reads it too."""
    for query in (entry.amenity_revenue, entry.amenity_revenue_nightly):
        files = query(spark, SF_DIR).inputFiles()
        assert any("roostline-amenities_changelog" in path for path in files)


def test_nights_are_summed_up_without_texts(spark):
    shown = plan(entry.amenity_revenue_nightly(spark, SF_DIR))
    by_listing = [line for line in shown.splitlines() if "HashAggregate(keys=" in line and "listing_id" in line]
    assert by_listing and not any("month_name" in line for line in by_listing)


def test_prices_need_no_amenities_and_two_months(spark):
    for query in (entry.neighborhood_pricing, entry.neighborhood_pricing_nightly, entry.listing_price_changes):
        shown = query(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
        # Neither amenity lists nor periods, nor reservations dealt to months.
        assert "p_type" not in shown and "lead(" not in shown and "map_from_entries" not in shown
        # Months are bounded before their nights are written out.
        lines = shown.splitlines()
        months = [i for i, line in enumerate(lines) if "Filter (((month" in line]
        assert months and all(any("Generate explode(sequence(greatest" in x for x in lines[:i]) for i in months)


def test_view_names_come_from_the_written_sources(spark, monkeypatch):
    read = []
    names = entry.Lineage.amenity_names

    def watched(run):
        read.extend(run.sources.amenities_changelog.inputFiles())
        return names(run)

    monkeypatch.setattr(entry.Lineage, "amenity_names", watched)
    entry.catalog_views(spark, SF_DIR)
    assert read and all("roostline-sources" in path for path in read)
