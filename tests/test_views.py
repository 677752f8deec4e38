"""Catalog views against the same relations as DataFrames, in a fresh session."""

from __future__ import annotations

import pytest

from roostline.functions import widen
from roostline.plans import intermediate
from roostline.plans.pipeline import Lineage
from roostline.plans.views import create_views, register_sources
from roostline.session import tune
from tests.lodging import changes, listings, nights, small_sources, span


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    tune(spark)
    base = small_sources(spark)
    odd_nights = nights(spark, *span(1, "2022-05-01", "2022-05-03"), *span(1, "2022-05-02", "2022-05-02"))
    sources = base.replacing(
        listings=base.listings.unionByName(
            listings(spark, {"id": 77, "amenities": "[]", "price": "n/a", "bathrooms_text": "none", "host_since": "?"})
        ),
        calendar=base.calendar.unionByName(odd_nights),
        amenities_changelog=base.amenities_changelog.unionByName(
            changes(
                spark,
                {"listing_id": 77, "change_at": "2022-02-01 08:00:00", "amenities": ["Wifi"]},
                {"listing_id": 77, "change_at": "2022-02-01 18:00:00", "amenities": ["WiFi", "it's"]},
                {"listing_id": 77, "change_at": "2022-03-01 18:00:00", "amenities": []},
            )
        ),
    )
    root = str(tmp_path_factory.mktemp("raw"))
    for name, df in sources.items():
        df.write.parquet(f"{root}/{name}")
    lineage = Lineage(sources)
    register_sources(spark, root, "raw_views")
    routes = {"staging": "stagging", "intermediate": "development"}
    names = create_views(spark, "raw_views", lineage.amenity_names(), lineage.listing_amenity_names(), routes)
    # Views are replaced in place.
    assert create_views(spark, "raw_views", lineage.amenity_names(), lineage.listing_amenity_names(), routes) == names
    return lineage


def frames(run):
    names, own = run.amenity_names(), run.listing_amenity_names()
    return {
        "stagging.stg_listings": widen(run.listings, own),
        "stagging.stg_calendar": run.calendar,
        "stagging.stg_reviews": run.reviews,
        "stagging.stg_amenities_changelog": widen(run.changelog, names),
        "development.int_listing_amenities_scd": widen(run.scd, names),
        "development.int_availability_spans": widen(run.spans(), own),
        "development.int_calendar_enriched": intermediate.calendar_enriched(run.calendar, run.listings, run.scd, names),
        "development.int_hosts_history": intermediate.hosts_history(run.listings),
        "development.int_listings_history": run.listings_history(),
    }


def test_views_equal_the_frames_in_a_fresh_session(spark, run, rows):
    fresh = tune(spark.newSession())
    for name, df in frames(run).items():
        view = fresh.table(name)
        assert sorted(view.columns) == sorted(df.columns), name
        assert dict(view.dtypes) == dict(df.dtypes), name
        assert rows(view.select(*[f"`{c}`" for c in df.columns])) == rows(df), name
    assert fresh.catalog.getTable("stagging.stg_calendar").tableType == "VIEW"
    assert "it's" in fresh.table("stagging.stg_amenities_changelog").columns
