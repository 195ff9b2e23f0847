from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from tests.shop import by, raw
from tidemark.operators import staging
from tidemark.sources.category_names import category_names


def test_category_lookup_is_complete_and_unique(spark):
    rows = category_names(spark).collect()
    assert len(rows) == 71
    assert len({r[0] for r in rows}) == len({r[1] for r in rows}) == 71


def test_products_translate_or_keep_the_category(spark):
    products = raw(
        spark,
        "products",
        [
            {"product_id": "a", "product_category_name": "beleza_saude", "product_name_lenght": 5},
            {"product_id": "b", "product_category_name": "pc_gamer"},
            {"product_id": "c"},
        ],
    )
    staged = by(staging.stg_products(products, category_names(spark)), "product_id")
    assert staged["a"].product_category == "health_beauty"
    assert staged["a"].product_name_length == 5
    assert staged["b"].product_category == "pc_gamer"
    assert staged["c"].product_category is None


def test_staging_accepts_an_all_text_load(spark):
    text = spark.createDataFrame(
        [("o", "2.0", "p", "s", "2020-01-02 03:04:05", "1.5", "0.25")],
        "order_id string, order_item_id string, product_id string, seller_id string, "
        "shipping_limit_date string, price string, freight_value string",
    )
    row = staging.stg_order_items(text).first()
    assert (row.order_item_id, row.price, row.freight_value) == (2, 1.5, 0.25)
    assert row.shipping_limit_at.isoformat() == "2020-01-02T03:04:05"


@pytest.mark.parametrize(
    ("price", "limit"),
    [("1.5d", "2020-01-02"), ("2f", "2020-01-02"), ("1", "2017"), ("1", "2020-01-02T10:00:00+05:00")],
)
def test_staging_refuses_texts_that_the_loader_sets_aside(spark, price, limit):
    text = spark.createDataFrame(
        [("o", "1", "p", "s", limit, price, None)],
        "order_id string, order_item_id string, product_id string, seller_id string, "
        "shipping_limit_date string, price string, freight_value string",
    )
    with pytest.raises(PySparkException, match="bad value"):
        staging.stg_order_items(text).collect()


def test_zip_codes_stay_text(spark):
    rows = raw(spark, "customers", [{"customer_id": "c", "customer_zip_code_prefix": "01037"}])
    assert staging.stg_customers(rows).first().zip_code == "01037"


def test_geolocation_averages_points_and_takes_last_names(spark):
    def point(zip_code, lat, lng, city, state):
        return dict(
            zip(
                (
                    "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "geolocation_city", "geolocation_state",
                ),
                (zip_code, lat, lng, city, state),
            )
        )

    rows = raw(
        spark,
        "geolocation",
        [
            point("1", 1.0, 10.0, "a", "Z"),
            point("1", 2.0, 20.0, "b", "Y"),
            point("1", 6.0, None, "b", "Y"),
            point("2", None, None, None, None),
            point(None, 4.0, 4.0, "n", "N"),
        ],
    )
    for exact in (False, True):
        got = by(staging.stg_geolocation(rows, exact), "zip_code")
        assert tuple(got["1"]) == ("1", 3.0, 15.0, "b", "Z")
        assert tuple(got["2"]) == ("2", None, None, None, None)
        assert got[None].latitude == 4.0
