from conftest import by, make_events

from clickflow.operators import funnel as fn

# events_out_of_order: purchase before cart before view; cart without view;
# events_null_dims: NULL brand / category; events_zero_views: purchases only.
ROWS = [
    (1, "2024-01-01 10:00:30", 1, "purchase", 10, "tv", "acme", 5.00),
    (2, "2024-01-01 10:01:00", 1, "cart", 10, "tv", "acme", 5.00),
    (3, "2024-01-01 10:02:00", 1, "view", 10, "tv", "acme", 5.00),
    (4, "2024-01-01 10:00:00", 2, "cart", 10, "tv", "acme", 5.00),          # cart, no view
    (5, "2024-01-01 10:00:00", 3, "view", 11, None, "acme", 1.00),          # NULL category
    (6, "2024-01-01 10:00:00", 3, "view", 12, "phone", None, 1.00),         # NULL brand
    (7, "2024-01-01 11:00:00", 4, "purchase", 13, "phone", "solo", 9.00),   # purchases only
    (8, "2024-01-01 11:00:05", 4, "purchase", 13, "phone", "solo", 9.00),
    (9, "2024-01-01 10:05:00", 1, "view", 10, "tv", "acme", 5.00),          # later view: first kept
]


def test_first_touch_negative_durations(spark):
    t = by(fn.first_touch(make_events(spark, ROWS)).collect(), "user_id", "product_id")
    u1 = t[(1, 10)]
    assert (u1.has_view, u1.has_cart, u1.has_purchase) == (1, 1, 1)
    assert u1.view_to_cart_seconds == -60          # cart before view
    assert u1.cart_to_purchase_seconds == -30
    assert u1.view_to_purchase_seconds == -90
    u2 = t[(2, 10)]
    assert (u2.has_view, u2.has_cart) == (0, 1)
    assert u2.view_to_cart_seconds is None


def test_open_funnel_rates_and_dropoff(spark):
    b = by(fn.funnel_by_brand(make_events(spark, ROWS)).collect(), "brand")
    acme = b["acme"]
    # viewers: users 1 and 3; carts: users 1 and 2 (no view needed)
    assert (acme.users_viewed, acme.users_added_to_cart, acme.users_purchased) == (2, 2, 1)
    assert acme.view_to_cart_rate == 1.0
    assert acme.cart_to_purchase_rate == 0.5
    solo = b["solo"]   # zero viewers, zero carts -> guarded rates are 0
    assert (solo.users_viewed, solo.users_purchased) == (0, 1)
    assert solo.view_to_cart_rate == 0.0 and solo.view_to_purchase_rate == 0.0
    assert solo.cart_to_purchase_dropoff == 0.0
    assert None not in b                 # NULL brand dropped


def test_rate_above_one_negative_dropoff(spark):
    rows = [(1, "2024-01-01 10:00:00", 1, "view", 1, "c", "b", 1),
            (2, "2024-01-01 10:00:00", 2, "cart", 1, "c", "b", 1),
            (3, "2024-01-01 10:00:00", 3, "cart", 1, "c", "b", 1)]
    r = fn.funnel_by_brand(make_events(spark, rows)).collect()[0]
    assert r.view_to_cart_rate == 2.0
    assert r.view_to_cart_dropoff == -1.0


def test_category_keeps_null_group_and_records(spark):
    ev = make_events(spark, ROWS)
    c = by(fn.funnel_by_category(ev).collect(), "category_code")
    assert None in c and c[None].users_viewed == 1
    recs = fn.funnel_records(ev, "20240201_000000", "2024-02-01 00:00:00").collect()
    keys = {r.row_key for r in recs}
    assert "20240201_000000_category_unknown" in keys
    assert "20240201_000000_brand_acme" in keys
    r = by(recs, "row_key")["20240201_000000_brand_acme"]
    assert r.avg_view_to_cart_seconds == -60 and r.cart_to_purchase_rate == 0.5


def test_mean_duration_over_user_product_rows(spark):
    # two products of one brand for the same user: the mean is over both rows
    rows = [(1, "2024-01-01 10:00:00", 1, "view", 1, "c", "b", 1),
            (2, "2024-01-01 10:00:10", 1, "cart", 1, "c", "b", 1),
            (3, "2024-01-01 10:00:00", 1, "view", 2, "c", "b", 1),
            (4, "2024-01-01 10:00:30", 1, "cart", 2, "c", "b", 1)]
    r = fn.funnel_by_brand(make_events(spark, rows)).collect()[0]
    assert r.users_viewed == 1
    assert r.avg_view_to_cart_seconds == 20.0
