import datetime as dt

from conftest import by, make_events, make_products, make_users

from clickflow.operators import brands as br
from clickflow.operators import recommend as rc

AS_OF = dt.date(2024, 2, 1)
USERS = [(1, "a", "2000-01-01", "X"),   # 24 -> 18-24
         (2, "b", "2000-06-01", "X"),   # 23 -> 18-24
         (3, "c", "1980-01-01", "Y")]   # 44 -> 35-44


def test_score_ties_and_top_k(spark):
    # score_ties: 12 products with one view each from user 1 -> all score 1;
    # product 99 viewed by both young users -> score 2 ranks first
    rows = [(i, "2024-01-10 10:00:00", 1, "view", 100 - i, "c", "b", 1) for i in range(1, 13)]
    rows += [(20, "2024-01-10 10:00:00", 2, "view", 99, "c", "b", 1)]
    ev = make_events(spark, rows)
    seg = rc.user_segments(make_users(spark, USERS), AS_OF)
    prods = make_products(spark, [(99, None, "c", "c", "c", "b", 1.0), (98, "p98", "c", "c", "c", "b", 1.0)])
    recs = sorted(rc.recommend(ev, seg, prods).collect(), key=lambda r: r["rank"])
    assert len(recs) == 10
    assert recs[0].product_id == 99 and recs[0].views == 2 and recs[0].recommendation_score == 2
    # ties broken by product_id ascending
    assert [r.product_id for r in recs[1:]] == [88, 89, 90, 91, 92, 93, 94, 95, 96]
    wide = rc.recommendation_records(rc.recommend(ev, seg, prods), "run", "2024-02-01").collect()[0]
    assert wide.rank_1_product_name == "Unknown"      # NULL name -> Unknown
    assert wide.row_key == "run_segment_18-24"


def test_distinct_users_not_events(spark):
    rows = [(1, "2024-01-10 10:00:00", 1, "view", 5, "c", "b", 1),
            (2, "2024-01-10 10:01:00", 1, "view", 5, "c", "b", 1),
            (3, "2024-01-10 10:02:00", 1, "cart", 5, "c", "b", 1),
            (4, "2024-01-10 10:03:00", 1, "purchase", 5, "c", "b", 7.5),
            (5, "2024-01-10 10:04:00", 1, "purchase", 5, "c", "b", 2.5),
            (6, "2024-01-10 10:04:00", 77, "view", 5, "c", "b", 1)]   # unknown user: dropped
    ev = make_events(spark, rows)
    seg = rc.user_segments(make_users(spark, USERS), AS_OF)
    s = rc.segment_product_stats(ev, seg).collect()
    assert len(s) == 1
    r = s[0]
    assert (r.views, r.add_to_cart, r.purchases) == (1, 1, 1)
    assert r.recommendation_score == 8 and r.total_revenue == 10.0
    act = rc.segment_activity(ev, seg).collect()
    assert act[0].events_count == 5


def test_brand_age_left_join_unknown_user(spark):
    rows = [(1, "2024-01-10 10:00:00", 1, "view", 5, "c", "acme", 1),
            (2, "2024-01-10 10:00:00", 77, "view", 5, "c", "acme", 1),     # unmatched -> 55+
            (3, "2024-01-10 10:00:00", None, "purchase", 5, "c", "acme", 4),  # NULL user -> 55+
            (4, "2024-01-10 10:00:00", 3, "view", 5, "c", None, 1)]        # NULL brand dropped
    m = by(br.brand_age_metrics(make_events(spark, rows), make_users(spark, USERS), AS_OF).collect(),
           "brand", "age_group")
    assert set(m) == {("acme", "18-24"), ("acme", "55+")}
    old = m[("acme", "55+")]
    assert old.unique_users == 1          # NULL user not counted as a user
    assert old.total_views == 1 and old.total_purchases == 1
    assert old.total_revenue == 4.0 and old.overall_conversion_rate == 1.0
    young = m[("acme", "18-24")]
    assert young.total_revenue == 0.0 and young.overall_conversion_rate == 0.0


def test_brand_user_metrics_dominant_age(spark):
    rows = [(1, "2024-01-10 10:00:00", 1, "view", 5, "c", "acme", 1),
            (2, "2024-01-10 10:00:00", 3, "view", 5, "c", "acme", 1),
            (3, "2024-01-10 10:00:00", 3, "purchase", 5, "c", "acme", 3),
            (4, "2024-01-10 10:00:00", 2, "cart", 5, "c", "acme", 1),
            (5, "2024-01-10 10:00:00", 1, "view", 6, "c", "zeta", 1),
            (6, "2024-01-10 10:00:00", 3, "view", 6, "c", "zeta", 1)]
    seg = rc.user_segments(make_users(spark, USERS), AS_OF)
    m = by(br.brand_user_metrics(make_events(spark, rows), seg).collect(), "brand")
    a = m["acme"]
    assert (a.unique_users, a.viewers, a.cart_users, a.buyers) == (3, 2, 1, 1)
    assert (a.total_views, a.total_cart_adds, a.total_purchases) == (2, 1, 1)
    assert a.view_to_cart_rate == 0.5 and a.overall_conversion_rate == 0.5
    assert a.age_group == "18-24"                 # 2 events 18-24 vs 2 events 35-44: tie -> smaller
    z = m["zeta"]
    assert z.total_revenue is None                # no purchase -> NULL revenue
    assert z.age_group == "18-24"                 # tie 1:1 -> smaller label
    top = br.brand_top_records(br.brand_user_metrics(make_events(spark, rows), seg), "r", "2024-02-01").collect()
    assert [t.brand for t in top] == ["acme", "zeta"] and top[1].total_revenue == 0.0


def test_top_brand_restriction(spark):
    rows = [(i, "2024-01-10 10:00:00", 1, "purchase", i, "c", f"b{i}", i) for i in range(1, 6)]
    m = br.brand_age_metrics(make_events(spark, rows), make_users(spark, USERS), AS_OF)
    kept = {r.brand for r in br.restrict_to_top_brands(m, 2).collect()}
    assert kept == {"b5", "b4"}
