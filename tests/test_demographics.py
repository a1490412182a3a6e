import datetime as dt

from pyspark.sql import functions as F

from conftest import make_users

from clickflow.functions.demographics import age_band_a, age_band_b, calendar_age, exact_age
from clickflow.operators import dims

AS_OF = dt.date(2024, 2, 1)


def _age_rows(spark, births):
    u = make_users(spark, [(i, f"u{i}", b, "X") for i, b in enumerate(births)])
    a = exact_age(F.col("birth_date"), AS_OF)
    return u.select("user_id", a.alias("age"), age_band_a(a).alias("band")).orderBy("user_id").collect()


def test_band_a_boundaries(spark):
    # users_edge_ages: 17, 24, 25, 34, 35, 54, 55, unknown, birthday on as_of
    births = ["2006-06-01", "1999-06-01", "1998-06-01", "1989-06-01", "1988-06-01",
              "1969-06-01", "1968-06-01", None, "1999-02-01"]
    rows = _age_rows(spark, births)
    assert [r.age for r in rows[:7]] == [17, 24, 25, 34, 35, 54, 55]
    assert [r.band for r in rows] == ["18-24", "18-24", "25-34", "25-34", "35-44", "45-54",
                                      "55+", "55+", "18-24"]
    assert rows[7].age is None
    # 25th birthday on as_of: 9131 days / 365.25 = 24.9993 -> 24 (the day-count
    # formula lags calendar age around birthdays; kept as defined)
    assert rows[8].age == 24


def test_band_b_calendar_age(spark):
    u = make_users(spark, [(1, "a", "1998-12-31", "X"), (2, "b", "1988-01-01", "X"),
                           (3, "c", "1973-06-01", "X"), (4, "d", "1970-01-01", "X")])
    a = calendar_age(F.col("birth_date"), AS_OF)
    got = [r.b for r in u.select(age_band_b(a).alias("b")).orderBy("user_id").collect()]
    assert got == ["26-35", "36-50", "50+", "50+"]   # 26, 36, 51, 54


def test_user_demographics_counts(spark):
    u = make_users(spark, [(1, "a", "2000-01-01", "Oslo"), (2, "b", "2001-01-01", "Oslo"),
                           (3, "c", "1960-01-01", "Rome")])
    r = {(x.city, x.age_group): x.users_count for x in dims.user_demographics(u, AS_OF).collect()}
    assert r == {("Oslo", "18-25"): 2, ("Rome", "50+"): 1}
