"""Builders of hand-made input rows."""

import datetime as dt

from visitlens.schemas import USER_INFO, USER_VISIT_ACTION

BASE_DAY = dt.date(2019, 8, 7)


def action(session_id, user_id, time, page_id=0, keyword=None, click_cat=None,
           click_prod=None, order_cats=None, order_prods=None, pay_cats=None,
           pay_prods=None, city_id=0, event_id=0, day=BASE_DAY):
    return (day, user_id, session_id, page_id, f"{day.isoformat()} {time}", keyword,
            click_cat, click_prod, order_cats, order_prods, pay_cats, pay_prods,
            city_id, event_id)


def actions_df(spark, rows):
    # give every row a unique event id in input order unless set
    fixed = [r[:-1] + (r[-1] or i,) for i, r in enumerate(rows, start=1)]
    return spark.createDataFrame(fixed, USER_VISIT_ACTION)


def users_df(spark, rows):
    return spark.createDataFrame(rows, USER_INFO)


def user(user_id, age=30, professional="p", city="c", sex="male"):
    return (user_id, f"u{user_id}", f"u{user_id}", age, professional, city, sex)


def secs(n):
    """'H:mm:ss' for n seconds after 5:00:00 (one-digit hour on purpose)."""
    t = dt.datetime(2000, 1, 1, 5) + dt.timedelta(seconds=n)
    return f"{t.hour}:{t.minute:02d}:{t.second:02d}"
