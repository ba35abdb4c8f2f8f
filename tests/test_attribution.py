import pytest
from pyspark.sql import Window, functions as F

from conftest import rows, same_rows
from cohortline.operators import attribution as at
from cohortline.operators import identity as ids

OWN = at.OwnSites(("own.example",), ("own.example",), "mail.own.example", "accounts.google.com")
TOUCH = "initial_referrer string, initial_referring_domain string, utm_source string, utm_medium string, utm_campaign string"

FIRST = [
    (("https://accounts.google.com/", None, None, None, None), "Google Oauth"),
    (("https://accounts.google.com/", "accounts.google.com", None, "cpc", None), "Paid Search"),
    (("x", "ad.doubleclick.net", None, "banner", None), "Display"),
    (("x", "ad.doubleclick.net", None, None, None), "External Referral"),  # null medium is not "lacks paid-social"
    (("x", "x.example", None, "paid-social", "display"), "External Referral"),
    (("x", "x.example", "EMAIL", None, None), "Email"),
    (("https://mail.own.example/", None, None, None, None), "Email"),
    (("x", "www.google.com", None, "PPC", None), "Paid Search"),
    (("x", None, None, "ppc", "search-display"), "Display"),
    (("https://www.facebook.com", "facebook.com", None, None, None), "Owned Social"),
    (("https://t.co/a", "t.co", None, "social", None), "Owned Social"),
    (("https://WWW.FACEBOOK.com", "f.example", None, None, None), "External Referral"),  # site names are case-sensitive
    (("x", "x.example", "gaggle", "Gaggle", None), "Owned Social"),
    (("x", "x.example", "linkedin", "Paid Social", None), "Paid Social"),
    (("x", "x.example", None, "paid social", None), "Paid Social"),
    (("x", "www.bing.com", None, None, None), "Organic Search"),
    (("x", "docs.own.example", None, None, None), "Internal Referral"),
    (("x", "other.example", None, None, None), "External Referral"),
    (("$direct", "$direct", "news", None, None), "External Referral"),
    (("$direct", None, None, None, None), "Direct"),
    ((None, None, None, None, None), None),
]
LAST = [
    ("", "Direct or N/A"),
    ("https://a/?campaign=x-display", "Display"),
    ("https://a/?utm_medium=banner&utm_medium=paid-social", "External Referral"),
    ("https://a/?utm_source=Email", "Email"),
    ("https://a/?utm_campaign=search", "Paid Search"),
    ("https://a/?utmXmedium=cpc", "Paid Search"),  # the underscore matches any character
    ("https://www.facebook.com/?utm_medium=paid", "Paid Social"),
    ("https://www.facebook.com/?utm_medium=cpc&utm_campaign=display", "Display"),
    ("https://www.twitter.com/", "Owned Social"),
    ("https://www.twitter.com/?utm_medium=social", "Owned Social"),
    ("https://b/?gaggle&utm_medium=other", "External Referral"),
    ("https://www.google.com/", "Organic Search"),
    ("https://own.example/docs", "Internal Referral"),
    ("https://else.example/", "External Referral"),
    ("$direct", None),
    (None, None),
]


@pytest.mark.parametrize("touch, channel", FIRST)
def test_first_touch_channel(spark, touch, channel):
    assert spark.createDataFrame([touch], TOUCH).select(at.first_touch_channel(OWN)).first()[0] == channel


def test_first_touch_channel_without_oauth(spark):
    own = at.OwnSites(("own.example",), ("own.example",), "mail.own.example", None)
    frame = spark.createDataFrame([("https://accounts.google.com/", "accounts.google.com", None, None, None)], TOUCH)
    assert frame.select(at.first_touch_channel(own)).first()[0] == "Organic Search"


@pytest.mark.parametrize("referrer, channel", LAST)
def test_last_touch_channel(spark, referrer, channel):
    frame = spark.createDataFrame([(referrer,)], "r string")
    assert frame.select(at.last_touch_channel(F.col("r"), OWN)).first()[0] == channel


def test_first_touch_equals_the_window_form(views):
    pv = views.page_views()
    w = Window.partitionBy("distinct_id").orderBy("mp_processing_time_ms", *at.TOUCH)
    windowed = pv.select("distinct_id", "mp_processing_time_ms", *at.TOUCH, F.row_number().over(w).alias("n")).where("n = 1").drop("n")
    same_rows(at.first_touch(pv, "distinct_id", "mp_processing_time_ms", at.TOUCH), windowed)


def test_first_touch_ties_and_null_times(spark):
    frame = spark.createDataFrame([("a", 5, "z"), ("a", 5, "b"), ("b", None, "n"), ("b", 1, "m"), (None, 1, "x")], "k string, t long, v string")
    assert rows(at.first_touch(frame, "k", "t", ["v"])) == sorted([("a", 5, "b"), ("b", None, "n"), (None, 1, "x")], key=repr)


def test_first_touch_by_email_pre_cut_equals_joining_everything(views):
    pv, pairs = views.page_views(), ids.email_pairs(views.event_log())
    everything = pv.join(pairs.withColumnRenamed("email_address", "email"), "distinct_id")
    full = at.first_touch(everything, "email", "time", at.PROFILE).drop("time").withColumnsRenamed(
        {"mp_country_code": "mp_country", "region": "mp_region"})
    same_rows(at.first_touch_by_email(pv, pairs), full)


def test_daily_visitors_equals_first_of_visitors(views):
    from cohortline.sources import stand_in as s

    pv = views.page_views()
    args = (pv, at.first_touch_by_device(pv), s.LANDING_PATHS, s.EVENT_START, s.EVENT_AS_OF, s.OWN)
    w = Window.partitionBy("distinct_id", "visited_date").orderBy("visited_time", "referrer", "referring_domain", "mp_country_code")
    first = at.visitors(*args).select("*", F.row_number().over(w).alias("n")).where("n = 1")
    pick = ["distinct_id", "visited_date", "last_touch_channel", "first_touch_channel"]
    assert rows(at.daily_visitors(*args), *pick) == rows(first, *pick)
