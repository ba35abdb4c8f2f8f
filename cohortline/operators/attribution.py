"""First- and last-touch attribution and visit-to-registration matching."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from cohortline.functions import times
from cohortline.functions.text import any_of, has

TOUCH = ("initial_referrer", "initial_referring_domain", "utm_source", "utm_medium", "utm_campaign")
PROFILE = ("device_id", "mp_country_code", "region", "utm_source", "utm_medium", "utm_campaign",
           "initial_referrer", "initial_referring_domain")

# Words and codes the channel rules look for.
PAID_CLICKS = ("cpc", "ppc")
ENGINES = ("google", "bing", "yandex", "baidu", "duckduckgo")
NETWORKS = ("facebook", "linkedin", "twitter")
SHORT_LINK = "//t.co"
ADVOCACY = "gaggle"
DIRECT = "$direct"


@dataclass(frozen=True)
class OwnSites:
    """The product's own hosts; they decide what is internal."""

    domains: tuple[str, ...] = ("example.com",)
    referrer_domains: tuple[str, ...] = ("example.com",)
    mail_host: str = "mail.example.com"
    oauth_host: str | None = "accounts.google.com"


def touch_events(
    sources: Sequence[DataFrame], tenant: str, times: Sequence[str] = ("time", "mp_processing_time_ms"),
    attributes: Sequence[str] = PROFILE, distinct: bool = False,
) -> DataFrame:
    """One tenant's visits from several event tables (page views, navigation), with what first touches read.

    ``distinct`` drops repeated rows within each table. First touches do not
    need it: a minimum is the same over repeated rows, and needs no shuffle of the facts.
    """
    parts = [f.where(F.col("project_id") == tenant).select("distinct_id", *times, *attributes) for f in sources]
    parts = [p.distinct() if distinct else p for p in parts]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def first_touch(events: DataFrame, key: str, time: str, attributes: Sequence[str]) -> DataFrame:
    """All attributes of the earliest event per key, in one pass that combines before the shuffle.

    Equal times are settled by the attributes themselves, smallest (null) first.
    """
    row = F.min(F.struct(F.col(time), *[F.col(a) for a in attributes])).alias("_first")
    return events.groupBy(key).agg(row).select(
        key, F.col("_first")[time].alias(time), *[F.col("_first")[a].alias(a) for a in attributes]
    )


def first_touch_by_email(events: DataFrame, identity: DataFrame, attributes: Sequence[str] = PROFILE) -> DataFrame:
    """First touch over all ids of an e-mail.

    Ids are cut to their own first event before meeting the identity map, so
    the join sees one row per id however busy the id was.
    """
    per_id = first_touch(events.where(F.col("distinct_id").isNotNull()), "distinct_id", "time", attributes)
    pairs = identity.select("distinct_id", F.col("email_address").alias("email")).distinct()
    touched = first_touch(per_id.join(pairs, "distinct_id"), "email", "time", attributes)
    return touched.drop("time").withColumnsRenamed({"mp_country_code": "mp_country", "region": "mp_region"})


def first_touch_by_device(events: DataFrame) -> DataFrame:
    """First touch per id with the date of the first visit."""
    touched = first_touch(events, "distinct_id", "mp_processing_time_ms", TOUCH)
    visit = F.to_date(F.timestamp_millis("mp_processing_time_ms")).alias("first_visit")
    return touched.select("distinct_id", visit, *TOUCH)


def _first_match(rules: Sequence[tuple[str, Column]]) -> Column:
    chain = F.when(rules[0][1], rules[0][0])
    for label, condition in rules[1:]:
        chain = chain.when(condition, label)
    return chain


def first_touch_channel(own: OwnSites = OwnSites()) -> Column:
    """Channel of a first touch, from the ``TOUCH`` columns; first rule that holds, else null.

    Comparisons with a null are unknown, not false: a null medium keeps a row
    out of "Display". Without an OAuth host the rule for it is left out.
    """
    referrer, medium = F.col("initial_referrer"), F.col("utm_medium")
    no_medium, campaign = medium.isNull(), F.col("utm_campaign")
    r, d, s, m, c = (F.lower(x) for x in TOUCH)
    clicks = m.isin(*PAID_CLICKS)
    social_site = has(referrer, *NETWORKS, SHORT_LINK)
    rules = [
        ("Display", (has(c, "display") | has(d, "doubleclick") | (m == "banner")) & ~has(m, "paid-social")),
        ("Email", has(s, "email") | has(m, "email") | has(r, own.mail_host)),
        ("Paid Search", (has(c, "search") | clicks) & (~has(c, "display") | campaign.isNull())),
        ("Owned Social", ((m == "social") | has(s, ADVOCACY) | social_site)
                         & ((medium == "social") | no_medium | has(m, ADVOCACY))),
        ("Paid Social", (has(s, *NETWORKS) | (m == "paid social")) & (has(m, "paid") | clicks)),
        ("Organic Search", has(d, *ENGINES) & (~m.isin(*PAID_CLICKS, "banner") | no_medium)),
        ("Internal Referral", has(d, *own.domains)),
        ("External Referral", (d.isNotNull() & (r != DIRECT)) | ((r == DIRECT) & F.col("utm_source").isNotNull())),
        ("Direct", referrer == DIRECT),
    ]
    if own.oauth_host:
        oauth = has(r, own.oauth_host) & (~medium.isin(*PAID_CLICKS) | no_medium)
        rules.insert(0, ("Google Oauth", oauth))
    return _first_match(rules)


def last_touch_channel(referrer: Column, own: OwnSites = OwnSites()) -> Column:
    """Channel of a last touch, read off the referrer string alone."""
    r = F.lower(referrer)

    def tag(*patterns: str) -> Column:
        return any_of(r.like(f"%{p}%") for p in patterns)

    clicks = tag("utm_medium%cpc", "utm_medium%ppc")
    social_site = has(r, ADVOCACY) | has(referrer, *NETWORKS, SHORT_LINK)
    # The last term compares with '=', so only a referrer spelled exactly like this meets it.
    paid_site = social_site | (r == "%utm_medium%paid%social%")
    rules = [
        ("Direct or N/A", referrer == ""),
        ("Display", (tag("campaign%display", "utm_medium%banner") | has(r, "doubleclick")) & ~tag("utm_medium%paid-social")),
        ("Email", tag("utm_%email") | has(r, own.mail_host)),
        ("Paid Search", (tag("utm_campaign%search") | clicks) & (~tag("utm_campaign%display") | ~tag("utm_campaign"))),
        ("Paid Social", paid_site & (tag("utm_medium%paid") | clicks)),
        ("Owned Social", social_site & (tag("utm_medium%social", "utm_medium%" + ADVOCACY) | ~tag("utm_medium"))),
        ("Organic Search", has(r, *ENGINES) & ~clicks),
        ("Internal Referral", has(r, *own.referrer_domains)),
        ("External Referral", (r != DIRECT) | ((r == DIRECT) & tag("utm_source"))),
    ]
    return _first_match(rules)


def page_visits(page_views: DataFrame, paths: Sequence[str], start: date | str, as_of: datetime | str) -> DataFrame:
    """Views of the listed pages between ``start`` and ``as_of``, both included."""
    low = F.unix_millis(times.instant(start))
    high = F.unix_millis(times.instant(as_of))
    return page_views.where(
        F.col("pathname").isin(*paths) & F.col("mp_processing_time_ms").between(low, high)
    )


def visitors(
    page_views: DataFrame, touched: DataFrame, paths: Sequence[str], start: date | str, as_of: datetime | str,
    own: OwnSites = OwnSites(),
) -> DataFrame:
    """Visits to the listed pages with the visitor's first touch and the visit's own channel."""
    seen = F.timestamp_millis("mp_processing_time_ms")
    visits = page_visits(page_views, paths, start, as_of).select(
        "distinct_id", F.to_date(seen).alias("visited_date"), seen.alias("visited_time"), "pathname",
        "referrer", "referring_domain", "mp_country_code",
    )
    first = touched.select("*", first_touch_channel(own).alias("first_touch_channel"))
    return visits.join(first, "distinct_id").distinct().select(
        "distinct_id", "first_visit", "visited_date", "visited_time", "pathname", *TOUCH, "first_touch_channel",
        "referrer", "referring_domain",
        last_touch_channel(F.col("referrer"), own).alias("last_touch_channel"), "mp_country_code",
    )


def daily_visitors(
    page_views: DataFrame, touched: DataFrame, paths: Sequence[str], start: date | str, as_of: datetime | str,
    own: OwnSites = OwnSites(),
) -> DataFrame:
    """One row per visitor and day: new or returning, first touch, and the day's first visit.

    Visits are cut to the first of the day before the join, and channels are
    worked out on what is left.
    """
    seen = F.timestamp_millis("mp_processing_time_ms")
    attributes = ("referrer", "referring_domain", "mp_country_code")
    per_day = (
        page_visits(page_views, paths, start, as_of)
        .groupBy("distinct_id", F.to_date(seen).alias("visited_date"))
        .agg(F.min(F.struct("mp_processing_time_ms", *attributes)).alias("_v"))
    )
    first, day = F.col("first_visit"), F.col("visited_date")
    return per_day.join(touched, "distinct_id").select(
        "distinct_id", "first_visit", "visited_date",
        F.when(day > first, "Returning").when(day == first, "New").alias("user_type"),
        F.col("initial_referrer").alias("first_touch_referrer"),
        F.col("initial_referring_domain").alias("first_touch_referring_domain"),
        *[F.col(c).alias(f"first_touch_{c}") for c in ("utm_source", "utm_medium", "utm_campaign")],
        first_touch_channel(own).alias("first_touch_channel"),
        F.col("_v.referrer").alias("last_touch_referrer"),
        F.col("_v.referring_domain").alias("last_touch_referring_domain"),
        last_touch_channel(F.col("_v.referrer"), own).alias("last_touch_channel"),
        F.col("_v.mp_country_code").alias("mp_country_code"),
    )


def registrations_by_id(users: DataFrame, identity: DataFrame) -> DataFrame:
    """Distinct (id, registration date), through the e-mails of the identity map."""
    pairs = identity.select("distinct_id", F.col("email_address").alias("email")).distinct()
    days = users.select("email", F.to_date("user_created_at").alias("registered_date")).distinct()
    return pairs.join(days, "email").select("distinct_id", "registered_date").distinct()


def attribute_registration(daily: DataFrame, registers: DataFrame) -> DataFrame:
    """Adds ``registered_id``: the visitor's id if the visitor registered on the day of the visit."""
    r = registers.where("registered_date is not null").select(
        "distinct_id", F.col("registered_date").alias("visited_date"), F.lit(True).alias("_registered")
    )
    return (
        daily.join(r, ["distinct_id", "visited_date"], "left")
        .select(*daily.columns, F.when(F.col("_registered"), F.col("distinct_id")).alias("registered_id"))
        .orderBy("distinct_id", "first_visit", "visited_date")
    )
