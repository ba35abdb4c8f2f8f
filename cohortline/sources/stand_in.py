"""Product-analytics views over the driver's tables, for checks and the bench.

Each view is a deterministic, narrow derivation of one or two driver tables;
``FIXTURES.md`` describes them and ``oracle/views.py`` has the same in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortline.operators.attribution import OwnSites
from cohortline.operators.events import EVENT_SHAPES
from cohortline.operators.querylog import ClientRules
from cohortline.plans.users import UserRules, UserTables

ASSET_AS_OF = "2001-09-01 00:00:00"
# The day of the first asset: a later start would leave out creations but not the destructions after it.
ASSET_START = "1995-01-01"
EVENT_AS_OF = "2024-02-01 00:00:00"
EVENT_START = "2024-01-01"
TENANT = "t1"
INTERNAL_DOMAINS = ("@d7.example", "@d13.example")
INTERNAL_DOMAIN_NAMES = ("d7.example", "d13.example")
OWN = OwnSites(
    domains=("own.example", "corp.example", "live.example", "console.example"),
    referrer_domains=("own.example", "corp.example"),
    mail_host="mail.own.example",
    oauth_host="accounts.google.com",
)
LANDING_PATHS = ("https://own.example/product/", "https://own.example/product/pricing/")
CLIENTS = ClientRules()
TOOL_AGENTS = ("query-console", "explorer")
NON_PROGRAMMATIC_AGENTS = ("Embedded Session", "query-console", "explorer", "desktop", "shell")

# Event names in the order the views number them.
EVENT_NAMES = (
    "LOGIN", "open_db", "open_db", "navigate_to_create-database", "navigate_to_step1", "navigate_to_step2",
    "create_db", "navigate_to_import-instructions", "set_import_option", "next_step", "next_step", "next_step",
    "finish_import", "change_language", "help_link", "feedback_link", "navigate_to_databases/detail",
    "navigate_to_databases/detail/import", "navigate_to_databases/detail/connect",
    "navigate_to_databases/detail/snapshots", "navigate_to_databases/detail/settings", "expand_resize_db",
    "resize_db", "restore_db", "export_db_backup", "destroy_db", "navigate_to_account",
    "navigate_to_account/usage", "navigate_to_", "navigate_to_databases", "logout", "take_snapshot_db",
    "create_from_snapshot", "navigate_to_how-to-connect", "terms_accepted",
)
STEPS = ("Ensure admin command", "Run admin command", "Complete the process")
PIVOT_EVENTS = (
    "NAVIGATE_TO_LANDING_PAGE", "PAGE_SIGNUP_CLICK", "NAVIGATE_TO_", "LOGIN", "NAVIGATE_TO_CREATE_DATABASE",
    "CREATE_DB", "OPEN_DB", "NAVIGATE_TO_EMAIL_VERIFICATION_REQUIRED", "DESTROY_DB", "NAVIGATE_TO_HOW_TO_CONNECT",
    "NAVIGATE_TO_DATABASES", "CHANGE_LANGUAGE", "NAVIGATE_TO_IMPORT_INSTRUCTIONS", "FEEDBACK_LINK",
    "NAVIGATE_TO_ADD_PAYMENT", "ADD_PAYMENT",
)
# (initial referrer, referring domain, source, medium, campaign): every first-touch rule, overlaps and nulls.
TOUCHES = (
    ("https://accounts.google.com/o/", "accounts.google.com", None, None, None),
    ("https://accounts.google.com/o/", "accounts.google.com", None, "cpc", None),
    ("https://ad.doubleclick.net/", "ad.doubleclick.net", "net", "banner", "q1-display"),
    ("https://ad.doubleclick.net/", "ad.doubleclick.net", None, None, "q1-Display"),
    ("https://x.example/", "x.example", "x", "paid-social", "display"),
    ("https://x.example/", "x.example", "Email-list", "news", None),
    ("https://mail.own.example/a", "mail.own.example", None, None, None),
    ("https://www.google.com/", "www.google.com", "google", "cpc", "brand-search"),
    ("https://www.google.com/", "www.google.com", "google", "PPC", None),
    ("https://www.google.com/", "www.google.com", "google", "ppc", "search-display"),
    ("https://www.facebook.com/", "www.facebook.com", None, None, None),
    ("https://t.co/abc", "t.co", None, None, None),
    ("https://y.example/", "y.example", "GaggleAMP", "gaggle", None),
    ("https://y.example/", "y.example", "y", "social", None),
    ("https://www.linkedin.com/", "www.linkedin.com", "linkedin", "paid social", None),
    ("https://z.example/", "z.example", "twitter", "paid", None),
    ("https://www.bing.com/", "www.bing.com", None, None, None),
    ("https://duckduckgo.com/", "duckduckgo.com", None, "organic", None),
    ("https://console.example/", "console.example", None, None, None),
    ("https://else.example/", "else.example", None, None, None),
    ("$direct", "$direct", "newsletter", None, None),
    ("$direct", None, None, None, None),
    (None, None, None, None, None),
    ("https://www.facebook.com/", "www.facebook.com", "facebook", "cpc", "display"),
)
REFERRERS = (
    "", "https://a.example/?utm_campaign=q1-display", "https://ad.doubleclick.net/", "https://a.example/?utm_medium=banner",
    "https://a.example/?utm_medium=paid-social&utm_campaign=display", "https://a.example/?utm_source=email",
    "https://mail.own.example/", "https://a.example/?utm_campaign=search", "https://a.example/?utm_medium=cpc",
    "https://a.example/?utm_medium=ppc&utm_campaign=display", "https://www.facebook.com/?utm_medium=paid",
    "https://www.linkedin.com/?utm_medium=cpc&utm_campaign=display", "https://t.co/x", "https://b.example/gaggle",
    "https://www.twitter.com/?utm_medium=social", "https://www.google.com/", "https://www.bing.com/?q=1",
    "https://own.example/docs", "https://corp.example/", "https://else.example/", "$direct", None,
    "https://a.example/?utmXmedium=cpc", "%utm_medium%paid%social%",
)
PATHS = LANDING_PATHS + ("https://own.example/blog/",)
DRIVERS = ("pydriver/4.2.1 Python/3.8 (linux)", "godriver/1.8", "monitor/0.9 beta", "old driver 1.1", "service-registry")
ANNOTATIONS = ("{type: 'user-direct', app: 'console_v1'}", "{app: 'explorer_v2', type: 'user-action'}", "{}", None)
QUERIES = (
    "MATCH (n)\nRETURN n", "load csv from 'x' as r\ncreate (n)", " load CSV from 'y' as r", "merge (a) with a match (b)",
    "create (x)", "RETURN 1\n+ 2\n+ 3", "call proc() yield x match (y) create (z)", None,
)
AGENTS = ("query-console", "explorer", "pydriver", "Embedded Session", "godriver")
AGENT_VERSIONS = ("4.2", "dev", "0.0.0-dev")


def pick(values: Sequence, index: Column) -> Column:
    """``values[index]`` as a constant lookup."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


class StandIn:
    """The views at one scale-factor folder. Every call is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def email(key: Column) -> Column:
        return F.concat(F.lit("u"), key, F.lit("@"), StandIn.domain(key))

    @staticmethod
    def domain(key: Column) -> Column:
        return F.concat(F.lit("d"), key % 25, F.lit(".example"))

    @staticmethod
    def classification(key: Column) -> Column:
        return (
            F.when(key % 5 == 0, "Internal").when(key % 5 == 1, "External Private User").otherwise("External Company User")
        )

    # Assets and what hangs on them

    def assets(self, sequence: bool = False) -> DataFrame:
        dbid, user = F.col("o_orderkey"), F.col("o_custkey")
        hours = F.make_dt_interval(F.lit(0), (dbid % 24).cast("int"))
        orders = self.table("orders").select(
            dbid.alias("dbid"), user.alias("userkey"),
            (F.col("o_orderdate").cast("timestamp") + hours).alias("db_created_at"),
            (F.col("o_orderstatus") == "O").alias("_live"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("_p"),
        )
        life = F.make_dt_interval((F.col("dbid") * 37 % 200).cast("int"), (F.col("dbid") % 5).cast("int"))
        orders = orders.withColumn("db_destroyed_at", F.when(~F.col("_live"), F.col("db_created_at") + life))
        dbid, user = F.col("dbid"), F.col("userkey")
        end = F.coalesce("db_destroyed_at", F.lit(ASSET_AS_OF).cast("timestamp"))
        initial, recent = F.pow(F.lit(2.0), dbid % 4), F.pow(F.lit(2.0), (dbid + 2) % 4)
        out = orders.select(
            "dbid", "userkey", self.email(user).alias("email"), self.domain(user).alias("email_domain"),
            self.classification(user).alias("user_classification"),
            pick(("Enterprise", "Direct", "Free", "GCP", "GDS"), F.col("_p") - 1).alias("db_billing_identity"),
            pick(("enterprise", "professional", "free", "professional", "gds"), F.col("_p") - 1).alias("db_tier"),
            "db_created_at", "db_destroyed_at",
            initial.alias("initial_size_gb"), recent.alias("most_recent_size_gb"),
            (recent * 1024).alias("most_recent_size_mb"),
            F.concat(initial.cast("int"), F.lit("GB")).alias("initial_size_label"),
            (dbid % 3).alias("resize_count"),
            F.timestamp_diff("DAY", F.col("db_created_at"), end).alias("db_lifetime_days"),
            ((dbid % 400) / 4).alias("total_cost_dollars"),
            ((dbid % 100) / 4).alias("mrr_num"),
        )
        if not sequence:
            return out
        # Sequence 1 is a user's first asset, reverse sequence 1 the last; all others are 2.
        ends = out.groupBy("userkey").agg(
            F.min(F.struct("db_created_at", "dbid")).alias("_first"), F.max(F.struct("db_created_at", "dbid")).alias("_last")
        )
        return out.join(ends, "userkey").select(
            *out.columns,
            F.when(F.col("dbid") == F.col("_first.dbid"), 1).otherwise(2).alias("user_db_sequence"),
            F.when(F.col("dbid") == F.col("_last.dbid"), 1).otherwise(2).alias("user_db_rsequence"),
        )

    def first_assets(self) -> DataFrame:
        """Every user's first asset: the rows with sequence 1, found by a minimum instead of a join."""
        first = F.min(F.struct("db_created_at", "dbid", "db_billing_identity")).alias("_f")
        return self.assets().groupBy("userkey").agg(first).select("userkey", "_f.*", F.lit(1).alias("user_db_sequence"))

    def size_history(self) -> DataFrame:
        v = F.col("version")
        start = F.col("db_created_at") + F.make_dt_interval(v * 30)
        stop = F.col("db_created_at") + F.make_dt_interval((v + 1) * 30)
        born = self.assets().select("dbid", "db_created_at")
        return born.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("version")).select(
            "dbid",
            (F.pow(F.lit(2.0), (F.col("dbid") + v) % 4) * 1024).alias("db_size"),
            start.alias("ts_effective_from"),
            F.when(v < 2, stop).otherwise(F.lit("9999-12-31 00:00:00").cast("timestamp")).alias("ts_effective_thru"),
        )

    def _lineitem(self) -> DataFrame:
        return self.table("lineitem").withColumn("_ship", F.col("l_shipdate").cast("timestamp"))

    def billing_hours(self) -> DataFrame:
        return self._lineitem().select(
            F.col("l_orderkey").alias("dbid"),
            (F.col("_ship") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias("hour_of_day"),
            F.col("l_quantity").alias("memory_gb"),
        )

    def asset_minutes(self) -> DataFrame:
        return self._lineitem().select(
            F.col("l_orderkey").alias("dbid"), F.col("_ship").alias("minute"),
            (F.col("l_linenumber") % 3).alias("imputed_net_user_queries"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("imputed_load_statements"),
            (F.col("l_linenumber") % 3).alias("queries_completed"),
        )

    def agent_facts(self) -> DataFrame:
        return self._lineitem().select(
            F.col("l_orderkey").alias("dbid"), F.col("_ship").alias("minute"),
            pick(AGENTS, F.col("l_suppkey") % 5).alias("user_agent_name"),
            pick(AGENT_VERSIONS, F.col("l_partkey") % 3).alias("user_agent_version"),
        )

    def dump_uploads(self) -> DataFrame:
        e = self.table("events").where("event_type = 'purchase'")
        return e.select(self.email(F.col("user_id")).alias("owner"), F.col("ts").cast("timestamp").alias("timestamp"))

    # Users, plans, CRM

    def users(self) -> DataFrame:
        born = self.assets().groupBy("userkey").agg(F.min("db_created_at").alias("_born"))
        key = F.col("c_custkey")
        plan = F.when(key % 4 != 0, pick(("free", "self_serve", "enterprise"), key % 3))
        created = F.coalesce("_born", F.lit("1995-01-01 00:00:00").cast("timestamp"))
        c = self.table("customer").withColumn("userkey", key)
        return c.join(born, "userkey", "left").select(
            "userkey", self.email(key).alias("email"), self.domain(key).alias("email_domain"),
            self.classification(key).alias("user_classification"),
            (created - F.make_dt_interval((key % 10).cast("int"))).alias("createdat"),
            plan.alias("PlanType"),
        )

    def users_narrow(self) -> DataFrame:
        key, moment = F.col("userkey"), F.col("createdat")
        return self.users().select(
            "email", "userkey", "user_classification", moment.alias("user_created_at"),
            (key % 3).alias("total_db_count"),
            F.when(key % 2 == 0, moment).alias("first_query"), F.when(key % 5 == 0, moment).alias("first_load"),
        )

    def snapshots(self) -> DataFrame:
        key, v = F.col("c_custkey"), F.col("v")
        rows = self.table("customer").select(key, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("v"))
        month = F.make_date(F.lit(2000), ((key + v) % 3 + 1).cast("int"), F.lit(1)).cast("timestamp")
        return rows.select(
            F.struct(F.concat(F.lit('User, "'), key, F.lit('"')).alias("path")).alias("__key__"),
            month.alias("snapshottime"),
            pick(("free", None, "enterprise", "self_serve"), (key + 2 * v) % 4).alias("PlanType"),
        )

    def contacts(self) -> DataFrame:
        k = F.col("s_suppkey")
        owner = k % 40
        return self.table("supplier").select(
            F.concat(F.lit("c"), k).alias("id"), F.col("s_name").alias("name"),
            pick(("CTO", None, "Engineer", "Analyst"), k % 4).alias("title"),
            F.concat(F.lit("a"), F.col("s_nationkey")).alias("account_id"),
            F.when(k % 9 != 0, self.email(owner)).alias("email"),
        )

    def accounts(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.table("nation").where(k % 6 != 5).select(
            F.concat(F.lit("a"), k).alias("id"), F.col("n_name").alias("name"),
            pick(("Retail", "Energy", None), k % 3).alias("industry"),
            pick(("Customer", "Prospect"), k % 2).alias("type"), (k * 1000.0).alias("annual_revenue"),
        )

    def leads(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            F.concat(F.lit("l"), k).alias("id"), F.col("c_name").alias("name"),
            pick(("Retail", "Energy", None), k % 3).alias("industry"),
            pick(("CTO", None, "Engineer", "Analyst"), k % 4).alias("title"),
            F.when(k % 11 != 0, self.email(k % 200)).alias("email"),
            F.when(k % 3 == 0, F.concat(F.lit("c"), k)).alias("converted_contact_id"),
        )

    def helpdesk(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").where(k % 4 == 1).select(
            self.email(k).alias("email"), F.concat(F.lit("h"), k).alias("id"),
            pick(("vip", None), k % 2).alias("tags"),
        )

    def subjects(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").where(k % 7 != 0).select(
            k.alias("userkey"), F.concat(F.lit("subject-"), k).alias("subject_id"),
            F.concat(F.lit("s"), k % 100).alias("short_subject_id"),
        )

    def user_tables(self) -> UserTables:
        return UserTables(
            users=self.users(), helpdesk=self.helpdesk(), subjects=self.subjects(), assets=self.assets(),
            first_assets=self.first_assets(), size_history=self.size_history(), billing_hours=self.billing_hours(),
            minute_stats=self.asset_minutes(), agent_minutes=self.agent_facts(), dump_uploads=self.dump_uploads(),
            snapshots=self.snapshots(), touch_tables=(self.page_views(), self.navigation()), event_log=self.event_log(),
            leads=self.leads(), contacts=self.contacts(), accounts=self.accounts(),
        )

    @staticmethod
    def user_rules() -> UserRules:
        return UserRules(ASSET_AS_OF, TENANT, TOOL_AGENTS, NON_PROGRAMMATIC_AGENTS, OWN)

    # Events

    def _events(self) -> DataFrame:
        return self.table("events").select(
            "event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"),
            F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        )

    def raw_events(self) -> DataFrame:
        """One row per event with every column any event table has."""
        eid, user, k = F.col("event_id"), F.col("user_id"), F.col("k")
        number = (k + eid) % len(EVENT_NAMES)
        prior = F.concat(F.lit("p"), user, F.lit("-"), eid % 2)
        tail = pick(("/created", "/detail", "/other"), k % 3)
        url = F.concat(F.lit("https://own.example/#databases/"), F.lpad(eid.cast("string"), 8, "0"), tail)
        return self._events().select(
            F.unix_seconds("ts").alias("time"), F.col("ts").alias("event_ts"),
            pick(EVENT_NAMES, number).alias("raw_event_type"),
            F.concat(F.lit("d"), user, F.lit("-"), eid % 3).alias("distinct_id"),
            F.when(F.col("event_type") == "signup", self.email(user)).alias("email"),
            pick(("browser", "explorer"), k % 2).alias("event_label"),
            pick(("4.1", "4.2", None), k % 3).alias("version"), F.concat(k % 8, F.lit("GB")).alias("size"),
            pick(("eu", "us", "ap"), eid % 3).alias("region"),
            F.when(k % 2 == 0, "new").alias("installtype"), pick(STEPS, k % 3).alias("step"),
            F.concat(F.lit("view"), k % 5).alias("view"), pick(("en", "de"), k % 2).alias("language"),
            F.concat(k % 4, F.lit("GB")).alias("old_size"), F.concat(k % 6, F.lit("GB")).alias("new_size"),
            F.when(k % 3 == 0, "push").alias("readytorunpushcommand"), url.alias("current_url"),
            F.concat(F.lit("v"), user).alias("device_id"),
            F.when(eid % 5 == 0, F.concat(F.lit("U"), user)).alias("user_id"),
            F.when(eid % 7 == 0, prior).alias("distinct_id_before_identity"),
            pick(("t1", "t1", "t1", "t2"), eid % 4).alias("project_id"),
            F.col("event_type"),
        )

    def event_tables(self) -> dict[str, DataFrame]:
        """The raw events cut into a table per event kind, as a tracker exports them."""
        raw = self.raw_events()
        name = F.lower("raw_event_type")
        tables = {t: raw.where(name == t) for t in EVENT_SHAPES if t != "navigate_to"}
        tables["navigate_to"] = raw.where(name.startswith("navigate_to"))
        return tables

    def event_log(self) -> DataFrame:
        return self.raw_events().withColumnsRenamed({"raw_event_type": "event_name", "email": "email_address"})

    def nested_events(self) -> DataFrame:
        eid, k = F.col("event_id"), F.col("k")
        return self._events().select(
            pick(PIVOT_EVENTS, (k + eid) % len(PIVOT_EVENTS)).alias("event"),
            F.struct(
                F.unix_seconds("ts").alias("time"),
                F.concat(F.lit("d"), F.col("user_id"), F.lit("-"), eid % 3).alias("distinct_id"),
                pick(("browser", "explorer", None), k % 3).alias("event_label"),
            ).alias("properties"),
        )

    def page_views(self) -> DataFrame:
        return self._visits("event_type in ('view', 'click')")

    def navigation(self) -> DataFrame:
        """Moves inside the console: the other table that first touches are taken from."""
        return self._visits("event_type in ('signup', 'purchase')").drop("pathname", "referrer", "referring_domain")

    def _visits(self, kinds: str) -> DataFrame:
        eid, user, k = F.col("event_id"), F.col("user_id"), F.col("k")
        touch = (k + eid) % 24
        columns = ("initial_referrer", "initial_referring_domain", "utm_source", "utm_medium", "utm_campaign")
        return self._events().where(kinds).select(
            F.concat(F.lit("d"), user, F.lit("-"), eid % 3).alias("distinct_id"),
            F.concat(F.lit("v"), user).alias("device_id"),
            F.unix_seconds("ts").alias("time"), F.unix_millis("ts").alias("mp_processing_time_ms"),
            pick(PATHS, eid % 3).alias("pathname"),
            pick(REFERRERS, (k + eid) % 24).alias("referrer"),
            pick(("a.example", "b.example", None), k % 3).alias("referring_domain"),
            *[pick([t[i] for t in TOUCHES], touch).alias(c) for i, c in enumerate(columns)],
            pick(("US", "DE", None), k % 3).alias("mp_country_code"),
            pick(("CA", "BE"), eid % 2).alias("region"),
            pick(("t1", "t1", "t1", "t2"), k % 4).alias("project_id"),
        )

    def registrants(self) -> DataFrame:
        e = self._events().where("event_type = 'signup'")
        return e.groupBy(F.col("user_id").alias("userkey")).agg(F.min("ts").alias("user_created_at")).select(
            "userkey", self.email(F.col("userkey")).alias("email"), "user_created_at"
        )

    def registrant_assets(self) -> DataFrame:
        e = self._events().where("event_type in ('purchase', 'signup')")
        first = e.groupBy(F.col("user_id").alias("userkey")).agg(F.min(F.struct("ts", "event_id")).alias("_f"))
        return first.select(
            F.col("_f.event_id").alias("dbid"), self.email(F.col("userkey")).alias("email"),
            F.col("_f.ts").alias("db_created_at"), F.lit(1).alias("user_db_sequence"),
        )

    def query_logs(self) -> list[DataFrame]:
        """Two log tables: odd and even assets."""
        eid, k = F.col("event_id"), F.col("k")
        parts = [F.lit("bolt-session"), F.lit("bolt"), pick(DRIVERS, k % 5), F.lit("gap"), F.lit("client"), F.lit("server")]
        parts[0] = F.when(k % 10 == 3, "embedded-session").otherwise("bolt-session")
        source = F.concat_ws("\t", F.slice(F.array(*parts), F.lit(1), (eid % 6 + 1).cast("int")))
        trace = F.concat(F.lit("ClientError: bad\nline "), k)
        payload = F.struct(
            F.col("user_id").alias("dbid"), F.lit("4.2").alias("dbversion"),
            pick(("ann", "bob", None), eid % 3).alias("username"), F.lit("main").alias("database"),
            F.when(F.col("event_type") == "purchase", "commit").otherwise("start").alias("event"),
            eid.alias("id"), source.alias("source"), pick(QUERIES, k % 8).alias("query"),
            F.lit("slotted").alias("runtime"), pick(ANNOTATIONS, (k + eid) % 4).alias("annotationdata"),
            F.when(k % 11 == 0, "failed").alias("failurereason"), F.when(k % 11 == 0, trace).alias("stacktrace"),
            (F.col("value") * 4 - 100).alias("allocatedbytes"), (F.col("value") - 50).alias("elapsedtimems"),
            (k * 1.5).alias("pagehits"), (k * 0.5).alias("pagefaults"),
        )
        log = self._events().select(F.col("ts").alias("timestamp"), F.lit("INFO").alias("severity"), payload.alias("jsonPayload"))
        odd = F.col("jsonPayload.dbid") % 2 == 1
        return [log.where(odd), log.where(~odd)]
