"""Structured query logs: extract, parse, and summarise per minute."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from cohortline.functions import aggs, numbers, text

# The tab-separated parts of a log source.
SOURCE_PARTS = ("bolt_session", "bolt", "driver_info", "gap", "client", "server")
# Fixed patterns. (?d): only a newline ends a line, as in other regex engines.
TWO_SLASH_NAME = r"(?d)^(.*)/.* .*/.* \(.*\)\z"
TWO_SLASH_VERSION = r"(?d)^.*/(.*) .*/.* \(.*\)\z"
ONE_SLASH_NAME = r"(?d)^(.*)/.*\z"
ONE_SLASH_VERSION = r"(?d)^.*/(.*)\z"
BLANKS = r"[\t\n\f\r ]"
LAST_WORD = rf"(?d)^.*{BLANKS}+(.*)\z"
ANNOTATION = rf"(?d)^\{{([a-z]+):{BLANKS}'(.*)',{BLANKS}([a-z]+): '(.*)'\}}"
DIRECT_USE = "user-direct"
TOOL_USE = "user-action"
# Keyword measures, and whether the keyword may stand inside the text.
STATEMENTS = {
    "imputed_load_statements": ("load csv ", True),
    "imputed_match_lines": ("match ", False),
    "imputed_merge_lines": ("merge ", False),
    "imputed_create_lines": ("create ", False),
}


@dataclass(frozen=True)
class ClientRules:
    """Names a deployment uses for clients that do not follow the driver convention."""

    embedded_session: str = "embedded-session"
    registry_marker: str = "service-registry"
    tool_driver: str = "monitor"


def split_source(source: Column) -> list[Column]:
    """The parts of a source string; parts that are not there are null."""
    parts = F.split(source, "\t")
    return [F.get(parts, i).alias(name) for i, name in enumerate(SOURCE_PARTS)]


def _not_negative(c: Column) -> Column:
    return F.when(c < 0, F.lit(0)).otherwise(c)


def extract_log(
    log: DataFrame, day: date | str | None = None, day_column: str | None = None, version_field: str = "dbversion"
) -> DataFrame:
    """One day of one log table in the common layout; rows without a query are dropped.

    ``day_column`` is the table's partition column when it has one; otherwise
    the timestamp is filtered, which still reaches the scan as a range.
    ``version_field`` is what the payload calls the version of the database.
    """
    if day is not None:
        when = F.col(day_column) if day_column else F.to_date("timestamp")
        log = log.where(when == F.lit(str(day)).cast("date"))
    p = "jsonPayload."
    return log.where(F.col(p + "query").isNotNull()).select(
        "timestamp", "severity",
        F.col(p + "dbid"), F.col(p + version_field).alias("dbversion"),
        *[F.col(p + c) for c in ("username", "database", "event", "id")],
        *split_source(F.col(p + "source")),
        _not_negative(F.col(p + "allocatedbytes")).alias("allocatedbytes"),
        _not_negative(F.col(p + "elapsedtimems")).alias("elapsedtimems"),
        *[F.col(p + c) for c in ("pagehits", "pagefaults", "query", "runtime", "annotationdata", "failurereason")],
        F.substring_index(F.col(p + "stacktrace"), ":", 1).alias("exception"),
        F.col(p + "stacktrace"),
    )


def extract_logs(
    sources: Sequence[DataFrame], day: date | str | None = None, day_column: str | None = None, version_field: str = "dbversion"
) -> DataFrame:
    """The same day of several log tables as one."""
    log = extract_log(sources[0], day, day_column, version_field)
    for more in sources[1:]:
        log = log.unionByName(extract_log(more, day, day_column, version_field))
    return log


def parse_driver(info: Column, session: Column, rules: ClientRules = ClientRules()) -> tuple[Column, Column]:
    """Driver name and version from the driver text, by the number of slashes in it."""
    slashes = F.regexp_count(info, F.lit("/"))
    embedded = session == rules.embedded_session
    registry = info.contains(rules.registry_marker)
    spaced, last_word = info.rlike(BLANKS), text.extract_or_null(info, LAST_WORD)

    def pick(two: str, one: str, for_embedded: Column, for_registry: Column) -> Column:
        return (
            F.when(slashes == 2, text.extract_or_null(info, two))
            .when(slashes == 1, text.extract_or_null(info, one))
            .when(spaced, last_word)
            .when(embedded, for_embedded)
            .when(registry, for_registry)
        )

    return (
        pick(TWO_SLASH_NAME, ONE_SLASH_NAME, session, info),
        pick(TWO_SLASH_VERSION, ONE_SLASH_VERSION, F.lit("NA"), F.lit("NA")),
    )


def parse_annotation(annotation: Column) -> list[Column]:
    """Key and value of the two pairs in ``{key: 'value', key: 'value'}``, else nulls."""
    names = ("field1_key", "field1_val", "field2_key", "field2_val")
    return [text.extract_or_null(annotation, ANNOTATION, i + 1).alias(n) for i, n in enumerate(names)]


def submission(rules: ClientRules = ClientRules()) -> tuple[Column, Column]:
    """Submission type and app, from ``driver_*``, ``annotationdata`` and its parsed fields."""
    tool = F.col("driver_name") == rules.tool_driver

    def field(key: str) -> Column:
        return F.when(F.col("field1_key") == key, F.col("field1_val")).when(
            F.col("field2_key") == key, F.col("field2_val")
        )

    named = (F.col("field1_key") == "type") | (F.col("field2_key") == "type")
    kind = (
        F.when(tool, TOOL_USE)
        .when(named, field("type"))
        .when(F.col("annotationdata") == "{}", DIRECT_USE)
    )
    tool_app = F.concat(F.lit(rules.tool_driver + "_"), F.substring_index("driver_version", " ", 1))
    return kind, F.when(tool, tool_app).otherwise(field("app"))


def structured_log(extract: DataFrame, rules: ClientRules = ClientRules()) -> DataFrame:
    """The extract with driver, annotation and submission worked out. Narrow: no shuffle."""
    name, version = parse_driver(F.col("driver_info"), F.col("bolt_session"), rules)
    parsed = extract.select(
        "*", name.alias("driver_name"), version.alias("driver_version"), *parse_annotation(F.col("annotationdata"))
    )
    kind, app = submission(rules)
    return parsed.select(
        "timestamp", "severity", "dbid", "dbversion", "username", "database", "event", "id", "driver_name", "driver_version",
        "elapsedtimems", "allocatedbytes", "pagehits", "pagefaults", "query", "runtime", "annotationdata",
        kind.alias("query_submission_type"), app.alias("query_submission_app"),
        "failurereason", "exception", "stacktrace",
    )


RESOURCES = {"millis": "elapsedtimems", "memory_bytes": "allocatedbytes", "page_hits": "pagehits", "page_faults": "pagefaults"}


#: Sums of resources are held as whole units and, under this ending, millionths.
MICROS = "_micros"


def resource_total(name: str) -> Column:
    return numbers.rounded_total(F.col(name), F.col(name + MICROS)).alias(name)


def on_day(log: DataFrame, day: date | str | None) -> DataFrame:
    return log if day is None else log.where(F.to_date("timestamp") == F.lit(str(day)).cast("date"))


def log_measures(fix_errors: bool = False) -> dict[str, Column]:
    """The additive measures of a structured log, by name.

    ``completed_errors`` is always 0 unless ``fix_errors``, which counts failed commits.
    """
    event, direct = F.col("event"), F.col("query_submission_type") == DIRECT_USE
    query, trace = F.lower("query"), F.col("stacktrace")
    lines, chars = text.newline_count(F.col("query")) + 1, F.length("query")
    started = event == "start"
    measures = {}
    for state, hit in (("submitted", started), ("completed", event == "commit")):
        measures[f"{state}_queries"] = aggs.count_where(hit)
        measures[f"{state}_direct"] = aggs.count_where(hit & direct)
        measures[f"{state}_lines"] = aggs.sum_where(hit & direct, lines)
        measures[f"{state}_chars"] = aggs.sum_where(hit & direct, chars)
        for r, c in RESOURCES.items():
            whole, micros = numbers.whole_and_micros(F.col(c))
            measures[f"{state}_{r}"] = aggs.sum_where(hit, whole)
            measures[f"{state}_{r}{MICROS}"] = aggs.sum_where(hit, micros)
    failed = F.col("failurereason").isNotNull()
    commit_failed = (event == "commit") & (failed | trace.isNotNull())
    measures["total_submit_errors"] = aggs.count_where(started & failed)
    measures["completed_errors"] = aggs.count_where(commit_failed if fix_errors else F.lit(False))
    measures["exceptions"] = aggs.count_where(direct & trace.isNotNull())
    measures["stacktrace_lines"] = aggs.sum_where(direct, F.coalesce(text.newline_count(trace) + 1, F.lit(0)))
    measures["error_message_characters"] = F.sum(F.coalesce(F.length("exception"), F.lit(0)))
    for name, (word, anywhere) in STATEMENTS.items():
        found = query.contains(word) if anywhere else query.startswith(word) | query.contains(" " + word)
        measures[name] = aggs.count_where(started & direct & found)
    return measures


def minute_stats(log: DataFrame, day: date | str | None = None, fix_errors: bool = False) -> DataFrame:
    """Query statistics per minute and asset: :func:`log_measures`, averages and users.

    Measures are first summed per user name, which spreads a hot asset and
    turns the distinct user count into a plain count.
    """
    measures = log_measures(fix_errors)
    per_user = on_day(log, day).groupBy(
        F.date_trunc("MINUTE", "timestamp").alias("minute"), "dbid", "username"
    ).agg(*[m.alias(n) for n, m in measures.items()])
    names = F.array_sort(F.collect_list("username"))
    totals = per_user.groupBy("minute", "dbid").agg(
        *[F.sum(n).alias(n) for n in measures],
        F.count("username").alias("named_users"),
        names.alias("_names"),
    )

    def side(state: str, direct_name: str, average: str) -> list[Column]:
        n = F.col(f"{state}_direct")
        return [
            F.col(f"{state}_queries"),
            n.alias(direct_name),
            F.col(f"{state}_lines").alias(f"imputed_{state}_query_lines"),
            F.col(f"{state}_chars").alias(f"imputed_total_{state}_characters"),
            numbers.rounded_ratio(F.col(f"{state}_lines"), n).alias(f"imputed_avg_lines_per_{average}"),
            numbers.rounded_ratio(F.col(f"{state}_chars"), n).alias(f"imputed_avg_characters_per_{average}"),
            resource_total(f"{state}_millis"),
            F.lit(0).alias(f"{state}_planning_millis"),
            F.lit(0).alias(f"{state}_waiting_millis"),
            *[resource_total(f"{state}_{r}") for r in RESOURCES if r != "millis"],
        ]

    return totals.select(
        "minute", "dbid",
        *side("submitted", "imputed_net_user_queries", "submitted_query"),
        "total_submit_errors",
        *side("completed", "imputed_net_completed_queries", "completed_query"),
        "completed_errors", "exceptions", "stacktrace_lines", "error_message_characters",
        *STATEMENTS,
        "named_users",
        F.when(F.size("_names") > 0, F.array_join("_names", ",")).alias("userlist"),
    )


def agent_minutes(log: DataFrame, event: str, day: date | str | None = None, fix_errors: bool = False) -> DataFrame:
    """Queries per minute, asset and client of one event kind: ``start`` or ``commit``."""
    if event not in ("start", "commit"):
        raise ValueError(f"event must be 'start' or 'commit', not {event!r}")
    state, errors = ("submitted", "submit_errors") if event == "start" else ("completed", "completed_errors")
    direct = F.col("query_submission_type") == DIRECT_USE
    failed = F.col("failurereason").isNotNull()
    if event == "commit":
        failed = (failed | F.col("stacktrace").isNotNull()) if fix_errors else F.lit(False)
    keys = ["minute", "dbid", "user_agent_name", "user_agent_version"]
    per_user = (
        on_day(log, day)
        .where(F.col("event") == event)
        .groupBy(
            F.date_trunc("MINUTE", "timestamp").alias("minute"), "dbid",
            F.col("driver_name").alias("user_agent_name"), F.col("driver_version").alias("user_agent_version"),
            "username",
        )
        .agg(
            aggs.count_where(direct).alias(f"{state}_queries"),
            aggs.count_where(direct & failed).alias(errors),
            *[F.sum(part).alias(f"{state}_{r}{ending}") for r, c in RESOURCES.items()
              for part, ending in zip(numbers.whole_and_micros(F.col(c)), ("", MICROS))],
        )
    )
    summed = [f"{state}_queries", errors, *[f"{state}_{r}{ending}" for r in RESOURCES for ending in ("", MICROS)]]
    totals = per_user.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in summed], F.count("username").alias("named_users")
    )
    return totals.select(
        *keys, f"{state}_queries", errors, "named_users",
        resource_total(f"{state}_millis"),
        F.lit(0).alias(f"{state}_planning_millis"),
        F.lit(0).alias(f"{state}_waiting_millis"),
        *[resource_total(f"{state}_{r}") for r in RESOURCES if r != "millis"],
    )
