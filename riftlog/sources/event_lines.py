"""Log lines made from an ``events`` table, for checks and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def event_lines(events: DataFrame) -> DataFrame:
    """One log line per event: ``line_no, value``."""
    kind, user, number = F.col("event_type"), F.col("user_id"), F.col("event_id")

    def by_kind(click, view, error, signup, purchase):
        return (
            F.when(kind == "click", click)
            .when(kind == "view", view)
            .when(kind == "error", error)
            .when(kind == "signup", signup)
            .otherwise(purchase)
        )

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    api, scheduler, compute = (
        F.lit("nova-api.log"), F.lit("nova-scheduler.log"), F.lit("nova-compute.log")
    )
    source = by_kind(api, api, scheduler, compute, compute)
    manager = F.lit("nova.compute.manager")
    component = by_kind(
        F.lit("nova.osapi_compute.wsgi.server"),
        F.lit("nova.metadata.wsgi.server"),
        F.lit("nova.scheduler.host_manager"),
        manager,
        manager,
    )
    info = F.lit("INFO")
    level = F.when(number % 13 == 0, F.lit("info")).otherwise(
        by_kind(info, info, F.lit("ERROR"), F.lit("WARNING"), info)
    )
    request = F.when(number % 7 == 0, F.lit("[-]")).when(number % 11 != 0, text("[req-", user, "]"))
    message = by_kind(
        text(
            "10.11.10.", user % 250, ' "GET /v2/servers/detail" status: 200 len: ',
            F.floor("value"), " time: 0.", number % 1000,
        ),
        text("image img-", number % 17, " at (/var/lib/nova/base): checking"),
        text("The instance sync for host 'cp-", user % 5, "' did not match. Re-created its InstanceList."),
        text("[instance: i-", user, "] Instance spawned successfully."),
        text("[instance: i-", user, "] Took ", number % 30, ".", number % 100, " seconds to build instance."),
    )
    return events.select(
        number.alias("line_no"),
        F.concat_ws(
            " ",
            source,
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"),
            text(2000 + user % 97),
            level,
            component,
            request,
            message,
        ).alias("value"),
    )
