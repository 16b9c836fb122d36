"""One destination per row. Each route is a ``when`` chain, so rows are never copied."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings of destination names, and the ending of source names.
COPY, TEST, OTHER, FILTER = "Copy", "Test", "Other", "Filter"
ERROR_END, RIGHT_END = "Error", "Std"
SOURCE_END = "Src"


def destination(source: str) -> str:
    return source[:-len(SOURCE_END)] if source.endswith(SOURCE_END) else source


def route_login(source: str, ok: Column, special: Column | None = None, folded_into: str | None = None) -> Column:
    """Invalid rows to the filter; members of the special set apart; else the destination."""
    dest = destination(source)
    main = F.lit(folded_into or dest)
    if special is not None:
        main = F.when(special, F.lit(dest + OTHER)).otherwise(main)
    return F.when(~F.coalesce(ok, F.lit(False)), F.lit(dest + FILTER)).otherwise(main)


def route_order(source: str, is_copy: Column, ok: Column, outside: Column, is_test: Column, special: Column) -> Column:
    """Copy, then filter, test, other, main: in that order."""
    dest = destination(source)
    return (F.when(is_copy, F.lit(dest + COPY))
            .when(~F.coalesce(ok, F.lit(False)) | outside, F.lit(dest + FILTER))
            .when(is_test, F.lit(dest + TEST)).when(special, F.lit(dest + OTHER)).otherwise(F.lit(dest)))


def route_own_order(source: str, table: Column, ok: Column, folded_into: str | None = None) -> Column:
    """Own-channel databases: good order rows to the destination, all else to the filter."""
    dest = destination(source)
    return F.when((table == "order") & F.coalesce(ok, F.lit(False)), F.lit(folded_into or dest)) \
        .otherwise(F.lit(dest + FILTER))


def route_service(service: Column, ok: Column, special: Column, folded: dict[str, str] | None = None,
                  split: tuple[str, ...] = ("agent",)) -> Column:
    """``<service>Error``, ``<service>Std`` and, for split services, ``<service>StdOther``."""
    target = service
    for name, into in (folded or {}).items():
        target = F.when(service == name, F.lit(into)).otherwise(target)
    right = F.concat(target, F.lit(RIGHT_END))
    apart = service.isin(*split) & special
    return (F.when(~F.coalesce(ok, F.lit(False)), F.concat(service, F.lit(ERROR_END)))
            .when(apart, F.concat(right, F.lit(OTHER))).otherwise(right))


def route_table(table: Column) -> Column:
    """order, user, order_jh-like side table, or others."""
    return F.when(table.isin("order", "user", "order_side"), table).otherwise(F.lit("others"))


def route_event(event: Column, event_type: Column, purchase: Column, refund: Column) -> Column:
    """Log load: login, active, install, purchase, refund list or nothing."""
    return (F.when(event == "login", "login").when(event == "active", "active")
            .when(event_type == "install", "install").when(~F.coalesce(purchase == "", F.lit(True)), "purchase")
            .when(~F.coalesce(refund == "", F.lit(True)), "refund").otherwise("none"))
