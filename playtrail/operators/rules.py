"""Rule-driven validation: the rule table becomes one expression per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import double_of, int_of, text_of
from .once import once

Rule = tuple[str, str, str, str]

# The cleaning rules. 0 present, 1 text not empty, 2 whole number not
# negative, 3 number above zero, anything else a pattern for the whole text.
_USER = [("user", "user_id", "1"), ("user", "user_name", "1"), ("game", "game_name", "1")]
_ROLE = _USER + [("role", "role_name", "1"), ("role", "role_server", "1"), ("role", "role_id", "1")]
_EVENTS = {
    "register": _USER, "login": _USER, "enter_game": _ROLE, "create_role": _ROLE,
    "logout": _ROLE, "exit": _USER,
    "order": _ROLE + [("order", "order_sn", "1"), ("order", "currency_amount", "3"),
                      ("order", "order_type", "1"), ("order", "order_status", "1")],
    "coin_trade": _ROLE + [("trade", "trade_type", "1"), ("trade", "trade_amount", "2"),
                           ("trade", "remain_amount", "2"), ("trade", "item_amount", "2")],
    "heart": _ROLE, "role_update": _ROLE,
    "mission": _ROLE + [("mission", "mission_id", "1"), ("mission", "mission_name", "1")],
    "copy": _ROLE + [("copy", "copy_id", "1"), ("copy", "copy_name", "1")],
    "click": _ROLE + [("click", "event_tag", "1"), ("click", "click_time", "2")],
}
DEFAULT_RULES: list[Rule] = [(event, *rule) for event, rules in _EVENTS.items() for rule in rules]

# Columns every event must bring.
COMMON = ["event", "server_time_zone", "device", "game", "is_test", "client_ts", "client_time_zone", "data_ver"]
COMMON_BATCH = ["event", "device", "game", "is_test", "data_ver"]


def require_common(doc: Column, server_ts: Column, batch: bool = False) -> Column:
    """Nine common fields (batch: six) present; the stand-in for a missing time fails."""
    ok = F.coalesce(server_ts, F.lit(-1)) != (0 if batch else -1)
    for name in COMMON_BATCH if batch else COMMON:
        ok = ok & doc[name].isNotNull()
    return F.coalesce(ok, F.lit(False))


def _holds(leaf: Column, rule: str, int_strict: bool) -> Column:
    if rule == "0":
        ok = leaf.isNotNull()
    elif rule == "1":
        ok = text_of(leaf) != ""
    elif rule == "2":
        ok = int_of(leaf) > 0 if int_strict else int_of(leaf) >= 0
    elif rule == "3":
        ok = double_of(leaf) > 0.0
    else:
        ok = leaf.rlike(f"^(?:{rule})$")
    return leaf.isNotNull() & F.coalesce(ok, F.lit(False))


def _shared_order(by_event: dict[str, list[tuple[str, str, str]]]) -> list[tuple[str, str, str]] | None:
    """One order of all distinct checks that agrees with every event's own order, if there is one."""
    after: dict[tuple, set] = {}
    for own in by_event.values():
        for n, check in enumerate(own):
            after.setdefault(check, set()).update(own[:n])
    done: list[tuple[str, str, str]] = []
    while len(done) < len(after):
        ready = [c for c in after if c not in done and after[c] <= set(done)]
        if not ready:
            return None
        done += ready
    return done


def _own_checks(rules: list[Rule]) -> dict[str, list[tuple[str, str, str]]]:
    """Checks per event in order: a group must be there before its fields are looked at."""
    by_event: dict[str, list[tuple[str, str, str]]] = {}
    for event, grp, name, rule in rules:
        own = by_event.setdefault(event, [])
        for check in ((grp, "", ""), (grp, name, rule)):
            if check not in own:
                own.append(check)
    return by_event


def first_failure(doc: Column, rules: list[Rule] = DEFAULT_RULES, int_strict: bool = False) -> Column:
    """Name of the first group or field, in rule order, that breaks a rule; NULL when none does.

    An event without rules passes. ``int_strict`` asks whole numbers to be above zero.
    Checks shared by several events are compiled once, so the expression stays small.
    """
    by_event = _own_checks(rules)
    if not by_event:
        return F.lit(None).cast("string")

    def broken(check: tuple[str, str, str]) -> tuple[Column, str]:
        grp, name, rule = check
        if not name:
            return doc[grp].isNull(), grp
        return ~_holds(doc[grp][name], rule, int_strict), name

    order = _shared_order(by_event)
    if order is not None:
        parts = []
        for check in order:
            events = [e for e, own in by_event.items() if check in own]
            fails, label = broken(check)
            parts.append(F.when(doc["event"].isin(*events) & fails, F.lit(label)))
        return F.coalesce(*parts)
    result = None
    for event, own in by_event.items():
        found = F.coalesce(*[F.when(fails, F.lit(label)) for fails, label in map(broken, own)])
        result = F.when(doc["event"] == event, found) if result is None else result.when(doc["event"] == event, found)
    return result


def failure_text(field: Column) -> Column:
    return F.when(field.isNotNull(), F.concat(F.lit("Error value in "), field, F.lit(" column may be null.")))


def validated(df: DataFrame, doc: str = "doc", rules: list[Rule] = DEFAULT_RULES,
              server_ts: Column | None = None, batch: bool = False, int_strict: bool = False) -> DataFrame:
    """AND the common and the rule check into ``ok`` and name the first reason."""
    d = F.col(doc)
    ts = int_of(d["server_ts"]) if server_ts is None else server_ts
    common = require_common(d, ts, batch)
    reason = F.coalesce(
        F.col("reject_reason"),
        F.when(~common, F.lit("1.Error value in common column may be null.")),
        failure_text(first_failure(d, rules, int_strict)))
    kept = [c for c in df.columns if c not in ("reject_reason", "ok")]
    checked = once(df, {"_reason": reason}, kept)
    return checked.withColumnRenamed("_reason", "reject_reason").withColumn("ok", F.col("reject_reason").isNull())
