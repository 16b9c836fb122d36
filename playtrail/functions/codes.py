"""Code -> label tables. An unknown code passes through as text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code tables of the log formats.
ORDER_STEP = {"1": "create_order", "2": "paid_success", "3": "notify_cp_failue",
              "4": "notify_cp_success", "5": "finish"}
PAY_STATUS = {"0": "failure", "1": "success"}
PAY_TYPE_DOMESTIC = {"1": "alipay", "5": "yeebao", "6": "weichat_pay", "7": "apple_pay",
                     "8": "iapppay", "9": "alipay", "10": "alipay", "12": "weichat_pay",
                     "13": "weichat_pay", "14": "alipay", "15": "weichat_pay",
                     "17": "weichat_pay", "18": "weichat_pay", "19": "weichat_pay",
                     "20": "unionpay", "21": "weichat_pay", "22": "weichat_pay"}
PAY_TYPE_OVERSEAS = {"1": "google_pay", "2": "mycard", "3": "visa_global", "4": "apple_pay",
                     "5": "mol", "6": "huawei", "7": "onestore"}
OS_BY_PLATFORM = {"0": "android", "1": "ios", "2": "ios", "3": "ios", "4": "android",
                  "5": "ios", "6": "ios"}
GENDER = {"1": "male", "2": "female"}


def label(code: Column, table: dict[str, str]) -> Column:
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    text = code.cast("string")
    return F.coalesce(F.try_element_at(literal, text), text)


def store_flag(channel: Column) -> Column:
    """2 for the app store channel, 0 for all others."""
    return F.when(channel == "appstore", F.lit(2)).otherwise(F.lit(0))


def topic_source(topic: Column, rules: list[tuple[tuple[str, ...], str]]) -> Column:
    """Data-source name of a topic: the first rule with a matching part wins."""
    lowered = F.lower(topic)
    result = None
    for parts, name in rules:
        hit = None
        for part in parts:
            found = lowered.contains(part.lower())
            hit = found if hit is None else hit | found
        result = F.when(hit, F.lit(name)) if result is None else result.when(hit, F.lit(name))
    return topic if result is None else result.otherwise(topic)
