"""Row keys: ``<device id>:<kind>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import as_col

# The two kinds, and the lengths of a whole key and of its id.
ANDROID_KIND = "didmd5"
IOS_KIND = "ifa"
KEY_LENGTHS = (39, 40)
ID_LENGTHS = (32, 36)
OS_NUMBERS = ("0", "1")

# What a path of Android ids contains, and how a result for a path ends.
ANDROID_PATH = "and"
PROCESSED_ENDING = "_proceed.csv"

# Characters a trim removes: everything up to the blank.
TRIMMED = "".join(map(chr, range(0x21)))


def _has_colon(key: Column) -> Column:
    return F.contains(key, F.lit(":"))


def _has_hyphen(device_id: Column) -> Column:
    return F.contains(device_id, F.lit("-"))


def key_prefix_first(key: Column | str) -> Column:
    """Text before the first colon; null without one."""
    key = as_col(key)
    return F.when(_has_colon(key), F.substring_index(key, ":", 1))


def key_prefix_last(key: Column | str) -> Column:
    """Text before the last colon; null without one."""
    key = as_col(key)
    tail = F.length(F.substring_index(key, ":", -1))
    return F.when(_has_colon(key), F.substring(key, F.lit(1), F.length(key) - tail - 1))


def build_key_by_os(device_id: Column | str, os: Column | str) -> Column:
    """Key from an id and its os: ``"0"`` is Android, anything else (null too) iOS."""
    kind = F.when(as_col(os) == "0", F.lit(f":{ANDROID_KIND}")).otherwise(F.lit(f":{IOS_KIND}"))
    return F.concat(F.lower(as_col(device_id)), kind)


def build_key_by_hyphen(device_id: Column | str) -> Column:
    """Key from an id alone: ids with a hyphen are iOS."""
    device_id = as_col(device_id)
    kind = F.when(_has_hyphen(device_id), F.lit(f":{IOS_KIND}")).otherwise(F.lit(f":{ANDROID_KIND}"))
    return F.concat(F.lower(device_id), kind)


def os_of_id(device_id: Column | str) -> Column:
    """``"1"`` for ids with a hyphen, else ``"0"``."""
    return F.when(_has_hyphen(as_col(device_id)), F.lit("1")).otherwise(F.lit("0"))


def has_no_upper(text: Column | str) -> Column:
    text = as_col(text)
    return F.lower(text) == text


def key_is_loose_ok(key: Column | str) -> Column:
    """A colon, and an id of a known length before the first one."""
    key = as_col(key)
    return _has_colon(key) & F.length(F.substring_index(key, ":", 1)).isin(*ID_LENGTHS)


def key_is_wellformed(key: Column | str) -> Column:
    """The loose rule plus lower case and a known total length; the kind itself is not checked."""
    key = as_col(key)
    return F.length(key).isin(*KEY_LENGTHS) & has_no_upper(key) & key_is_loose_ok(key)


def normalize_id(device_id: Column | str) -> Column:
    """Lower case without blanks or control characters at either end."""
    return F.trim(F.lower(as_col(device_id)), F.lit(TRIMMED))


def display_did(device_id: Column | str, with_kind: bool = False) -> Column:
    """The id as exports show it: iOS in upper case, optionally followed by its kind."""
    device_id = as_col(device_id)
    ios, android = F.upper(device_id), device_id
    if with_kind:
        ios = F.concat(ios, F.lit(f":{IOS_KIND}"))
        android = F.concat(android, F.lit(f":{ANDROID_KIND}"))
    return F.when(_has_hyphen(device_id), ios).otherwise(android)


def os_number(device_id: Column | str) -> Column:
    """The os as exports show it: integer 1 or 0."""
    return F.when(_has_hyphen(as_col(device_id)), F.lit(1)).otherwise(F.lit(0))


def kind_from_path(path: Column | str) -> Column:
    """Kind of the ids in a file, told by its path."""
    return F.when(F.contains(as_col(path), F.lit(ANDROID_PATH)), F.lit(ANDROID_KIND)).otherwise(F.lit(IOS_KIND))


def processed_path(path: Column | str) -> Column:
    """Name of the result for an input path: up to the first dot, then a fixed ending."""
    path = as_col(path)
    renamed = F.concat(F.substring_index(path, ".", 1), F.lit(PROCESSED_ENDING))
    return F.when(F.contains(path, F.lit(".")), renamed).otherwise(path)
