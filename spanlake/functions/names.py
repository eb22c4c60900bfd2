"""Names, labels, secrets and error texts as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the tail of an error text starts, its nested prefixes, and what says that data isn't indexed yet.
REASON_TAILS = (". gRPC client debug context", " Client context:")
REASON_PREFIXES = (
    "Error during update request:", "Flight returned not found error, with message:", "Flight returned unavailable error, with message:",
    "Flight returned unauthorized error, with message:", "Error getting flight info or do_get:",
)
NOT_YET_INDEXED = ("model does not exist or denied access to the model", "project not found", "cannot find data from last")
#: Parts of a setting's name that mark a secret.
SECRET_PARTS = ("KEY", "SECRET", "TOKEN", "PASSWORD", "CREDENTIAL")


def column_name(name: Column) -> Column:
    """A score name as a column name: other characters than letters, digits, _ and white space become one _. Null if nothing is left."""
    raw = F.regexp_replace(name, r"(?U)\A\s+|\s+\z", "")
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, r"(?U)[^a-zA-Z0-9_\s]+", "_"), r"(?U)\A\s+|\s+\z", ""), "_{2,}", "_")
    return F.when(clean != "", clean)


def project_name(name: Column, limit: int = 60) -> Column:
    """A project name of letters, digits, _ and -: runs of others become one -, ends are trimmed."""
    clean = F.regexp_replace(F.regexp_replace(name, r"(?U)\A\s+|\s+\z", ""), "[^a-zA-Z0-9_-]+", "-")
    trim = lambda c: F.regexp_replace(c, r"\A[-_]+|[-_]+\z", "")
    return trim(F.substring(trim(clean), 1, limit))


def default_project_name(prefix: str, moment: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.date_format(moment, "yyyyMMdd-HHmmss"))


def number_label(number: Column) -> Column:
    """A number with up to four decimals and no zeros at the end."""
    text = F.regexp_replace(F.format_string("%.4f", number), r"\.?0+\z", "")
    return F.when(text.isin("", "-0", "-"), "0").otherwise(text)


def error_reason(text: Column, limit: int = 160) -> Column:
    """An error text in one line: without its tail and nested prefixes, cut to `limit` characters with an ellipsis."""
    quote = lambda s: r"\Q" + s + r"\E"
    line = F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"\A | \z", "")
    line = F.regexp_replace(line, "(?:" + "|".join(map(quote, REASON_TAILS)) + ").*", "")
    line = F.regexp_replace(line, r"\A(?:\s*(?:" + "|".join(map(quote, REASON_PREFIXES)) + r")\s*)+", "")
    line = F.regexp_replace(F.regexp_replace(line, r"\A\s+|\s+\z", ""), r"\.+\z", "")
    return F.when(F.length(line) <= limit, line).otherwise(F.concat(F.substring(line, 1, limit - 1), F.lit("…")))


def not_yet_indexed(text: Column) -> Column:
    return F.lower(text).rlike("|".join(NOT_YET_INDEXED))


def is_secret(name: Column) -> Column:
    return F.upper(name).rlike("|".join(SECRET_PARTS))


def redacted(value: Column, keep: int = 4) -> Column:
    """A secret as its first characters and its length."""
    return F.when(F.coalesce(value, F.lit("")) == "", "<unset>").otherwise(F.concat(F.substring(value, 1, keep), F.lit("…<"), F.length(value).cast("string"), F.lit(" chars>")))


def parse_pairs(text: Column) -> Column:
    """`a=x,b=y` as a map with lower-case keys; parts without = or with an empty side are left out."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.struct(F.lower(F.trim(F.substring_index(p, "=", 1))).alias("key"), F.trim(F.regexp_extract(p, r"=(.*)\z", 1)).alias("value"))), lambda e: (e["key"] != "") & (e["value"] != ""))
    last = F.transform(F.array_distinct(F.transform(parts, lambda e: e["key"])), lambda k: F.struct(k.alias("key"), F.element_at(F.filter(parts, lambda e: e["key"] == k), -1)["value"].alias("value")))
    return F.map_from_entries(last)


def pair_error(text: Column) -> Column:
    """What is wrong with `a=x,b=y` read strictly: the first part without = or with an empty side; null if all are right."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")
    bad = F.filter(parts, lambda p: ~p.rlike(r"\A\s*[^=\s][^=]*=\s*\S"))
    return F.when(F.size(bad) > 0, F.concat(F.lit("not a pair: "), F.element_at(bad, 1)))


def deep_link(host: str, space: Column, project: Column, start: Column, end: Column) -> Column:
    """A link to a project's spans in a range of time, with encoded parts and milliseconds."""
    millis = lambda c: F.unix_millis(c.cast("timestamp")).cast("string")
    return F.concat(F.lit(host.rstrip("/") + "/spaces/"), F.url_encode(space), F.lit("/projects/"), F.url_encode(project), F.lit("?start="), millis(start), F.lit("&end="), millis(end))
