"""Deterministic trace and span ids as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Namespaces:
    """Salts that keep derived ids of each purpose apart; a change renames every derived id."""

    span: str = "spanlake:v1:span:"
    trace: str = "spanlake:v1:trace:"
    root: str = "spanlake:v1:root:"


DEFAULT = Namespaces()


def normalise(value: Column) -> Column:
    """The value as text without white space around it; empty is null."""
    text = F.regexp_replace(value.cast("string"), r"(?U)\A\s+|\s+\z", "")
    return F.when(text != "", text)


def digest(namespace: str, text: Column, width: int) -> Column:
    """The first `width` hex digits of a salted SHA-256."""
    return F.substring(F.sha2(F.concat(F.lit(namespace), text).cast("binary"), 256), 1, width)


def _hex_or_digest(value: Column, namespace: str, width: int) -> Column:
    text = normalise(value)
    plain = F.replace(F.lower(text), F.lit("-"), F.lit(""))
    fits = plain.rlike(rf"\A[0-9a-f]{{{width}}}\z") & (plain != F.lit("0" * width))
    return F.when(fits, plain).otherwise(digest(namespace, text, width))


def span_id(value: Column, names: Namespaces = DEFAULT) -> Column:
    """16 hex digits: the value itself if it is such an id (any case, dashes ignored), else its digest. Null stays null."""
    return _hex_or_digest(value, names.span, 16)


def trace_id(value: Column, names: Namespaces = DEFAULT) -> Column:
    """32 hex digits; a UUID passes without its dashes."""
    return _hex_or_digest(value, names.trace, 32)


def root_span_id(value: Column, names: Namespaces = DEFAULT) -> Column:
    """The id of a trace's made-up root: always a digest, so it can't meet an id of an observation."""
    return digest(names.root, normalise(value), 16)
