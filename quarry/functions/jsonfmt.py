"""Relation lists as records, and records as Python-``json.dumps`` text, natively.

``grouped`` turns ``(head, relation, tail)`` triples into a record: entities
and their fields in first-seen order, each field with all its tails.  It sorts
the triples of a row once by entity and field instead of filtering them for
each entity and field, so a record of n triples costs n log n.  ``record_json``
prints a record with Python's default separators (``", "`` and ``": "``);
single tails are unwrapped.  All of it is row-local (no shuffle, no Python).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import json_quote, json_string_list

#: Type of a record.
RECORD = "array<struct<entity:string,members:array<struct<field:string,tails:array<string>>>>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: an expression repeated
    inside a lambda would be computed again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _runs(rows: Column, same: Callable[[Column, Column], Column], make: Callable[[Column], Column]) -> Column:
    """``make`` of every run of neighbouring rows that are the ``same``."""

    def cut(rows):
        n = F.size(rows)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | ~same(F.get(rows, i - 1), F.get(rows, i)))
        return let(starts, lambda s: F.transform(s, lambda b, j: make(F.slice(rows, b + 1, F.coalesce(F.get(s, j + 1), n) - b))))

    # an empty array takes the branch that never builds a sequence
    return let(rows, lambda r: F.when(F.size(r) > 0, cut(r)))


#: Up to so many triples, filters for each entity and field cost less than sorting.
SHORT = 16


def grouped(rel: Column) -> Column:
    """The record of an array of ``struct(head, relation, tail)``."""
    return let(rel, lambda r: F.when(F.size(r) <= SHORT, _by_filters(r)).otherwise(_by_sorting(r)))


def _by_filters(rel: Column) -> Column:
    def members(own):
        def member(k):
            return F.struct(k.alias("field"), F.transform(F.filter(own, lambda r: r["relation"].eqNullSafe(k)), lambda r: r["tail"]).alias("tails"))

        return F.transform(F.array_distinct(F.transform(own, lambda r: r["relation"])), member)

    def entity(e):
        return F.struct(e.alias("entity"), let(F.filter(rel, lambda r: r["head"].eqNullSafe(e)), members).alias("members"))

    return F.transform(F.array_distinct(F.transform(rel, lambda r: r["head"])), entity)


def _by_sorting(rel: Column) -> Column:
    triples = F.array_sort(F.transform(rel, lambda r, i: F.struct(r["head"].alias("head"), r["relation"].alias("relation"), i.alias("i"), r["tail"].alias("tail"))))
    fields = _runs(
        triples,
        lambda a, b: a["head"].eqNullSafe(b["head"]) & a["relation"].eqNullSafe(b["relation"]),
        lambda run: F.struct(F.get(run, F.lit(0))["head"].alias("head"), F.get(run, F.lit(0))["i"].alias("i"), F.get(run, F.lit(0))["relation"].alias("field"),
                             F.transform(run, lambda r: r["tail"]).alias("tails")),
    )
    entities = _runs(
        F.array_sort(fields),
        lambda a, b: a["head"].eqNullSafe(b["head"]),
        lambda run: F.struct(F.get(run, F.lit(0))["i"].alias("i"), F.get(run, F.lit(0))["head"].alias("entity"),
                             F.transform(run, lambda m: F.struct(m["field"].alias("field"), m["tails"].alias("tails"))).alias("members")),
    )
    in_order = F.transform(F.array_sort(entities), lambda e: F.struct(e["entity"].alias("entity"), e["members"].alias("members")))
    return F.when(F.size(rel) > 0, in_order).when(F.size(rel) == 0, F.array().cast(RECORD))


def record_json(record: Column) -> Column:
    """The JSON text of a record; null for null."""

    def member(m):
        single = json_quote(F.get(m["tails"], F.lit(0)))
        return F.concat(json_quote(m["field"]), F.lit(": "), F.when(F.size(m["tails"]) == 1, single).otherwise(json_string_list(m["tails"])))

    def entity(e):
        return F.concat(json_quote(e["entity"]), F.lit(": {"), F.array_join(F.transform(e["members"], member), ", "), F.lit("}"))

    return F.concat(F.lit("{"), F.array_join(F.transform(record, entity), ", "), F.lit("}"))


def relations_json(rel: Column) -> Column:
    """``{entity: {relation: tail | [tails]}}`` of a relation list."""
    return record_json(grouped(rel))
