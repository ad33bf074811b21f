"""Which keys occur where: one pass that answers uniqueness, coverage and orphans for all tables together.

Every use of a key (a table's own key, or a reference to it) is a place in the key's domain. All uses in all
tables become rows (domain, place, key), which are counted on the map side and shuffled once; a key then has one row with its
number of occurrences in each place.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from stallbook.functions.scalars import agg

# (child table, child column, parent table, parent column)
Reference = tuple[str, str, str, str]


def domains_of(references: list[Reference]) -> dict[tuple[str, str], list[tuple[str, str]]]:
    """Per parent key the places that use it: itself first, then its references."""
    found: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for child, column, parent, key in references:
        found.setdefault((parent, key), [(parent, key)]).append((child, column))
    return found


def key_counts(frames: Mapping[str, DataFrame], references: list[Reference]) -> DataFrame:
    """``(domain, k, c0, c1, ...)``: how often key ``k`` occurs in each place of its domain, place 0 being the parent's.

    Domains are numbered in the order of ``domains_of``. Each table is read once, whatever the number of its keys. NULL is a key of its own.
    """
    uses: dict[str, list[str]] = {}
    domains = domains_of(references)
    for d, places in enumerate(domains.values()):
        for p, (table, column) in enumerate(places):
            uses.setdefault(table, []).append(f"named_struct('domain', {d}, 'place', {p}, 'k', CAST({column} AS STRING))")
    rows = reduce(DataFrame.unionByName, [frames[t].selectExpr(f"inline(array({', '.join(found)}))") for t, found in uses.items()])
    most = max(map(len, domains.values()))
    return agg(rows, ["domain", "k"], **{f"c{p}": f"count_if(place = {p})" for p in range(most)})


def reference_counts(frames: Mapping[str, DataFrame], references: list[Reference]) -> DataFrame:
    """One row per reference: ``at`` (its place in the list), distinct keys and rows of the child, and those of them without a parent.

    A NULL is no key: it counts as a row without a parent only.
    """
    domains = domains_of(references)
    numbers = {key: d for d, key in enumerate(domains)}
    seen = {key: 0 for key in domains}
    sums, structs = {}, []
    for i, (_, _, parent, key) in enumerate(references):
        seen[parent, key] += 1
        used = f"domain = {numbers[parent, key]} AND c{seen[parent, key]} > 0"
        n = f"c{seen[parent, key]}"
        sums |= {
            f"keys_{i}": f"count_if({used} AND k IS NOT NULL)",
            f"lost_keys_{i}": f"count_if({used} AND k IS NOT NULL AND c0 = 0)",
            f"null_rows_{i}": f"coalesce(sum({n}) FILTER (WHERE {used} AND k IS NULL), 0)",
            f"lost_rows_{i}": f"coalesce(sum({n}) FILTER (WHERE {used} AND k IS NOT NULL AND c0 = 0), 0)",
        }
        structs.append(f"named_struct('at', {i}, 'keys', keys_{i}, 'lost_keys', lost_keys_{i}, 'null_rows', null_rows_{i}, 'lost_rows', lost_rows_{i})")
    return agg(key_counts(frames, references), [], **sums).selectExpr(f"inline(array({', '.join(structs)}))")
