"""Load a warehouse and count, in the passes that store it, what the cleaning rules changed.

Every source is read once: the pass that stores its staging table counts lost values and the rules that
its rows decide alone; the pass that stores a warehouse table counts the lookups that found nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from stallbook.operators.materialize import materialize, observed
from stallbook.params import Params
from stallbook.plans.warehouse import Frames, check_integrity, clean, in_load_order, with_surrogate_keys
from stallbook.quality.validation import LOOKUP_RULES, staging_rules, unmapped_categories
from stallbook.schemas import WAREHOUSE
from stallbook.sources.csv_files import LoadError, load_staging


class WarehouseLoad(NamedTuple):
    tables: dict[str, DataFrame]
    counters: dict[str, int]


def store_frames(staging: Frames, params: Params) -> WarehouseLoad:
    """Staging frames from any source, each stored in one pass that also counts."""
    tables, counters, rules = {}, {}, staging_rules(params)
    for table in staging:
        watched, counted = observed(staging[table], rules.get(table, {}), f"rules of {table}")
        tables[table] = materialize(watched, f"staging-{table}")
        counters |= counted()
    return WarehouseLoad(tables, counters)


def store_warehouse(staging: Frames, params: Params, check: bool = True) -> WarehouseLoad:
    """The nine tables of staging frames that are stored, with keys in load order, and how many rows each lookup and rule touched."""
    found: list[Callable[[], Mapping[str, int]]] = []

    def watch(table: str, df: DataFrame) -> DataFrame:
        watched, counted = observed(df, LOOKUP_RULES.get(table, {}), f"lookups of {table}")
        found.append(counted)
        return watched

    cleaned = clean(in_load_order(staging, stored=True), params, mark=True)
    keyed = with_surrogate_keys(cleaned, params, watch=watch)
    tables = {name: materialize(keyed[name], name) for name in WAREHOUSE}
    counters = {name: n for counted in found for name, n in counted().items()}
    counters["unmapped_categories"] = unmapped_categories(tables["dim_product"]).first()[0]
    if check:
        check_integrity(cleaned, tables)
    return WarehouseLoad(tables, counters)


def load_frames(staging: Frames, params: Params, check: bool = True) -> WarehouseLoad:
    """A warehouse from staging frames, with all counters."""
    stored = store_frames(staging, params)
    loaded = store_warehouse(stored.tables, params, check)
    return WarehouseLoad(loaded.tables, {**stored.counters, **loaded.counters})


def load_folder(spark: SparkSession, folder: str, params: Params, check: bool = True) -> WarehouseLoad:
    """A warehouse from a folder of CSV files, with all counters; problems of files are raised together."""
    load = load_staging(spark, folder, rules=staging_rules(params))
    if load.problems:
        raise LoadError("; ".join(load.problems), load.frames)
    loaded = store_warehouse(load.frames, params, check)
    counters = {name if not name.startswith("lost ") else f"{table}: {name}": n for table, counted in load.counts.items() for name, n in counted.items()}
    return WarehouseLoad(loaded.tables, {**counters, **loaded.counters})
