"""Parameters of the reporting jobs; the defaults are the published business rules."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Params:
    # Fixed values of the business rules.
    reference_date: str = "2018-09-01"
    active_from: str = "2018-03-01"
    dormant_from: str = "2017-09-01"
    calendar_start: str = "2016-01-01"
    calendar_end: str = "2019-12-31"
    purchases_from: str = "2016-01-01"
    purchases_to: str = "2018-12-31"
    lat_min: float = -34.0
    lat_max: float = 6.0
    lng_min: float = -75.0
    lng_max: float = -32.0
    shipping_grace_days: int = 60
    early_days: int = 2
    min_orders_for_score: int = 5
    manual_categories: tuple[tuple[str, str], ...] = (
        ("pc_gamer", "gaming_pc"),
        ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen_food_preparators"),
    )
    row_ranges: dict[str, tuple[int, int]] = field(
        default_factory=lambda: {
            "dim_date": (1461, 1461),
            "dim_geolocation": (18000, 22000),
            "dim_customer": (99441, 99441),
            "dim_seller": (3095, 3095),
            "dim_product": (32951, 32951),
            "dim_order": (99441, 99441),
            "fact_order_items": (112650, 112650),
            "fact_payments": (103886, 103886),
            "fact_reviews": (99224, 99224),
        }
    )


# The same rules moved to the years covered by the benchmark tables.
BENCH_PARAMS = replace(
    Params(),
    reference_date="2001-09-01",
    active_from="2001-03-01",
    dormant_from="2000-09-01",
    calendar_start="1995-01-01",
    calendar_end="2001-12-31",
    purchases_from="1995-01-01",
    purchases_to="2001-12-31",
    manual_categories=(("PROMO", "promo_manual"),),
    # The calendar has its days; a warehouse of any size passes, but for the locations, kept as they are to fail.
    row_ranges={
        **{t: (1, 10**15) for t in Params().row_ranges},
        "dim_date": (2557, 2557),
        "dim_geolocation": Params().row_ranges["dim_geolocation"],
    },
)
