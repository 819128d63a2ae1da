"""Small helpers shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side we broadcast without having a bound by construction.
BROADCAST_MAX_ROWS = 100_000


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               bounded: bool = False, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``small`` onto ``big``, broadcasting it only when its size is known
    to be small: either bounded by construction (``bounded=True``, e.g. one row
    per segment or per fold) or checked here with a cheap ``limit+count``.
    Beyond the bound Spark plans a shuffle join (AQE may still broadcast)."""
    if not bounded:
        bounded = small.limit(max_rows + 1).count() <= max_rows
    return big.join(F.broadcast(small) if bounded else small, on, how)


def desc_last(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def asc_last(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


# The default column names of the roles.
@dataclass
class Roles:
    """Which column plays which part. Defaults are the reference's names; the
    test-table catalogue passes its own (see ``CATALOG_ROLES``)."""

    item_id: str = "item_id"
    oem: str = "oem"
    model: str = "model"
    brand: str = "brand_group"
    price: str = "price_eur"
    spec: str = "spec_score_0_100"
    value: str = "value_score"
    tier: str = "price_tier"
    segment: str = "segment"
    age: str = "phone_age"
    ram: str = "ram_gb"
    camera: str = "main_camera_max_mp"
    segment_features: list = field(default_factory=lambda: [
        "price_eur", "spec_score_0_100", "ram_gb", "storage_gb", "battery_capacity_mah",
        "main_camera_max_mp", "ppi", "network_generation", "sensor_count"])
    market_features: list = field(default_factory=lambda: [
        "spec_score_0_100", "ram_gb", "storage_gb", "battery_capacity_mah", "main_camera_max_mp",
        "ppi", "network_generation", "sensor_count", "phone_age"])
    display_specs: list = field(default_factory=lambda: [
        "ram_gb", "storage_gb", "battery_capacity_mah", "main_camera_max_mp", "network_generation"])
    summary_means: list = field(default_factory=lambda: [
        "spec_score_0_100", "ram_gb", "storage_gb", "battery_capacity_mah", "main_camera_max_mp",
        "ppi", "network_generation"])


CATALOG_ROLES = Roles(
    age="item_age",
    ram="avg_quantity",
    camera="size",
    segment_features=["price_eur", "spec_score_0_100", "size", "n_lines", "avg_quantity",
                      "avg_discount", "avg_extendedprice", "item_age"],
    market_features=["spec_score_0_100", "size", "n_lines", "avg_quantity", "avg_discount",
                     "avg_extendedprice", "item_age"],
    display_specs=["avg_quantity", "n_lines", "avg_extendedprice", "size", "avg_discount"],
    summary_means=["spec_score_0_100", "size", "n_lines", "avg_quantity", "avg_discount",
                   "avg_extendedprice", "item_age"],
)
