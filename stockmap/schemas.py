"""Declared schemas for the 15 supply-chain datasets.

Each dataset has a StructType (never inferred: inference turns the ZIP
'01399' into 1399), a key, required and forbidden fields, and the renames
that map older field names onto the data model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_DATE_FIELDS = {
    "eff_start_date", "eff_end_date", "snapshot_date", "expiry_date", "order_date", "requested_delivery_date",
    "expected_delivery_date", "planned_ship_date", "planned_delivery_date", "actual_delivery_date",
}
_TS_FIELDS = {"forecast_start_dttm", "forecast_end_dttm", "date"}
_DOUBLE_FIELDS = {"latitude", "longitude", "transit_time", "distance", "cost_per_unit", "mean"}
_LONG_FIELDS = {
    "on_hand_inventory", "quantity_submitted", "init_quantity_requested", "min_safety_stock", "max_safety_stock",
    "target_inventory_qty", "min_order_qty", "max_order_qty", "year", "month", "week", "day",
}


def _type(name: str) -> T.DataType:
    if name in _DATE_FIELDS:
        return T.DateType()
    if name in _TS_FIELDS:
        return T.TimestampType()
    if name in _DOUBLE_FIELDS:
        return T.DoubleType()
    if name in _LONG_FIELDS:
        return T.LongType()
    return T.StringType()


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    required: tuple[str, ...]
    forbidden: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, _type(c), True) for c in self.columns])

    @property
    def string_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])


def _spec(name, cols, key, required, forbidden=(), renames=None) -> DatasetSpec:
    return DatasetSpec(name, tuple(cols.split()), tuple(key.split()), tuple(required.split()),
                       tuple(forbidden.split()) if isinstance(forbidden, str) else tuple(forbidden), renames or {})


# Dataset columns, keys, required and forbidden fields, field renames.
DATASETS: dict[str, DatasetSpec] = {s.name: s for s in [
    _spec("company", "id connection_id description", "id", "id description"),
    _spec("geography", "id connection_id description parent_geo_id country state_prov city", "id", "id description"),
    _spec("calendar", "calendar_id connection_id date year month week day is_working is_holiday eff_start_date "
          "eff_end_date", "calendar_id", "calendar_id date"),
    _spec("product_hierarchy", "id connection_id description parent_product_group_id", "id", "id description"),
    _spec("product", "id connection_id description base_uom product_type", "id", "id description",
          "category unit_of_measure manufacturer", {"unit_of_measure": "base_uom"}),
    _spec("site", "id connection_id description site_type geo_id latitude longitude city state_prov postal_code "
          "country", "id", "id description", "state custom_total_pop custom_median_income custom_poverty_rate",
          {"state": "state_prov"}),
    _spec("transportation_lane", "id from_site_id to_site_id connection_id from_geo_id to_geo_id "
          "carrier_tpartner_id trans_mode service_type product_group_id transit_time time_uom distance "
          "distance_uom cost_per_unit eff_start_date eff_end_date", "id", "id from_site_id to_site_id"),
    _spec("trading_partner", "id description tpartner_type city state_prov country geo_id eff_start_date "
          "eff_end_date", "id", "id description tpartner_type", "name partner_type state",
          {"name": "description", "partner_type": "tpartner_type", "state": "state_prov"}),
    _spec("inv_policy", "id site_id product_id connection_id product_group_id dest_geo_id vendor_tpartner_id "
          "ss_policy min_safety_stock max_safety_stock target_inventory_qty min_order_qty max_order_qty "
          "eff_start_date eff_end_date", "id", "id site_id product_id"),
    _spec("forecast", "snapshot_date connection_id product_id site_id region_id product_group_id "
          "forecast_start_dttm forecast_end_dttm mean", "snapshot_date site_id product_id forecast_start_dttm",
          "snapshot_date site_id product_id"),
    _spec("inv_level", "snapshot_date site_id product_id connection_id on_hand_inventory inv_condition lot_number "
          "expiry_date", "snapshot_date site_id product_id lot_number",
          "product_id site_id on_hand_inventory snapshot_date"),
    _spec("inbound_order", "id connection_id tpartner_id order_type order_status", "id", "id tpartner_id"),
    _spec("inbound_order_line", "id order_id connection_id tpartner_id product_id quantity_submitted to_site_id "
          "quantity_uom status expected_delivery_date", "id", "id order_id product_id"),
    _spec("shipment", "id supplier_tpartner_id connection_id product_id order_id order_line_id package_id "
          "ship_from_site_id ship_to_site_id planned_ship_date planned_delivery_date actual_delivery_date "
          "shipment_status", "id", "id product_id"),
    _spec("outbound_order_line", "id cust_order_id connection_id product_id customer_tpartner_id "
          "init_quantity_requested quantity_uom order_date requested_delivery_date status ship_from_site_id",
          "id", "id product_id"),
]}

DATASET_ORDER = tuple(DATASETS)


def spec(name: str) -> DatasetSpec:
    return DATASETS[name]
