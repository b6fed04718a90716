"""Flow settings as frozen dataclasses, loadable from a JSON file."""

from __future__ import annotations

import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class OutletSettings:
    table_name: str = "affiliated_outlets"
    table_id: int = 1
    key: str = "Affiliated_Code"
    rename: dict = field(default_factory=dict)
    postcode_key: str = "cp"
    postcode_aggs: dict = field(default_factory=dict)
    location_col: str = "Location"
    size_col: str = "Tam_m2"
    size_codes: dict = field(default_factory=dict)
    expected_types: dict = field(default_factory=dict)
    source_path: str = ""       # CSV files, for runs that get no frames
    postcode_path: str = ""
    delimiter: str = ";"
    order_by: list = field(default_factory=list)        # row order; empty: that of the files
    postcode_order: list = field(default_factory=list)


@dataclass(frozen=True)
class ProductSettings:
    table_name: str = "product"
    table_id: int = 2
    key: str = "Product_Code"
    expected_types: dict = field(default_factory=dict)
    source_path: str = ""
    delimiter: str = ";"
    order_by: list = field(default_factory=list)


@dataclass(frozen=True)
class FactSettings:
    table_name: str
    table_id: int
    key: str            # new surrogate key column, e.g. sales_ID
    day_col: str        # YYYYMMDD day column, e.g. Sales_DAY
    date_format: str = "YYYYMMDD"
    source_path: str = ""
    delimiter: str = ";"
    order_by: list = field(default_factory=list)


@dataclass(frozen=True)
class CalendarSettings:
    table_name: str = "calendar"
    table_id: int = 6
    key: str = "Day"
    start: str = "01-01-2015"
    end: str = "31-12-2015"
    json_types: dict = field(default_factory=dict)
    expected_types: dict = field(default_factory=dict)


def load_settings(path: str) -> dict:
    """Read a JSON settings file ``{"flows": {name: {...}}}`` into dataclasses."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    kinds = {"outlets": OutletSettings, "products": ProductSettings,
             "calendar": CalendarSettings}
    out = {}
    for name, body in raw.get("flows", {}).items():
        out[name] = kinds.get(name, FactSettings)(**body)
    return out
