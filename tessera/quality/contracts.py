"""Data contracts: columns, types, nullability, business key, version
column and domain rules, declared once and exported as JSON.

Domain rules are Spark SQL boolean expressions; a rule fails for a row
when it evaluates to FALSE (NULL inputs are left to the not-null rules).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str            # Spark SQL type name, e.g. "bigint", "decimal(12,2)"
    nullable: bool = True


@dataclass(frozen=True)
class Contract:
    table: str
    version: int
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...]
    version_column: str | None = None
    rules: dict[str, str] = field(default_factory=dict)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)  # col -> (table, col)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.type), c.nullable)
                             for c in self.columns])

    def to_json(self) -> str:
        d = asdict(self)
        d["columns"] = [asdict(c) for c in self.columns]
        d["key"] = list(self.key)
        d["foreign_keys"] = {k: list(v) for k, v in self.foreign_keys.items()}
        return json.dumps(d, indent=2, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "Contract":
        d = json.loads(text)
        return Contract(table=d["table"], version=d["version"],
                        columns=tuple(ColumnSpec(**c) for c in d["columns"]), key=tuple(d["key"]),
                        version_column=d.get("version_column"), rules=d.get("rules", {}),
                        foreign_keys={k: tuple(v) for k, v in d.get("foreign_keys", {}).items()})


def _cols(*specs: tuple) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(*s) for s in specs)


# Contracts of the six star tables as derived from the test data (see
# tessera.sources.star).  Keys are not nullable.
STAR_CONTRACTS: dict[str, Contract] = {
    "category": Contract(
        "category", 1, _cols(("category_code", "string", False), ("category_name", "string", False)),
        ("category_code",), rules={"category_code_format": "category_code RLIKE '^CAT-.+$'"}),
    "brands": Contract(
        "brands", 1, _cols(("brand_code", "string", False), ("brand_name", "string", False),
                           ("brand_label", "string"), ("category_code", "string")),
        ("brand_code",), rules={"brand_code_format": "brand_code RLIKE '^BRD-'"},
        foreign_keys={"category_code": ("category", "category_code")}),
    "customers": Contract(
        "customers", 1, _cols(("customer_id", "bigint", False), ("phone", "string"), ("country_code", "string"),
                              ("country", "string"), ("state", "string"), ("city", "string")),
        ("customer_id",), rules={"phone_format": "phone RLIKE '^[+][0-9]{8,}$'",
                                 "country_code_format": "country_code RLIKE '^[A-Z0-9]{2,3}$'"}),
    "calendar": Contract(
        "calendar", 1, _cols(("date_code", "int", False), ("full_date", "date", False), ("year", "int"),
                             ("quarter", "int"), ("month", "int"), ("month_name", "string"), ("day", "int"),
                             ("day_of_week", "int"), ("day_name", "string"), ("is_weekend", "boolean")),
        ("date_code",), rules={"quarter_range": "quarter BETWEEN 1 AND 4",
                               "day_of_week_range": "day_of_week BETWEEN 1 AND 7"}),
    "products": Contract(
        "products", 1, _cols(("product_id", "bigint", False), ("product_name", "string", False),
                             ("brand_code", "string"), ("category_code", "string"),
                             ("price", "decimal(10,2)"), ("size", "int")),
        ("product_id",), rules={"price_positive": "price > 0"},
        foreign_keys={"brand_code": ("brands", "brand_code"), "category_code": ("category", "category_code")}),
    "order_items": Contract(
        "order_items", 1, _cols(("order_item_id", "string", False), ("order_id", "bigint", False),
                                ("customer_id", "bigint"), ("product_id", "bigint"), ("supplier_id", "bigint"),
                                ("date_code", "int"), ("quantity", "decimal(12,2)"), ("total_price", "decimal(12,2)"),
                                ("discount", "decimal(4,2)"), ("tax", "decimal(4,2)"),
                                ("return_flag", "string"), ("line_status", "string"), ("dt_update", "bigint")),
        ("order_item_id",), version_column="dt_update",
        rules={"quantity_positive": "quantity > 0",
               "total_price_non_negative": "total_price >= 0",
               "discount_range": "discount BETWEEN 0 AND 1",
               "return_flag_domain": "return_flag IN ('A', 'N', 'R')",
               "line_status_domain": "line_status IN ('O', 'F')"},
        foreign_keys={"customer_id": ("customers", "customer_id"), "product_id": ("products", "product_id"),
                      "date_code": ("calendar", "date_code")}),
}


# The source-side contract of the fact table as its OLTP DDL declares it
# (string ids, unit price, no supplier/discount columns): validating the
# derived table against it shows missing, extra and re-typed columns.
SOURCE_ORDER_ITEMS = Contract(
    "order_items", 0, _cols(("order_item_id", "string", False), ("order_id", "string"), ("customer_id", "string"),
                            ("product_id", "string"), ("date_code", "int"), ("quantity", "int"),
                            ("unit_price", "decimal(10,2)"), ("total_price", "decimal(10,2)"),
                            ("dt_update", "bigint")),
    ("order_item_id",), version_column="dt_update")


def contract_of(table: str, schema: T.StructType, like: Contract) -> Contract:
    """A contract that states ``schema`` as it is, with the key and the
    nullability of ``like`` (new columns nullable)."""
    required = set(like.required)
    return Contract(table, like.version + 1, tuple(ColumnSpec(f.name, f.dataType.simpleString(), f.name not in required)
                                                   for f in schema.fields), like.key, like.version_column)


def export_all(contracts: dict[str, Contract] | None = None) -> dict[str, str]:
    """table -> JSON text, for writing next to the tables."""
    return {name: c.to_json() for name, c in (contracts or STAR_CONTRACTS).items()}


def classify_change(old: Contract, new: Contract) -> list[tuple[str, str, str]]:
    """Schema-evolution policy: (column, change, kind) where kind is
    'additive' (new nullable column, nullability relaxed, decimal widened)
    or 'breaking' (column dropped, re-typed, made required, key changed)."""
    out = []
    o = {c.name: c for c in old.columns}
    n = {c.name: c for c in new.columns}
    for name in o.keys() - n.keys():
        out.append((name, "removed", "breaking"))
    for name in n.keys() - o.keys():
        out.append((name, "added", "additive" if n[name].nullable else "breaking"))
    for name in o.keys() & n.keys():
        a, b = o[name], n[name]
        if a.type != b.type:
            out.append((name, f"type {a.type} -> {b.type}", "additive" if _widens(a.type, b.type) else "breaking"))
        if a.nullable != b.nullable:
            out.append((name, "nullable" if b.nullable else "required", "additive" if b.nullable else "breaking"))
    if tuple(old.key) != tuple(new.key):
        out.append((",".join(new.key), "key changed", "breaking"))
    return sorted(out)


_INT_ORDER = ["tinyint", "smallint", "int", "bigint"]


def _widens(a: str, b: str) -> bool:
    if a in _INT_ORDER and b in _INT_ORDER:
        return _INT_ORDER.index(b) >= _INT_ORDER.index(a)
    if a.startswith("decimal") and b.startswith("decimal"):
        pa, sa = (int(x) for x in a[8:-1].split(","))
        pb, sb = (int(x) for x in b[8:-1].split(","))
        return sb >= sa and (pb - sb) >= (pa - sa)
    return (a, b) in {("float", "double"), ("int", "double"), ("bigint", "decimal(20,0)")}
