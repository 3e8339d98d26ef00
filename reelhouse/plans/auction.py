"""The auction tables: their rules, and the rows they start with."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelhouse.operators.change import Change
from reelhouse.operators.integrity import ForeignKey, Rules, Unique, after, at_most, not_null, scalar_lookup
from reelhouse.operators.seeding import insert_or_skip
from reelhouse.sources.schemas import AUCTION

# The earliest date allowed, the ways to pay, and the longest texts.
DATE_FLOOR = "2000-01-01"
PAYMENT_METHODS = ("CASH", "CARD", "TRANSFER")
TEXT_LENGTHS = {
    "country": {"country_name": 100},
    "city": {"city_name": 100},
    "category": {"category_name": 100},
    "address": {"street": 150, "postal_code": 20},
    "location": {"location_name": 100},
    "buyer": {"buyer_name": 100, "contact_number": 30, "email": 120},
    "seller": {"seller_name": 100, "contact_number": 30, "email": 120},
    "employee": {"name": 100, "role": 50},
    "item": {"item_name": 150},
    "lot": {"lot_number": 20},
    "payment": {"payment_method": 50},
}


def _at_least_zero(column: str) -> Column:
    return F.col(column) >= 0


def _rules(
    required: list[str],
    key: tuple[str, ...],
    checks: Mapping[str, Column] | None = None,
    unique: Mapping[str, tuple[str, ...]] | None = None,
    references: Mapping[str, str] | None = None,
) -> Rules:
    """Rules of one table; ``references`` maps a column to the table whose id it holds."""
    return Rules(
        checks={**not_null(*required), **(checks or {})},
        keys={"primary key": Unique(key, primary=True), **{n: Unique(c) for n, c in (unique or {}).items()}},
        references={
            f"{column} in {parent}": ForeignKey((column,), parent, (f"{parent}_id",))
            for column, parent in (references or {}).items()
        },
    )


def rules(recorded: bool = False) -> dict[str, Rules]:
    """The rules of every table, text lengths included; the ``recorded`` tables have a ``record_ts`` that is never null."""
    return {
        name: replace(r, checks={**r.checks, **at_most(TEXT_LENGTHS.get(name, {})), **(not_null("record_ts") if recorded else {})})
        for name, r in _table_rules().items()
    }


def _table_rules() -> dict[str, Rules]:
    return {
        "country": _rules(["country_name"], ("country_id",), unique={"name": ("country_name",)}),
        "city": _rules(
            ["city_name", "country_id"],
            ("city_id",),
            unique={"name in country": ("city_name", "country_id")},
            references={"country_id": "country"},
        ),
        "category": _rules(
            ["category_name"],
            ("category_id",),
            unique={"name in parent": ("category_name", "parent_category_id")},
            references={"parent_category_id": "category"},
        ),
        "address": _rules(
            ["street", "postal_code", "city_id"],
            ("address_id",),
            unique={"street, code, city": ("street", "postal_code", "city_id")},
            references={"city_id": "city"},
        ),
        "location": _rules(
            ["location_name", "city_id"],
            ("location_id",),
            unique={"name in city": ("location_name", "city_id")},
            references={"city_id": "city"},
        ),
        "buyer": _rules(
            ["buyer_name", "address_id"], ("buyer_id",), unique={"email": ("email",)}, references={"address_id": "address"}
        ),
        "seller": _rules(
            ["seller_name", "address_id"], ("seller_id",), unique={"email": ("email",)}, references={"address_id": "address"}
        ),
        "auction": _rules(
            ["auction_date", "start_time", "end_time", "location_id", "category_id"],
            ("auction_id",),
            checks={"date floor": after("auction_date", DATE_FLOOR), "ends after start": F.col("end_time") > F.col("start_time")},
            references={"location_id": "location", "category_id": "category"},
        ),
        "employee": _rules(["name"], ("employee_id",), references={"auction_id": "auction"}),
        "item": _rules(
            ["item_name", "starting_price", "seller_id", "category_id"],
            ("item_id",),
            checks={"starting price": _at_least_zero("starting_price")},
            unique={"name by seller": ("item_name", "seller_id")},
            references={"seller_id": "seller", "category_id": "category"},
        ),
        "auction_item": _rules(
            ["auction_id", "item_id", "display_order"],
            ("auction_id", "item_id"),
            checks={"estimated price": F.col("estimated_price").isNull() | _at_least_zero("estimated_price")},
            unique={"display order": ("auction_id", "display_order")},
            references={"auction_id": "auction", "item_id": "item"},
        ),
        "lot": _rules(
            ["lot_number", "auction_id", "item_id"],
            ("lot_id",),
            unique={"number in auction": ("auction_id", "lot_number")},
            references={"auction_id": "auction", "item_id": "item"},
        ),
        "bid": _rules(
            ["lot_id", "buyer_id", "bid_amount", "bid_time"],
            ("bid_id",),
            checks={"amount": _at_least_zero("bid_amount")},
            references={"lot_id": "lot", "buyer_id": "buyer"},
        ),
        "sale": _rules(
            ["lot_id", "buyer_id", "final_price", "sale_date"],
            ("sale_id",),
            checks={"price": _at_least_zero("final_price"), "date floor": after("sale_date", DATE_FLOOR)},
            unique={"one per lot": ("lot_id",)},
            references={"lot_id": "lot", "buyer_id": "buyer"},
        ),
        "payment": _rules(
            ["sale_id", "payment_date", "payment_amount", "payment_method"],
            ("payment_id",),
            checks={
                "amount": _at_least_zero("payment_amount"),
                "date floor": after("payment_date", DATE_FLOOR),
                "method": F.col("payment_method").isin(*PAYMENT_METHODS),
            },
            unique={"one per sale": ("sale_id",)},
            references={"sale_id": "sale"},
        ),
    }


class Lookup(NamedTuple):
    """Turn the text in ``column`` into an id: the row of ``parent`` whose ``against`` it names."""

    column: str
    parent: str
    against: str


class SeedStep(NamedTuple):
    table: str
    columns: str
    rows: list[tuple]
    lookups: tuple[Lookup, ...] = ()


# The rows the auction tables start with. Texts in id columns name the parent row.
_AUCTION_DAY = Lookup("auction_id", "auction", "auction_date")
_ITEM = Lookup("item_id", "item", "item_name")
_LOT = Lookup("lot_id", "lot", "lot_number")
_BUYER = Lookup("buyer_id", "buyer", "buyer_name")
_CITY = Lookup("city_id", "city", "city_name")
_STREET = Lookup("address_id", "address", "street")
SEED = [
    SeedStep("country", "country_name", [("Lithuania",), ("Poland",)]),
    SeedStep(
        "city",
        "city_name, country_id",
        [("Vilnius", "LITHUANIA"), ("Kaunas", "LITHUANIA"), ("Warsaw", "POLAND")],
        (Lookup("country_id", "country", "country_name"),),
    ),
    SeedStep("category", "category_name, description", [("Art", "Fine art"), ("Antiques", "Old objects")]),
    SeedStep(
        "category",
        "category_name, description, parent_category_id",
        [("Painting", "Paintings", "ART"), ("Sculpture", "Sculptures", "ART")],
        (Lookup("parent_category_id", "top_category", "category_name"),),
    ),
    SeedStep(
        "address",
        "street, postal_code, city_id",
        [("Gedimino pr. 1", "01103", "VILNIUS"), ("Laisves al. 10", "44215", "KAUNAS"), ("Old Town 5", "00-001", "WARSAW")],
        (_CITY,),
    ),
    SeedStep(
        "location",
        "location_name, city_id",
        [("Vilnius Auction Hall", "VILNIUS"), ("Kaunas Expo Center", "KAUNAS")],
        (_CITY,),
    ),
    SeedStep(
        "buyer",
        "buyer_name, contact_number, email, address_id",
        [
            ("Jonas Petraitis", "+37060000001", "jonas@example.com", "GEDIMINO PR. 1"),
            ("Agnė Jankauskaitė", "+37060000002", "agne@example.com", "LAISVES AL. 10"),
        ],
        (_STREET,),
    ),
    SeedStep(
        "seller",
        "seller_name, contact_number, email, address_id",
        [
            ("Old Masters Gallery", "+37060000011", "gallery@example.com", "GEDIMINO PR. 1"),
            ("Antique World", "+37060000012", "antiques@example.com", "OLD TOWN 5"),
        ],
        (_STREET,),
    ),
    SeedStep(
        "auction",
        "auction_date, start_time, end_time, location_id, category_id",
        [
            ("2024-03-15", 64800, 75600, "VILNIUS AUCTION HALL", "ART"),
            ("2024-04-20", 61200, 73800, "KAUNAS EXPO CENTER", "ANTIQUES"),
        ],
        (Lookup("location_id", "location", "location_name"), Lookup("category_id", "top_category", "category_name")),
    ),
    SeedStep(
        "employee",
        "name, role, auction_id",
        [
            ("Laura Admin", "Auctioneer", "2024-03-15"),
            ("Mantas Helper", "Assistant", "2024-03-15"),
            ("Eglė Manager", "Coordinator", "2024-04-20"),
        ],
        (_AUCTION_DAY,),
    ),
    SeedStep(
        "item",
        "item_name, description, starting_price, seller_id, category_id",
        [
            ("Sunset Over Vilnius", "Oil painting", "500", "OLD MASTERS GALLERY", "PAINTING"),
            ("Ancient Vase", "19th century vase", "300", "ANTIQUE WORLD", "ANTIQUES"),
            ("Bronze Statue", "Bronze sculpture", "800", "OLD MASTERS GALLERY", "SCULPTURE"),
        ],
        (Lookup("seller_id", "seller", "seller_name"), Lookup("category_id", "category", "category_name")),
    ),
    SeedStep(
        "auction_item",
        "auction_id, item_id, display_order, estimated_price",
        [
            ("2024-03-15", "SUNSET OVER VILNIUS", 1, "700"),
            ("2024-03-15", "BRONZE STATUE", 2, "1000"),
            ("2024-04-20", "ANCIENT VASE", 1, "450"),
        ],
        (_AUCTION_DAY, _ITEM),
    ),
    SeedStep(
        "lot",
        "lot_number, auction_id, item_id, lot_description",
        [
            ("A-01", "2024-03-15", "SUNSET OVER VILNIUS", "Main painting"),
            ("A-02", "2024-03-15", "BRONZE STATUE", "Sculpture lot"),
            ("B-01", "2024-04-20", "ANCIENT VASE", "Antique lot"),
        ],
        (_AUCTION_DAY, _ITEM),
    ),
    SeedStep(
        "bid",
        "lot_id, buyer_id, bid_amount, bid_time",
        [
            ("A-01", "JONAS PETRAITIS", "600", "2024-03-15 18:30"),
            ("A-01", "AGNĖ JANKAUSKAITĖ", "650", "2024-03-15 18:45"),
            ("B-01", "JONAS PETRAITIS", "400", "2024-04-20 17:20"),
        ],
        (_LOT, _BUYER),
    ),
    SeedStep(
        "sale",
        "lot_id, buyer_id, final_price, sale_date",
        [("A-01", "AGNĖ JANKAUSKAITĖ", "650", "2024-03-15"), ("B-01", "JONAS PETRAITIS", "400", "2024-04-20")],
        (_LOT, _BUYER),
    ),
    SeedStep(
        "payment",
        "sale_id, payment_date, payment_amount, payment_method",
        [("A-01", "2024-03-16", "650", "CARD"), ("B-01", "2024-04-21", "400", "TRANSFER")],
        (Lookup("sale_id", "sold_lot", "lot_number"),),
    ),
]


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in AUCTION.items()}


def _parent(t: Mapping[str, DataFrame], name: str) -> tuple[DataFrame, str]:
    """A lookup's parent rows and the name of their id."""
    if name == "top_category":
        return t["category"].where(F.col("parent_category_id").isNull()), "category_id"
    if name == "sold_lot":
        return t["sale"].join(t["lot"], "lot_id").select("sale_id", "lot_number"), "sale_id"
    return t[name], f"{name}_id"


def seed_step(t: Mapping[str, DataFrame], step: SeedStep, unique_keys: list[list[str]]) -> Change:
    """Insert the rows of one step; a text that names no parent row is an error where null is not allowed."""
    required = _table_rules()[step.table].checks
    target = t[step.table]
    numbered = [(i, *row) for i, row in enumerate(step.rows)]
    rows = target.sparkSession.createDataFrame(numbered, ["row_id", *step.columns.split(", ")])
    for lookup in step.lookups:
        parent, value = _parent(t, lookup.parent)
        against = F.col(lookup.against).cast("string")
        needed = f"{lookup.column} not null" in required
        rows = scalar_lookup(rows, parent, lookup.column, against, value, lookup.column, required=needed)
    id_column = target.columns[0]
    return insert_or_skip(target, rows, unique_keys, None if id_column in rows.columns else id_column)


def seed(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with the seed rows in, skipping those a unique key already holds."""
    state = dict(t)
    known = _table_rules()
    for step in SEED:
        columns = state[step.table].columns
        keys = [list(k.columns) for k in known[step.table].keys.values()]
        generated = columns[0] not in step.columns.split(", ")
        if generated:
            keys = [k for k in keys if k != [columns[0]]]
        state[step.table] = seed_step(state, step, keys).state
    return state
