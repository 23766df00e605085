"""The four tables every analysis reads, and what has to be known about their columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.operators.distinct import is_unique

# Columns and types of the tables. Keys (None) may have any type that can be compared.
COLUMNS: dict[str, dict[str, T.DataType | None]] = {
    "users": {"id": None, "payer": T.IntegerType(), "race_id": None},
    "race": {"race_id": None, "race": T.StringType()},
    "items": {"item_code": None, "game_items": T.StringType()},
    "events": {
        "transaction_id": None, "id": None, "date": T.TimestampNTZType(), "amount": None,
        "item_code": None,
    },
}
TABLES = tuple(COLUMNS)
# (key, the two tables that share it)
SHARED_KEYS = (
    ("id", "users", "events"), ("race_id", "users", "race"), ("item_code", "items", "events"),
)


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def conform(df: DataFrame, columns: Mapping[str, T.DataType | None]) -> DataFrame:
    """Pick the columns, casting only those stored as another type than asked for.

    Keys and amounts stay as stored, so nothing about them changes on reading, and a column that
    stays a bare reference lets filters on it reach the file scan.
    """
    stored = _types(df)
    missing = [name for name in columns if name not in stored]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[
        F.col(name) if kind is None or stored[name] == kind else F.col(name).cast(kind).alias(name)
        for name, kind in columns.items()
    ])


def _widened(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.col(key).cast("long"))


@dataclass
class GameTables:
    """Players, races, items and purchases (one ``events`` row per purchase).

    Keys may be whole numbers, text, or anything else that can be compared; the two sides of a
    key must have the same type, but whole numbers of two widths are widened.

    ``amount`` is a decimal or a floating-point number. Whether it is positive or zero is decided
    on the stored value. Sums are exact: decimals keep their scale, and floating-point amounts become
    decimals with ``amount_scale`` places, which raises an error if one does not fit exactly.

    ``unique_transactions`` says whether ``transaction_id`` is unique. If it is, distinct purchases
    are plain counts that add up from player to race or segment; if not, purchases have to be
    joined to find repeats across players. It is ``True`` where the table's owner guarantees the
    key, and ``None`` where it has to be checked; the check is a job that reads one column and runs
    at most once per instance, so share one among several analyses.

    ``user_columns`` names further columns of ``users`` to keep, by which players can be grouped.
    """

    users: DataFrame
    race: DataFrame
    items: DataFrame
    events: DataFrame
    unique_transactions: bool | None = None
    amount_scale: int = 2
    user_columns: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for name, columns in COLUMNS.items():
            more = dict.fromkeys(self.user_columns) if name == "users" else {}
            setattr(self, name, conform(getattr(self, name), more | columns))
        for key, one, other in SHARED_KEYS:
            kinds = [_types(getattr(self, table))[key] for table in (one, other)]
            if kinds[0] == kinds[1]:
                continue
            if not all(isinstance(k, T.IntegralType) for k in kinds):
                raise ValueError(
                    f"{key} is {kinds[0].simpleString()} in {one} "
                    f"but {kinds[1].simpleString()} in {other}"
                )
            for table in (one, other):
                setattr(self, table, _widened(getattr(self, table), key))
        kind = _types(self.events)["amount"]
        if isinstance(kind, T.IntegralType):
            self.amount_scale = 0
        elif isinstance(kind, T.DecimalType):
            self.amount_scale = kind.scale
        elif not isinstance(kind, T.FractionalType):
            raise ValueError(f"amount is {kind.simpleString()}, not a number")

    def money(self) -> Column:
        """``amount`` as an exact decimal with ``amount_scale`` places."""
        amount = F.col("amount")
        kind = _types(self.events)["amount"]
        if isinstance(kind, T.DecimalType):
            return amount
        exact = amount.cast(f"decimal(18,{self.amount_scale})")
        if isinstance(kind, T.IntegralType):
            return exact
        places = F.lit(f" does not fit into {self.amount_scale} decimal places")
        refused = F.raise_error(F.concat(F.lit("amount "), amount.cast("string"), places))
        return F.when(amount.isNull() | (exact.cast(kind) == amount), exact).otherwise(refused)

    def transactions_are_unique(self) -> bool:
        if self.unique_transactions is None:
            self.unique_transactions = is_unique(self.events, "transaction_id")
        return self.unique_transactions
