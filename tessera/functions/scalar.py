"""Scalar helpers built from Spark's own functions (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAYMENT_SCHEMA = "array<struct<iin:string,amount:decimal(18,2),description:string>>"


def add_column_if_absent(df: DataFrame, name: str, default: Column) -> DataFrame:
    """ALTER TABLE ... ADD COLUMN IF NOT EXISTS name DEFAULT value (backfills rows)."""
    return df if name in df.columns else df.withColumn(name, default)


def format_text(fmt: str, *args: Column) -> Column:
    """FORMAT with %s placeholders; a NULL argument prints as empty text."""
    return F.format_string(fmt, *[F.coalesce(a.cast("string"), F.lit("")) for a in args])


def age_years(as_of: Column, born: Column) -> Column:
    """Whole years from ``born`` to ``as_of`` (EXTRACT(YEAR FROM AGE(as_of, born))).

    One year is subtracted when the month-day of ``as_of`` is before the
    month-day of ``born``; month arithmetic is avoided on purpose because it
    treats two month-ends as whole months.
    """
    early = F.date_format(as_of, "MMdd") < F.date_format(born, "MMdd")
    return (F.year(as_of) - F.year(born) - F.when(early, 1).otherwise(0)).cast("long")


def year_equals(col: str, year: int) -> Column:
    """``EXTRACT(YEAR FROM col) = year`` as a half-open range on the column
    itself, so Parquet statistics can skip row groups (what an expression
    index on the year does in a row store)."""
    c = F.col(col)
    return (c >= F.lit(f"{year:04d}-01-01").cast("date")) & (c < F.lit(f"{year + 1:04d}-01-01").cast("date"))


def json_object(**fields: Column) -> Column:
    """jsonb_build_object(k1, v1, ...): NULL values are kept as JSON null."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]),
                     {"ignoreNullFields": "false"})


def payments_json(orders: DataFrame) -> DataFrame:
    """Per order, a JSON array of two payments (customer IIN with the order
    total, and the order's own IIN with 1.50) -- test input for JSON unnesting.
    Some orders carry an empty list, no document or a broken one instead."""
    iin = lambda c: F.lpad(F.col(c).cast("string"), 12, "0")
    text = F.concat(
        F.lit('[{"iin": "'), iin("o_custkey"), F.lit('", "amount": '),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit('},'),
        F.lit(' {"iin": "'), iin("o_orderkey"), F.lit('", "amount": 1.50}]'),
    )
    kind = F.col("o_orderkey") % 16
    text = F.when(kind == 0, "[]").when(kind == 1, F.lit(None)).when(kind == 2, '[{"iin": ').otherwise(text)
    return orders.select("o_orderkey", text.alias("payments"))


#: Fields are read as text first, so that an amount that is no number is seen.
_PAYMENT_TEXT = "array<struct<iin:string, amount:string, description:string>>"


def parse_payments(df: DataFrame, keep: Sequence[str], col: str = "payments") -> DataFrame:
    """``keep``, ``document`` ('ok', 'empty' or 'malformed') and the parsed ``items`` of a JSON array column.

    A document is malformed when it is NULL, no JSON array, or holds an amount
    that is no number (which a cast of the element would refuse).
    """
    items = F.from_json(col, _PAYMENT_TEXT)
    parsed = df.select(*keep, F.col(col).alias("__doc"), items.alias("items"))
    wrong = F.exists("items", lambda p: p["amount"].isNotNull() & p["amount"].try_cast("decimal(18,2)").isNull())
    array = F.ltrim("__doc").startswith("[") & F.col("items").isNotNull()
    document = (F.when(~F.coalesce(array, F.lit(False)) | F.coalesce(wrong, F.lit(False)), "malformed")
                .when(F.size("items") == 0, "empty").otherwise("ok"))
    return parsed.withColumn("document", document).drop("__doc")


def explode_payments(df: DataFrame, keep: Sequence[str], col: str = "payments") -> DataFrame:
    """jsonb_array_elements over a JSON array column, with 1-based positions.

    No document is lost: an empty or malformed one gives a row without payment.
    """
    parsed = parse_payments(df, keep, col)
    items = F.when(F.col("document") == "ok", F.col("items"))
    rows = parsed.select(*keep, "document", F.posexplode_outer(items).alias("__pos", "__p"))
    return rows.select(*keep, "document", (F.col("__pos") + 1).cast("long").alias("pos"), F.col("__p.iin").alias("iin"),
                       F.col("__p.amount").cast("decimal(18,2)").cast("double").alias("amount"))


def explode_payment_rows(df: DataFrame, keep: Sequence[str], col: str = "payments") -> DataFrame:
    """Payment rows (pos, iin, amount as decimal, description) of the well-formed documents."""
    parsed = parse_payments(df, keep, col).where(F.col("document") == "ok")
    rows = parsed.select(*keep, F.posexplode("items").alias("__pos", "__p"))
    return rows.select(*keep, (F.col("__pos") + 1).cast("int").alias("pos"), F.col("__p.iin").alias("iin"),
                       F.col("__p.amount").cast("decimal(18,2)").alias("amount"),
                       F.col("__p.description").alias("description"))
