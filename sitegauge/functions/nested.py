"""Maps, lists of structs and their JSON text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

# The lenient defaults of the JSON reader that a strict parser does not share.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out a single time per row, however often ``use``
    names it. A plain column is put in place of each mention, also inside lambdas, where it
    would run again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def json_objects(text: Column, document: StructType) -> Column:
    """Text of one object as an array of one struct; NULL for anything but one whole object.

    Read as the one element of a list, because the reader stops after a complete value: text
    after the object would go unseen without the closing bracket. A field of the wrong type is
    NULL and the rest of the document stays.
    """
    listed = F.concat(F.lit("["), text, F.lit("]"))
    parsed = F.from_json(listed, ArrayType(document), STRICT)
    return once(parsed, lambda found: F.when(F.size(found) == 1, found))


def json_text(value: Column) -> Column:
    """JSON text with its nulls written out; NULL stays NULL."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def map_rows(df: DataFrame, keep: Sequence[str], entries: Column, key: str, value: str) -> DataFrame:
    """One row per map entry beside the ``keep`` columns; a NULL or empty map gives none.

    ``entries`` is worked out once. Below a plain ``explode`` or ``inline`` Spark puts a filter on
    the size of its input, which works the same expression out a second time; the outer form
    has none, and what it adds for an empty input goes by its missing key.
    """
    rows = df.select(*keep, F.explode_outer(entries).alias(key, value))
    return rows.where(F.col(key).isNotNull())


def list_rows(df: DataFrame, keep: Sequence[str], items: Column) -> DataFrame:
    """One row per struct of a list, its fields beside the ``keep`` columns; see ``map_rows``."""
    rows = df.select(*keep, F.posexplode_outer(items).alias("_at", "_item"))
    return rows.where(F.col("_at").isNotNull()).select(*keep, "_item.*")


def last_of_keys(read: Column) -> Column:
    """A map read from JSON text with one entry per key: the last one, as JSON readers have it.
    Spark's reader keeps them all, and a series would get a month twice."""

    def last(found: Column) -> Column:
        keys = F.map_keys(found)
        backwards = F.reverse(F.map_entries(found))
        one_each = entries_map(backwards, lambda e: e["key"], lambda e: e["value"])
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), found).otherwise(one_each)

    return once(read, last)


def whole_numbers(texts: Column) -> Column:
    """Map values as bigint, each by itself: one bad value does not cost the others."""
    return F.transform_values(texts, lambda _, text: whole_number(text))


def whole_number(text: Column) -> Column:
    """JSON number text as bigint, rounded; NULL if it is no number."""
    return F.round(text.try_cast("decimal(38,6)"), 0).try_cast("bigint")


def utc_date(text: Column) -> Column:
    """Date of a date or timestamp text, taken in UTC whatever the session's zone is."""
    moment = F.to_utc_timestamp(text.try_cast("timestamp"), F.current_timezone())
    return F.coalesce(F.when(F.length(text) == 10, text.try_cast("date")), moment.cast("date"))


def entries_map(items: Column, key: Callable, value: Callable) -> Column:
    """Map made of a list. A NULL key is left out and of equal keys the first one stays, so
    that one odd document cannot fail the job."""
    pairs = F.filter(
        F.transform(items, lambda item: F.struct(key(item).alias("key"), value(item).alias("value"))),
        lambda pair: pair["key"].isNotNull(),
    )

    def unique(found: Column, keys: Column) -> Column:
        first = F.filter(found, lambda pair, at: F.array_position(keys, pair["key"]) == at + 1)
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), found).otherwise(first)

    return F.map_from_entries(
        once(pairs, lambda found: once(found["key"], lambda keys: unique(found, keys)))
    )
