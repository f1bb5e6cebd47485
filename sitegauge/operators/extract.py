"""Pages to parsed documents, or to a reason why not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from sitegauge.functions.html import APP_DATA, assigned_object
from sitegauge.functions.nested import json_objects, list_rows
from sitegauge.sources.pages import utf8_text

INVALID_UTF8 = "invalid_utf8"
NO_OBJECT = "no_object"
BAD_JSON = "bad_json"


def parse_pages(
    pages: DataFrame, document: StructType, content: str = "html", variable: str = APP_DATA
) -> DataFrame:
    """Every page with ``parsed``, an array of its one document, and ``reason``.

    ``document`` declares the wanted part of the document. A good page has a NULL ``reason``,
    and the page text does not travel further. Narrow: no shuffle.
    """
    raw = F.col(content)
    text = utf8_text(raw) if isinstance(pages.schema[content].dataType, BinaryType) else raw
    keys = [c for c in pages.columns if c != content]
    # One select per step: a column that the next step names twice is worked out once.
    return (
        pages.select(*keys, text.alias("text"))
        .select(
            *keys,
            F.col("text").isNotNull().alias("readable"),
            assigned_object(F.col("text"), variable).alias("blob"),
        )
        .select(*keys, "readable", "blob", json_objects(F.col("blob"), document).alias("parsed"))
        .select(
            *keys,
            "parsed",
            F.when(~F.col("readable"), INVALID_UTF8)
            .when(F.col("blob").isNull(), NO_OBJECT)
            .when(F.col("parsed").isNull(), BAD_JSON)
            .alias("reason"),
        )
    )


def documents(parsed_pages: DataFrame) -> DataFrame:
    """The good pages, each with the fields of its document as columns.

    By the position in the list and not by ``reason``: a filter on that would go below the
    parsing and search each good page a second time.
    """
    keys = [c for c in parsed_pages.columns if c not in ("parsed", "reason")]
    return list_rows(parsed_pages, keys, F.col("parsed"))


def rejects(parsed_pages: DataFrame) -> DataFrame:
    """The other pages, with the reason."""
    return parsed_pages.where(F.col("reason").isNotNull()).drop("parsed")
