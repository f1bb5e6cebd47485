"""Configured paths of a document to flat columns, and their cleaning."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from sitegauge.functions.cleaning import clock_seconds, counted, percent_text
from sitegauge.functions.nested import json_text, last_of_keys, whole_numbers



def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


TEXT, WHOLE, NUMBER, SMALL = StringType(), LongType(), DoubleType(), IntegerType()

# The document's root, and the fields below it with their types. Month values are
# read as text, so that one odd value does not lose the whole history, and so are the two counts,
# which come in several spellings.
ROOT = ("layout", "data")
DATA = struct(
    domain=TEXT,
    overview=struct(
        globalRank=TEXT,
        visitsTotalCount=TEXT,
        bounceRateFormatted=TEXT,
        pagesPerVisit=NUMBER,
        visitsAvgDurationFormatted=TEXT,
    ),
    ranking=struct(
        globalRankCompetitorsHistory=MapType(TEXT, ArrayType(struct(date=TEXT, rank=TEXT)))
    ),
    traffic=struct(visitsHistory=MapType(TEXT, TEXT), visitsTotalCountChange=NUMBER),
    geography=struct(
        topCountriesTraffics=ArrayType(
            struct(
                countryAlpha2Code=TEXT, countryUrlCode=TEXT, visitsShare=NUMBER, visitsShareChange=NUMBER
            )
        )
    ),
    demographics=struct(
        ageDistribution=ArrayType(struct(minAge=SMALL, maxAge=SMALL, value=NUMBER))
    ),
)
DOCUMENT = struct(layout=struct(data=DATA))


@dataclass(frozen=True)
class PathSpec:
    """One projected column: its name and the keys that lead to it below the root.

    A number is a position in a list, for ``project_variants`` alone.
    """

    alias: str
    path: tuple[str | int, ...]

    def __post_init__(self) -> None:
        if not isinstance(self.alias, str) or not self.alias:
            raise ValueError("alias must be non-empty text")
        if not self.path or not all(isinstance(key, str) or (type(key) is int and key >= 0) for key in self.path):
            raise ValueError(f"path of {self.alias!r} must be a non-empty list of text")

    def column(self, root: Column) -> Column:
        return reduce(Column.getField, self.path, root).alias(self.alias)


# The eleven projected columns.
SITE_SPEC = (
    PathSpec("domain", ("domain",)),
    PathSpec("global_rank", ("overview", "globalRank")),
    PathSpec("total_visits", ("overview", "visitsTotalCount")),
    PathSpec("bounce_rate_raw", ("overview", "bounceRateFormatted")),
    PathSpec("pages_per_visit", ("overview", "pagesPerVisit")),
    PathSpec("avg_visit_duration_raw", ("overview", "visitsAvgDurationFormatted")),
    PathSpec("rank_history_raw", ("ranking", "globalRankCompetitorsHistory")),
    PathSpec("visits_history_raw", ("traffic", "visitsHistory")),
    PathSpec("last_month_change", ("traffic", "visitsTotalCountChange")),
    PathSpec("top_countries_raw", ("geography", "topCountriesTraffics")),
    PathSpec("age_distribution_raw", ("demographics", "ageDistribution")),
)


def path_type(path: Sequence[str]) -> DataType | None:
    """Declared type at a path below the root, None if nothing is declared there."""
    kind: DataType = DATA
    for key in path:
        if isinstance(key, int) and isinstance(kind, ArrayType):
            kind = kind.elementType
            continue
        if not isinstance(kind, StructType) or key not in kind.names:
            return None
        kind = kind[key].dataType
    return kind


def spec_types(
    specs: Iterable[PathSpec], types: Mapping[str, DataType] | None = None
) -> dict[str, DataType]:
    """Type of each projected column as read: the one in ``types``, else the declared one, else text.

    As text a nested value is its JSON, so any path of a configuration can be projected.
    """
    given = types or {}
    return {s.alias: given.get(s.alias) or path_type(s.path) or TEXT for s in specs}


def document_type(
    specs: Sequence[PathSpec], root: Sequence[str] = ROOT,
    types: Mapping[str, DataType] | None = None,
) -> StructType:
    """The part of a document that ``specs`` need; the reader skips the rest of its text."""
    specs = unequal(specs)
    kinds = spec_types(specs, types)
    return nested_type({(*root, *spec.path): kinds[spec.alias] for spec in specs})


def nested_type(leaves: Mapping[tuple[str, ...], DataType]) -> StructType:
    """Struct type with ``leaves`` at their paths.

    A path below another one is part of it; where that one has no type of its own, it gets one
    from the paths below.
    """
    fields: dict[str, dict[tuple[str, ...], DataType]] = {}
    for (first, *rest), kind in leaves.items():
        fields.setdefault(first, {})[tuple(rest)] = kind

    def kind_of(below: dict[tuple[str, ...], DataType]) -> DataType:
        own = below.pop((), None)
        if not below:
            return own
        if own is not None and own != TEXT:
            return own
        return nested_type(below)

    return struct(**{name: kind_of(dict(below)) for name, below in fields.items()})


def parse_spec(text: str, positions: bool = False) -> tuple[PathSpec, ...]:
    """A JSON list of ``{"alias": ..., "path": [...]}``.

    Any other key, two entries with one alias, or something else than a list is an error, and
    without ``positions`` a number in a path is one.
    """
    listed = json.loads(text) if text.strip() else None
    if not isinstance(listed, list):
        raise ValueError("the projection list must be a JSON list")
    specs: list[PathSpec] = []
    for entry in listed:
        if not isinstance(entry, dict):
            raise ValueError(f"not an entry of a projection list: {entry!r}")
        unknown = set(entry) - {"alias", "path"}
        if unknown:
            raise ValueError(f"unknown keys in the projection list: {sorted(unknown)}")
        spec = PathSpec(entry.get("alias"), tuple(entry.get("path") or ()))
        if not positions and any(isinstance(key, int) for key in spec.path):
            raise ValueError(f"path of {spec.alias!r} must be a non-empty list of text")
        specs.append(spec)
    return unequal(specs)


def unequal(specs: Iterable[PathSpec]) -> tuple[PathSpec, ...]:
    """The same specs, if their aliases differ; letters alone make no difference to Spark."""
    seen: set[str] = set()
    specs = tuple(specs)
    for spec in specs:
        if spec.alias.lower() in seen:
            raise ValueError(f"two columns of the projection list are called {spec.alias!r}")
        seen.add(spec.alias.lower())
    return specs


def load_spec(spark: SparkSession, path: str, positions: bool = False) -> tuple[PathSpec, ...]:
    """``parse_spec`` of one small file on any file system Spark reads."""
    found = spark.read.text(path, wholetext=True).head()
    return parse_spec(found[0] if found else "", positions)


def project(df: DataFrame, specs: Iterable[PathSpec], root: Sequence[str] = ROOT,
            keep: Sequence[str] = ()) -> DataFrame:
    """One column per spec, after the ``keep`` columns.

    A path that is typed only by other paths below it comes as the JSON text of what they hold.
    """
    specs = unequal(specs)
    top = reduce(Column.getField, root[1:], F.col(root[0]))
    kind = df.schema[root[0]].dataType
    for key in root[1:]:
        kind = kind[key].dataType
    paths = {spec.path for spec in specs}

    def column(spec: PathSpec) -> Column:
        below = any(p != spec.path and p[: len(spec.path)] == spec.path for p in paths)
        declared = isinstance(path_type(spec.path), StructType)
        if below and not declared and isinstance(leaf(kind, spec.path), StructType):
            return json_text(reduce(Column.getField, spec.path, top)).alias(spec.alias)
        return spec.column(top)

    return df.select(*keep, *(column(spec) for spec in specs))


def variant_path(path: Sequence[str | int]) -> str:
    """A path as Spark's variants take it; a key may hold one kind of quotes."""
    out = "$"
    for key in path:
        if isinstance(key, int):
            out += f"[{key}]"
        elif "'" not in key:
            out += f"['{key}']"
        elif '"' not in key:
            out += f'["{key}"]'
        else:
            raise ValueError(f"no path to a key with both kinds of quotes: {key!r}")
    return out


def project_variants(
    df: DataFrame, text: str, specs: Iterable[PathSpec], root: Sequence[str] = ROOT,
    types: Mapping[str, DataType] | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """One column per spec out of JSON text, after the ``keep`` columns; no schema of the document.

    The text is parsed once, to a variant, and the paths are taken from that, positions of lists
    included. A column has the type in ``types``, else the declared one, and else it is a variant
    that keeps the type of the document's own value, row by row. What is not there, or is of
    another type, is NULL, and so is all of a text that is not JSON or repeats a key.
    """
    given = types or {}
    whole = df.select(*keep, F.try_parse_json(F.col(text)).alias("_document"))

    def column(spec: PathSpec) -> Column:
        kind = given.get(spec.alias) or path_type(spec.path)
        wanted = kind.simpleString() if kind is not None else "variant"
        return F.try_variant_get("_document", variant_path((*root, *spec.path)), wanted).alias(spec.alias)

    return whole.select(*keep, *(column(spec) for spec in unequal(specs)))


def leaf(kind: DataType, path: Sequence[str]) -> DataType | None:
    """Type at ``path`` within a struct type."""
    for key in path:
        if not isinstance(kind, StructType) or key not in kind.names:
            return None
        kind = kind[key].dataType
    return kind


def clean(df: DataFrame) -> DataFrame:
    """Numbers of the two formatted columns, counts and month values as bigint, and one entry per
    key of the histories; a column that was not projected is passed over."""
    cleaned = {
        "global_rank": ("global_rank", lambda c: counted(c.cast("string"))),
        "total_visits": ("total_visits", lambda c: counted(c.cast("string"))),
        "bounce_rate_raw": ("bounce_rate_percent", percent_text),
        "avg_visit_duration_raw": ("avg_visit_duration_seconds", clock_seconds),
        "visits_history_raw": ("visits_history_raw", lambda m: whole_numbers(last_of_keys(m))),
        "rank_history_raw": ("rank_history_raw", last_of_keys),
    }
    return df.withColumns(
        {out: use(F.col(name)) for name, (out, use) in cleaned.items() if name in df.columns}
    )


def nested_columns(df: DataFrame) -> list[str]:
    """Names of the columns that a flat file cannot hold; looks at the schema only."""
    return [f.name for f in df.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))]


def flatten_nested(df: DataFrame) -> DataFrame:
    """Nested columns replaced by their JSON text."""
    return df.withColumns({name: json_text(F.col(name)) for name in nested_columns(df)})


def restore_nested(df: DataFrame, types: Mapping[str, DataType | str]) -> DataFrame:
    """JSON text columns replaced by values of the declared types."""
    return df.withColumns({name: F.from_json(name, kind) for name, kind in types.items()})


def flat_schema(specs: Iterable[PathSpec] = SITE_SPEC) -> StructType:
    """Columns of the flat file: the projected ones, nested ones as text, and the cleaned ones."""
    columns = {
        name: TEXT if isinstance(kind, (ArrayType, MapType, StructType)) else kind
        for name, kind in spec_types(specs).items()
    }
    columns |= {name: WHOLE for name in ("global_rank", "total_visits") if name in columns}
    return struct(**columns, bounce_rate_percent=NUMBER, avg_visit_duration_seconds=WHOLE)


def typed_sites(flat: DataFrame, specs: Iterable[PathSpec] = SITE_SPEC) -> DataFrame:
    """Rows of the flat file with their nested columns back, cleaned from the raw text again."""
    kinds = spec_types(specs)
    nested = {n: k for n, k in kinds.items() if isinstance(k, (ArrayType, MapType, StructType))}
    return clean(restore_nested(flat.select(*kinds), nested))
