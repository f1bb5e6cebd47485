"""Completeness, kinds of missing values, and volumes against expectation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sitegauge.functions.numeric import round_half_away
from sitegauge.sources.workdir import marked, remove

PRESENT = "present"
TRULY = "truly_missing"
EXPECTED = "expectedly_missing"
IMPLICIT = "implicitly_missing"


def completeness_report(df: DataFrame, source: str, columns: Sequence[str]) -> DataFrame:
    """Rows per source and the share of them that has a value, column by column."""
    return df.groupBy(source).agg(
        F.count("*").alias("n_rows"),
        *((F.count(c) / F.count("*")).alias(f"{c}_complete") for c in columns),
    )


def missing_class(value: Column, kind: str, expected: Column | None = None) -> Column:
    """Class of one value.

    A NULL is expectedly missing where ``expected`` holds and truly missing elsewhere. A value
    that only stands for a gap, 0 for a ``number`` or empty for a ``text``, is implicitly missing.
    """
    stand_in = value == 0 if kind == "number" else value == ""
    absent = F.lit(TRULY) if expected is None else F.when(expected, EXPECTED).otherwise(TRULY)
    return F.when(value.isNull(), absent).when(stand_in, IMPLICIT).otherwise(PRESENT)


def missing_report(
    df: DataFrame, by: str, kinds: Mapping[str, str], expected: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows per ``by``, column and class. One pass with a counter for each column and class."""
    classes = {c: missing_class(F.col(f"`{c}`"), k, (expected or {}).get(c)) for c, k in kinds.items()}
    counted = df.groupBy(by).agg(
        *(
            F.struct(
                F.lit(column).alias("field"), F.lit(name).alias("class"),
                F.count_if(found == name).alias("n_rows"),
            ).alias(f"_{at}_{name}")
            for at, (column, found) in enumerate(classes.items())
            for name in (PRESENT, TRULY, EXPECTED, IMPLICIT)
        )
    )
    counters = [F.col(c) for c in counted.columns[1:]]
    rows = counted.select(by, F.explode(F.array(*counters)).alias("_counter"))
    return rows.select(by, "_counter.*").where("n_rows > 0")


def volume_check(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], tolerance: float
) -> DataFrame:
    """Counts against expected counts per key, with an alert where they are too far apart.

    ``actual`` has ``n_actual`` and ``expected`` has ``n_expected``; a key in only one of the two
    counts 0 in the other. ``deviation`` is relative to the expectation, NULL if that is 0,
    which alerts as well.
    """
    both = actual.join(expected, list(keys), "full").fillna(0, ["n_actual", "n_expected"])
    gap = F.col("n_actual") - F.col("n_expected")
    off = gap / F.nullif(F.col("n_expected").cast("double"), F.lit(0.0))
    return both.withColumn("deviation", round_half_away(off, 4)).withColumn(
        "alert", F.coalesce(F.abs(off) > tolerance, F.lit(True))
    )


# Checks while a job runs


def watched_write(
    df: DataFrame, path: str, metrics: Mapping[str, Column],
    limits: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Write ``df`` as Parquet to ``path``; the rows of ``check_rows`` for what was counted on the way.

    ``metrics`` are aggregates over the rows written, worked out by the writing job itself: no
    second pass, and the counts are those of the very rows in the files.
    """
    seen = Observation()
    df.observe(seen, *(column.alias(name) for name, column in metrics.items())).write.parquet(path)
    return check_rows(df.sparkSession, seen.get, limits or {})


def check_rows(
    spark: SparkSession, values: Mapping[str, object], limits: Mapping[str, tuple[float | None, float | None]]
) -> DataFrame:
    """``metric``, ``value``, ``low``, ``high`` and ``alert``, one row per metric.

    ``alert`` tells that a value is below ``low``, above ``high``, or missing where there is a
    limit. A limit for a metric that was not measured alerts as well.
    """
    rows = []
    for name in {**values, **limits}:
        value, (low, high) = values.get(name), limits.get(name, (None, None))
        number = None if value is None else float(value)
        if number is None:
            alert = low is not None or high is not None
        else:
            alert = (low is not None and number < low) or (high is not None and number > high)
        low, high = (None if x is None else float(x) for x in (low, high))
        rows.append((name, number, low, high, alert))
    return spark.createDataFrame(rows, "metric string, value double, low double, high double, alert boolean")


# Rules for missing values as a table

#: Rules up to this number go to every task, more are joined by field.
SENT_RULES = 10_000


def missing_by_rules(df: DataFrame, by: str, kinds: Mapping[str, str], rules: DataFrame) -> DataFrame:
    """``missing_report`` with the classes of missing values taken from the table ``rules``.

    A rule has ``priority``, ``field``, ``state`` (``null``, ``stand_in``, or NULL for both),
    ``other``, ``low``, ``high``, ``text`` and ``class``. It holds for a missing value of its field
    if ``other`` is NULL, or if the value of the column ``other`` in the same row is a number from
    ``low`` up to ``high`` (NULL is no limit), or the text ``text`` where that is given. The rule
    with the smallest priority that holds gives the class, of equal ones the first by class; without
    one a NULL is truly and a stand-in implicitly missing. Rules for other fields are not looked at.
    """
    listed = rules.where(F.col("field").isin(list(kinds)))
    others = [r["other"] for r in listed.where("other IS NOT NULL").select("other").distinct().collect()]
    unknown = sorted(set(others) - set(df.columns))
    if unknown:
        raise ValueError(f"rules name columns that are not there: {unknown}")
    one = F.struct("priority", "class", "state", "other", "low", "high", "text")
    lists = listed.groupBy("field").agg(F.sort_array(F.collect_list(one)).alias("_rules"))
    if listed.count() <= SENT_RULES:
        lists = F.broadcast(lists)
    values = [
        F.struct(
            F.lit(name).alias("field"),
            F.when(F.col(f"`{name}`").isNull(), "null")
            .when(F.col(f"`{name}`") == (0 if kind == "number" else ""), "stand_in")
            .alias("state"),
        )
        for name, kind in kinds.items()
    ]
    texts = [part for name in sorted(others) for part in (F.lit(name), F.col(f"`{name}`").cast("string"))]
    beside = F.create_map(*texts) if texts else F.lit(None).cast("map<string,string>")
    long = df.select(F.col(by), beside.alias("_beside"), F.explode(F.array(*values)).alias("_v"))
    long = long.select(by, "_beside", "_v.*").join(lists, "field", "left")

    def holds(rule: Column) -> Column:
        found = F.element_at("_beside", rule["other"])
        number = found.try_cast("double")
        within = (
            number.isNotNull()
            & (rule["low"].isNull() | (number >= rule["low"]))
            & (rule["high"].isNull() | (number <= rule["high"]))
        )
        on_other = F.when(rule["text"].isNotNull(), found == rule["text"]).otherwise(within)
        on_state = rule["state"].isNull() | (rule["state"] == F.col("state"))
        return on_state & (rule["other"].isNull() | F.coalesce(on_other, F.lit(False)))

    first = F.get(F.filter(F.coalesce("_rules", F.array().cast(lists.schema["_rules"].dataType)), holds), 0)["class"]
    plain = F.when(F.col("state") == "null", TRULY).otherwise(IMPLICIT)
    found = F.when(F.col("state").isNull(), PRESENT).otherwise(F.coalesce(first, plain))
    return long.groupBy(by, "field", found.alias("class")).agg(F.count(F.lit(1)).alias("n_rows"))


# Completeness over all batches


def add_counters(df: DataFrame, store: str, batch: str, source: str, columns: Sequence[str]) -> None:
    """Counters of one batch, in place of any that this batch left before: rows and values per
    source, and a sketch of the different values of every column."""
    counted = df.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(
            F.struct(F.count(f"`{c}`").alias("n"), F.hll_sketch_agg(F.col(f"`{c}`").cast("string")).alias("sketch")).alias(f"c_{at}")
            for at, c in enumerate(columns)
        ),
    )
    listed = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"c_{at}").alias("value")) for at, c in enumerate(columns)))
    rows = counted.select("source", "n_rows", F.explode(listed).alias("f"))
    rows.select("source", "n_rows", "f.field", "f.value.n", "f.value.sketch").write.mode("overwrite").parquet(f"{store}/batch={batch}")


def completeness_so_far(spark: SparkSession, store: str) -> DataFrame:
    """Rows, values, their share and about how many different ones, per source and field, over all
    batches. Reads counters and sketches alone, a row per batch, source and field."""
    parts = marked(spark, f"{store}/batch=*")
    schema = "source string, n_rows long, field string, n long, sketch binary"
    rows = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    return rows.groupBy("source", "field").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n").alias("n_values"),
        (F.sum("n") / F.sum("n_rows")).alias("complete"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about_distinct"),
    )


def forget_batch(spark: SparkSession, store: str, batch: str) -> None:
    """Take a batch out of the counters."""
    remove(spark, f"{store}/batch={batch}")
