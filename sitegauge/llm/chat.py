"""Multi-party dialogues as training text: one rendering from every participant's side.

In a rendering its speaker is the assistant, whose words are trained on, and all others are
users with their names. A dialogue is cut into parts of bounded length before its turns are
brought together, so that one of any length is spread over many rows and tasks; where many rows
share a turn, or have none, they are cut into pieces as well. Texts and names are escaped one to
one: no text can pass for a marker, and every rendering can be read back.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.sources.workdir import stored

# Turn numbers of a part: turns 0 to 63, 64 to 127 and so on.
PART_TURNS = 64
#: Rows of a part beyond which it is cut by its turns, and rows of one turn by their hash.
PART_ROWS = 256
#: Roles that speak to all and are no participants, a fixed value.
NARRATORS = ("system",)

OPEN, CLOSE, END = "<|", "|>", "<|end|>\n"


# What is escaped in texts and, beyond that, in names: the second sign of a marker by a backslash.
IN_TEXTS = (("\\", "\\\\"), (OPEN, "<\\|"))
IN_NAMES = (*IN_TEXTS, (CLOSE, "|\\>"), ("\n", "\\n"))


def escaped(column: Column, signs: tuple[tuple[str, str], ...] = IN_TEXTS) -> Column:
    """Backslashes doubled, then markers broken by one: the text is what stands without them."""
    for sign, instead in signs:
        column = F.replace(column, F.lit(sign), F.lit(instead))
    return column


def segments(speaker: Column, turn: Column) -> Column:
    """Head and body of one turn, as seen by ``speaker``."""
    own = turn["role"] == speaker
    head = (
        F.when(own, F.lit(f"{OPEN}assistant{CLOSE}\n"))
        .when(turn["role"].isin(*NARRATORS), F.concat(F.lit(OPEN), turn["role"], F.lit(f"{CLOSE}\n")))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), escaped(turn["role"], IN_NAMES), F.lit(f"{CLOSE}\n")))
    )
    return F.struct(
        head.alias("head"), F.concat(turn["text"], F.lit(END)).alias("body"), own.alias("own")
    )


def pieces(clean: DataFrame, part_rows: int) -> DataFrame:
    """``clean`` with ``piece``, its rows dealt to pieces of about ``part_rows`` where a part has more.

    Such a part is cut by its turns, and a turn with more rows by the hash of role and text. All
    that is counted is counted in the map tasks first; no row of another part goes through a join
    with the few parts that are large but by its key.
    """
    key = [F.col("conv_id"), F.col("part")]
    large = clean.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_rows)
    if large.isEmpty():
        return clean.withColumn("piece", F.lit("0"))
    names = large.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"))
    same = [column.eqNullSafe(F.col(name)) for column, name in zip(key, ("_conv", "_part"))]
    turns = clean.join(names.hint("merge"), same, "left_semi").groupBy("conv_id", "part", "turn").agg(F.count(F.lit(1)).alias("_n"))
    turns = turns.select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("turn").alias("_turn"), F.ceil(F.col("_n") / part_rows).alias("_pieces")
    )
    same = [*same, F.col("turn").eqNullSafe(F.col("_turn"))]
    digest = F.conv(F.substring(F.md5(F.concat("role", F.lit("\n"), "text")), 1, 8), 16, 10).cast("long")
    number = F.concat(F.coalesce(F.col("_turn").cast("string"), F.lit("")), F.lit("."), F.pmod(digest, F.col("_pieces")).cast("string"))
    marked = clean.join(turns.hint("merge"), same, "left")
    piece = F.when(F.col("_pieces").isNull(), F.lit("0")).otherwise(number)
    return marked.withColumn("piece", piece).select(*clean.columns, "piece")


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per conversation, participant, part and piece of the dialogue.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not looked
    at. Columns: ``conv_id``, ``speaker``, ``part`` (turn divided by ``part_turns``), ``piece``
    (``0``, or turn and number where a part has more than ``part_rows`` rows),
    ``n_turns``, ``text`` and ``mask``, the spans of code points of ``text`` that are trained on:
    the speaker's words with their end marker.

    Turns stand by turn, role and text; a row that is repeated in these and ``conv_id`` counts
    once. A NULL role is the participant ``unknown``, a NULL text is empty, a NULL turn stands
    first, in part NULL. NULL ``conv_id`` is one conversation. Narrators are rendered for all
    and have no rendering of their own; a dialogue of narrators alone gives no row.
    """
    clean = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Repeated rows go before they are brought together, so that they cannot swell a part.
    clean = clean.distinct().withColumn("text", escaped(F.col("text")))
    clean = clean.withColumn("part", F.floor(F.col("turn") / part_turns).cast("long"))
    clean = stored(clean, "turns")
    parts = pieces(clean, part_rows).groupBy("conv_id", "part", "piece").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    speakers = (
        clean.where(~F.col("role").isin(*NARRATORS))
        .groupBy("conv_id", "role")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker"))
    )
    joined = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))
    seen = F.transform("turns", lambda t: segments(F.col("speaker"), t))
    # Walk over the turns once: length so far, and the spans of the speaker's words.
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def walk(state: Column, s: Column) -> Column:
        at = state["at"] + F.length(s["head"])
        end = at + F.length(s["body"])
        span = F.struct(at.alias("start"), end.alias("end"))
        spans = F.when(s["own"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return joined.withColumn("seen", seen).select(
        "conv_id",
        "speaker",
        "part",
        "piece",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("seen", lambda s: F.concat(s["head"], s["body"])), "").alias("text"),
        F.aggregate("seen", start, walk, lambda s: s["spans"]).alias("mask"),
    )


def digest(rendered: DataFrame) -> DataFrame:
    """The rows with the mask as text, ``start:end`` joined by commas."""
    spans = F.transform(
        "mask", lambda m: F.concat(m["start"].cast("string"), F.lit(":"), m["end"].cast("string"))
    )
    return rendered.withColumn("mask", F.array_join(spans, ","))


def oracle(part_turns: int = PART_TURNS, part_rows: int = PART_ROWS) -> str:
    """The same as SQL: every turn has its place by running lengths."""
    narrators = ", ".join(f"'{n}'" for n in NARRATORS)

    def replaced(column: str, signs: tuple[tuple[str, str], ...]) -> str:
        for sign, instead in signs:
            told = "chr(10)" if sign == "\n" else f"'{sign}'"
            column = f"replace({column}, {told}, '{instead}')"
        return column

    return f"""
WITH clean AS MATERIALIZED (
  SELECT conv_id, turn, role, {replaced("text", IN_TEXTS)} AS text, CAST(floor(turn / {part_turns}) AS BIGINT) AS part
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations)),
sized AS (
  SELECT *, count(*) OVER (PARTITION BY conv_id, part) AS n_part,
         (count(*) OVER (PARTITION BY conv_id, part, turn) + {part_rows - 1}) // {part_rows} AS n_pieces FROM clean),
cut AS MATERIALIZED (
  SELECT *, CASE WHEN n_part <= {part_rows} THEN '0'
                 ELSE coalesce(CAST(turn AS VARCHAR), '') || '.' ||
                      CAST(CAST('0x' || substr(md5(role || chr(10) || text), 1, 8) AS BIGINT) % n_pieces AS VARCHAR) END AS piece
  FROM sized),
speakers AS (
  SELECT DISTINCT conv_id, role AS speaker FROM clean WHERE role NOT IN ({narrators})),
seen AS (
  SELECT c.conv_id, s.speaker, c.part, c.piece, c.turn, c.role, c.text AS raw, c.role = s.speaker AS own,
         CASE WHEN c.role = s.speaker THEN '{OPEN}assistant{CLOSE}' || chr(10)
              WHEN c.role IN ({narrators}) THEN '{OPEN}' || c.role || '{CLOSE}' || chr(10)
              ELSE '{OPEN}user name=' || {replaced("c.role", IN_NAMES)} || '{CLOSE}' || chr(10) END AS head,
         c.text || '<|end|>' || chr(10) AS body
  FROM cut c JOIN speakers s ON s.conv_id IS NOT DISTINCT FROM c.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (
    PARTITION BY conv_id, speaker, part, piece ORDER BY turn NULLS FIRST, role, raw ROWS UNBOUNDED PRECEDING) AS upto
  FROM seen)
SELECT conv_id, speaker, part, piece, CAST(count(*) AS INTEGER) AS n_turns,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, raw) AS text,
       coalesce(string_agg(CASE WHEN own THEN CAST(upto - length(body) AS VARCHAR) || ':' || CAST(upto AS VARCHAR) END,
                           ',' ORDER BY turn NULLS FIRST, role, raw), '') AS mask
FROM placed GROUP BY conv_id, speaker, part, piece"""
