"""Chat formatting: collapse of cumulative snapshots, then rendering.

Logs often hold a conversation once per turn. Each turn has a hash of its position, role and
text; the exclusive or of the first k is the hash of the prefix of k turns. A conversation whose
whole hash is the prefix hash of a longer one is dropped by an anti-join; of equal conversations
the one with the smallest id stays. Equal turns are counted before they are sorted, and unlike ones
are sorted by range over the whole table, so a conversation of any length, with any turn numbers, is
dealt over tasks. Positions are carried over from range to range, prefix hashes from chunk to chunk
of `CHUNK_TURNS` positions. Hashes are two 64-bit numbers beside the number of turns.

Turns are in order of turn (null last), role, text; equal rows are turns one after another. Null
roles and texts are values of their own and are rendered as empty. Rows without a conversation id
form one conversation, which has no id. An empty table gives an empty one. Markers in a text are
broken by a backslash, so a rendered conversation can be split again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costwatch.staging import stage

CHUNK_TURNS = 1024
HASHES = ("h1", "h2")


def hashed_turns(turns: DataFrame) -> DataFrame:
    """conv_id, position (from 1), role, text and the hashes of the prefix that ends there."""
    order = [F.col(c).asc_nulls_last() for c in ("turn", "role", "text")]
    unlike = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("_own_n"))
    ranges = unlike.repartitionByRange("conv_id", *order)
    # Written with the number of its range, which sorts like the rows.
    unlike = stage(ranges.withColumn("_chunk", F.spark_partition_id()), "chat_ranges")
    upto_row = Window.partitionBy("conv_id", "_chunk").orderBy(*order)
    upto_row = upto_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = unlike.withColumn("_last", F.sum("_own_n").over(upto_row))

    def carried(frame: DataFrame, columns: list[str], fold) -> DataFrame:
        """`frame` with `_past` columns: the fold of all earlier chunks of the conversation."""
        before = Window.partitionBy("_conv").orderBy(F.col("_part").asc_nulls_last())
        before = before.rowsBetween(Window.unboundedPreceding, -1)
        key = [F.col("conv_id").alias("_conv"), F.col("_chunk").alias("_part")]
        sums = frame.groupBy(*key).agg(*[fold(f"_own_{c}").alias(c) for c in columns])
        past = [F.coalesce(fold(c).over(before), F.lit(0)).alias(f"_past_{c}") for c in columns]
        same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("_chunk").eqNullSafe(F.col("_part"))
        return frame.join(sums.select("_conv", "_part", *past), same).drop("_conv", "_part")

    last = F.col("_past_n") + F.col("_last")
    counted = carried(placed, ["n"], F.sum).withColumn("_last", last)
    # Equal turns get a row each again, by parts of a bounded length.
    first, size = F.col("_last") - F.col("_own_n") + 1, F.lit(CHUNK_TURNS)
    parts = counted.select(
        "conv_id", "role", "text", "_last", F.explode(F.sequence(first, F.col("_last"), size)).alias("_from")
    )
    upto_part = F.least("_last", F.col("_from") + size - 1)
    single = parts.select(
        "conv_id", "role", "text", F.explode(F.sequence("_from", upto_part)).alias("position")
    )
    chunk = F.floor((F.col("position") - 1) / CHUNK_TURNS).alias("_chunk")
    known = [F.coalesce(c, F.lit("")) for c in ("role", "text")]
    missing = [F.col(c).isNull() for c in ("role", "text")]
    keyed = single.select("conv_id", chunk, "role", "text", "position").withColumns(
        {
            f"_own_{h}": F.xxhash64(F.lit(h), "position", *known, *missing)
            for h in HASHES
        }
    )
    upto = Window.partitionBy("conv_id", "_chunk").orderBy("position")
    summed = carried(keyed, list(HASHES), F.bit_xor)
    prefix = [F.bit_xor(f"_own_{h}").over(upto).bitwiseXOR(F.col(f"_past_{h}")).alias(h) for h in HASHES]
    return summed.select("conv_id", "position", "role", "text", *prefix)


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """conv_id, n_turns of the conversations that are no prefix of a longer one, each once."""
    sizes = hashed.groupBy("conv_id").agg(F.max("position").alias("n_turns"))
    whole = (
        hashed.withColumnRenamed("conv_id", "_id")
        .join(sizes, F.col("_id").eqNullSafe(F.col("conv_id")))
        .drop("_id")
    )
    ends = F.col("position") == F.col("n_turns")
    full = whole.filter(ends).groupBy("position", *HASHES).agg(F.min("conv_id").alias("conv_id"))
    inner = whole.filter(~ends).select("position", *HASHES).distinct()
    return full.join(inner, ["position", *HASHES], "left_anti").select(
        "conv_id", F.col("position").alias("n_turns")
    )


def render_turns(turns: DataFrame) -> DataFrame:
    """`turns` with `rendered`: the turn between role and end markers."""
    part = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("<\\|"))
    text = F.concat(
        F.lit("<|"), part(F.col("role")), F.lit("|>\n"), part(F.col("text")), F.lit("<|end|>\n")
    )
    return turns.withColumn("rendered", text)


def chat_turns(conversations: DataFrame) -> DataFrame:
    """Rendered turns of the maximal conversations: conv_id, position, n_turns, rendered.

    In order of position they concatenate to the conversation; a row per turn, as one
    conversation may be longer than a task can hold.
    """
    hashed = stage(hashed_turns(conversations), "chat_turns")
    kept = maximal_conversations(hashed).withColumnRenamed("conv_id", "_id")
    chosen = hashed.join(kept, F.col("conv_id").eqNullSafe(F.col("_id")))
    return render_turns(chosen).select("conv_id", "position", "n_turns", "rendered")


CHAT_SQL = r"""
WITH placed AS (
  SELECT conv_id, role, text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS position
  FROM conversations),
whole AS (
  SELECT conv_id, count(*) AS n_turns,
         list({'role': role, 'text': text} ORDER BY position) AS turns
  FROM placed GROUP BY conv_id),
unlike AS (SELECT min(conv_id) AS conv_id, n_turns, turns FROM whole GROUP BY n_turns, turns),
kept AS (
  SELECT conv_id, n_turns FROM unlike AS a
  WHERE NOT EXISTS (
    SELECT 1 FROM unlike AS b
    WHERE b.n_turns > a.n_turns AND b.turns[1] = a.turns[1] AND b.turns[1:a.n_turns] = a.turns))
SELECT p.conv_id, p.position, k.n_turns,
       '<|' || replace(coalesce(role, ''), '<|', '<\|') || '|>' || chr(10)
       || replace(coalesce(text, ''), '<|', '<\|') || '<|end|>' || chr(10) AS rendered
FROM placed AS p JOIN kept AS k ON p.conv_id IS NOT DISTINCT FROM k.conv_id
"""
