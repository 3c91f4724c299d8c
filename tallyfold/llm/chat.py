"""Chat logs: collapse of cumulative snapshots, and rendering.

A service that logs a conversation after every turn leaves all its beginnings behind. The
hash of a conversation's first n turns, for every n, shows which logged conversation
is the beginning of a longer one; anti-joins leave the longest ones, and of equal ones
that with the smallest id. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import stored

#: Turns of a conversation that one window sees; longer ones are put together from stretches.
STRETCH = 1024
ROLES = {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"}


def _turn_hash(seed: int) -> Column:
    """Hash of a turn at its place; null and empty fields differ."""
    fields = [F.struct(F.col(c).isNull().alias("none"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value"))
              for c in ("role", "text")]
    return F.xxhash64(F.lit(seed), F.col("place"), *fields)


def placed_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(conv_id, place, role, text): turns numbered from 1 in the order of turn, role and text, nulls first.

    Rows repeated as a whole count once. A long conversation is numbered in stretches of
    turn numbers whose sizes are added up, so no window holds more than one stretch (or
    the turns that share a number).
    """
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text")).distinct()
    rows = rows.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    sizes = rows.groupBy("conv_id", "stretch").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("conv_id", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("conv_id", "stretch").orderBy(
        F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    numbered = rows.withColumn("nth", F.row_number().over(within)).alias("r")
    met = numbered.join(firsts.alias("f"), F.col("r.conv_id").eqNullSafe(F.col("f.conv_id"))
                        & F.col("r.stretch").eqNullSafe(F.col("f.stretch")))
    return met.select("r.conv_id", (F.col("f.base") + F.col("r.nth")).cast("int").alias("place"), "r.role", "r.text")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, h1, h2): rolling hashes of the first ``place`` turns of ``placed_turns``.

    The hash of a prefix is the exclusive or of its turns' hashes, each of which covers the
    turn's place. Stretches are summed first, so a long conversation is not one window.
    """
    rows = turns.select("conv_id", "place", _turn_hash(1).alias("t1"), _turn_hash(2).alias("t2")).withColumn(
        "stretch", F.floor((F.col("place") - 1) / STRETCH))
    sums = rows.groupBy("conv_id", "stretch").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("conv_id", "stretch", *[
        F.coalesce(F.bit_xor(f"s{k}").over(before), F.lit(0)).alias(f"b{k}") for k in (1, 2)])
    within = Window.partitionBy("conv_id", "stretch").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = rows.select("conv_id", "stretch", "place", *[F.bit_xor(f"t{k}").over(within).alias(f"w{k}") for k in (1, 2)])
    met = rolled.alias("r").join(bases.alias("b"), F.col("r.conv_id").eqNullSafe(F.col("b.conv_id"))
                                 & (F.col("r.stretch") == F.col("b.stretch")))
    return met.select("r.conv_id", "r.place", *[
        F.col(f"w{k}").bitwiseXOR(F.col(f"b{k}")).alias(f"h{k}") for k in (1, 2)])


def maximal(placed: DataFrame) -> DataFrame:
    """(conv_id, turns): conversations that begin no longer one, the smallest id of equal ones."""
    rolled = stored(prefixes(placed), "turn-prefixes")
    lengths = rolled.groupBy("conv_id").agg(F.max("place").alias("turns"))
    ends = rolled.alias("p").join(lengths.alias("l"), F.col("p.conv_id").eqNullSafe(F.col("l.conv_id"))
                                  & (F.col("p.place") == F.col("l.turns"))).select("p.conv_id", "l.turns", "h1", "h2")
    once = ends.groupBy("turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    # every proper beginning, once; copies add up before they are shuffled
    proper = rolled.alias("p").join(lengths.alias("l"), F.col("p.conv_id").eqNullSafe(F.col("l.conv_id"))
                                    & (F.col("p.place") < F.col("l.turns"))).select(
        F.col("place").alias("turns"), "h1", "h2").distinct()
    return once.join(proper, ["turns", "h1", "h2"], "left_anti").select("conv_id", "turns")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template; unknown and null roles show their name in the mark."""
    mark = F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))
    for name, known in ROLES.items():
        mark = F.when(role == name, F.lit(known)).otherwise(mark)
    return F.concat(mark, F.coalesce(text, F.lit("")), F.lit("\n"))


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(conv_id, turns, chat): every conversation that is kept, as one text.

    Null ids are one conversation. Null roles and texts count as empty when rendered but
    differ from empty ones when compared. Columns of other names are left out; an empty
    table gives no rows. A conversation is one row of the result, so its text
    has to fit one; nothing else gathers it.
    """
    placed = stored(placed_turns(turns, conv_id, turn, role, text), "placed-turns")
    kept = maximal(placed)
    met = placed.alias("t").join(kept.alias("k"), F.col("t.conv_id").eqNullSafe(F.col("k.conv_id")))
    lines = met.select("t.conv_id", "k.turns", "place", rendered(F.col("role"), F.col("text")).alias("line"))
    return lines.groupBy("conv_id", "turns").agg(
        F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines")).select(
        "conv_id", F.col("turns").cast("long").alias("turns"), F.array_join("lines.line", "").alias("chat"))
