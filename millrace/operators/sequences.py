"""Frequent sequences of item sets by prefix growth, with rows instead of one cell per sequence.

A pattern is a sequence of item sets. For each sequence that holds a pattern two places are kept: where its last set can be
found first (``first``), and where the sets before it can be found first (``base``). A round gives the patterns that are one
item longer. By a set of its own: each item that its sequence holds behind ``first`` is looked up there, by one ordered pass over
the places of the sequence's items, so an event costs the same however many patterns there are. Within the last set: the rows
meet the sets of several items behind ``base`` that hold it. Then sequences are counted, and patterns below the support are
dropped. So a round's rows are at most the frequent patterns that each sequence holds and their next items, and the events of a
sequence are never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.joins import broadcast_join, salted_join
from millrace.operators.skew import HOT_ROWS
from millrace.operators.windows import running
from millrace.session import checkpointed


def prefix_span(df: DataFrame, sequence: str, at: Column, item: Column, min_support: float, max_length: int = 10, min_rows: int = HOT_ROWS) -> DataFrame:
    """``sequence`` (a list of sorted item sets) and ``freq``, for every pattern of at most ``max_length`` items in at least
    ``ceil(min_support * sequences)`` sequences.

    A row is an item in the set of its sequence at a place; ``at`` may be a struct. Items of one place are one set, in which
    repeated items count once; rows without a place or an item hold nothing, but their sequence counts as one. A null
    sequence is a sequence. A sequence with many rows is spread over tasks.
    """
    rows = df.select(F.struct(F.col(sequence).alias("id")).alias("_seq"), at.alias("_at"), item.alias("_item"))
    least = F.ceil(F.lit(min_support) * rows.select("_seq").distinct().count())
    sets = rows.where("_at IS NOT NULL AND _item IS NOT NULL").groupBy("_seq", "_at").agg(F.sort_array(F.collect_set("_item")).alias("_set"))
    # places are numbers from here on
    sets = checkpointed(running(sets, ["_seq"], ["_at"], position="_pos", min_rows=min_rows).select("_seq", "_pos", "_set"))
    kind = sets.schema["_set"].dataType.simpleString()

    def frequent(held: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The patterns with enough sequences, and what the sequences hold of them."""
        counts = checkpointed(held.groupBy("pattern").agg(F.count("*").alias("freq")).where(F.col("freq") >= least))
        return counts, broadcast_join(held, counts.select("pattern"), "pattern", "left_semi")

    single = sets.select("_seq", "_pos", F.explode("_set").alias("_item"))
    one = single.groupBy("_seq", F.array(F.array("_item")).alias("pattern")).agg(F.min("_pos").alias("first"), F.max("_pos").alias("_end"))
    found, held = frequent(checkpointed(one))
    found_all = [found]
    # no pattern holds an item that is not frequent by itself
    single = broadcast_join(single, found.select(F.col("pattern")[0][0].alias("_item")), "_item", "left_semi")
    single = checkpointed(single)
    ends = checkpointed(held.select("_seq", F.col("pattern")[0][0].alias("_item"), "_end"))
    wide = checkpointed(sets.where(F.size("_set") > 1))
    held = held.drop("_end").withColumn("base", F.lit(None).cast("bigint"))
    for _ in range(max_length - 1):
        held = checkpointed(held)
        if held.limit(1).count() == 0:
            break
        # a sequence's last place of an item tells where the item comes again
        asked = held.select("_seq", "first").distinct().join(ends, "_seq").where("_end > first").select("_seq", "_item", "first")
        points = single.select("_seq", "_item", (-F.col("_pos")).alias("_back"), F.lit(1).alias("_kind"), F.col("_pos").alias("_here"))
        points = points.union(asked.select("_seq", "_item", (-F.col("first")).alias("_back"), F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("_here")))
        nexts = running(points, ["_seq", "_item"], ["_back", "_kind"], mins={"_next": F.col("_here")}, min_rows=min_rows).where("_kind = 0")
        nexts = nexts.select("_seq", (-F.col("_back")).alias("first"), "_item", "_next")
        apart = held.select("_seq", "pattern", "first").join(nexts, ["_seq", "first"]).select(
            "_seq", F.concat("pattern", F.array(F.array("_item"))).alias("pattern"), F.col("_next").alias("first"), F.col("first").alias("base"))
        # the side with a sequence's many rows is spread, the side with its patterns is copied
        met = salted_join(wide, held, ["_seq"], min_rows=min_rows).where("base IS NULL OR _pos > base")
        last = F.element_at("pattern", -1)
        inside = F.when(
            F.size(F.array_intersect("_set", last)) == F.size(last),
            F.transform(F.filter("_set", lambda x: x > F.element_at(last, -1)),
                        lambda x: F.concat(F.slice("pattern", F.lit(1), F.size("pattern") - 1), F.array(F.concat(last, F.array(x))))))
        within = met.select("_seq", F.explode(F.coalesce(inside, F.array().cast(f"array<array<{kind}>>"))).alias("pattern"), F.col("_pos").alias("first"), "base")
        step = apart.union(within).groupBy("_seq", "pattern").agg(F.min("first").alias("first"), F.min("base").alias("base"))
        found, held = frequent(checkpointed(step))
        found_all.append(found)
    out = found_all[0]
    for more in found_all[1:]:
        out = out.unionByName(more)
    return out.select(F.col("pattern").alias("sequence"), "freq")
