"""Mixing sources to target weights by systematic sampling.

Every source gets a target (words of the mix) by its weight.  The documents of
a source stand on a line, up through every second one by size and down through
the others; each takes ``target / source size`` on it, its expected copies.  A
random offset below one is added, and a document is emitted once for every
integer boundary that its interval crosses, so it gets the floor or the ceiling
of its expectation.  Neighbours on the line are alike in size and both ends are
small, so what the offset adds on the way up it takes back on the way down, and
the words taken stay near the target.

Cases: a null text or source takes part (size 0; the null source is the last);
repeated rows are mixed as rows of their own; a source without words has target
0 and no copies; empty tables give empty results; extra columns are kept by
``mix_documents``.  Ties in size go by doc_id, so reruns agree.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, unused

#: Weights given to the sources in order, again and again.
WEIGHTS = (5, 2, 1)
#: A target stops at this multiple of the source's size.
MAX_REPEATS = 3
#: Parts in which a source's documents meet its target.
SALT = 32
#: The offset is one of this many equal steps (five hexadecimal digits of a hash).
STEPS = 1 << 20


def n_words(text: str):
    """Words of a text; a null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, *order) -> DataFrame:
    """The rows with ``rank`` (from 0) in the given order, over any number of tasks.

    Rows are dealt to tasks by range and numbered in each; the numbers of rows
    before each task come from one count per task.
    """
    low = (1 << 33) - 1
    dealt = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_task", F.shiftright("_at", 33)).withColumn("_in", F.col("_at").bitwiseAND(F.lit(low)))
    tasks = dealt.groupBy("_task").agg(F.count("*").alias("_n"))
    before = tasks.select("_task", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_before"))  # a row for each task
    return dealt.join(before, "_task").withColumn("rank", F.col("_before") + F.col("_in")).drop("_task", "_in", "_before", "_at")


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, ratio) for (source, source_size): the total shared by weight under the caps.

    A source stops at ``max_repeats`` of its size.  Each round gives what the
    stopped ones leave to the others; it needs two sums over the sources.
    """
    order = F.col("source").asc_nulls_last()
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = cut(ranked(sizes, order).withColumn("weight", w.cast("long")))
    total, all_weight = s.agg(F.sum(F.col("source_size").cast("decimal(38,0)")), F.sum("weight")).first()
    total = int(total or 0)
    rate = Fraction(total, all_weight or 1)  # words for one unit of weight
    cap = F.lit(max_repeats).cast("decimal(38,0)") * F.col("source_size")
    while True:
        whole, part = rate.numerator, rate.denominator
        stopped = cap * F.lit(part).cast("decimal(20,0)") <= F.col("weight").cast("decimal(20,0)") * F.lit(whole).cast("decimal(30,0)")
        held, free = s.agg(F.sum(F.when(stopped, cap)), F.sum(F.when(~stopped, F.col("weight")))).first()
        new = Fraction(total - int(held or 0), free) if free else rate
        if new == rate:
            break
        rate = new
    share = F.when(stopped, cap.cast("double")).otherwise(F.col("weight") * F.lit(whole).cast("double") / F.lit(part).cast("double"))
    out = s.withColumn("target", share)
    ratio = F.when(F.col("source_size") == 0, 0.0).when(stopped, float(max_repeats)).otherwise(F.col("target") / F.col("source_size"))
    return out.select("source", "source_size", "target", ratio.alias("ratio"))


def copies(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 17) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each row of ``docs``."""
    rows = cut(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goal = cut(targets(sizes.select("source", "source_size"), weights, max_repeats))
    line = ranked(rows, F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id"))
    line = cut(line)
    first = line.groupBy("source").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    goal = goal.withColumnRenamed("source", "s").join(first.withColumnRenamed("source", "s2"), F.col("s").eqNullSafe(F.col("s2"))).drop("s2")
    # A source may hold most documents: its rows meet its targets in SALT parts.
    goal = goal.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    line = line.withColumn("part", F.pmod(F.col("rank"), F.lit(SALT)).cast("int"))
    out = line.join(goal, (line["part"] == goal["part"]) & F.col("source").eqNullSafe(F.col("s"))).drop("s", "part")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("-")))
    offset = F.conv(F.substring(F.sha2(named, 256), 1, 5), 16, 10).cast("double") / F.lit(float(STEPS))  # 20 bits
    by_size = F.col("rank") - F.col("first")
    k = F.when(by_size % 2 == 0, by_size / 2).otherwise(F.col("n") - 1 - (by_size - 1) / 2).cast("long")
    crossed = F.floor((k + 1) * F.col("ratio") + offset) - F.floor(k * F.col("ratio") + offset)
    return out.select("doc_id", "source", "size", "source_size", "target", F.least(crossed, F.lit(max_repeats)).cast("long").alias("copies"))


def mix_report(docs: DataFrame, **kw) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken (words, repeats counted), copies."""
    return copies(docs, **kw).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix_documents(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it was drawn, with its own columns.

    Rows that share a doc_id and source are drawn together: as often in all as the mix draws them.
    """
    d, s, z, times, rows, k, nth = unused(docs, "drawn_id", "drawn_source", "drawn_size", "times", "n_rows", "k", "nth")
    drawn = copies(docs, **kw).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("t"), F.count("*").alias("r")).where("t > 0")
    drawn = drawn.select(F.col("doc_id").alias(d), F.col("source").alias(s), F.col("size").alias(z), F.col("t").alias(times), F.col("r").alias(rows))
    same = F.col(kw.get("doc_id", "doc_id")).eqNullSafe(F.col(d)) & F.col(kw.get("source", "source")).eqNullSafe(F.col(s))
    both = docs.join(drawn, same & (n_words(kw.get("text", "text")) == F.col(z)))
    again = lambda df, n: df.withColumn(k, F.explode(F.sequence(F.lit(1), n.cast("int")))).select(*docs.columns)
    single = again(both.where(F.col(rows) == 1), F.col(times))
    # Rows that cannot be told apart by id, source and size: the draws go round them.
    place = F.row_number().over(Window.partitionBy(d, s, z).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns])))
    many = both.where(F.col(rows) > 1).withColumn(nth, place)
    each = F.floor(F.col(times) / F.col(rows)) + (F.col(nth) <= F.col(times) % F.col(rows)).cast("long")
    return single.unionByName(again(many.where(each > 0), each))
