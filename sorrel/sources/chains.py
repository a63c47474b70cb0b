"""Chain files of pairwise alignments: the whole grammar checked in parallel, and ungapped blocks from prefix sums.

A header declares the ends of an alignment on target and query, and lines of a size and two gaps step through it; the last line has a size alone. A sequential reader keeps cursors. Here each line gets its
header and the sums of what stands before it in its chain, in two levels: within ranges of lines, and from the ranges' last lines. So a chain of any length is dealt over many tasks, and lines are shuffled once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sorrel.operators.contract import RowError, at_most
from sorrel.sources.readers import RANGE, numbered
from sorrel.sources.scratch import written

#: The largest number that a field may be, so that sums stay within 64 bits.
LARGEST = 10**12
_HEAD = ("word", "score", "t_name", "t_size", "t_strand", "t0", "t1", "q_name", "q_size", "q_strand", "q0", "q1", "chain_id")
_NUMBERS = ("t_size", "t0", "t1", "q_size", "q0", "q1")


def _whole(c):
    x = F.when(c.rlike("^[+-]?[0-9]+$"), c.try_cast("bigint"))
    return F.when(F.abs(x) <= LARGEST, x)


def _first_broken(rules):
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(why)) for ok, why in rules])


def chain_lines(lines: DataFrame, source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(violations: src_row and reason; blocks) of the lines (src_row, value) of a chain file. `source` and `target` have chr and length of the assemblies' contigs; the query side of a chain is the source.

    Each line is judged by itself, with what its chain's other lines say of its place; a line that isn't made of numbers steps by nothing. Empty lines and comments are skipped. Blocks are 0-based and half-open, q_start on the
    strand's own coordinates; they mean something only if there are no violations.
    """
    f = F.split(F.btrim("value", F.lit(" \t\r\n\x0b\x0c")), r"[ \t\r\n\x0b\x0c]+")
    rows = lines.select("src_row", "value", F.floor(F.col("src_row") / RANGE).alias("range")).repartition("range").select("range", "src_row", f.alias("f")).where((F.col("f")[0] != "") & ~F.startswith(F.col("f")[0], F.lit("#")))
    is_head, fields = F.col("f")[0] == "chain", {n: F.try_element_at("f", F.lit(i + 1)) for i, n in enumerate(_HEAD)}
    fields["score"] = F.when(fields["score"].rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), fields["score"].try_cast("double"))
    own = F.struct("src_row", F.size("f").alias("n_fields"), *[(_whole(c) if n in _NUMBERS else c).alias(n) for n, c in fields.items() if n != "word"])
    step = {n: F.when(~is_head, _whole(F.try_element_at("f", F.lit(i + 1)))).alias(n) for i, n in enumerate(("size", "dt", "dq"))}
    rows = rows.select("range", "src_row", is_head.alias("is_head"), F.when(is_head, own).alias("own"), F.size("f").alias("n_fields"), *step.values())

    # within a range: a line's header, if it stands there, and what its chain's lines there add up to before it
    order = Window.partitionBy("range").orderBy("src_row")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"head": F.last("own", ignorenulls=True).over(so_far), "goes_on": ~F.first("is_head").over(so_far), "is_last": F.lead("src_row").over(order).isNull()}).drop("own").withColumn("head_row", F.col("head.src_row"))
    chain = Window.partitionBy("range", "head_row").orderBy("src_row")
    size, dt, dq = (F.coalesce(n, F.lit(0)) for n in ("size", "dt", "dq"))
    adds = {"t": size + dt, "q": size + dq, "ends": (~F.col("is_head") & (F.col("n_fields") == 1)).cast("bigint")}
    before = {f"{n}_before": F.coalesce(F.sum(x).over(chain.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) for n, x in adds.items()}
    rows = written(rows.withColumns(before | {"ended": F.sum(adds["ends"]).over(chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) > 0}), "chain-lines")

    # from range to range: the header and the sums that a range which begins within a chain goes on with
    tails = rows.where("is_last").select("range", "goes_on", "head", *[(F.col(f"{n}_before") + x).alias(n) for n, x in adds.items()])
    at = Window.orderBy("range")
    tails = tails.withColumns({"held": F.last("head", ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, 0)), "part": F.count("head").over(at.rowsBetween(Window.unboundedPreceding, 0))})
    sums = {n: F.sum(n).over(Window.partitionBy("part").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) for n in adds}
    tails = tails.withColumns(sums).select("range", "goes_on", F.lag("held").over(at).alias("held"), *[F.lag(n).over(at).alias(f"{n}_held") for n in adds])
    held = written(tails.where("goes_on and held is not null").drop("goes_on"), "held-chains")

    body = rows.where("not is_head").join(held, "range", "left")
    known = F.col("head").isNotNull()
    body = body.withColumns({f"{n}_before": F.when(known, F.col(f"{n}_before")).otherwise(F.col(f"{n}_before") + F.coalesce(f"{n}_held", F.lit(0))) for n in adds} | {"head": F.coalesce("head", "held")})
    body = body.select("src_row", "n_fields", "size", "dt", "dq", "ends_before", *[F.col(f"head.{n}").alias(n) for n in _HEAD if n != "word"], F.col("head").isNotNull().alias("in_chain"), (F.col("head.t0") + F.col("t_before")).alias("t_start"), (F.col("head.q0") + F.col("q_before")).alias("q_start"))

    heads = rows.where("is_head").select("head.*", "ended")
    # few, so that Spark may hand them to all tasks: later ends of chains, ids of several chains, contigs
    late = written(rows.where("not is_head and n_fields = 1 and head is null").join(held, "range").select(F.col("held.src_row").alias("src_row"), F.lit(True).alias("late")).distinct(), "late-ends")
    firsts = written(heads.groupBy("chain_id").agg(F.min("src_row").alias("first_row"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated-chains")
    judged = heads.join(firsts, "chain_id", "left").join(late, "src_row", "left")
    for side, contigs in (("t", target), ("q", source)):
        judged = judged.join(written(contigs.select(F.col("chr").alias(f"{side}_name"), F.col("length").alias(f"{side}_length")), "contigs"), f"{side}_name", "left")
    head_rules = [
        (F.col("n_fields") == len(_HEAD), "a header has 13 fields"),
        (reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in _NUMBERS]), "a header's sizes and ends are whole numbers"),
        ((F.col("score") >= 0) & (F.col("score") < float("inf")), "a score is finite and not negative"),
        (F.col("chain_id").isNotNull() & (F.col("first_row").isNull() | (F.col("first_row") == F.col("src_row"))), "an earlier chain has the id"),
        ((F.col("t_strand") == "+") & F.col("q_strand").isin("+", "-"), "the target's strand is +, the query's + or -"),
        ((F.col("t_size") == F.col("t_length")) & (F.col("q_size") == F.col("q_length")), "a contig isn't in its assembly, or has another length there"),
        ((F.col("t0") >= 0) & (F.col("t0") < F.col("t1")) & (F.col("t1") <= F.col("t_size")) & (F.col("q0") >= 0) & (F.col("q0") < F.col("q1")) & (F.col("q1") <= F.col("q_size")), "the ends aren't within the contigs"),
        (F.col("ended") | F.col("late"), "the chain has no last block"),
    ]
    ends = (F.col("t_start") + F.col("size") <= F.col("t1")) & (F.col("q_start") + F.col("size") <= F.col("q1"))
    reached = (F.col("t_start") + F.col("size") == F.col("t1")) & (F.col("q_start") + F.col("size") == F.col("q1"))
    whole = F.col("size").isNotNull() & ((F.col("n_fields") == 1) | (F.col("dt").isNotNull() & F.col("dq").isNotNull()))
    body_rules = [
        (F.col("in_chain"), "a block outside a chain"),
        (F.col("ends_before") == 0, "a block after the last one of its chain"),
        (F.col("n_fields").isin(1, 3), "a block has one or three fields"),
        (whole, "a block's fields are whole numbers"),
        ((F.col("size") > 0) & (F.coalesce("dt", F.lit(0)) >= 0) & (F.coalesce("dq", F.lit(0)) >= 0), "a block has a size, and gaps aren't negative"),
        (F.col("t1").isNull() | F.col("q1").isNull() | F.col("t0").isNull() | F.col("q0").isNull() | ends, "a block exceeds the declared ends"),
        ((F.col("n_fields") == 3) | F.col("t_start").isNull() | F.col("q_start").isNull() | reached, "the last block doesn't reach the declared ends"),
    ]
    found = judged.select("src_row", _first_broken(head_rules).alias("reason")).unionByName(body.select("src_row", _first_broken(body_rules).alias("reason")))
    blocks = body.select("chain_id", "t_name", "t_start", "size", "q_name", "q_start", "q_size", F.col("q_strand").alias("strand"), "score")
    return found.where("reason is not null"), blocks


def chain_blocks(spark: SparkSession, path: str, source: DataFrame, target: DataFrame, most_blocks: int = 1_000_000) -> DataFrame:
    """Ungapped blocks of a chain file whose query side is `source`. The first line that breaks a rule is an error, and so are a file without chains and one with more than `most_blocks` blocks."""
    lines = numbered(spark.read.text(path)).select("src_row", "value")
    violations, blocks = chain_lines(lines, source, target)
    if bad := violations.orderBy("src_row").limit(1).collect():
        raise RowError(f"{path}, line {bad[0].src_row}: {bad[0].reason}")
    if not blocks.limit(1).collect():
        raise RowError(f"{path} has no chains")
    return at_most(blocks, most_blocks, "blocks")
