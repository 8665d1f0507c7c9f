"""Mixing sources to target weights: capped water-filling over the sources and
seeded whole and fractional repetitions of their documents.

``targets`` gives every source its share of the budget in proportion to its
weight, stops a source at ``max_epochs`` times its size, and shares what is left
over among the others by weight, again and again, until none is above its limit.
Every round is one aggregation over the table of sources.

``mix`` then repeats each document of a source ``floor(target / size)`` times, and
takes one repetition more of those documents whose middle lies below the
remaining quota when the source is laid out in seeded hash order, so a source's
taken words differ from its target by at most half of one document. The running
sums are two-level (hash buckets, then rows inside the one bucket that the quota
cuts), so a source that holds a third of all rows never meets in one task. The hash
is of the id and, from the second row of an id on, of the row's number among the rows
of that id, so rows with one id, or with none, are decided one by one.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a source of size 0 has target 0 and its documents are taken 0
times; rows that repeat a doc_id are documents of their own; an empty table gives
an empty result. Extra columns are ignored by ``mix`` and kept by ``sample``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curlew.llm.common import fresh, ordered_position, seeded_hash, stored

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Hashes have 60 bits; their first 10 are the bucket.
BUCKET_SHIFT = 50


def numbered(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, str]:
    """``docs`` with a column (its name is returned) that numbers the rows of each id
    from 0, in the order of their texts' digests and sources. Only where an id
    repeats are rows ordered and written; rows of one id may lie in many ranges."""
    which = fresh(docs, "mix_which")
    if docs.groupBy(id_col).count().where("count > 1").isEmpty():
        return docs.withColumn(which, F.lit(0).cast("long")), which
    pid, salt = fresh(docs, "mix_pid"), fresh(docs, "mix_salt")
    order = [F.col(id_col).asc_nulls_last(), F.md5(F.col(text_col).cast("string")), F.col(source_col), F.col(salt)]
    ranged = stored(docs.withColumn(salt, F.rand(17)).repartitionByRange(*order).withColumn(pid, F.spark_partition_id()), "mix-numbered")
    per = ranged.groupBy(F.col(id_col).alias("i"), F.col(pid).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    before = per.withColumn("earlier", F.sum("n").over(Window.partitionBy("i").orderBy("p")) - F.col("n")).where("earlier > 0")
    # at most the first id of each range has rows in earlier ranges
    first = F.broadcast(before.select(F.col("i").alias(f"{which}_i"), F.col("p").alias(f"{which}_p"), F.col("earlier").alias(f"{which}_n")))
    inside = ranged.withColumn(which, F.row_number().over(Window.partitionBy(pid, id_col).orderBy(*order[1:])) - 1)
    joined = inside.join(first, (F.col(pid) == F.col(f"{which}_p")) & F.col(id_col).eqNullSafe(F.col(f"{which}_i")), "left")
    return joined.withColumn(which, F.col(which) + F.coalesce(f"{which}_n", F.lit(0))).select(*docs.columns, which), which


def row_hash(seed: int, id_col: str, which: str) -> Column:
    return F.when(F.col(which) == 0, seeded_hash(seed, F.col(id_col))).otherwise(seeded_hash(seed, F.col(id_col), F.col(which)))


def sizes(docs: DataFrame, which: str, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", seed: int = 17) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_hash(seed, id_col, which).alias("h"))


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """source, source_size, weight, target. ``weights`` go round the sources in
    code point order, null last; the budget is the sum of all sizes."""
    if not weights or min(weights) <= 0 or max_epochs < 1:
        raise ValueError("weights must be positive and max_epochs at least 1")
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = ordered_position(per, [F.col("source").asc_nulls_last()], "pos", "mix-sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (F.col("pos") % len(weights) + 1).cast("int")).cast("long")
    src = stored(ranked.select("source", "source_size", weight.alias("weight")), "mix-weights")
    limit = F.col("source_size") * max_epochs
    total, free = src.agg(F.sum("source_size"), F.sum("weight")).first()
    total, free, capped = total or 0, free or 0, 0
    while True:
        level = (total - capped) / free if free else 0.0
        over = limit <= F.col("weight") * F.lit(level)
        now_capped, now_free = src.agg(F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight")))).first()
        now_capped, now_free = now_capped or 0, now_free or 0
        if (now_capped, now_free) == (capped, free):
            break
        capped, free = now_capped, now_free
        if not free:
            level = float("inf")
            over = F.lit(True)
            break
    share = (F.col("weight") * F.lit(float(total - capped))) / F.lit(float(free or 1))
    return src.withColumn("target", F.when(over, limit.cast("double")).otherwise(share))


def plan(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """source, source_size, target, whole, cut: each document of the source is taken
    ``whole`` times, and once more if its hash is at most ``cut``. One row a source."""
    goal = targets(sized, weights, max_epochs).drop("weight")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = goal.withColumnRenamed("source", "s")
    sized = sized.withColumn("bucket", F.shiftright("h", BUCKET_SHIFT))
    per = sized.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    run = per.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")))
    # the one bucket of each source that its quota cuts, and the words before it
    edge = run.join(goal, F.expr("source <=> s")).where(
        (F.col("n") > 0) & (F.col("upto") > F.col("quota")) & (F.col("upto") - F.col("n") <= F.col("quota")))
    edge = stored(edge.select("s", "quota", F.col("bucket").alias("b"), (F.col("upto") - F.col("n")).alias("before")), "mix-edges")
    inside = sized.join(edge, F.expr("source <=> s AND bucket = b"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    within = inside.withColumn("upto", F.col("before") + upto).where(F.col("upto") - F.col("size") / 2 <= F.col("quota"))
    last = within.groupBy("s").agg(F.max("h").alias("last"))
    cut = edge.alias("e").join(last.alias("l"), F.expr("e.s <=> l.s"), "left").select(
        F.col("e.s").alias("s2"), F.coalesce("last", F.shiftleft("b", BUCKET_SHIFT) - 1).alias("cut"))
    return stored(goal.join(cut, F.expr("s <=> s2"), "left").select(
        "s", "source_size", "target", "whole", F.coalesce("cut", F.lit(-1).cast("long")).alias("cut")), "mix-plan")


def _copies() -> Column:
    return F.col("whole") + (F.col("h") <= F.col("cut")).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: one row for each row of ``docs``."""
    docs, which = numbered(docs, id_col, text_col, source_col)
    sized = stored(sizes(docs, which, id_col, text_col, source_col, seed), "mix-sizes")
    return sized.join(plan(sized, weights, max_epochs), F.expr("source <=> s")).withColumn("copies", _copies()).select(
        F.col("doc_id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as ``mix`` takes it. Rows
    meet only the table of sources, so texts are not shuffled while that is small and no
    id repeats."""
    columns = docs.columns
    docs, which = numbered(docs, id_col, text_col, source_col)
    sized = stored(sizes(docs, which, id_col, text_col, source_col, seed), "mix-sizes")
    source, times, h = (fresh(docs, c) for c in ("mix_source", "mix_copies", "mix_h"))
    chosen = plan(sized, weights, max_epochs).select(F.col("s").alias(source), F.col("whole").alias(times), F.col("cut").alias(h))
    extra = (row_hash(seed, id_col, which) <= F.col(h)).cast("long")
    joined = docs.join(chosen, F.col(source_col).eqNullSafe(F.col(source))).withColumn(times, F.col(times) + extra)
    return joined.where(F.col(times) > 0).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*columns)
