"""Mixing sources to target weights: capped water-filling, then seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import free_name, staged, word_count

#: Draws are whole numbers below 2**60; their upper 12 bits name a histogram bin, and the
#: next 12 bits a bin within it.
_BIN_SHIFT, _FINE_SHIFT = 48, 36

#: A plan of up to so many sources is sent to every executor (about 60 bytes each).
BROADCAST_SOURCES = 200_000


#: Copies of one row that are told apart in one go; more are counted out chunk by chunk.
_COPIES = 10_000

#: Bits of the filter of rows that repeat; its size is fixed.
_FILTER_BITS = 1 << 24


def identity(docs: DataFrame, key: str, source: str, text: str, seed: str) -> Column:
    """A seeded 128-bit name of a row's content: key, source, text and all other columns.

    Rows that share a key (or have none) are told apart by what they say.
    """
    parts = [F.lit(seed), F.coalesce(docs[key].cast("string"), F.lit("")), F.coalesce(docs[source].cast("string"), F.lit(""))]
    parts.append(F.md5(F.coalesce(docs[text], F.lit(""))))
    # Spark has no hash of a map.
    others = [f.name for f in docs.schema.fields if f.name not in (key, source, text) and "map<" not in f.dataType.simpleString()]
    if others:
        parts.append(F.hex(F.xxhash64(*[docs[c] for c in others])))
    return F.md5(F.concat_ws("|", *parts))


def draw(name: Column, copy: Column | int) -> Column:
    """A number in [0, 2**60) for a copy (from 1) of the rows with that name."""
    copy = F.lit(copy) if isinstance(copy, int) else copy
    return F.conv(F.substring(F.md5(F.concat_ws("|", name, copy)), 1, 15), 16, 10).cast("bigint")


def _each_copy(rows: DataFrame, count: str, copy: str) -> DataFrame:
    """Every row as often as ``count`` says, numbered from 1 in the column ``copy``.

    A row with very many copies becomes chunks first, which are dealt to tasks.
    """
    numbers = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(count)))
    few = rows.where(F.col(count) <= _COPIES).withColumn(copy, numbers)
    chunk, stop = f"{copy}_chunk", F.least(F.col(count), (F.col(f"{copy}_chunk") + 1) * _COPIES)
    many = rows.where(F.col(count) > _COPIES).withColumn(
        chunk, F.explode(F.expr(f"sequence(0L, (`{count}` - 1) div {_COPIES})"))
    )
    many = many.repartition(F.col(chunk)).withColumn(copy, F.explode(F.sequence(F.col(chunk) * _COPIES + 1, stop)))
    return few.unionByName(many.drop(chunk))


def measure(docs: DataFrame, key: str, source: str, text: str, seed: str) -> DataFrame:
    """The staged key, source, size in words and draw of every row; the text is read once.

    Rows that agree in all columns are counted, with map-side combine, and each of their
    copies gets a draw of its own: a group of copies is neither gathered nor taken as one.
    Draws depend on the rows alone, so reruns agree.
    """
    rows = docs.select(
        docs[key].alias("key"),
        docs[source].alias("source"),
        word_count(docs[text]).alias("size"),
        identity(docs, key, source, text, seed).alias("name"),
    )
    counted = rows.groupBy("name", "key", "source", "size").agg(F.count("*").alias("count"))
    counted = staged(counted, "mix-rows")
    return _each_copy(counted, "count", "copy").select(
        "key", "source", "size", "name", "count", "copy", draw(F.col("name"), F.col("copy")).alias("draw")
    )


def targets(sizes: DataFrame, weights: DataFrame, share: float, max_epochs: float) -> tuple[DataFrame, int]:
    """The words that each source should give, and the number of sources.

    ``sizes`` has source and source_size, ``weights`` source and weight; a source without a
    positive weight gives nothing. The budget is ``share`` of all words. A source is clamped
    at ``max_epochs`` times its size, and what is above goes to the others by weight, until
    none is above. Each round is one sum over the small table of sources. If every source is
    clamped, all targets are the clamps.
    """
    w = F.greatest(F.coalesce("weight", F.lit(0)), F.lit(0))
    table = staged(
        sizes.join(weights.withColumnRenamed("source", "weighed"), F.col("source").eqNullSafe(F.col("weighed")), "left")
        .select("source", "source_size", w.alias("weight"), (F.col("source_size") * max_epochs).alias("cap")),
        "mix-sources",
    )
    total, n = table.agg(F.sum("source_size"), F.count("*")).first()
    budget, level, clamped = float(total or 0) * share, 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > F.col("cap")
        full, open_weight, count = table.agg(
            F.sum(F.when(above, F.col("cap")).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
            F.count_if(above),
        ).first()
        if not open_weight:
            level = float("inf") if n and count else 0.0
            break
        if count == clamped:
            break
        level, clamped = (budget - (full or 0)) / open_weight, count
    share_of = F.when(F.col("weight") > 0, F.lit(level) * F.col("weight")).otherwise(0.0)
    return table.withColumn("target", F.least(F.col("cap"), share_of).cast("double")), n


def plan_mix(points: DataFrame, weights: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """One row for each source: source, source_size, target, whole, cut.

    A row of the source is taken ``whole`` times, and once more if its draw is at most
    ``cut``. The cut is placed where the words of the rows below it come nearest to the rest
    of the target: by a histogram over 4,096 bins of the draw, by another within the one bin
    that holds it, then exactly within the bin of that. All are sums with map-side combine, so a source with most of all
    rows is no hot key.
    """
    binned = staged(
        points.groupBy("source", F.shiftright("draw", _BIN_SHIFT).alias("bin")).agg(F.sum("size").alias("words")),
        "mix-bins",
    )
    sizes = binned.groupBy("source").agg(F.sum("words").alias("source_size"))
    table, n = targets(sizes, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    table = table.withColumn("whole", whole.cast("long")).withColumn(
        "goal", F.col("target") - F.col("whole") * F.col("source_size")
    )
    table = staged(table.select("source", "source_size", "target", "whole", "goal"), "mix-targets")

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n <= BROADCAST_SOURCES else df

    def same(name: str) -> Column:
        return F.col("source").eqNullSafe(F.col(name))

    def crossing(bins: DataFrame) -> DataFrame:
        """The bin of each source in which its words pass the goal."""
        upto = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
        found = bins.withColumn("upto", upto).where("upto > goal").groupBy(F.col("source").alias("of")).agg(
            F.min("bin").alias("at"),
            F.min_by(F.col("upto") - F.col("words"), "bin").alias("before"),
            F.first("goal").alias("goal"),
        )
        return staged(found, "mix-crossing")

    def inside(shift: int, crossed: DataFrame, unit: Column) -> DataFrame:
        """The words of each unit of draws within the bins that were crossed."""
        return (
            points.join(small(crossed), same("of") & (F.shiftright("draw", shift) == F.col("at")))
            .groupBy("source", unit.alias("bin"))
            .agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("goal").alias("goal"))
        )

    goals = table.select(F.col("source").alias("of"), "goal", F.lit(0).cast("bigint").alias("before"))
    crossed = crossing(binned.join(small(goals), same("of")))
    crossed = crossing(inside(_BIN_SHIFT, crossed, F.shiftright("draw", _FINE_SHIFT)))
    within = inside(_FINE_SHIFT, crossed, F.col("draw")).withColumnRenamed("bin", "draw")
    below = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("draw")) - F.col("words")
    cuts = (
        within.withColumn("below", below)
        .where((F.col("goal") - F.col("below")) * 2 > F.col("words"))
        .groupBy(F.col("source").alias("cut_of"))
        .agg(F.max("draw").alias("found"))
    )
    bins = crossed.select("of", (F.shiftleft("at", _FINE_SHIFT) - 1).alias("floor"))
    plan = (
        table.join(bins, same("of"), "left")
        .join(cuts, same("cut_of"), "left")
        .select("source", "source_size", "target", "whole", F.coalesce("found", "floor", F.lit(-1)).alias("cut"))
    )
    return small(staged(plan, "mix-plan"))


def repeats(rows: DataFrame, source: str, drawn: str, plan: DataFrame, name: str) -> DataFrame:
    """``rows`` joined to the plan of their source; the column ``name`` has target,
    source_size and repeats."""
    p = plan.select(F.struct("source", "source_size", "target", "whole", "cut").alias(name))
    out = rows.join(p, rows[source].eqNullSafe(p[name]["source"]))
    extra = F.when(F.col(drawn) <= F.col(name)["cut"], 1).otherwise(0)
    return out.withColumn(
        name,
        F.struct(
            F.col(name)["source_size"].alias("source_size"),
            F.col(name)["target"].alias("target"),
            (F.col(name)["whole"] + extra).cast("long").alias("repeats"),
        ),
    )


def cyclic_weights(docs: DataFrame, source: str, cycle: tuple[int, ...]) -> DataFrame:
    """Weights given in turn to the sources in code-point order, null last.

    One row for each source is ranked; rows of documents are not.
    """
    found = docs.select(docs[source].alias("source")).distinct()
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (rank % len(cycle) + 1).cast("int"))
    return found.select("source", weight.cast("long").alias("weight"))


def taken_words(
    docs: DataFrame,
    weights: DataFrame,
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``key``, size, source_size, target and taken (words, repeats counted) of every row.

    Nulls, repeated rows and the empty table are as in ``mix``: a null text has size 0, so
    it takes no words.
    """
    points = measure(docs.select(key, source, text), key, source, text, seed)
    out = repeats(points, "source", "draw", plan_mix(points, weights, share, max_epochs), "plan")
    return out.select(
        F.col("key").alias(key),
        "size",
        F.col("plan.source_size").alias("source_size"),
        F.col("plan.target").alias("target"),
        (F.col("size") * F.col("plan.repeats")).alias("taken"),
    )


def mix(
    docs: DataFrame,
    weights: DataFrame,
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The mixed rows of ``docs``, each as often as its source's target asks, same columns.

    Sizes are words (null text: 0), texts are measured whole. A null source is a source. Rows
    with a null or a repeated key draw by what they say; rows that agree in every column draw
    copy by copy. An empty table gives an empty table. Sources that miss in ``weights`` or
    have no words give no rows beyond their target of 0. Columns may have any names.
    """
    points = measure(docs, key, source, text, seed)
    plan = plan_mix(points, weights, share, max_epochs)
    named, drawn, planned, count, of = (free_name(docs, n) for n in ("name", "draw", "plan", "count", "of"))
    rows = docs.withColumn(named, identity(docs, key, source, text, seed))
    # Rows without a twin, nearly all, need no shuffle: the filter tells most of them.
    twins = points.where("copy = 1 AND count > 1").select(F.col("name").alias(of), F.col("count").alias(count))
    bit = f"pmod(xxhash64(`{{}}`), {_FILTER_BITS})"
    words = twins.groupBy(F.expr(f"shiftright({bit.format(of)}, 6)").alias(of)).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST({bit.format(of)} % 64 AS INT)))").alias(count)
    )
    hit = F.expr(
        f"shiftright({bit.format(named)}, 6) = `{of}`"
        f" AND (shiftrightunsigned(`{count}`, CAST({bit.format(named)} % 64 AS INT)) & 1L) = 1"
    )
    single = rows.join(F.broadcast(words), hit, "left_anti")
    maybe = rows.join(F.broadcast(words), hit, "left_semi").join(twins.hint("merge"), F.col(named) == F.col(of), "left")
    single = single.unionByName(maybe.where(F.col(of).isNull()).drop(of, count)).withColumn(drawn, draw(F.col(named), 1))
    twin = maybe.where(F.col(of).isNotNull()).dropDuplicates([named])
    twin = _each_copy(twin.drop(of), count, drawn)
    twin = twin.withColumn(drawn, draw(F.col(named), F.col(drawn))).drop(count)
    counted = repeats(single.unionByName(twin), source, drawn, plan, planned)
    copies = F.explode(F.array_repeat(F.lit(1), F.col(planned)["repeats"].cast("int")))
    return counted.where(F.col(planned)["repeats"] > 0).select(*[F.col(f"`{c}`") for c in docs.columns], copies.alias(planned)).drop(planned)
