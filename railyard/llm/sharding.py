"""Sharding by a k-d tree of distributed weighted medians."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm.common import staged

#: Bins of one histogram round; also the rows of one node in its window.
BINS = 1024
#: A cut is near enough when what lies in doubt is this share of its node.
_NEAR = 0.0005
_MAX = 2**63 - 1


@dataclass
class _Cut:
    """A node that is being split: the interval that holds its weighted median."""

    node: int
    leaves: int
    dim: int
    weight: int
    goal: float
    low: list
    high: list
    stage: int = 0
    below: int = 0
    open: bool = True
    held: int = 0
    cut: tuple = field(default=())

    def refine(self, r, group_limit: float) -> None:
        """Go on with the bin that the median falls into."""
        self.below, self.held = r["below"], r["held"]
        low, high = [r["low_x"], r["low_h"], r["low_r"]], [r["high_x"], r["high_h"], r["high_r"]]
        while self.stage < 2 and low[self.stage] == high[self.stage]:
            if self.stage == 1 and self.held <= group_limit:
                break
            self.stage += 1
        for i in range(self.stage + 1):
            self.low[i], self.high[i] = low[i], high[i]
        single = low[self.stage] == high[self.stage]
        if single or (self.held <= _NEAR * self.weight and self.stage < 2):
            self.close()

    def close(self) -> None:
        """The last coordinate on the left side: with the open interval, or without it."""
        left = 2 * (self.goal - self.below) >= self.held
        if self.stage == 0:
            x = self.high[0] if left else math.nextafter(self.low[0], -math.inf)
            self.cut = (x, _MAX, _MAX)
        elif self.stage == 1:
            self.cut = (self.low[0], self.high[1] if left else self.low[1] - 1, _MAX)
        else:
            self.cut = (self.low[0], self.low[1], self.high[2] if left else self.low[2] - 1)
        self.open = False


def _nodes(spark: SparkSession, rows: list[tuple], fields: str) -> DataFrame:
    """A table of nodes from the driver: one text literal that the executors parse."""
    names = [f.split()[0] for f in fields.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    kind = "array<struct<" + fields.replace(" ", ":").replace(",:", ",") + ">>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def _coordinate(dim: str) -> Column:
    return F.element_at("dims", F.col(dim) + 1)


def _step(located: DataFrame, cuts: list[_Cut], bins: int) -> list:
    """One histogram round: for each open node the bin where the weight passes its goal."""
    rows = [
        (c.node, c.dim, c.stage, c.goal, c.below, *(v for pair in zip(c.low, c.high, strict=True) for v in pair))
        for c in cuts
    ]
    schema = (
        "of bigint, dim int, stage int, goal double, under bigint, lo_x double, hi_x double,"
        " lo_h bigint, hi_h bigint, lo_r bigint, hi_r bigint"
    )
    state = F.broadcast(_nodes(located.sparkSession, rows, schema))
    x = located.join(state, F.col("node") == F.col("of")).withColumn("x", _coordinate("dim"))
    x = x.where(
        "CASE stage WHEN 0 THEN x BETWEEN lo_x AND hi_x WHEN 1 THEN x = lo_x AND h BETWEEN lo_h AND hi_h"
        " ELSE x = lo_x AND h = lo_h AND row BETWEEN lo_r AND hi_r END"
    )
    part = F.expr(
        "CASE stage WHEN 0 THEN IF(hi_x > lo_x, (x - lo_x) / (hi_x - lo_x), 0D)"
        " WHEN 1 THEN (h - lo_h) / (hi_h - lo_h + 1D) ELSE (row - lo_r) / (hi_r - lo_r + 1D) END"
    )
    bin_ = F.least(F.lit(bins - 1), F.floor(part * bins).cast("int"))
    ends = [f(c).alias(f"{n}_{k}") for c, k in (("x", "x"), ("h", "h"), ("row", "r")) for f, n in ((F.min, "low"), (F.max, "high"))]
    table = x.groupBy("node", bin_.alias("bin")).agg(
        F.sum("size").alias("held"), F.first("goal").alias("goal"), F.first("under").alias("under"), *ends
    )
    upto = F.sum("held").over(Window.partitionBy("node").orderBy("bin"))
    last = F.max("bin").over(Window.partitionBy("node"))
    table = table.withColumn("below", F.col("under") + upto - F.col("held")).withColumn("last", last)
    table = table.where("below + held > goal OR bin = last")
    found = F.min_by(F.struct(*[c for c in table.columns if c != "node"]), "bin")
    return table.groupBy("node").agg(found.alias("f")).select("node", "f.*").collect()


def _descend(located: DataFrame, cuts: list[_Cut]) -> DataFrame:
    """Every row one level down: right if its coordinates are above its node's cut."""
    rows = [(c.node, c.dim, *c.cut) for c in cuts]
    state = _nodes(located.sparkSession, rows, "of bigint, dim int, cut_x double, cut_h bigint, cut_r bigint")
    x = _coordinate("dim")
    right = (x > F.col("cut_x")) | (
        (x == F.col("cut_x"))
        & ((F.col("h") > F.col("cut_h")) | ((F.col("h") == F.col("cut_h")) & (F.col("row") > F.col("cut_r"))))
    )
    joined = located.join(F.broadcast(state), F.col("node") == F.col("of"), "left")
    node = F.col("node") * 2 + F.when(right, 1).otherwise(0)
    return joined.select(*[c for c in located.columns if c != "node"], node.alias("node"))


def assign(points: DataFrame, dims: int, leaves: int, bins: int = BINS) -> DataFrame:
    """``points`` with shard, from 0 to ``leaves`` - 1.

    ``points`` has dims (array of doubles), h (a hash that groups share), row (unique) and
    size; other columns stay. A node is split along its widest dimension, measured by the
    root's width, where the weight left of the cut comes nearest to its leaves' share. The
    median is found by rounds of histograms, all nodes of a level at once: the driver gets
    one row for each node. Ties of the coordinate are ordered by h, so rows with equal dims
    and h stay together; a group that outweighs a quarter of a leaf is split by row.
    The tables of nodes that are broadcast have at most ``leaves`` rows.
    """
    located = points.withColumn("node", F.lit(0).cast("bigint"))
    shape = {0: leaves}
    order: list[int] = [0]
    total, width = 0, None
    while any(k > 1 for k in shape.values()):
        ends = [f(F.element_at("dims", i + 1)).alias(f"{n}{i}") for i in range(dims) for f, n in ((F.min, "lo"), (F.max, "hi"))]
        stats = {
            r["node"]: r for r in located.groupBy("node").agg(F.sum("size").alias("weight"), *ends).collect()
        }
        if not stats:
            break
        if width is None:
            total = stats[0]["weight"]
            width = [max(stats[0][f"hi{i}"] - stats[0][f"lo{i}"], 1e-300) for i in range(dims)]
        cuts = []
        for node in order:
            s, k = stats.get(node), shape[node]
            if k < 2 or s is None:
                continue
            dim = max(range(dims), key=lambda i: ((s[f"hi{i}"] - s[f"lo{i}"]) / width[i], -i))
            goal = s["weight"] * (k // 2) / k
            cuts.append(_Cut(node, k, dim, s["weight"], goal, [s[f"lo{dim}"], 0, 0], [s[f"hi{dim}"], _MAX // 2, 0]))
        while still := [c for c in cuts if c.open]:
            found = {r["node"]: r for r in _step(located, still, bins)}
            for c in still:
                c.refine(found[c.node], total / leaves / 4)
        located = _descend(located, cuts)
        below: dict[int, int] = {}
        for node in order:
            k = shape[node]
            below[2 * node] = k if k < 2 else k // 2
            if k > 1:
                below[2 * node + 1] = k - k // 2
        shape, order = below, list(below)
    number = "CASE node " + " ".join(f"WHEN {n} THEN {i}" for i, n in enumerate(order)) + " END"
    if len(order) > 256:
        table = _nodes(located.sparkSession, list(zip(order, range(len(order)), strict=True)), "of bigint, shard int")
        out = located.join(F.broadcast(table), F.col("node") == F.col("of"))
        return out.drop("node", "of")
    return located.withColumn("shard", F.expr(number).cast("int")).drop("node")


def with_slots(placed: DataFrame) -> DataFrame:
    """Rows of ``placed`` (shard, part, row) with slot: gapless from 0 in every shard.

    ``part`` is the input split that a row came from. Rows are numbered within (shard, part)
    and each part begins where the counts of the parts before it end, so no shard is sorted
    as a whole.
    """
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    first = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    starts = counts.select(F.col("shard").alias("s"), F.col("part").alias("p"), first.alias("first"))
    joined = placed.join(starts, (F.col("shard") == F.col("s")) & (F.col("part") == F.col("p")))
    slot = F.col("first") + F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    return joined.withColumn("slot", slot).drop("s", "p", "first")


def shard_by_bytes(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, size, text_crc32, law, shard, slot and grown_shard of every row.

    The law is ``bytes``: leaves of the tree hold near equal bytes (UTF-8 length plus 1; a
    null text: 1). Dimensions are metadata of the text alone (code points, bytes for each code
    point, lines for each code point), so copies lie in one shard unless they outweigh a
    quarter of it; null and empty texts are copies of each other. Repeated rows and null keys
    are rows like others. grown_shard is null, as the law is not ``key``.
    """
    body = F.coalesce(docs[text], F.lit(""))
    size, chars = F.octet_length(body), F.length(body)
    whole = F.greatest(chars, F.lit(1)).cast("double")
    breaks = chars - F.length(F.replace(body, F.lit("\n"), F.lit("")))
    points = staged(
        docs.select(
            docs[key].alias("key"),
            (size + 1).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.array(F.log2(chars + 1.0), size / whole, breaks / whole).alias("dims"),
            F.xxhash64(body).bitwiseAND(F.lit(2**62 - 1)).alias("h"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-points",
    )
    placed = staged(assign(points, 3, shards).drop("dims", "h"), "shards")
    return with_slots(placed).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
