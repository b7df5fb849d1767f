"""Line dedup: winnowed line fingerprints, extended both ways; later repeats are deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import bit_filter, bit_hit, free_name, staged, word_count


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each line with words: key, digest of the text, pos, two hashes, words, and words before it.

    Rows that agree in key and text are one document here. White space at the ends of a line
    doesn't count.
    """
    body = F.trim(F.col("line"), F.lit(" \t\x0b\x0c\r"))
    exploded = docs.select(
        docs[key].alias("key"),
        F.xxhash64(docs[text]).alias("digest"),
        F.posexplode(F.split(docs[text], "\n")).alias("pos", "line"),
    )
    hashes = [F.xxhash64(body).alias("hash"), F.xxhash64(F.lit("line"), body).alias("hash2")]
    one = (
        exploded.select("key", "digest", "pos", word_count(F.col("line")).alias("words"), *hashes)
        .where("words > 0")
        .groupBy("key", "digest", "pos")
        .agg(*[F.first(c).alias(c) for c in ("words", "hash", "hash2")])
    )
    so_far = F.sum("words").over(Window.partitionBy("key", "digest").orderBy("pos"))
    return one.withColumn("upto", so_far).withColumn("before", F.col("upto") - F.col("words"))


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """The windows of all documents: key, digest, first, last, mark, mark_pos, shared, name, name2.

    A window starts or ends at every line and reaches just far enough to hold ``min_words``
    words. Its mark is the least line hash in it (of equal ones the last); its names are
    hashes of all its lines, from two independent hashes of each line. ``shared`` is the
    mark's own, where ``lines`` has that column.
    """
    shared = F.col("shared") if "shared" in lines.columns else F.lit(False)
    doc = Window.partitionBy("key", "digest")
    frames = (
        doc.orderBy("before").rangeBetween(0, min_words - 1),
        doc.orderBy("upto").rangeBetween(1 - min_words, 0),
    )

    def windows(frame) -> DataFrame:
        return lines.select(
            "key",
            "digest",
            F.min("pos").over(frame).alias("first"),
            F.max("pos").over(frame).alias("last"),
            F.sum("words").over(frame).alias("held"),
            F.min(F.struct("hash", (-F.col("pos")).alias("back"), shared.alias("shared"))).over(frame).alias("least"),
            F.xxhash64(F.collect_list("hash").over(frame)).alias("name"),
            F.xxhash64(F.collect_list("hash2").over(frame)).alias("name2"),
        ).where(F.col("held") >= min_words)

    found = windows(frames[0]).unionByName(windows(frames[1]))
    mark = [F.col("least.hash").alias("mark"), (-F.col("least.back")).alias("mark_pos"), "least.shared"]
    return found.select("key", "digest", "first", "last", "name", "name2", *mark)


def marks(lines: DataFrame, min_words: int) -> DataFrame:
    """The selected minima: key, digest, mark_pos and mark of each line that is a window's mark.

    Every run of ``min_words`` words or more holds one, at the same line in each of its copies.
    """
    return _windows(lines, min_words).select("key", "digest", "mark_pos", "mark").distinct()


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """Runs of lines that repeat an earlier run of at least ``min_words`` words.

    Returns key, digest (of the text), and runs: disjoint ranges (first, last) of line numbers
    in rising order, only for documents that have some.

    Lines are winnowed: of each window only the minimum is kept as a mark, one row for each
    marked line. Marks are joined on their hash, and positions whose mark stands nowhere else
    are done. From each other position the match is extended backward and forward over the
    windows through it, and compared with the first place where the same lines
    stand around the same mark; a window is matched by two independent hashes of its lines
    (128 bits), not by its mark. Every line of a repeated run lies in a window that starts or
    ends in the run, so chained windows give the whole run, and positions are never paired
    with each other.

    Order is the key (null last), the text's digest, then the line. A run may overlap the
    one that it repeats: a period that repeats within a document stays once.
    """
    lines = staged(_lines(docs, key, text), "line-hashes")
    found = staged(marks(lines, min_words), "line-marks")
    place = F.struct("key", "digest", "mark_pos")
    shared = (
        found.groupBy("mark")
        .agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .where("low <> high")
        .select("mark")
    )
    # Written tables on the small side leave both sides of a join plain shuffles, which
    # adaptive execution can split where a line or a window stands in very many places. They
    # are merged at every size: the tables grow with the corpus and aren't for broadcasting.
    shared = staged(shared, "shared-marks")
    joined = staged(found.join(shared.hint("merge"), "mark", "left_semi").drop("mark"), "joined-marks")
    of = joined.select(F.col("key").alias("of_key"), F.col("digest").alias("of_digest"), F.col("mark_pos").alias("of_pos"))
    here = F.col("key").eqNullSafe(F.col("of_key")) & (F.col("digest") == F.col("of_digest")) & (F.col("pos") == F.col("of_pos"))
    told = lines.join(of.hint("merge"), here, "left").withColumn("shared", F.col("of_pos").isNotNull())
    near = _windows(told, min_words).where("shared").drop("mark", "mark_pos", "shared")
    near = staged(near, "shared-windows")
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "digest", "first")
    origin = near.groupBy("name", "name2").agg(F.min(order).alias("origin"), F.max(order).alias("latest"))
    origin = staged(origin.where("origin < latest").select("name", "name2", "origin"), "window-origins")
    later = (
        near.join(origin.hint("merge"), ["name", "name2"])
        .where(order > F.col("origin"))
        .select("key", "digest", "first", "last")
        .distinct()
    )
    rising = Window.partitionBy("key", "digest").orderBy("first", "last")
    reach = F.max("last").over(rising.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("first") <= F.col("reach") + 1, 0).otherwise(1)).over(rising)
    return (
        later.withColumn("reach", F.coalesce(reach, F.lit(-2)))
        .withColumn("island", island)
        .groupBy("key", "digest", "island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .groupBy("key", "digest")
        .agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))
    )


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50, report: bool = False
) -> DataFrame:
    """``docs`` with every later repeat of a run of ``min_words`` words or more deleted.

    All rows and columns stay; only ``text`` changes. With ``report`` two columns follow,
    lines and removed_lines, in place of any that had these names. A text that repeats as a
    whole becomes empty. Null and empty texts stay as they are; shorter repeats stay; blank
    lines go where they lie inside a deleted run. Rows with equal key and text are treated
    alike, null keys like any other. A text may have any number of lines; an empty table
    stays empty. Other columns may have any names. See ``repeated_runs`` for the method and
    the order.
    """
    runs = repeated_runs(docs, key, text, min_words)
    of_key, of_digest, of_runs, digest, word, mask = (
        free_name(docs, n) for n in ("run_key", "run_digest", "runs", "digest", "word", "mask")
    )
    runs = runs.select(F.col("key").alias(of_key), F.col("digest").alias(of_digest), F.col("runs").alias(of_runs))
    runs = staged(runs, "runs")
    # Texts without a run, mostly far more, need no shuffle: a filter of fixed size tells.
    rows = docs.withColumn(digest, F.xxhash64(docs[text]))
    words = F.broadcast(bit_filter(F.col(of_digest), runs, word, mask))
    hit = bit_hit(F.col(digest), word, mask)
    clean = rows.join(words, hit, "left_anti").withColumn(of_runs, F.lit(None).cast(runs.schema[of_runs].dataType))
    found = rows.join(words, hit, "left_semi").join(
        runs.hint("shuffle_hash"), F.col(f"`{key}`").eqNullSafe(F.col(of_key)) & (F.col(digest) == F.col(of_digest)), "left"
    )
    joined = clean.unionByName(found.drop(of_key, of_digest))
    body = f"`{text}`"
    lines = F.split(F.col(body), "\n")
    starts = F.concat(F.array(F.lit(0)), F.transform(of_runs, lambda r: r["last"] + 1))
    stops = F.concat(F.transform(of_runs, lambda r: r["first"]), F.array(F.size(lines)))
    parts = F.transform(
        F.arrays_zip(starts.alias("a"), stops.alias("z")),
        lambda p: F.slice(lines, p["a"] + 1, F.greatest(p["z"] - p["a"], F.lit(0))),
    )
    kept = F.when(F.col(of_runs).isNull(), F.col(body)).otherwise(F.array_join(F.flatten(parts), "\n"))
    replaced = ("lines", "removed_lines") if report else ()
    columns = [kept.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c.lower() not in replaced]
    if report:
        gone = F.aggregate(of_runs, F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
        columns += [
            F.when(F.col(body).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("lines"),
            F.coalesce(gone, F.lit(0)).cast("long").alias("removed_lines"),
        ]
    return joined.select(*columns)
