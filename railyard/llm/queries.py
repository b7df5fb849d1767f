"""The registered queries of the numbered operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm import (
    bpe, chat, fptree, linededup, mixing, neighbours, oddsketch, phrases, quality, sharding, simhash, sketch, toxicity,
)
from railyard.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@_register
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


@_register
def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    weights = mixing.cyclic_weights(docs, "source", (3, 1, 2))
    return mixing.taken_words(docs, weights)


ORACLES["op3_mix"] = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, '') || '|'
           || md5(coalesce(text, ''))) || '|' || CAST(copy AS VARCHAR)), 1, 15) AS BIGINT) AS draw
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, source, text) AS copy FROM documents)),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, 2.0 * source_size AS cap,
         row_number() OVER (ORDER BY source_size / w, source) AS i
  FROM s),
f AS (
  SELECT *, (1.5 * (SELECT sum(source_size) FROM s)
             - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM o),
l AS (SELECT coalesce((SELECT level FROM f WHERE level * w <= cap ORDER BY i LIMIT 1), 1e300) AS level),
t AS (SELECT source, source_size, CAST(least(cap, l.level * w) AS DOUBLE) AS target FROM f, l),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM t),
r AS (
  SELECT d.*, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS goal,
         sum(size) OVER (PARTITION BY d.source ORDER BY draw) AS upto,
         sum(size) OVER (PARTITION BY d.source, draw) AS same
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN (goal - (upto - same)) * 2 > same THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""


@_register
def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of 50 words or more that stand earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, report=True)


ORACLES["op9_linededup"] = r"""
WITH a AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents),
b AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS body
  FROM a),
c AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM b WHERE words > 0),
w AS (
  SELECT doc_id, min(pos) OVER f AS p, max(pos) OVER f AS q, sum(words) OVER f AS held, list(body) OVER f AS name
  FROM c WINDOW f AS (PARTITION BY doc_id ORDER BY upto - words RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION
  SELECT doc_id, min(pos) OVER k, max(pos) OVER k, sum(words) OVER k, list(body) OVER k
  FROM c WINDOW k AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
r AS (
  SELECT doc_id, p, q, rank() OVER (PARTITION BY name ORDER BY doc_id NULLS LAST, p) AS nth FROM w WHERE held >= 50),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, q + 1)) AS pos FROM r WHERE nth > 1),
kept AS (
  SELECT a.doc_id, string_agg(line, chr(10) ORDER BY a.pos) FILTER (gone.pos IS NULL) AS text,
         count(*) AS lines, count(gone.pos) AS removed_lines
  FROM a LEFT JOIN gone ON a.doc_id = gone.doc_id AND a.pos = gone.pos
  GROUP BY a.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(coalesce(lines, 0) AS BIGINT) AS lines, CAST(coalesce(removed_lines, 0) AS BIGINT) AS removed_lines
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


@_register
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3)


def _predicted(scored: DataFrame, folds: int, out: int) -> DataFrame:
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == out, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@_register
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = quality.fit_quality(docs, labels, fold(labels["doc_id"], 5) != 0)
    return _predicted(quality.score_quality(docs, model), 5, 0)


@_register
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels, fold(labels["doc_id"], 4) != 2)
    return _predicted(toxicity.score_toxicity(docs, model), 4, 2)


@_register
def op1_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch of every document and of its edited text."""
    return sketch.fingerprint_edits(table(spark, sf_dir, "documents"))


def _log_of_a_turn() -> Column:
    """The events that leave one turn (message, role, text) behind, as a chat server logs them.

    By turns, a message is streamed in pieces; or drafted, answered too early and then
    edited, which voids the answer; or streamed wrongly and regenerated.
    """
    third = F.floor(F.length("text") / 3).cast("int")
    pieces = [
        F.substring("text", F.lit(1), third),
        F.substring("text", third + 1, third),
        F.substring("text", 2 * third + 1, F.length("text")),
    ]
    none = F.lit(None).cast("string")

    def log(*steps: tuple) -> Column:
        return F.array(
            *[
                F.struct(
                    (F.col("message") * 16 + n).alias("seq"),
                    F.lit(kind).alias("kind"),
                    (F.col("message") + later).alias("message"),
                    role.alias("role"),
                    text.alias("text"),
                )
                for n, (kind, later, role, text) in enumerate(steps)
            ]
        )

    role, empty, wrong = F.col("role"), F.lit(""), F.reverse("text")
    stream = [("delta", 0, none, p) for p in pieces]
    streamed = log(("message", 0, role, empty), *stream)
    edited = log(("message", 0, role, pieces[0]), ("delta", 0, none, wrong), ("message", 1, none, wrong), ("edit", 0, none, F.col("text")))
    again = log(("message", 0, role, empty), ("delta", 0, none, wrong), ("regenerate", 0, none, none), *stream)
    way = F.pmod(F.col("conv") + F.col("message"), F.lit(3))
    return F.when(way == 0, edited).when(way == 1, again).otherwise(streamed)


@_register
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, logged event by event, folded, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    forged = spark.range(2, numPartitions=1).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("bigint")
    placed = rows.unionByName(forged).select(F.col("conv_id").alias("conv"), place.alias("message"), "role", F.coalesce("text", F.lit("")).alias("text"))
    events = placed.select("conv", F.explode(_log_of_a_turn()).alias("e")).select("conv", "e.*")
    done = chat.format_conversations(events)
    back = done.select(
        F.col("conv").alias("conv_id"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLES["op4_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (
  SELECT *, lower(role) = 'assistant' AS answer,
         length(role) + length(text) + length(regexp_replace(role || text, '[^~<\[]', '', 'g'))
         + 3 + 4 + CASE WHEN lower(role) = 'assistant' THEN 7 ELSE 6 END AS size
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (answer), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (answer), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
"""


@_register
def op7_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


@_register
def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_register
def op13_oddsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and near-duplicate component of every document."""
    return oddsketch.near_duplicates(table(spark, sf_dir, "documents"), percent=85, words=5)


ORACLES["op13_oddsketch"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
t AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(node, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.root),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@_register
def op12_fptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    docs, items = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return fptree.rank_documents(docs, items, top=20)


ORACLES["op12_fptree"] = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
s AS (SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM t WHERE len(terms) > 0),
d AS (SELECT doc_id, 75 + (25 * len(terms) * s.n) // s.l AS m FROM t, s WHERE len(terms) > 0),
f AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM t) GROUP BY doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * s.n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY item_id, term),
r AS (
  SELECT q.item_id, f.doc_id,
         CAST(sum(q.times * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * d.m))) AS BIGINT) AS score
  FROM q JOIN w ON w.term = q.term JOIN f ON f.term = q.term JOIN d ON d.doc_id = f.doc_id
  GROUP BY q.item_id, f.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20
"""


@_register
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"), top=2000, least=30, longest=4)


ORACLES["op11_phrases"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
i AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM w),
g AS (
  SELECT lang, k, array_to_string(words[pos:pos + k - 1], ' ') AS phrase
  FROM i, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE pos + k - 1 <= len(words)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS words, f AS a FROM f WHERE k > 1 AND f >= 30),
s AS (
  SELECT lang, a AS longer, words, k, size, unnest(range(1, k - size + 2)) AS pos
  FROM c, (SELECT unnest([2, 3]) AS size) WHERE size < k),
b AS (SELECT lang, array_to_string(words[pos:pos + size - 1], ' ') AS phrase, max(longer) AS longer FROM s GROUP BY 1, 2),
o AS (
  SELECT c.* FROM c LEFT JOIN b ON b.lang = c.lang AND b.phrase = c.phrase
  WHERE b.longer IS NULL OR 100 * CAST(b.longer AS HUGEINT) < 80 * CAST(c.a AS HUGEINT)),
u AS (SELECT lang, phrase, a, k, words, unnest(range(1, k)) AS cut FROM o),
v AS (
  SELECT u.lang, u.phrase, u.a, u.cut, x.f AS l, y.f AS r,
         CAST((2000000 * CAST(u.a AS HUGEINT)) // (x.f + y.f) AS BIGINT) AS score
  FROM u JOIN f x ON x.lang = u.lang AND x.k = u.cut AND x.phrase = array_to_string(u.words[1:u.cut], ' ')
  JOIN f y ON y.lang = u.lang AND y.k = u.k - u.cut AND y.phrase = array_to_string(u.words[u.cut + 1:u.k], ' ')),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS best FROM v),
k AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z WHERE best = 1)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, n.n, k.score
FROM k JOIN n ON n.lang = k.lang WHERE k.rank <= 2000
"""
