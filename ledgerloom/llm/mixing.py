"""Mixing sources to target weights by nested hash thresholds.

Every source gets a target (water-filling of its weight, at most ``cap``
times its own size).  A source takes all of its documents ``floor(target /
size)`` times and one more copy of the documents whose hash lies at or
below a threshold.  The threshold is found without sorting documents:

* sizes are summed by (source, leading 12 bits of the hash): at most 4,096
  sums a source, combined on the map side;
* the bucket where the running sum crosses the remaining budget is the
  boundary; only its documents are summed again by their next 12 bits,
  until a boundary holds a single hash value (60 bits: five passes at most);
* that last hash is taken if it brings the sum nearer to the budget.

A larger budget moves the threshold up, so the taken sets are nested, and
the outcome depends on ids and sizes alone: reruns agree.

Defined cases: null or blank text has size 0 and takes 0; a null source is
a source of its own, ranked last; a null id hashes as the empty string;
repeated rows share a hash and so share their fate; an empty table gives
an empty result; ``mix`` keeps other columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, columns_of, cut, same, small

WEIGHTS = (1, 2, 3)
CAP = 3.0
LEVELS, BITS = 5, 12
HASH_MAX = (1 << (LEVELS * BITS)) - 1


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(doc_id: Column) -> Column:
    """60 bits of the md5 of the id's text, as an integer."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Sources in code-point order (null last) weigh ``weights`` in turn and
    share the sum of all sizes; a target stops at ``cap`` times the source's
    size and the excess goes to the others by weight.  Sorted by ``cap *
    size / weight``, the first source whose ratio is not below the level
    ``(total - caps before) / (weights from here on)`` gives the water level.
    The windows run over one row per source, never over documents.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(k)) + 1).cast("int"))
    per = per.withColumn("rank", F.row_number().over(by_name)).withColumn("w", w)
    per = per.withColumn("most", F.lit(cap) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("w"))
    order = Window.orderBy("ratio", "rank")
    total = F.sum("source_size").over(Window.partitionBy())
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("level", (total - before) / left)
    first = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "rank", "level"))).over(Window.partitionBy())
    level = first["level"]
    per = per.withColumn("target", F.least(F.col("most"), F.col("w") * F.coalesce(level, F.lit(0.0))))
    return per.select("source", "source_size", "target")


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """``source, source_size, target, base, upto``: every document is taken
    ``base`` times, and once more where its hash is at most ``upto``."""
    goals = goals.withColumn("base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goals = cut(goals.withColumn("rest", F.col("target") - F.col("base") * F.col("source_size")))
    found = None
    rest, rows = goals.select("source", "rest"), sized.select("source", "size", "h")
    for level in range(LEVELS):
        digit = F.shiftright("h", BITS * (LEVELS - 1 - level)).bitwiseAND(F.lit((1 << BITS) - 1))
        hist = rows.groupBy("source", digit.alias("b")).agg(F.sum("size").alias("s"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        run = Window.partitionBy("source").orderBy("b")
        hist = hist.withColumn("before", F.sum("s").over(run) - F.col("s"))
        r = rest.select(F.col("source").alias("_src"), F.col("rest"))
        edge = hist.join(small(r), same(F.col("source"), F.col("_src")))
        # The one bucket of a source that the budget ends in.
        edge = edge.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("s") > F.col("rest")))
        edge = cut(edge.select("source", "b", "s", "lo", "hi", (F.col("rest") - F.col("before")).alias("rest")))
        ended = edge.where("lo = hi").select("source", F.when(F.col("s") / 2 <= F.col("rest"), F.col("lo")).otherwise(F.col("lo") - 1).alias("upto"))
        found = ended if found is None else found.unionByName(ended)
        open_ = edge.where("lo < hi")
        if open_.isEmpty():
            break
        e = open_.select(F.col("source").alias("_src"), F.col("b").alias("_b"))
        rows = cut(rows.join(small(e), same(F.col("source"), F.col("_src")) & (digit == F.col("_b"))).select("source", "size", "h"))
        rest = open_.select("source", "rest")
    found = found.select(F.col("source").alias("_src"), "upto")
    out = goals.join(found, same(F.col("source"), F.col("_src")), "left")
    return out.select("source", "source_size", "target", "base", F.coalesce("upto", F.lit(HASH_MAX)).alias("upto"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target,
    taken`` with ``taken`` = copies x size."""
    d = columns_of(docs, {"doc_id": id_col, "text": text_col, "source": source_col})
    sized = cut(d.select("doc_id", "source", size_of(F.col("text")).alias("size"), hash_of(F.col("doc_id")).alias("h")))
    return _taken(sized, weights, cap)


def _taken(sized: DataFrame, weights, cap: float) -> DataFrame:
    limits = cut(thresholds(sized, targets(sized, weights, cap)).withColumnRenamed("source", "_src"))
    out = sized.join(small(limits), same(F.col("source"), F.col("_src")), "left")
    copies = F.col("base") + (F.col("h") <= F.col("upto")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", "h", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mixed corpus: every document as often as the plan takes it, all
    its columns unchanged.  At most ``cap + 1`` copies, made row by row."""
    d = docs.select("*", size_of(docs[text_col]).alias("__size"), hash_of(docs[id_col]).alias("__h"), docs[source_col].alias("__source"))
    sized = cut(d.select(F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__h").alias("h")))
    limits = cut(thresholds(sized, targets(sized, weights, cap)).select(F.col("source").alias("__lim"), F.col("base").alias("__base"), F.col("upto").alias("__upto")))
    out = d.join(small(limits), same(F.col("__source"), F.col("__lim")))
    copies = F.col("__base") + (F.col("__h") <= F.col("__upto")).cast("long")
    out = out.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
    return out.select(*[out[c] for c in docs.columns])


#: The same plan by sorting, for an independent engine.
OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk FROM per),
weighed AS (SELECT *, CAST(1 + (rnk - 1) % 3 AS DOUBLE) AS w, 3.0::DOUBLE * source_size AS most FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(w) OVER (ORDER BY most / w, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
goals AS (
  SELECT source, source_size,
         least(most, w * coalesce((SELECT level FROM levels WHERE most / w >= level ORDER BY most / w, rnk LIMIT 1), 0.0::DOUBLE)) AS target
  FROM levels),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM goals),
groups AS (SELECT source, h, CAST(sum(size) AS BIGINT) AS g FROM sized GROUP BY source, h),
running AS (SELECT source, h, g, sum(g) OVER (PARTITION BY source ORDER BY h) - g AS before FROM groups)
SELECT s.doc_id, s.size, c.source_size, c.target,
       CAST((c.base + CASE WHEN r.before + r.g / 2.0 <= c.target - c.base * c.source_size THEN 1 ELSE 0 END) * s.size AS BIGINT) AS taken
FROM sized s
JOIN cut c ON s.source IS NOT DISTINCT FROM c.source
JOIN running r ON s.source IS NOT DISTINCT FROM r.source AND s.h = r.h
"""


def query(spark, sf_dir: str) -> DataFrame:
    from ledgerloom.llm.common import prepare, table

    prepare(spark)
    return plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
