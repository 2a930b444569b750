"""Line dedup by site-relative frequency.

Pages are grouped by host; a line of a page is boilerplate if the part of the
host's other pages that hold it too exceeds ``ratio``.  The page itself is left
out on both sides: else every line of a host of a few pages would be over the
ratio by standing on its own page.  Pages of a host with equal text count as
one page: a page crawled or copied a thousand times says nothing about
boilerplate.

With ``near`` (the pipeline) neither do near copies: pages of a site whose
pairs of adjacent words agree to ``ALIKE`` count as one page, in the lines'
counts and in the site's pages, so the lines they share stay and the SimHash
stage reduces them.  They are found by minimum hashes in bands; a page is
compared with the least page of each bucket, and links are followed.  Words
and not lines are compared: a page that is mostly boilerplate still counts
for itself unless more than some 85 % of its words are the same.

Counts are two-phase aggregates over (host, line, page), the latter two as
128-bit digests, so one line or host holding a third of all rows is combined
before the shuffle.  A host has at most ``lines per page / ratio`` boilerplate
lines, whatever its number of pages; these sets are joined by host, broadcast
only if all of them together are few lines.

Defined cases: lines are compared without blanks at their ends; blank lines
are never counted and never dropped; a line is dropped everywhere in the
host's pages; null text stays null; a null host is a host of its own; a page
alone on its host keeps its lines; repeated rows are treated alike; a page may
lose all its lines (its text is then empty) but never its row; an empty table
stays one; other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import columns_of, cut, prepare, same, small, steady, table
from ledgerloom.llm.components import components
from ledgerloom.session import ensure_checkpoint_dir

RATIO = 0.05
#: The sets are broadcast if they hold at most so many lines (16 bytes each).
BROADCAST_LINES = 200_000

#: Near copies: minimum hashes a page, rows a band, and the part that agrees.
MINIMA, BAND, ALIKE, SEED = 64, 4, 0.75, 42
_CHUNK = 1 << 12
_MIX = np.random.default_rng(SEED).integers(1, 1 << 63, size=MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def _digest(value: Column) -> list[Column]:
    """128 bits as two longs; null if the value is."""
    return [F.when(value.isNotNull(), F.xxhash64(F.lit(k), value)) for k in (0, 1)]


def minima(text: str) -> np.ndarray | None:
    """The least of each mixed hash over the pairs of adjacent words; None
    without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return None
    pairs = {b" ".join(p) for p in zip(words, words[1:])} or {words[0]}
    h = np.array([xxh64_intdigest(p, SEED) for p in pairs], dtype=np.uint64)
    least = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(h), _CHUNK):
        x = h[at:at + _CHUNK, None] * _MIX
        x ^= x >> np.uint64(32)  # the order follows the mixed low bits too
        np.minimum(least, (x * _MIX).min(0), out=least)
    return least


def _page(site: str, text: str) -> Column:
    return F.xxhash64(site, text)


def near_copies(docs: DataFrame) -> DataFrame:
    """``node, root``: the pages (by site and text) that are near copies of
    another page of their site, and the one they count as."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, sigs, bands = [], [], []
            for i, t in enumerate(b.column("text")):
                m = minima(t.as_py()) if t.is_valid else None
                if m is not None:
                    at.append(i)
                    sigs.append((m & np.uint64(255)).astype(np.uint8).tobytes())
                    bands.append(m.reshape(-1, BAND) @ _MIX[:BAND])
            take = pa.array(at, pa.int64())
            bands = pa.array([x.view(np.int64) for x in bands], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("site").take(take), b.column("page").take(take), pa.array(sigs, pa.binary()), bands], ["site", "page", "sig", "bands"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(n).to_pylist()), np.uint8).reshape(-1, MINIMA) for n in ("x", "y"))
            yield b.select(["u", "v"]).filter(pa.array((x == y).mean(1) >= ALIKE))

    kind = docs.schema["site"].dataType.simpleString()
    pages = docs.select("site", "text", _page("site", "text").alias("page"))
    pages = pages.mapInArrow(steady(sketch), f"site {kind}, page long, sig binary, bands array<long>")
    pages = cut(pages.dropDuplicates(["page"]))
    held = pages.select("site", "page", F.posexplode("bands").alias("band", "key"))
    held = held.select(F.xxhash64("site", "band", "key").alias("bucket"), F.col("page").alias("v"))
    firsts = held.groupBy("bucket").agg(F.min("v").alias("u"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = held.join(firsts.select("bucket", "u"), "bucket").where("u <> v").select("u", "v").distinct()
    pairs = pairs.join(pages.select(F.col("page").alias("u"), F.col("sig").alias("x")), "u")
    pairs = pairs.join(pages.select(F.col("page").alias("v"), F.col("sig").alias("y")), "v")
    return components(pairs.select("u", "v", "x", "y").mapInArrow(alike, "u long, v long"))


def boilerplate(docs: DataFrame, ratio: float = RATIO, near: bool = False) -> DataFrame:
    """``site, a, b``: the digests of each site's boilerplate lines, a row a
    line.  ``docs`` has columns ``site`` and ``text``.  One pass over the texts
    counts pages and lines alike; a null text has neither.  With ``near``, near
    copies count as one page."""
    # The null line stands for the page itself.
    lines = F.array_append(F.array_distinct(F.transform(_lines(F.col("text")), _bare)), F.lit(None))
    pages = docs.where("text IS NOT NULL").select("site", "text", *(d.alias(n) for d, n in zip(_digest(F.col("text")), ("p", "q"))))
    if near:
        groups = small(cut(near_copies(docs)))
        pages = pages.withColumn("p", _page("site", "text")).join(groups, F.col("p") == groups["node"], "left")
        pages = pages.select("site", "text", F.coalesce("root", "p").alias("p"), F.lit(0).alias("q"))
    held = pages.select("site", "p", "q", F.explode(lines).alias("line")).where("line IS NULL OR line <> ''")
    held = held.select("site", "p", "q", *(d.alias(n) for d, n in zip(_digest(F.col("line")), ("a", "b")))).distinct()
    held = cut(held.groupBy("site", "a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR a IS NULL"))
    totals = small(cut(held.where("a IS NULL").select(F.col("site").alias("_site"), F.col("n").alias("pages"))))
    often = held.where("a IS NOT NULL").join(totals, same(F.col("site"), F.col("_site")))
    return often.where((F.col("n") - 1) > F.lit(ratio) * (F.col("pages") - 1)).select("site", "a", "b")


def drop_boilerplate(docs: DataFrame, text_col: str = "text", site: Column | str = "source", ratio: float = RATIO, near: bool = False) -> DataFrame:
    """``docs`` with the boilerplate lines of each page's site cut out of
    ``text_col``; plus ``__lines`` and ``__dropped``, the page's counts."""
    prepare(docs.sparkSession)
    site = docs[site] if isinstance(site, str) else site
    keyed = docs.withColumn("__own_site", site)
    often = cut(boilerplate(keyed.select(F.col("__own_site").alias("site"), keyed[text_col].alias("text")), ratio, near))
    few = often.count() <= BROADCAST_LINES
    found = often.groupBy(F.col("site").alias("__at")).agg(F.collect_set(F.struct("a", "b")).alias("__often"))
    found = found.withColumn("__first", F.transform("__often", lambda o: o["a"]))
    out = keyed.join(F.broadcast(found) if few else found, same(F.col("__own_site"), F.col("__at")), "left")
    lines = _lines(F.col(text_col))

    def dropped(x: Column) -> Column:
        a, b = _digest(_bare(x))
        return F.array_contains("__first", a) & F.exists("__often", lambda o: (o["a"] == a) & (o["b"] == b)) & (_bare(x) != "")

    kept = F.when(F.col("__often").isNull(), lines).otherwise(F.filter(lines, lambda x: ~dropped(x)))
    out = out.withColumn("__kept", kept).withColumn("__lines", F.coalesce(F.size(lines), F.lit(0)))
    out = out.withColumn("__dropped", F.coalesce(F.col("__lines") - F.size("__kept"), F.lit(0)))
    out = out.withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.array_join("__kept", "\n")))
    return out.select(*docs.columns, "__lines", "__dropped")


# Pages: the visible lines of HTML, one per block element.
_HIDDEN = r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->"
_BLOCK = r"</?(?:p|br|div|li|ul|ol|nav|h[1-6]|tr|td|th|table|article|section|header|footer|aside|body|head|html|title|pre|blockquote)(?:\s[^>]*)?/?>"
_TAG = r"<[^>]*>"


def html_lines(html: Column) -> Column:
    """Visible text of a page, one line per block element, blank ones left
    out; null stays null."""
    t = F.regexp_replace(html, r"(?s)<(?:script.*?</script>|style.*?</style>|!--.*?-->)", "")
    t = F.regexp_replace(t, _BLOCK, "\n")
    t = F.regexp_replace(t, _TAG, "")
    return F.btrim(F.regexp_replace(t, r"[ \t\r]*+\n[ \t\r\n]*+", "\n"), F.lit(" \t\r\n"))


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; null without one."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def query(spark, sf_dir: str) -> DataFrame:
    """Every page: its host, visible lines, lines dropped, and kept text."""
    prepare(spark)
    p = columns_of(table(spark, sf_dir, "pages"), {"page_id": "page_id", "url": "url", "html": "html"})
    p = p.select("page_id", host_of(F.col("url")).alias("host"), html_lines(F.col("html")).alias("text"))
    # The markup is taken off once; both passes read the visible lines.
    seen = os.path.join(ensure_checkpoint_dir(spark), f"pages-{uuid.uuid4().hex}")
    p.write.parquet(seen)
    out = drop_boilerplate(spark.read.schema(p.schema).parquet(seen), "text", "host")
    return out.select("page_id", "host", F.col("__lines").cast("long").alias("n_lines"), F.col("__dropped").cast("long").alias("n_dropped"), "text")


OP8_SQL = rf"""
WITH seen AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') AS host,
         trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '{_HIDDEN}', '', 'g'), '{_BLOCK}', chr(10), 'g'),
              '{_TAG}', '', 'g'), '[ \t\r]*\n[ \t\r\n]*', chr(10), 'g'), chr(32) || chr(9) || chr(13) || chr(10)) AS text
  FROM pages),
parts AS (SELECT page_id, host, text, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS raw FROM seen),
lines AS (SELECT *, trim(raw, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM parts),
totals AS (SELECT host, count(DISTINCT text) AS pages FROM seen WHERE text IS NOT NULL GROUP BY host),
often AS (
  SELECT l.host, l.line FROM (SELECT DISTINCT host, text, line FROM lines WHERE line <> '') l
  JOIN totals t ON l.host IS NOT DISTINCT FROM t.host
  GROUP BY l.host, l.line, t.pages HAVING count(*) > 1 AND count(*) - 1 > {RATIO}::DOUBLE * (t.pages - 1)),
marked AS (
  SELECT l.page_id, l.pos, l.raw, o.line IS NOT NULL AS often FROM lines l
  LEFT JOIN often o ON l.host IS NOT DISTINCT FROM o.host AND l.line = o.line),
folded AS (
  SELECT page_id, count(*) AS n_lines, count(*) FILTER (WHERE often) AS n_dropped,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT often), '') AS text
  FROM marked GROUP BY page_id)
SELECT s.page_id, s.host, CAST(coalesce(f.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(f.n_dropped, 0) AS BIGINT) AS n_dropped,
       CASE WHEN s.text IS NULL THEN NULL ELSE coalesce(f.text, '') END AS text
FROM seen s LEFT JOIN folded f ON s.page_id = f.page_id
"""
