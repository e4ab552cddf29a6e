"""How far the sources of a language differ in their terms: exact pair divergences over a frequent-pattern tree.

Terms are runs of ASCII letters and non-ASCII characters, A-Z in lower case. A language keeps the `V` terms that at
least `LEAST_DOCUMENTS` of its documents hold. Each group (lang, source), and each language as a whole, gives a kept term
with `count` occurrences the share `p = 1 + floor(SCALE * (count + 2) / (N + 2 * V))` of its `N`. Two shares differ by
`f(p, q) = floor((p - q)^2 / (p + q))`; all of it is integer arithmetic.

1. Terms are counted inside tasks, documents at a time, and summed by (lang, source, term), so text is never shuffled.
2. Most pairs of counts hold a zero. A pair of sources starts from `V * f(zero, zero)`; each term of one source alone
   corrects that by its own share, counted per distinct share.
3. What is left are terms that both sources have. A term is a row: its nonzero shares in order of the source. Equal rows
   are one row with a multiplicity. Sorted rows are the depth-first walk of a frequent-pattern tree: a row opens nodes
   where it leaves the path of the row before it, and a node's multiplicity is that of the rows until it is left. Each
   node adds its correction with every ancestor once, times its multiplicity, however many terms share the path. Rows
   are dealt by ranges of whole paths and walked 4,096 at a time; a node that two walks hold is in both with a part of
   its multiplicity, which changes no sum.

Defined results: null text, lang and source are ''. A group without terms, or in a language without kept terms, still
has its pairs (value 0 if `V` = 0). Repeated rows are documents of their own. An empty table gives no rows. Further
columns are not looked at. A term's row holds at most one entry per source, and a group's pairs are one row per other
source, as the result is.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourweave.llm.common import col, ship_package, slices
from hourweave.session import materialise

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
#: Terms of groups a task holds before it passes its counts on.
HELD = 500_000

#: Bytes of terms stay (A-Z lowered), all others separate.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Rows (lang, source, term, n occurrences, d documents) of partial counts; several rows may have one key."""
    ship_package(docs.sparkSession)

    def passed(found: dict[tuple[str, str], Counter], within: dict[tuple[str, str], Counter]) -> Iterator[pa.RecordBatch]:
        for (lang, source), documents in within.items():
            terms, occurrences = list(documents), found[lang, source]
            yield pa.record_batch({
                "lang": pa.repeat(pa.scalar(lang, pa.string()), len(terms)), "source": pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                "term": pa.array(terms, pa.binary()), "n": pa.array([occurrences[t] for t in terms], pa.int64()),
                "d": pa.array(documents.values(), pa.int64()),
            })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], Counter] = defaultdict(Counter)
        within: dict[tuple[str, str], Counter] = defaultdict(Counter)
        for part in slices(batches, 64):
            for lang, source, text in zip(*(c.to_pylist() for c in part.columns)):
                terms = text.translate(_TERM_BYTES).split()
                found[lang, source].update(terms)
                within[lang, source].update(set(terms))
            if sum(map(len, within.values())) > HELD:
                yield from passed(found, within)
                found.clear()
                within.clear()
        yield from passed(found, within)

    plain = [F.coalesce(col(c).cast("string"), F.lit("")) for c in (lang, source, text)]
    rows = docs.select(plain[0].alias("lang"), plain[1].alias("source"), plain[2].cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, source string, term binary, n long, d long").withColumn("term", F.col("term").cast("string"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """The share of `count` in `total`, exact for all longs; 0 where no term is kept."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.when(kept > 0, 1 + F.call_function("div", top, (total + 2 * kept).cast("decimal(20,0)"))).otherwise(0).cast("long")


def gap(p: Column, q: Column) -> Column:
    return F.when(p + q > 0, F.call_function("div", (p - q) * (p - q), p + q)).otherwise(0).cast("long")


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def tree_corrections(paths: DataFrame) -> DataFrame:
    """Rows (lang, a, b, value) from paths (lang, path of (source, p, zero), m): what a and b add where both have the term."""
    ship_package(paths.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            sizes = pc.list_value_length(part.column(1)).to_numpy().astype(np.int64)
            items = part.column(1).flatten()
            source = pc.dictionary_encode(items.field("source"))
            lang = pc.dictionary_encode(part.column(0))
            row = np.repeat(np.arange(len(sizes)), sizes)
            depth = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            name, p, zero = (np.full((len(sizes), int(sizes.max(initial=0))), -1, np.int64) for _ in range(3))
            name[row, depth] = source.indices.to_numpy()
            p[row, depth], zero[row, depth] = items.field("p").to_numpy(), items.field("zero").to_numpy()
            langs, m = lang.indices.to_numpy(), part.column(2).to_numpy()
            # how long a path each row has in common with the one before it
            same = (name[1:] == name[:-1]) & (p[1:] == p[:-1]) & (name[1:] >= 0) & (langs[1:] == langs[:-1])[:, None]
            common = np.concatenate([[0], np.cumprod(same, axis=1).sum(axis=1)])
            before = np.concatenate([[0], np.cumsum(m)])
            n = len(source.dictionary)
            keys, values = [], []
            for at in range(1, name.shape[1]):
                # a node opens where a row leaves its predecessor's path at or above it, and stands until the next does
                opens = np.append(np.flatnonzero(common <= at), len(sizes))
                nodes = opens[:-1][sizes[opens[:-1]] > at]
                times = (before[opens[1:]] - before[opens[:-1]])[sizes[opens[:-1]] > at]
                own, none, above, above_zero = p[nodes, at, None], zero[nodes, at, None], p[nodes, :at], zero[nodes, :at]
                value = _gaps(above, own) - _gaps(above, none) - _gaps(above_zero, own) + _gaps(above_zero, none)
                values.append((times[:, None] * value).ravel())
                keys.append(((langs[nodes, None] * n + name[nodes, :at]) * n + name[nodes, at, None]).ravel())
            if not keys:
                continue
            pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, place, np.concatenate(values))
            yield pa.record_batch({
                "lang": lang.dictionary.take(pa.array(pairs // (n * n))), "a": source.dictionary.take(pa.array(pairs // n % n)),
                "b": source.dictionary.take(pa.array(pairs % n)), "value": pa.array(total, pa.int64()),
            })

    return paths.select("lang", "path", "m").mapInArrow(run, "lang string, a string, b string, value long")


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): every other source of the language, and the group's `top` leading terms."""
    summed = term_counts(docs, text, lang, source).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    terms = summed.groupBy("lang", "term").agg(F.sum("d").alias("d"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("held"))
    kept = materialise(terms.where(F.col("d") >= least).select("lang", "term", "total", F.inline("held")), "kept-terms")

    found = docs.select(*[F.coalesce(col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    # a term's language total stands in each of its rows; count it in its first one
    first = F.row_number().over(Window.partitionBy("lang", "term").orderBy("source")) == 1
    langs = kept.select("lang", "total", first.alias("first")).where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    groups = found.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["n_group", "v", "n_lang"])
    groups = materialise(groups.withColumn("zero", share(F.lit(0).cast("long"), F.col("n_group"), F.col("v"))), "groups")

    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "zero", share(F.col("n"), F.col("n_group"), F.col("v")).alias("p"), share(F.col("total"), F.col("n_lang"), F.col("v")).alias("q"))
    shares = materialise(shares, "shares")

    # rows of the tree, equal ones counted
    rows = shares.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "zero"))).alias("path"))
    rows = materialise(rows.where(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("m")), "term-rows")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = tree_corrections(rows.repartitionByRange(parts, "lang", "path").sortWithinPartitions("lang", "path"))

    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"), "v")
    base = groups.drop("v").join(other, "lang").where(F.col("source") != F.col("item"))
    base = base.select("lang", "source", "item", (F.col("v") * gap(F.col("zero"), F.col("other_zero"))).alias("value"))
    distinct = shares.groupBy("lang", "source", "p", "zero").agg(F.count(F.lit(1)).alias("m"))
    alone = distinct.join(other, "lang").where(F.col("source") != F.col("item"))
    alone = alone.select("lang", "source", "item", (F.col("m") * (gap(F.col("p"), F.col("other_zero")) - gap(F.col("zero"), F.col("other_zero")))).alias("value"))
    halves = alone.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(both.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"))
    ends = F.array(F.struct(F.col("source"), F.col("item")), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    mirrored = halves.select("lang", F.inline(ends), "value")
    pairs = base.unionByName(mirrored).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    leading = shares.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    order = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", order).withColumn("part", F.lit("pair"))
    ranked = ranked.unionByName(leading.withColumn("rank", order).where(F.col("rank") <= top).withColumn("part", F.lit("term")))
    return ranked.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))


def divergence_sql(least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> str:
    """The same rows of `documents` in DuckDB."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share_of = f"CAST(1 + ({SCALE}::HUGEINT * ({{n}} + 2)) // ({{total}} + 2 * v) AS BIGINT)"
    gap_of = "((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
tokens AS (SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT row_id) >= {least}),
langs AS (SELECT l.lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS total FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept k USING (lang) GROUP BY l.lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts c USING (lang, source) GROUP BY g.lang, g.source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {share_of.format(n="coalesce(c.n, 0)", total="g.total")} AS p, {share_of.format(n="k.n", total="l.total")} AS q
           FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT x.lang, x.source, y.source AS item FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum({gap_of}) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pairs LEFT JOIN sums USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= {top}
"""
