"""Divergence audit of the sources of each language by one-hot level products.

The vocabulary of a source differs from another's by how often terms occur.  A
term's smoothed share p depends only on its *level*, the number of times that it
occurs in the source; so does every price f(p, q) of a pair of shares.  All that
is needed of two sources is therefore their joint table: how many terms have
level a in one and level b in the other.  For a block of terms, indicator columns
for (source, level) are multiplied by their transpose, and the exact product
holds the joint tables of all pairs of sources at once.  The tables are priced
inside the block and only the pairs' sums leave it.

Terms are counted in one pass over the texts, pre-added within a task, and those
in fewer than ``LEAST_DOCS`` documents of their language go.  A block holds some
thousand terms of one language, dealt by a hash; within it terms are put in order
of frequency and cut into runs with few levels, so that a product is small
(``COLUMNS`` at most on either side; more sources are multiplied in groups).

Arithmetic is exact: shares are integers of ``UNIT``, products count terms in
floats that hold whole numbers up to 2^24, prices and sums are 64-bit integers.

Defined results: null texts, languages and sources are ''; a row is a document,
so repeated rows and doc_ids count as often as they occur; a source without a
kept term still has its pairs; ties go by the bytes of the item; an empty table
gives no rows; further columns play no part."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtally.llm._files import staged
from seqtally.operators._util import broadcast_if_small

LEAST_DOCS = 3
UNIT = 1_000_000_000
TOP_TERMS = 200
#: Terms of a block, and columns of one side of a product.
BLOCK_TERMS, COLUMNS = 2048, 1024
#: Rows below which a run of terms is not cut further.
FEWEST = 16
#: Different terms that a task holds before it passes their counts on, and the
#: bytes of a text that it cuts into terms at once.
HELD, PIECE = 300_000, 1 << 20

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_OTHER = re.compile(rb"[^a-z\x80-\xff]")


def _terms_of(text: bytes):
    """Lists of a text's terms, a piece of the text at a time."""
    text, at = text.lower(), 0  # of bytes only A-Z change
    while at < len(text):
        gap = _OTHER.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        yield _TERM.findall(text, at, end)
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that hold it); a null term
    with n = 0 for each lang and source."""

    def count(batches):
        import pyarrow as pa
        from collections import Counter, defaultdict

        names = ["lang", "source", "term", "n", "docs"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        occurs, holds, groups = defaultdict(Counter), defaultdict(Counter), set()

        def told():
            for (lang, source), terms in occurs.items():
                held = holds[lang, source]
                columns = ([lang] * len(terms), [source] * len(terms), [t.decode("utf-8", "replace") for t in terms],
                           list(terms.values()), [held[t] for t in terms])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            occurs.clear(), holds.clear()

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for key, text in zip(keys, texts):
                groups.add(key)
                seen, own = set(), occurs[key]
                for terms in _terms_of(text.as_py()):
                    own.update(terms)
                    seen.update(terms)
                holds[key].update(seen)
                if sum(map(len, occurs.values())) > HELD:
                    yield from told()
        yield from told()
        none = [None] * len(groups)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            ([g[0] for g in groups], [g[1] for g in groups], none, [0] * len(none), [0] * len(none)), kinds)], names=names)

    plain = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    each = plain.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, term, total, by_source (source, n): the kept terms, a row each with
    its count in every source of the language that has it."""
    return (counts.filter("term IS NOT NULL").groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                 F.collect_list(F.struct("source", "n")).alias("by_source"))
            .filter(F.col("docs") >= least).drop("docs"))


def group_sizes(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, size (occurrences of kept terms, 0 without any), lang_size (the
    same of the whole language) and terms (the number of its kept terms)."""
    one = kept.select("lang", "total", F.explode("by_source").alias("s"))
    own = one.groupBy("lang", "s.source").agg(F.sum("s.n").alias("size"))
    groups = counts.select("lang", "source").distinct().join(own, ["lang", "source"], "left")
    langs = kept.groupBy("lang").agg(F.sum("total").alias("lang_size"), F.count(F.lit(1)).alias("terms"))
    return (groups.join(broadcast_if_small(langs), "lang", "left")
            .select("lang", "source", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("size", "lang_size", "terms"))))


def shares(count, size, terms):
    """1 + floor(UNIT * (count + 1) / (size + terms)) of integer arrays, digit by
    digit, so that no product leaves 64 bits."""
    count, size = np.asarray(count, np.int64), np.asarray(size, np.int64) + terms
    whole, rest = np.divmod(count + 1, size)
    left = UNIT
    while left > 1:
        whole, more = np.divmod(rest * 1000, size)[0] + whole * 1000, (rest * 1000) % size
        rest, left = more, left // 1000
    return whole + 1


def _runs(levels: np.ndarray):
    """(first, last) of runs of rows (in order of frequency) with few levels."""
    todo = [(0, len(levels))]
    while todo:
        a, b = todo.pop()
        different = sum(len(np.unique(levels[a:b, g])) for g in range(levels.shape[1]))
        if b - a > FEWEST and different > max(COLUMNS, 4 * levels.shape[1]):
            todo += [(a, (a + b) // 2), ((a + b) // 2, b)]
        else:
            yield a, b


def _one_hot(levels: np.ndarray):
    """Indicator columns (rows, columns), the first column of each group, and
    each column's group and level."""
    first, group, level, at = [], [], [], []
    k = 0
    for g in range(levels.shape[1]):
        values, place = np.unique(levels[:, g], return_inverse=True)
        first.append(k)
        at.append(place.ravel() + k)
        group.append(np.full(len(values), g))
        level.append(values)
        k += len(values)
    hot = np.zeros((len(levels), k), np.float32)
    hot[np.arange(len(levels))[:, None], np.stack(at, 1)] = 1
    return hot, np.array(first), np.concatenate(group), np.concatenate(level)


def pair_prices(levels: np.ndarray, sizes: np.ndarray, terms: int) -> np.ndarray:
    """Sums of the prices of a block: ``levels`` (terms, groups) of counts; entry
    (g, h) has p from group g and q from group h."""
    levels = levels[np.argsort(levels.sum(axis=1), kind="stable")]
    total = np.zeros((levels.shape[1],) * 2, np.int64)
    for a, b in _runs(levels):
        hot, first, group, level = _one_hot(levels[a:b])
        p = shares(level, sizes[group], terms)
        # groups whose columns make one side of a product
        cuts = [0]
        for g in range(1, len(first)):
            end = first[g + 1] if g + 1 < len(first) else len(group)
            if end - first[cuts[-1]] > COLUMNS:
                cuts.append(g)
        cuts.append(len(first))
        sides = [(g, h, first[g], first[h] if h < len(first) else len(group)) for g, h in zip(cuts, cuts[1:])]
        for g0, g1, c0, c1 in sides:
            for h0, h1, d0, d1 in sides:
                joint = (hot[:, c0:c1].T @ hot[:, d0:d1]).astype(np.int64)
                q = p[d0:d1]
                step = p[c0:c1, None] - q
                price = joint * (step * step // q)
                rows = np.add.reduceat(price, first[g0:g1] - c0, axis=0)
                total[g0:g1, h0:h1] += np.add.reduceat(rows, first[h0:h1] - d0, axis=1)
    return total


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every ordered pair of sources of a lang."""
    plan = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "size"))).alias("groups"),
                                      F.max("terms").alias("terms"))
    blocks = F.ceil(F.col("terms") / BLOCK_TERMS)
    dealt = kept.join(broadcast_if_small(plan.select("lang", blocks.cast("long").alias("blocks"))), "lang")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    rows = dealt.select("lang", block, "by_source").groupBy("lang", "block").agg(
        F.collect_list("by_source").alias("rows"))
    rows = rows.join(broadcast_if_small(plan), "lang").select("lang", "rows", "groups", "terms")

    def price(batches):
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("groups")[i].values
                names, sizes = own.field("source").to_pylist(), own.field("size").to_numpy()
                at = {s: g for g, s in enumerate(names)}
                block = batch.column("rows")[i].values  # a list of (source, n) for each term
                ends = block.offsets.to_numpy()
                flat = block.flatten()
                levels = np.zeros((len(block), len(names)), np.int64)
                row = np.repeat(np.arange(len(block)), np.diff(ends))
                levels[row, [at[s] for s in flat.field("source").to_pylist()]] = flat.field("n").to_numpy()
                total = pair_prices(levels, sizes, batch.column("terms")[i].as_py())
                g, h = np.nonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("lang")[i].as_py()] * len(g), pa.string()),
                     pa.array([names[x] for x in g], pa.string()), pa.array([names[x] for x in h], pa.string()),
                     pa.array(total[g, h])], names=["lang", "source", "item", "value"])
    kind = "lang string, source string, item string, value long"
    found = rows.mapInArrow(price, kind).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    own = groups.select("lang", "source")
    pairs = own.join(own.withColumnRenamed("source", "item"), "lang").filter("source <> item")
    return (pairs.join(found, ["lang", "source", "item"], "left")
            .select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")))


#: ``shares`` as SQL: at once if the product fits 64 bits, or else whole quotient and
#: remainder, three decimal digits at a time.
_SHARE = ("1 + if({0} < 9000000000, (({0} + 1) * 1000000000) div (size_), "
          "aggregate(array(1, 2, 3), named_struct('w', ({0} + 1) div (size_), 'r', ({0} + 1) % (size_)), "
          "(a, _) -> named_struct('w', a.w * 1000 + (a.r * 1000) div (size_), 'r', (a.r * 1000) % (size_)), a -> a.w))"
          ).replace("size_", "{1} + terms")


def term_values(kept: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, item, value, rank of the terms that a source has more of
    than its language.  The limit is applied within tasks before the shuffle."""
    each = kept.select("lang", "term", "total", F.explode("by_source").alias("s")).select(
        "lang", "term", "total", "s.source", "s.n")
    both = each.join(broadcast_if_small(groups), ["lang", "source"])
    p, q = F.expr(_SHARE.format("n", "size")), F.expr(_SHARE.format("total", "lang_size"))
    both = both.withColumn("p", p).withColumn("q", q).filter("n > 0 AND p > q")
    value = F.expr("((p - q) * (p - q)) div q")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return (both.select("lang", "source", F.col("term").alias("item"), value.cast("long").alias("value"))
            .withColumn("rank", rank).filter(F.col("rank") <= top))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank of ``docs`` (text, lang, source)."""
    counts = staged(term_counts(docs), "term-counts")
    kept = staged(kept_terms(counts, least), "kept-terms")
    groups = staged(group_sizes(counts, kept), "group-sizes")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(kept, groups).withColumn("rank", F.row_number().over(order))
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                                         F.col("rank").cast("int").alias("rank"))
    return columns(pairs, "pair").unionByName(columns(term_values(kept, groups, top), "term"))
