"""Near duplicates by DartMinHash.

A document is a weighted set: its five-word shingles, weighted by how often
they occur.  An element of weight w owns the region [0, w) of its own axis.  Hashed
darts fall on every axis, one per unit of weight and unit of rank on average: the
axis is cut into [0, 1), [1, 2), [2, 4), [4, 8), ..., and in each of these pieces
darts follow each other in rank at hashed (exponential) distances, each at a hashed
place of the piece and with one of ``DARTS`` coordinates.  A document is hit by the
darts that fall into its regions, and keeps the earliest of each coordinate; two
documents keep the same dart with the probability of their weighted Jaccard
similarity.  Weights may be any positive numbers (``signature``).  About ``DARTS *
(ln DARTS + 2)`` darts fill a signature, so the rank up to which they are looked
at falls with the total weight, and the work grows with the number of elements and
the logarithm of their weights, not with the weight.

``BANDS`` bands of ``ROWS`` coordinates are joined.  At similarity 0.8 a pair
shares no band with probability (1 - 0.8**6)**30, about 1 in 9,000, and less
above.  Candidates are screened by a byte of each coordinate (0.65 and less is
dropped: five standard deviations) and decided by the exact weighted Jaccard
similarity of their shingles.

No bucket is ever turned into all its pairs: texts with equal words are one
node; a bucket's nodes are compared with its first node; classes are joined; its nodes
are compared with a central one of its largest class, classes are joined again;
and only nodes of a bucket that are in *different* classes by then are compared
with each other, save the pairs that cannot be alike: a node's difference from
the bucket's first node is kept as counts and small bit sets, which bound the
shingles that two nodes can have in common.  The bound is tight for copies with
a few edits, and it is evaluated inside the join, so what comes out of a bucket
are nearly only links.  So every candidate pair is decided, or inside one class,
or impossible.

Classes are the connected components of the decided links, by label propagation
with pointer jumping over staged tables; nothing but counts comes to the driver.

Defined results: words are runs of ASCII letters, digits and characters beyond
ASCII, A-Z lower-cased; a document of one to four words is one shingle; a
wordless or null text is a class of its own; the class id is the smallest
doc_id of the class; a null doc_id joins its class and is null in a class of
its own; repeated rows are kept; further columns are ignored."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm._files import free_name, staged
from seqtally.llm._words import PLAIN_CASE, PLAIN_SEPARATOR, Words, mix, pieces, rolling

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 30, 6
DARTS = BANDS * ROWS
#: Darts looked at first; a signature with holes looks further.
THROWN = int(DARTS * (math.log(DARTS) + 2))
#: Least share of agreeing coordinates of a pair worth deciding (five standard
#: deviations below the similarity).
SCREEN = SIMILARITY - 0.15
#: Longs of the bit sets of a node's difference from its bucket's first node.
MASK = 16
_MASKS = [f"{kind}{k}" for kind in "me" for k in range(MASK)]

SIGNATURES = "doc_id long, text_key long, words binary, size long, bands array<long>, sketch binary"
_SALT = np.uint64(0x9E3779B97F4A7C15)


# --- one document ---------------------------------------------------------------

def _shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of every shingle, in the order of the texts; the order in
    which equal shingles of a text follow each other, and where each begins in it."""
    hashes, counts = words.hashes(), words.counts
    at = np.flatnonzero(words.window_starts(SHINGLE))
    owner = words.owner()[at]
    shingles = rolling(hashes, SHINGLE)[at]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        own = [mix(rolling(hashes[words.first[d]:words.first[d + 1]], int(counts[d])) + _SALT)[0] for d in short]
        shingles = np.concatenate((shingles, np.array(own, np.uint64)))
        owner = np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        shingles, owner = shingles[order], owner[order]
    group = mix(shingles ^ mix(owner.astype(np.uint64)))
    order = np.argsort(group, kind="stable")
    ranked = group[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, np.int64)
    return shingles, owner, order, first


def shingle_units(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit name for each unit of shingle weight, and the n + 1 bounds of
    the texts' units.  Equal shingles of a text differ by their number."""
    shingles, owner, order, first = _shingles(words)
    number = np.empty(len(order), np.uint64)
    number[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    units = mix(shingles + number * _SALT)
    return units, np.searchsorted(owner, np.arange(len(words.counts) + 1))


def shingle_weights(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of the texts, their weights, and the n + 1 bounds of
    the texts' shingles."""
    shingles, owner, order, first = _shingles(words)
    weights = np.diff(np.append(first, len(order))).astype(np.float64)
    one = order[first]
    by_text = np.argsort(owner[one], kind="stable")
    one, weights = one[by_text], weights[by_text]
    return shingles[one], weights, np.searchsorted(owner[one], np.arange(len(words.counts) + 1))


def darts(elements: np.ndarray, weights: np.ndarray, limit: float):
    """(rank, name, coordinate) of the darts of rank ``limit`` and less that hit
    the elements' regions; a piece of the axes and some darts of it at a time."""
    low, width, piece = 0.0, 1.0, 0
    while True:
        own = weights > low
        x, w = elements[own], weights[own]
        if not len(x):
            return
        rank, n = np.zeros(len(x)), 0
        step = max(1, math.ceil(limit * width))
        while len(x):
            number = np.arange(n, n + step, dtype=np.uint64) + np.uint64((piece << 40) + 1)
            name = mix(x[:, None] ^ mix(number)[None])
            r = rank[:, None] - np.cumsum(np.log(((name >> np.uint64(11)) + 0.5) * 2.0 ** -53), axis=1) / width
            place = mix(name)
            hit = (r <= limit) & (low + width * ((place >> np.uint64(32)) * 2.0 ** -32) < w[:, None])
            yield r[hit], name[hit], (((place[hit] & np.uint64(0xFFFFFFFF)) * np.uint64(DARTS)) >> np.uint64(32)).astype(np.int64)
            on = r[:, -1] <= limit
            x, w, rank, n = x[on], w[on], r[on, -1], n + step
        low, width, piece = low + width, max(1.0, low + width), piece + 1


def signature(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The name of the earliest dart of each coordinate, for distinct elements
    (64-bit hashes) with positive weights."""
    limit = THROWN / weights.sum()
    while True:
        rank, name, coordinate = (np.concatenate(c) for c in zip(*darts(elements, weights, limit)))
        late = np.argsort(-rank, kind="stable")
        out, filled = np.zeros(DARTS, np.uint64), np.zeros(DARTS, bool)
        out[coordinate[late]], filled[coordinate] = name[late], True  # the earliest is written last
        if filled.all():
            return out
        limit *= 2


def _fingerprint(hashes: np.ndarray) -> bytes:
    """128 bits of a word sequence."""
    n = len(hashes)
    return b"".join(int(mix(rolling(hashes, n, k) + np.uint64(n))[0]).to_bytes(8, "big") for k in (1, 2))


def signatures(docs: DataFrame) -> DataFrame:
    """words (fingerprint of the word sequence; null: no words), size (weight),
    bands and sketch of every document."""
    def run(batches):
        bands_of = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * _SALT
        for batch in batches:
            for part in pieces(batch):
                words = Words(part.column("text"), PLAIN_SEPARATOR, PLAIN_CASE)
                hashes = words.hashes()
                elements, weights, bounds = shingle_weights(words)
                prints, size, bands, sketch = [], [], [], []
                for d in range(part.num_rows):
                    own = slice(bounds[d], bounds[d + 1])
                    size.append(int(weights[own].sum()))
                    if not size[-1]:
                        prints.append(None), bands.append(None), sketch.append(None)
                        continue
                    prints.append(_fingerprint(hashes[words.first[d]:words.first[d + 1]]))
                    kept = mix(signature(elements[own], weights[own]))
                    sketch.append((kept & np.uint64(255)).astype(np.uint8).tobytes())
                    key = bands_of.copy()
                    for column in kept.reshape(BANDS, ROWS).T:
                        key = mix(key ^ column) + column
                    bands.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("text_key"), pa.array(prints, pa.binary()),
                     pa.array(size, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    names=["doc_id", "text_key", "words", "size", "bands", "sketch"])
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, SIGNATURES)


# --- links ----------------------------------------------------------------------

def _units_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id and sorted unit names of the wanted nodes, from the text of one
    document of each."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                units, bounds = shingle_units(Words(part.column("text"), PLAIN_SEPARATOR, PLAIN_CASE))
                own = [np.sort(units[a:b]).astype("<u8").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(own, pa.binary())], names=["id", "units"])
    found = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"), "text").join(
        wanted.select("id", "own.*"), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_key")))
    return found.select("id", "text").mapInArrow(run, "id long, units binary").dropDuplicates(["id"])


def _agreement(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with ``alike``, the share of agreeing coordinates."""
    left = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a"), F.col("size").alias("size_a"))
    right = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b"), F.col("size").alias("size_b"))
    both = pairs.join(left, "a").join(right, "b").select(*pairs.columns, "sketch_a", "sketch_b", "size_a", "size_b")
    keep = pairs.columns

    def run(batches):
        for batch in filter(len, batches):
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, DARTS)
                    for c in ("sketch_a", "sketch_b"))
            size = np.sort(np.stack([batch.column(c).to_numpy() for c in ("size_a", "size_b")]), 0)
            alike = np.minimum((x == y).mean(1), size[0] / size[1])  # similarity is no more than the sizes' ratio
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(alike)], names=[*keep, "alike"])
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema]
    return both.mapInArrow(run, ", ".join([*fields, "alike double"]))


def _paired(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """a, b and their units x, y."""
    return (pairs.select("a", "b").join(units.select(F.col("id").alias("b"), F.col("units").alias("y")), "b")
            .join(units.select(F.col("id").alias("a"), F.col("units").alias("x")), "a").select("a", "b", "x", "y"))


def _links(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity is enough."""
    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                common = len(np.intersect1d(x, y))
                ok.append(common >= SIMILARITY * (len(x) + len(y) - common) - 1e-9)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
    return _paired(pairs, units).mapInArrow(run, "a long, b long")


def _profiles(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """a, b, size_a, size_b, common, and hashed bit sets (``MASK`` longs each) of
    what b lacks of a's units (m0, m1, ...) and has beside them (e0, e1, ...);
    m_over and e_over: how many more units than bits there are."""
    places = np.uint64(64 * MASK)

    def mask(found):
        bits = np.zeros(64 * MASK, np.uint8)
        bits[(found % places).astype(np.int64)] = 1
        return np.packbits(bits, bitorder="little").view("<i8"), len(found) - int(bits.sum())

    def run(batches):
        for batch in filter(len, batches):
            numbers, masks = [], []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                lacks, adds = np.setdiff1d(x, y, assume_unique=True), np.setdiff1d(y, x, assume_unique=True)
                (m, m_over), (e, e_over) = mask(lacks), mask(adds)
                numbers.append((len(x), len(y), len(x) - len(lacks), m_over, e_over))
                masks.append(np.concatenate((m, e)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *(pa.array(c, pa.int64()) for c in zip(*numbers)),
                 *map(pa.array, np.ascontiguousarray(np.stack(masks).T))], names=names)
    names = ["a", "b", "size_a", "size_b", "common", "m_over", "e_over", *_MASKS]
    return _paired(pairs, units).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _possible(x: str, y: str):
    """Whether two nodes of a bucket can be alike, by their profiles against
    its first node.  With L the first node's units, M what a node lacks of them
    and E what it adds, |X & Y| = |L| - |Mx| - |My| + |Mx & My| + |Ex & Ey|; the
    last two are at most what the bit sets have in common, plus the units of
    one side that share a bit."""
    def c(side, name):
        return F.col(f"{side}.{name}")

    def overlap(kind):
        both = (F.bit_count(c(x, f"{kind}{k}").bitwiseAND(c(y, f"{kind}{k}"))) for k in range(MASK))
        return reduce(lambda p, q: p + q, both) + F.least(c(x, f"{kind}_over"), c(y, f"{kind}_over"))
    common = c(x, "common") + c(y, "common") - c(x, "size_a") + overlap("m") + overlap("e")
    return common >= SIMILARITY / (1 + SIMILARITY) * (c(x, "size_b") + c(y, "size_b")) - 1e-6


def components(links: DataFrame) -> DataFrame:
    """id and class (the smallest id reached) of every node of ``links`` (a, b):
    labels spread to neighbours, then jump to their label's label, until no
    label changes."""
    parts = 4 + links.count() // 500_000  # small tables in few files

    def kept(df, name):
        return staged(df.coalesce(parts), name)
    ends = kept(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "ends")
    labels = kept(ends.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("class")), "labels")
    while True:
        near = (ends.join(labels.select(F.col("id").alias("b"), "class"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("class").alias("near")))
        spread = labels.join(near, "id").select("id", "class", F.least("class", "near").alias("low"))
        far = labels.select(F.col("id").alias("low"), F.col("class").alias("far"))
        step = kept(spread.join(far, "low", "left").select("id", F.col("class").alias("old"),
                                                           F.least("low", "far").alias("class")), "labels")
        labels = step.select("id", "class")
        if step.filter("old <> class").isEmpty():
            return labels


def _mixed(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket entries (key, a, b, ...) with b's class, of buckets that hold
    several classes."""
    own = labels.select(F.col("id").alias("b"), F.col("class").alias("found"))
    entries = entries.join(own, "b", "left").withColumn("class", F.coalesce("found", "b")).drop("found")
    several = (entries.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
               .filter("low <> high").select("key"))
    return entries.join(several, "key", "left_semi")


def _across(x: DataFrame, y: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of nodes of one bucket and different classes that
    can be alike."""
    able = (F.col("x.key") == F.col("y.key")) & (F.col("x.class") != F.col("y.class")) & _possible("x", "y")
    if x is y:
        able = (F.col("x.b") < F.col("y.b")) & able
    return (x.alias("x").join(y.alias("y"), able)
            .select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, text_key (a hash of the text), class_no (a number of the
    class; null: no words) and first (doc_id and text_key of the class's first
    document) of every document."""
    sigs = staged(signatures(docs), "signatures")
    nodes = (sigs.filter("words IS NOT NULL").groupBy("words")
             .agg(F.min("doc_id").alias("doc"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("own"),
                  F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    # numbered in the order of doc_id, so a bucket's first node is its oldest text
    nodes = staged(nodes.orderBy("doc", "words").withColumn("id", F.monotonically_increasing_id()), "nodes")

    entries = nodes.select("id", F.explode("bands").alias("key"))
    firsts = (entries.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n"))
              .filter("n > 1").select("key", "a"))
    buckets = staged(entries.join(firsts, "key").select("key", "a", F.col("id").alias("b")), "buckets")
    stars = buckets.filter("a <> b").select("a", "b").distinct()
    members = buckets.select(F.col("b").alias("id")).distinct()
    stars = staged(_agreement(stars, nodes), "stars")
    units = staged(_units_of(docs, nodes.join(members, "id", "left_semi")), "units")

    links = staged(_links(stars.filter(F.col("alike") >= SCREEN), units), "links")
    labels = components(links)

    # nodes of one bucket in different classes (its first node has met all)
    mixed = staged(_mixed(buckets.filter("a <> b"), labels), "mixed")
    profiles = staged(_profiles(mixed.select("a", "b").distinct(), units), "profiles")
    mixed = staged(mixed.join(profiles, ["a", "b"]), "mixed")
    # first with the node of the bucket's largest class that is closest to the
    # first node, then, if classes are left, with each other
    far = F.col("size_a") + F.col("size_b") - 2 * F.col("common")
    sizes = mixed.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(far, "b")).alias("near"))
    central = (sizes.groupBy("key").agg(F.max(F.struct("n", "class", "near")).alias("top"))
               .select("key", F.col("top.near.b").alias("b")))
    more = staged(_links(_across(mixed, mixed.join(central, ["key", "b"], "left_semi")), units), "links")
    if not more.isEmpty():
        links = staged(links.unionByName(more), "links")
        labels = components(links)
        mixed = staged(_mixed(mixed.drop("class"), labels), "mixed")
    more = staged(_links(_across(mixed, mixed), units), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    whole = (nodes.select("id", "words", "own").join(labels, "id", "left")
             .withColumn("class", F.coalesce("class", "id")))
    # staged, so that a class of very many nodes can be split in the join
    least = staged(whole.groupBy("class").agg(F.min("own").dropFields("none").alias("first")), "classes")
    named = staged(whole.join(least, "class").select("words", "first", "class"), "named")
    return (sigs.select("doc_id", "text_key", "words").join(named, "words", "left")
            .select("doc_id", F.when(F.col("words").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
                    "text_key", F.col("class").alias("class_no"), "first"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class, that with the smallest doc_id
    (then the smallest hash of its text); rows alike in doc_id and text are one
    document.  Documents without words are in no class and all stay, repeated rows
    too.  Every document is told its class's first where the classes are named, so
    nothing meets by class."""
    classes = staged(near_duplicates(docs).filter("class_no IS NOT NULL"), "classes")
    own = F.struct("doc_id", "text_key")
    gone = classes.filter(~own.eqNullSafe(F.col("first"))).select("doc_id", "text_key").distinct()
    again = (classes.filter(own.eqNullSafe(F.col("first"))).groupBy("doc_id", "text_key").count()
             .filter("count > 1").select("doc_id", "text_key"))

    def among(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return df.alias("d").join(keys.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                                  & (F.xxhash64("d.text") == F.col("k.text_key")), how)
    kept = among(docs, gone, "left_anti")
    again = staged(again, "repeated")
    if again.isEmpty():
        return kept
    key = free_name("_key", docs.columns)
    once = among(kept, again, "left_semi").withColumn(key, F.xxhash64("text")).dropDuplicates(["doc_id", key]).drop(key)
    return among(kept, again, "left_anti").unionByName(once)
