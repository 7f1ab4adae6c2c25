"""Benchmark decontamination with DataFrame operations only.

Texts are lower-cased (A-Z) and cut into words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A benchmark item's windows are its
``WINDOW`` consecutive words, or all its words if it has fewer.  The windows are
hashed into a set that is broadcast when its measured size is within
``BROADCAST_BYTES`` (otherwise the join is shuffled and carries each window's
words).  Every word position of every document probes the set in one
code-generated stage (explode, hash, join); a hit is verified word by word.

A document also sends one row of its own through the same join, so that the
number of its words needs no second pass over the texts.  What is shuffled is
one row per document and one per hit.

Defined results: a null or wordless text has no words and no hit; null and
repeated doc_ids give a row for each row (rows alike in doc_id and text get the
same values); an empty benchmark hits nothing; an item that is null or has no
word is no window; further columns are kept by ``remove_documents`` and
``remove_spans`` and play no part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 10
#: Measured size of the window set up to which it is broadcast.
BROADCAST_BYTES = 64 << 20

_SEPARATORS = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Lower-case words of a text; a null text has none."""
    plain = F.trim(F.translate(F.coalesce(text, F.lit("")), _UPPER + _SEPARATORS,
                               _UPPER.lower() + " " * len(_SEPARATORS)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def _hash(ws: Column, at: Column, n: int) -> Column:
    """Hash of the n words from place ``at`` (0-based) on; null beyond the end."""
    return F.when(at + n <= F.size(ws), F.xxhash64(F.lit(n), *(F.get(ws, at + k) for k in range(n))))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """h, gram, item_id: the distinct windows of every benchmark item."""
    items = benchmark.select("item_id", words(F.col("text")).alias("ws")).filter(F.size("ws") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - window, F.lit(0)))
    grams = (items.select("item_id", "ws", F.explode(starts).alias("at"))
             .select("item_id", F.slice("ws", F.col("at") + 1, window).alias("gram")).distinct())
    sized = F.lit(None).cast("long")
    for n in range(1, window + 1):
        sized = F.when(F.size("gram") == n, _hash(F.col("gram"), F.lit(0), n)).otherwise(sized)
    return grams.select(sized.alias("h"), "gram", "item_id")


def window_set(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """h, gram, number: the distinct windows of all items, numbered; staged."""
    from seqtally.llm._files import staged
    grams = item_windows(benchmark, window).select("h", "gram").distinct()
    return staged(grams.withColumn("number", F.monotonically_increasing_id()), "item-windows")


def hits(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, at, n, number: a row for each occurrence of a
    window of ``window_set``, and a row with n = 0 for each document."""
    sizes = grams.groupBy(F.size("gram").alias("n")).agg(
        F.sum(F.octet_length(F.array_join("gram", " ")) + 64).alias("bytes")).collect()  # a row per length
    lengths = sorted(r.n for r in sizes)
    small = sum(r.bytes for r in sizes) <= BROADCAST_BYTES
    own = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("h"),
                                            F.array().cast("array<string>").alias("gram"),
                                            F.lit(None).cast("long").alias("number"))
    index = grams.unionByName(own)

    split = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("ws"))
    # place -1 is the document's own row
    places = split.select("doc_id", "text_key", "ws",
                          F.explode(F.sequence(F.lit(-1), F.size("ws") - 1)).alias("at"))
    keys = [F.when(F.col("at") < 0, F.lit(0) if k == 0 else None).otherwise(_hash(F.col("ws"), F.col("at"), n))
            for k, n in enumerate(lengths or [1])]
    if len(keys) == 1:
        probe = places.withColumn("key", keys[0]).withColumn("n", F.lit((lengths or [1])[0]))
    else:
        pairs = F.array(*(F.struct(F.lit(n).alias("n"), k.alias("key")) for n, k in zip(lengths, keys)))
        probe = places.withColumn("p", F.explode(pairs)).select("*", "p.key", "p.n").drop("p")
    probe = probe.filter("key IS NOT NULL")
    found = F.slice("ws", F.col("at") + 1, F.col("n"))
    if small:
        joined = probe.join(F.broadcast(index), F.col("key") == F.col("h"))
        same = F.when(F.col("at") < 0, F.size("gram") == 0).otherwise(
            (F.size("gram") == F.col("n")) & (found == F.col("gram")))
        joined = joined.filter(same).withColumn("n_words", F.size("ws"))
    else:
        probe = probe.select("doc_id", "text_key", "at", "n", "key", F.size("ws").alias("n_words"),
                             F.when(F.col("at") >= 0, found).otherwise(F.array().cast("array<string>")).alias("seen"))
        itself = probe.filter("at < 0").withColumn("number", F.lit(None).cast("long"))
        joined = (probe.filter("at >= 0").join(grams, (F.col("key") == F.col("h")) & (F.col("seen") == F.col("gram")))
                  .select(itself.columns).unionByName(itself))
    return joined.select("doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"), "at",
                         F.when(F.col("at") < 0, 0).otherwise(F.col("n")).alias("n"), "number")


def _same(left: str, right: str) -> Column:
    """Whether two rows are of one document."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (
        F.col(f"{left}.text_key").eqNullSafe(F.col(f"{right}.text_key")))


def document_items(rows: DataFrame, benchmark: DataFrame, grams: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, items: the sorted item_ids (as strings) whose windows
    occur in each document with a hit.  Each distinct window of a document meets
    its items once."""
    from seqtally.operators._util import broadcast_if_small
    items = (item_windows(benchmark, window).join(broadcast_if_small(grams), ["h", "gram"])
             .select("number", F.col("item_id").cast("string").alias("item")).distinct())
    seen = rows.filter("n > 0").select("doc_id", "text_key", "number").distinct()
    return (seen.join(broadcast_if_small(items), "number").groupBy("doc_id", "text_key")
            .agg(F.sort_array(F.collect_set("item")).alias("items")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row per document: doc_id, text_key, n_words, n_hit (words inside a
    window that occurs), items (sorted item_ids as strings)."""
    from seqtally.llm._files import staged
    grams = window_set(benchmark, window)
    rows = staged(hits(docs, grams), "window-hits")
    key = ["doc_id", "text_key"]
    before = Window.partitionBy(*key).orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("n")
    new = F.greatest(end - F.greatest(F.coalesce(F.max(end).over(before), F.lit(0)), F.col("at")), F.lit(0))
    per = (rows.withColumn("new", F.when(F.col("n") > 0, new).otherwise(0))
           .groupBy(*key)
           .agg(F.max("n_words").alias("n_words"), F.sum("new").cast("long").alias("n_hit"),
                F.count_if(F.col("n") == 0).alias("copies")))
    found = document_items(rows, benchmark, grams, window)
    both = per.alias("p").join(found.alias("f"), _same("p", "f"), "left")
    return (both.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("p.doc_id", "p.text_key", "n_words", "n_hit",
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def contaminated_keys(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and text_key of the documents with a hit, once each."""
    return hits(docs, window_set(benchmark, window)).filter("n > 0").select("doc_id", "text_key").distinct()


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    bad = contaminated_keys(docs, benchmark, window).alias("bad")
    kept = docs.alias("docs").join(bad, F.col("docs.doc_id").eqNullSafe(F.col("bad.doc_id"))
                                   & (F.xxhash64("docs.text") == F.col("bad.text_key")), "left_anti")
    return kept


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` whose texts have lost every hit word with the separators before
    it; other characters stay as they are."""
    spans = (hits(docs, window_set(benchmark, window)).filter("n > 0")
             .select("doc_id", "text_key", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("p"))
             .groupBy("doc_id", "text_key").agg(F.collect_set("p").alias("gone")).alias("s"))
    word, other = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    parts = F.regexp_extract_all("docs.text", F.lit(f"{other}*{word}+"), F.lit(0))
    tail = F.regexp_extract("docs.text", f"({other}*)$", 1)
    gone = F.map_from_arrays("s.gone", F.transform("s.gone", lambda _: F.lit(True)))
    kept = F.filter(parts, lambda _, i: ~F.map_contains_key(gone, i))
    text = F.when(F.col("s.gone").isNull(), F.col("docs.text")).otherwise(F.concat(F.array_join(kept, ""), tail))
    joined = docs.alias("docs").join(spans, F.col("docs.doc_id").eqNullSafe(F.col("s.doc_id"))
                                     & (F.xxhash64("docs.text") == F.col("s.text_key")), "left")
    return joined.select(*(text.alias("text") if c == "text" else F.col(f"docs.`{c}`") for c in docs.columns))
