"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window of ``length`` words is represented by one fingerprint: the smallest hash of its
k-grams. Documents and benchmark items select fingerprints by the same rule, so every
shared window shares its fingerprint; only fingerprints that meet are extended to whole
windows, which are compared as text. An item shorter than a window is one window of its
own length, with its own selection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from oddsline.llm.common import join_nulls, lower_ascii, sent, written

#: Fixed value: words are runs of ASCII letters and digits and of all non-ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
KEY = ["_id", "_hash"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def gram_size(length: int) -> int:
    return (length + 1) // 2


def starts(column: str, width: int) -> Column:
    """0-based starts of all runs of ``width`` elements; empty if there are fewer."""
    last = F.size(column) - width
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def run(column: str, start: Column, width: int) -> list[Column]:
    """``width`` elements from a 0-based start; unlike a slice, it never copies the array."""
    return [F.get(column, start + k) for k in range(width)]


def fingerprinted(rows: DataFrame, length: int) -> DataFrame:
    """Adds ``_mins``: the fingerprint of every window of ``length`` words of ``_words``."""
    k = gram_size(length)
    grams = rows.withColumn("_grams", F.transform(starts("_words", k), lambda i: F.xxhash64(*run("_words", i, k))))
    span = length - k + 1
    if span == 1:
        return grams.withColumnRenamed("_grams", "_mins")
    return grams.withColumn("_mins", F.transform(
        starts("_grams", span), lambda i: F.least(*run("_grams", i, span)))).drop("_grams")


def window_text(i: Column, length: int) -> Column:
    return F.concat_ws(" ", *run("_words", i, length))


def item_windows(items: DataFrame) -> DataFrame:
    """(length, fingerprint, window, item_id) for every window of every item."""
    rows = (items.select("item_id", words(F.col("text")).alias("_words"))
            .withColumn("_length", F.least(F.size("_words"), F.lit(WINDOW))).filter("_length > 0"))
    parts = []
    for length in range(1, WINDOW + 1):
        own = fingerprinted(rows.filter(F.col("_length") == length), length)
        pairs = F.transform("_mins", lambda x, i: F.struct(
            x.alias("fingerprint"), window_text(i, length).alias("window")))
        parts.append(own.select(F.lit(length).alias("length"), "item_id", F.explode(pairs).alias("_w"))
                     .select("length", "_w.fingerprint", "_w.window", "item_id"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.distinct()


def keyed(docs: DataFrame) -> DataFrame:
    """A row is named by its doc_id and a hash of its text, so repeated ids stay apart."""
    return docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), F.col("text").alias("_text"))


def fingerprint_hits(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """Per KEY: n_words, the number of equal rows, and the fingerprints it shares with items.

    The one pass that splits all texts, for all lengths at once. Each row is carried by its
    first fingerprint, met or not; of the others only those that an item has go on.
    """
    rows = docs.select(*KEY, words(F.col("_text")).alias("_words"))
    none = F.array().cast("array<bigint>")
    prints = rows.select(*KEY, F.coalesce(F.size("_words"), F.lit(0)).alias("_n"), "_words")
    for length in lengths:
        own = fingerprinted(prints, length)
        prints = own.withColumnRenamed("_mins", f"_mins{length}")
    joined = F.array_distinct(F.concat(none, *[F.coalesce(f"_mins{n}", none) for n in lengths]))
    each = prints.select(*KEY, "_n", F.posexplode_outer(joined).alias("_at", "fingerprint"))
    wanted = written(windows.select(F.col("fingerprint").alias("_met")).distinct(), "fingerprints")
    met = (each.join(sent(wanted), F.col("fingerprint") == F.col("_met"), "left")
           .filter("_met IS NOT NULL OR coalesce(_at, 0) = 0"))
    first = F.count(F.when(F.coalesce("_at", F.lit(0)) == 0, 1))
    return met.groupBy(*KEY).agg(F.max("_n").cast("long").alias("n_words"), first.alias("_copies"),
                                 F.collect_set("_met").alias("_matched"))


def hits(near: DataFrame, windows: DataFrame, length: int) -> DataFrame:
    """Occurrences (KEY, start, length, window) of item windows of one length in ``near`` documents."""
    own = windows.filter(F.col("length") == length)
    # Walks over the fingerprints themselves: looked up by index they would be computed anew for each.
    extended = fingerprinted(near, length).withColumn("_at", F.filter(F.transform(
        "_mins", lambda x, i: F.when(F.array_contains("_matched", x), i)), lambda i: i.isNotNull()))
    spans = extended.select(*KEY, F.explode(F.transform("_at", lambda i: F.struct(
        i.alias("start"), window_text(i, length).alias("window")))).alias("_w"))
    return (spans.select(*KEY, "_w.start", F.lit(length).alias("length"), "_w.window")
            .join(own.select("window").distinct(), "window", "left_semi"))


def found(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents by KEY, occurrences, item windows): written, the latter two empty if nothing is shared."""
    windows = written(item_windows(items.select("item_id", "text")), "windows")
    present = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most 10
    rows = keyed(docs)
    judged = written(fingerprint_hits(rows, windows, present), "matched")
    matched = judged.filter(F.size("_matched") > 0).select(F.col("_id").alias("_near_id"),
                                                           F.col("_hash").alias("_near_hash"), "_matched")
    same = F.col("_id").eqNullSafe(F.col("_near_id")) & F.col("_hash").eqNullSafe(F.col("_near_hash"))
    near = written(rows.join(sent(matched), same)
                   .select(*KEY, "_matched", words(F.col("_text")).alias("_words")), "near")
    out = near.select(*KEY, F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("window")).filter("false")
    for length in present:
        out = out.union(hits(near, windows, length).select(*KEY, "start", "length", "window"))
    return judged, written(out, "occurrences"), windows


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts the words inside any occurrence of a window of an item. A null text
    has no words; a null item_id counts for n_hit but is no item in n_items and the hash.
    Repeated rows get equal results; extra columns are ignored; empty tables give rows
    without hits, or no rows.
    """
    judged, occurrences, windows = found(docs, items)
    earlier = (Window.partitionBy(*KEY).orderBy("start", "length")
               .rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("length")
    covered = (occurrences.select(*KEY, "start", "length").distinct()
               .withColumn("_from", F.greatest("start", F.max(end).over(earlier)))
               .groupBy(*KEY).agg(F.sum(F.greatest(F.lit(0), end - F.col("_from"))).alias("n_hit")))
    named = (occurrences.select(*KEY, "length", "window").distinct()
             .join(windows.select("length", "window", "item_id"), ["length", "window"])
             .filter("item_id IS NOT NULL").select(*KEY, F.col("item_id").cast("string").alias("_item")).distinct())
    listed = named.groupBy(*KEY).agg(F.sort_array(F.collect_list("_item")).alias("_items"))
    counted = judged.select(*KEY, "n_words", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"))
    both = join_nulls(join_nulls(counted, covered, KEY, "left"), listed, KEY, "left")
    items_of = F.coalesce("_items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return both.select(F.col("_id").alias("doc_id"), "n_words", hit.alias("n_hit"),
                       F.size(items_of).cast("long").alias("n_items"),
                       F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
                       (hit > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark window, columns unchanged."""
    _, occurrences, _ = found(docs, items)
    dirty = written(occurrences.select(*KEY).distinct(), "dirty")
    return docs.join(sent(dirty), docs["doc_id"].eqNullSafe(dirty["_id"])
                     & F.xxhash64(docs["text"]).eqNullSafe(dirty["_hash"]), "left_anti")
