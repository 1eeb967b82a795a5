"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a key from the hash of its id. Within its source it is placed by that key: ranges
of equal width of the key (uniform by construction, so a source with a third of all rows is as well
spread as any) are summed, the sums of the ranges before give each range its offset, and a running
sum inside the range gives each document the words before it. Whole epochs take every document; the
rest of the budget takes documents from the start of the order and cuts the last one, so that a
source gives exactly its budget.

Targets: sources by code point, null last, have the given weights in turn and share
``share`` times all words; none gets more than ``most`` times its own words, the excess goes to the
others by weight. With sources ordered by (most * words / weight) the capped ones come first.

Defined results: null text has size 0; null is a source of its own; a null doc_id has the key of an
empty id; rows of a repeated doc_id stand next to each other, ordered by size and text hash; size-0
documents take 0; an empty table gives an empty mix. Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartloom.llm.ranks import ranked
from cartloom.llm.shared import WORD, free_names, stored, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
#: Documents that a key range of the largest source is meant to hold.
RANGE_ROWS = 50_000


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and what orders rows of equal id."""
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")
    )


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size, target. One row per source; the windows see no more than these rows."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    turn = F.array(*map(F.lit, weights))
    weighed = sources.withColumn("weight", F.element_at(turn, (place % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * most
    by_level = Window.orderBy("level", F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    filled = weighed.withColumns({"cap": cap, "level": cap / F.col("weight")}).withColumns(
        {
            "words_left": F.sum("source_size").over(everything) * share
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "weight_left": F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # From the first source on whose cap is not reached all share the rest by weight.
    even = F.col("words_left") / F.col("weight_left")
    first = F.first(F.when(F.col("level") >= even, even), ignorenulls=True)
    rest = first.over(by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap"), F.coalesce(rest, F.lit(float("inf"))) * F.col("weight"))
    return filled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 7
) -> DataFrame:
    """doc_id, source, size, text_hash, source_size, target, taken: words of each row in the mix."""
    placed = _placed(docs, weights, share, most, seed)
    partly = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    taken = (F.col("whole") * F.col("size") + partly).cast("long")
    return placed.select(
        "doc_id", "source", "size", "text_hash", "source_size", "target", taken.alias("taken")
    )


def _key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", doc_id.cast("string"), F.lit(str(seed))))


def _placed(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: int) -> DataFrame:
    """Sizes with their key, the words ``before`` them in their source, and what the mix takes of it:
    ``whole`` epochs and the first ``rest`` words of one more."""
    # Sizes are read several times and small; the texts are scanned once.
    sizes = stored(sized(docs), "mixing-sizes")
    largest = sizes.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    bits = min(32, max(1, math.ceil(math.log2(max(1.0, largest / RANGE_ROWS)))))
    key = _key(F.col("doc_id"), seed)
    top = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    keyed = sizes.withColumns({"key": key, "range": F.shiftright(top, 32 - bits)})
    targets = source_targets(sizes, weights, share, most)
    budget = F.round("target").cast("long")
    ranges = (
        keyed.groupBy("source", "range")
        .agg(F.sum("size").alias("range_size"))
        .withColumn(
            "offset",
            F.sum("range_size").over(Window.partitionBy("source").orderBy("range")) - F.col("range_size"),
        )
        .join(_small(targets), F.col("source").eqNullSafe(F.col("of_source")))
        .select(F.col("source").alias("s"), F.col("range").alias("r"), "offset", "source_size", "target")
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "text_hash")
    running = keyed.withColumn(
        "before", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    )
    placed = running.join(
        ranges, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))
    ).withColumns({"before": F.col("before") + F.col("offset"), "budget": budget})
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    rest = F.when(F.col("source_size") > 0, F.expr("budget % source_size")).otherwise(0)
    return placed.withColumns({"whole": whole, "rest": rest})


def _small(targets: DataFrame) -> DataFrame:
    return targets.select(F.col("source").alias("of_source"), "source_size", "target")


def first_words(text: Column, count: Column) -> Column:
    """The beginning of a text up to and with its ``count``-th word."""
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), count.cast("int")), "")


def _cuts(placed: DataFrame) -> DataFrame:
    """One row per source: its whole epochs and, where there is one more in part, the row at its cut
    (``at``) with the words that this row, or the rows equal to it, still take (``open``)."""
    open_ = F.col("rest") - F.col("before")
    last = F.struct("key", "doc_id", "size", "text_hash", open_.alias("open"))
    inside = (F.col("size") > 0) & (open_ > 0)
    # Of equal rows the first one, with the most words left, is the greatest here.
    found = placed.groupBy("source").agg(F.max("whole").alias("whole"), F.max(F.when(inside, last)).alias("last"))
    at = F.struct(*[F.col(f"last.{name}").alias(name) for name in ("key", "doc_id", "size", "text_hash")])
    at = F.when(F.col("last").isNotNull(), at)
    return found.select("source", "whole", at.alias("at"), F.col("last.open").alias("open"))


def mixed_documents(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 7
) -> DataFrame:
    """The mix itself, columns as in ``docs``: a document once per epoch, the one at the cut shortened.

    Texts are not shuffled: each source has one cut in the order of the keys, and a document tells by
    its own key on which side it stands. Only rows equal to the one at the cut (id, source and text) are
    numbered, and take what is left one after the other. Nulls are a source, an id or an empty text;
    texts without words are never in the mix; long texts and clashing names stay as they are; an empty
    table gives no rows.
    """
    cuts = stored(_cuts(_placed(docs, weights, share, most, seed)), "mixing-cuts")
    of, whole, at, open_, side, copies, words, place, total = free_names(
        docs, "of", "whole", "at", "open", "side", "copies", "words", "place", "total"
    )
    cuts = cuts.withColumnsRenamed({"source": of, "whole": whole, "at": at, "open": open_})
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    key = _key(F.col("doc_id"), seed)
    rest = F.struct(F.col("doc_id"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    cut = F.struct(*[F.col(f"{at}.{name}") for name in ("doc_id", "size", "text_hash")])
    # -1 before the cut, 0 at it, 1 behind it. Sizes are counted only where keys are equal.
    order = (
        F.when(F.col(at).isNull() | (key > F.col(f"{at}.key")), 1)
        .when(key < F.col(f"{at}.key"), -1)
        .when(rest < cut, -1)
        .when(rest > cut, 1)
        .otherwise(0)
    )
    dealt = docs.join(cuts, F.col("source").eqNullSafe(F.col(of))).where(has_words).withColumn(side, order)
    plain = dealt.where(F.col(side) != 0).select(
        *docs.columns,
        (F.col(whole) + F.when(F.col(side) < 0, 1).otherwise(0)).alias(copies),
        F.lit(None).cast("long").alias(words),
    )
    tied = ranked(dealt.where(F.col(side) == 0), [of], [], place, total)
    size = F.col(f"{at}.size")
    left = F.greatest(F.lit(0), F.least(size, F.col(open_) - F.col(place) * size))
    tied = tied.select(
        *docs.columns,
        (F.col(whole) + F.when(left == size, 1).otherwise(0)).alias(copies),
        F.when((left > 0) & (left < size), left).alias(words),
    )
    # One row per whole epoch (null: all words), and one with the words of the part.
    epochs = F.array_repeat(F.lit(None).cast("long"), F.col(copies).cast("int"))
    part = F.when(F.col(words).isNotNull(), F.array(words)).otherwise(F.array().cast("array<bigint>"))
    found = plain.unionAll(tied).withColumn(words, F.explode(F.concat(epochs, part)))
    cut = F.when(F.col(words).isNotNull(), first_words(F.col("text"), F.col(words)))
    out = {"text": F.coalesce(cut, F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(cut.isNull(), F.col("n_chars")).otherwise(F.length(cut).cast("long"))
    return found.withColumns(out).select(*docs.columns)
