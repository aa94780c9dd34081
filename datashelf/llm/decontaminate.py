"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datashelf.llm.common import keyed, stored

# Fixed seeds over twelve words: 1 is looked at, 0 may differ. Every overlap that is verified below holds some seed whole,
# whichever words are changed: 3 of 16 or 15, 2 of 14, 13 or 12.
MASKS = (
    "101001010011", "110001100101", "101110001100", "000110110011", "010000111110", "011111001000", "010101010110",
)
SHORTEST_ITEM = 5
VERIFIED_WORDS = 16
MIN_PERCENT = 80
AROUND = 16  # words looked at on either side of a hit
BLOCK_ROWS = 200_000  # seeds broadcast at once: about 400 bytes each


def word_hashes(text: Column) -> Column:
    """Hashes of the words (runs of letters and digits), lower-cased."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def seed_key(hashes: Column, at: Column, masks: list[str], which: Column) -> Column:
    """The hash of the words that mask number ``which`` looks at from position ``at``."""
    keys = [F.xxhash64(F.lit(i), *[F.get(hashes, at + j) for j, c in enumerate(m) if c == "1"]) for i, m in enumerate(masks)]
    out = keys[-1]
    for i in range(len(masks) - 2, -1, -1):
        out = F.when(which == i, keys[i]).otherwise(out)
    return out


def seeds(rows: DataFrame, masks: list[str]) -> DataFrame:
    """Every seed of every row with ``hashes``: adds mask, at, key. A mask applies where all of its words exist."""
    n = F.size("hashes")
    span, number = len(masks[0]), len(masks)
    long_ = rows.filter(n >= span).withColumn("k", F.explode(F.sequence(F.lit(0), (n - span + 1) * number - 1)))
    long_ = long_.withColumns({"at": F.expr(f"int(k div {number})"), "mask": F.col("k") % number})
    return long_.withColumn("key", seed_key(F.col("hashes"), F.col("at"), masks, F.col("mask"))).drop("k")


def short_masks(words: int) -> list[str]:
    """Masks of a whole item of few words: whichever words a verified copy changes, one of them looks at none of these."""
    changed = words * (100 - MIN_PERCENT) // 100
    blocks = changed + 2
    return ["".join("0" if i * blocks // words in gone else "1" for i in range(words)) for gone in combinations(range(blocks), changed)]


def leaks(docs: DataFrame, tests: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", masks: tuple[str, ...] = MASKS) -> DataFrame:
    """Overlaps of documents with test items: (row, doc_id, item_id, first, last, matched), words from 0, end included.

    Masks are laid over every run of words of documents and items; equal hashes are hits. Around a hit, both texts are
    compared word by word at the same distance, up to ``AROUND`` words either way. It stands if some
    ``VERIFIED_WORDS`` words in a row (all, where the texts end sooner) agree in at least ``MIN_PERCENT`` percent.
    Overlaps with such items have at least as many words as a mask, and none that would stand is without a hit. An item
    with fewer words than a mask, but at least five, must occur whole, with as many words in agreement; shorter items
    are ignored. Items of equal words count as one, named by the smallest id.

    The seeds of the items are broadcast in blocks of bounded size; documents stay where they are.
    """
    span = len(masks[0])
    items = tests.select(F.col(f"`{item_col}`").alias("item_id"), word_hashes(F.col(f"`{item_text_col}`")).alias("hashes"))
    items = stored(items.groupBy("hashes").agg(F.min("item_id").alias("item_id")).filter(F.size("hashes") >= SHORTEST_ITEM), "items")
    n = F.size("hashes")
    short = [r.n for r in items.filter(n < span).select(n.alias("n")).distinct().collect()]  # lengths 5 to 11
    source = keyed(docs, doc_id=id_col, hashes=word_hashes(F.col(f"`{text_col}`")))
    found = None
    for chosen in [list(masks), *map(short_masks, sorted(short))]:
        width = len(chosen[0])
        mine = items.filter(n >= span) if width == span else items.filter(n == width)
        table = seeds(mine.withColumnRenamed("hashes", "of_item").withColumn("hashes", F.col("of_item")), chosen)
        before = F.least(F.col("at"), F.lit(AROUND))
        after = F.least(F.size("of_item") - F.col("at") - width, F.lit(AROUND))
        table = stored(
            table.select(
                "key", "item_id", before.alias("before"), after.alias("after"),
                F.slice("of_item", F.col("at") - before + 1, before + width + after).alias("near"),
            ),
            "seeds",
        )
        blocks = -(-table.count() // BLOCK_ROWS)
        for block in range(blocks):
            part = table.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block) if blocks > 1 else table
            hits = _verified(seeds(source, chosen).join(F.broadcast(part), "key"), width)
            found = hits if found is None else found.union(hits)
    if found is None:
        found = _verified(seeds(source, list(masks)).withColumns(
            {"item_id": F.lit(None).cast(items.schema["item_id"].dataType), "before": F.lit(0), "after": F.lit(0),
             "near": F.col("hashes")}).filter("false"), span)
    return found.groupBy("row", "doc_id", "item_id").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("matched").alias("matched")
    )


def _verified(hits: DataFrame, width: int) -> DataFrame:
    """Hits whose surroundings agree: (row, doc_id, item_id, first, last, matched)."""
    before = F.least(F.col("before"), F.col("at"))
    after = F.least(F.col("after"), F.size("hashes") - F.col("at") - width)
    zone = before + width + after
    ours = F.slice("hashes", F.col("at") - before + 1, zone)
    theirs = F.slice("near", F.col("before") - before + 1, zone)
    # Only these few words of a document leave the stage that holds all of its words.
    near = hits.select(
        "row", "doc_id", "item_id", (F.col("at") - before).alias("from"), ours.alias("ours"), theirs.alias("theirs")
    )
    # The array of one element keeps the filter below from becoming a condition of the join, where it would be
    # worked out with the whole array at hand.
    same = F.zip_with("ours", "theirs", lambda a, b: (a == b).cast("int"))
    looked = near.select("row", "doc_id", "item_id", "from", F.explode(F.array(same)).alias("same"))
    window = F.least(F.size("same"), F.lit(VERIFIED_WORDS))
    sums = F.transform(
        F.sequence(F.lit(1), F.size("same") - window + 1),
        lambda s: F.aggregate(F.slice("same", s, window), F.lit(0), lambda a, b: a + b),
    )
    looked = looked.withColumns({"window": window, "matched": F.array_max(sums)})
    first, last = F.array_position("same", 1), F.size("same") - F.array_position(F.reverse("same"), 1)
    return looked.filter(F.col("matched") * 100 >= F.col("window") * MIN_PERCENT).select(
        "row", "doc_id", "item_id", (F.col("from") + first - 1).alias("first"), (F.col("from") + last).alias("last"), "matched"
    )


def decontaminate(docs: DataFrame, tests: DataFrame, **options) -> DataFrame:
    """One row for each document: (row, doc_id, contaminated, n_items, item_id, first_word, last_word, matched).

    ``n_items`` test items overlap (see ``leaks``), ``item_id`` is the smallest, the words those of the first and last
    overlap, ``matched`` the most words that agreed within a verified run. Clean documents have 0 items and nulls.

    A null or empty text, and any against an empty table of tests, is clean. Null ids and repeated rows are rows of
    their own; null ids of items are kept as null. Other columns are not looked at.
    """
    found = (
        leaks(docs, tests, **options)
        .groupBy("row")
        .agg(
            F.count(F.lit(1)).alias("n_items"), F.min("item_id").alias("item_id"), F.min("first").alias("first_word"),
            F.max("last").alias("last_word"), F.max("matched").alias("matched"),
        )
    )
    ids = keyed(docs, doc_id=options.get("id_col", "doc_id"))
    return ids.join(found, "row", "left").select(
        "row", "doc_id", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), "item_id", "first_word", "last_word", "matched",
    )
