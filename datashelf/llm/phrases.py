"""Phrases whose words occur together more than by chance, counted by prefix-free parsing."""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from datashelf.llm.common import stored

ENDS = b".,;:!?\x0A\x0B\x0C\x0D"
LOWERED = bytes.maketrans(string.ascii_uppercase.encode() + ENDS, string.ascii_lowercase.encode() + b"\n" * len(ENDS))
TRIGGER_EVERY = 16  # a word in so many, on average, ends a chunk
BLOCK_BYTES = 4 << 20  # of the dictionary, counted at a time in a task
ROWS_OUT = 50_000
CACHED_WORDS = 300_000
WORDS_AT_A_TIME = 1_000_000
WORDS_AT_ONCE = 20_000  # of a language, put into its counts in one step
TEXTS_AT_A_TIME = 250
FILTER_BITS = 1 << 27  # 16 MB, whatever the number of phrases: more phrases than bits only mean that fewer are ruled out early
UNKNOWN = "und"
TOTAL = ""  # stands for all words of a language among its phrases
EXACT = "decimal(15,0)"


def chunks(words: list[bytes], overlap: int, every: int) -> Iterator[tuple[bytes, bool]]:
    """The parse of a piece: (chunk, whether the piece ends with it).

    A chunk ends with a window of ``overlap`` words of which the first has a hash of zero modulo ``every``, and the next one
    begins with the same window. So words alone decide where chunks end, and equal runs of words are parsed alike wherever
    they stand.
    """
    start = 0
    for i, word in enumerate(words[1 : len(words) - overlap] if len(words) > overlap else (), 1):
        if crc32(word) % every == 0:
            yield b" ".join(words[start : i + overlap]), False
            start = i
    yield b" ".join(words[start:]), True


def pieces(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """(language, words) of each piece of each text."""
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        for piece in text.encode("utf-8", "surrogatepass").translate(LOWERED).split(b"\n") if text else ():
            words = piece.split()  # at spaces and tabs: other white space has ended the piece
            if words:
                yield lang, words


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f) of single words, and of all of a language's words together."""

    def told() -> pa.RecordBatch:
        langs = [lang for lang, of in counted.items() for _ in of]
        phrases, sums = ([x for of in counted.values() for x in each(of)] for each in (dict.keys, dict.values))
        return pa.record_batch(
            [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(sums, pa.int64())], names=["lang", "phrase", "f"]
        )

    for batch in batches:
        counted: dict[str, Counter] = {}
        held: dict[str, list[bytes]] = {}
        size = 0

        def put(lang: str) -> None:
            words, of = held.pop(lang), counted.setdefault(lang, Counter())
            of.update(words)
            of[TOTAL.encode()] += len(words)

        for lang, words in pieces(batch):
            held.setdefault(lang, []).extend(words)
            size += len(words)
            if len(held[lang]) >= WORDS_AT_ONCE:
                put(lang)
            if size >= WORDS_AT_A_TIME:
                for x in list(held):
                    put(x)
                yield told()
                counted, size = {}, 0
        for x in list(held):
            put(x)
        yield told()


def word_code(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def phrase_codes(langs: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of phrases from those of their language and of their words, in order."""
    codes = langs
    with np.errstate(over="ignore"):
        for w in words:
            codes = (codes ^ (codes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + w
        codes = (codes ^ (codes >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return codes ^ (codes >> np.uint64(29))


def word_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [
            np.array([word_code(x.encode("utf-8", "surrogatepass")) for x in batch.column(c).to_pylist()], np.uint64)
            for c in ("lang", "phrase")
        ]
        yield pa.record_batch([pa.array(phrase_codes(codes[0], codes[1:]).view(np.int64))], names=["code"])


class Filter:
    """A bit for each of a fixed number of classes of hashes: set if one of some phrases is in it."""

    def __init__(self, codes: DataFrame, bits: int):
        at = F.pmod("code", F.lit(bits)) + 1  # Spark's bitmaps count from 1
        rows = codes.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))
        size = 4096  # bytes of one of Spark's bitmaps
        held = np.zeros(max(bits // 8, size), np.uint8)
        for r in rows.collect():  # as many bytes as the filter has
            held[(r["bucket"] - 1) * size : r["bucket"] * size] = np.frombuffer(r["bitmap"], np.uint8)
        self.bits, self.held = bits, codes.sparkSession.sparkContext.broadcast(held)

    def holds(self, codes: np.ndarray) -> np.ndarray:
        """For each hash whether a phrase may have it."""
        at = codes.view(np.int64) % self.bits
        return (self.held.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def parser(frequent: Filter, overlap: int, every: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of runs of frequent words. The key says language and kind of chunk as well: one string to be shuffled."""
        known: dict[str, dict[bytes, bool]] = {}
        parsed: Counter = Counter()

        def learn(held: list[tuple[str, list[bytes]]]) -> None:
            """Ask for all words that are new, at once."""
            if sum(map(len, known.values())) > CACHED_WORDS:
                known.clear()
            for lang in {lang for lang, _ in held}:
                of = known.setdefault(lang, {})
                new = list(set().union(*[words for x, words in held if x == lang]).difference(of))
                code = np.full(len(new), word_code(lang.encode("utf-8", "surrogatepass")), np.uint64)
                codes = phrase_codes(code, [np.fromiter(map(word_code, new), np.uint64, len(new))])
                of.update(zip(new, frequent.holds(codes).tolist()))

        def told() -> pa.RecordBatch:
            out = [pa.array(list(parsed.keys()), pa.string()), pa.array(list(parsed.values()), pa.int64())]
            parsed.clear()
            return pa.record_batch(out, names=["key", "f"])

        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS_AT_A_TIME):
                held = list(pieces(batch.slice(begin, TEXTS_AT_A_TIME)))
                learn(held)
                tails = {lang: b"\t" + lang.encode("utf-8", "surrogatepass") for lang in known}
                found: list[bytes] = []
                for lang, words in held:
                    tail, good, start = tails[lang], list(map(known[lang].__getitem__, words)), 0
                    ends = [i for i, x in enumerate(good) if not x] if False in good else []
                    for end in [*ends, len(words)]:
                        if 1 < end - start <= overlap + 1:  # too short to be cut
                            found.append(b"1" + b" ".join(words[start:end]) + tail)
                        elif end - start > 1:
                            for chunk, last in chunks(words[start:end], overlap, every):
                                found.append((b"1" if last else b"0") + chunk + tail)
                        start = end + 1
                    if len(found) >= ROWS_OUT:
                        parsed.update(found)
                        found = []
                        if len(parsed) >= ROWS_OUT:
                            yield told()
                parsed.update(found)
                if len(parsed) >= ROWS_OUT:
                    yield told()
        yield told()

    return parse


class Block:
    """Chunks of the dictionary, a row for each position of a word in them."""

    def __init__(self, block: pa.Table, overlap: int):
        langs = block.column("lang").combine_chunks().dictionary_encode()
        split = pc.split_pattern(block.column("chunk").combine_chunks(), " ")
        coded = split.flatten().dictionary_encode()
        self.ids, self.words, self.langs = coded.indices.to_numpy().astype(np.int64), coded.dictionary, langs.dictionary
        sizes = np.diff(split.offsets.to_numpy())
        self.weights = np.repeat(block.column("f").to_numpy(), sizes)
        self.lang = np.repeat(langs.indices.to_numpy().astype(np.int64), sizes)
        self.after = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(self.ids))
        # What begins in the words that a chunk shares with the next one is the next one's.
        self.owned = np.repeat(block.column("last").to_numpy(), sizes) | (self.after > overlap)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which two words begin, and the hashes of these."""
        codes = [np.array([word_code(x.encode("utf-8", "surrogatepass")) for x in of.to_pylist()], np.uint64) for of in (self.langs, self.words)]
        at = np.flatnonzero(self.after >= 2)
        return at, phrase_codes(codes[0][self.lang[at]], [codes[1][self.ids[at + i]] for i in (0, 1)])


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, where each distinct one starts in it, the sums of their weights, and every key's number."""
    order = np.argsort(keys, kind="stable")
    fresh = np.concatenate([[True], np.diff(keys[order]) != 0])
    starts = np.flatnonzero(fresh)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return order, starts, np.add.reduceat(weights[order], starts), number


def count_pairs(block: Block) -> Iterator[pa.RecordBatch]:
    """(code, f): hashes of two words in a row and their counts over the whole parse."""
    at, codes = block.pairs()
    own = block.owned[at]
    if own.any():
        order, starts, sums, _ = _sums(codes[own], block.weights[at[own]])
        yield pa.record_batch([pa.array(codes[own][order[starts]].view(np.int64)), pa.array(sums)], names=["code", "f"])


def phrase_counter(frequent: Filter, longest: int):
    def count(block: Block) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, f): phrases whose pairs of neighbouring words may all be frequent, counted over the whole parse."""
        at, codes = block.pairs()
        good = np.zeros(len(block.ids) + longest, bool)
        good[at] = frequent.holds(codes)
        number, whole = block.lang * len(block.words) + block.ids, np.ones(len(block.ids), bool)
        for size in range(2, longest + 1):
            whole &= good[size - 2 : size - 2 + len(whole)]
            at = np.flatnonzero(whole & block.owned & (block.after >= size))
            if not len(at):
                return
            order, starts, sums, found = _sums(number[at] * len(block.words) + block.ids[at + size - 1], block.weights[at])
            number = np.zeros(len(block.ids), np.int64)  # of the run that begins at each position
            number[at] = found
            first = at[order[starts]]
            runs = [block.words.take(pa.array(block.ids[first + i])) for i in range(size)]
            yield pa.record_batch(
                [block.langs.take(pa.array(block.lang[first])), pc.binary_join_element_wise(*runs, " "), pa.array(sums)],
                names=["lang", "phrase", "f"],
            )

    return count


def in_blocks(count, overlap: int):
    """``count`` over the dictionary, some megabytes at a time."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                held.append(batch.slice(start, ROWS_OUT))
                size += held[-1].nbytes
                if size >= BLOCK_BYTES:
                    yield from count(Block(pa.Table.from_batches(held), overlap))
                    held, size = [], 0
        if size:
            yield from count(Block(pa.Table.from_batches(held), overlap))

    return counted


def phrase_counts(
    docs: DataFrame, *, lang_col: str, text_col: str, longest: int, min_count: int, every: int = TRIGGER_EVERY, bits: int = FILTER_BITS
) -> DataFrame:
    """(lang, phrase, f): runs of up to ``longest`` words within pieces that occur ``min_count`` times, and how often they do;
    the empty phrase stands for all words.

    Words are counted first; no phrase with a rare word is frequent, so texts are parsed into overlapping chunks between
    rare words. Equal chunks become one of the dictionary, with its frequency, in an aggregate with partial results. Phrases
    are counted once in each distinct chunk, times its frequency: first pairs of words by their hash, then, as phrases, those
    all of whose pairs may be frequent. Hashes only rule out early: what is counted as a phrase decides.
    """
    source = docs.select(
        F.coalesce(F.col(f"`{lang_col}`"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text_col}`").alias("text")
    )
    overlap, schema = longest - 1, "lang string, phrase string, f long"
    words = source.mapInArrow(count_words, schema).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    words = stored(words.filter((F.col("phrase") == TOTAL) | (F.col("f") >= min_count)), "words")
    frequent = Filter(words.filter(F.col("phrase") != TOTAL).mapInArrow(word_bits, "code long"), bits)

    keys = source.mapInArrow(parser(frequent, overlap, every), "key string, f long").groupBy("key").agg(F.sum("f").alias("f"))
    tab = F.instr("key", "\t")
    dictionary = stored(
        keys.select(
            F.substring("key", F.lit(2), tab - 2).alias("chunk"), F.substring("key", tab + 1, F.length("key")).alias("lang"),
            F.startswith("key", F.lit("1")).alias("last"), "f",
        ),
        "dictionary",
    )
    pairs = dictionary.mapInArrow(in_blocks(count_pairs, overlap), "code long, f long").groupBy("code").agg(F.sum("f").alias("f"))
    frequent = Filter(pairs.filter(F.col("f") >= min_count).select("code"), bits)
    phrases = dictionary.mapInArrow(in_blocks(phrase_counter(frequent, longest), overlap), schema)
    phrases = phrases.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    return stored(words.union(phrases), "phrases")


def _words_of(phrase: Column) -> Column:
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def collocations(
    docs: DataFrame,
    *,
    lang_col: str = "lang",
    text_col: str = "text",
    longest: int = 3,
    min_count: int = 10,
    contained_percent: int = 50,
    top: int | None = 2000,
) -> DataFrame:
    """Each language's strongest phrases of 2 to ``longest`` words: (lang, rank, phrase, a, l, r, n, score).

    A phrase of a occurrences cut in two parts of l and r has a score of a million times a * a / (l * r), floored; its
    weakest cut counts, the first of equals. Phrases contained in a longer one that takes ``contained_percent`` of their
    occurrences go. ``top`` is the length of the report for each language, None for all.

    Integers are exact up to counts of 10**15. A null language is ``und``; null and empty texts have no words, repeated rows
    count as often as they stand. An empty table gives no rows. Other columns are not looked at.
    """
    counts = phrase_counts(docs, lang_col=lang_col, text_col=text_col, longest=longest, min_count=min_count)
    held = counts.filter(F.col("phrase") != TOTAL).withColumn("size", _words_of(F.col("phrase")))
    found = held.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), "size")

    cut = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - size)").alias("right"),
    )
    part = held.filter(F.col("size") < longest)
    lefts = part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr(
        f"cast(1000000 as decimal(7,0)) * (cast(a as {EXACT}) * cast(a as {EXACT})) div (cast(l as {EXACT}) * cast(r as {EXACT}))"
    )
    weakest = (
        cut.join(lefts, ["lang", "left"])
        .join(rights, ["lang", "right"])
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r")).alias("w"))
        .select("lang", "phrase", "w.*")
    )
    inside = (
        found.filter("size > 2")
        .withColumn("of", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .withColumn("start", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("of"))))
        .withColumn("part", F.array_join(F.slice(F.split("phrase", " "), F.col("start") + 1, F.col("of")), " "))
        .groupBy("lang", F.col("part").alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    standing = weakest.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < contained_percent * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = standing.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        best = best.filter(F.col("rank") <= top)  # every task keeps its own first ones before they meet
    totals = counts.filter(F.col("phrase") == TOTAL).select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long"))
