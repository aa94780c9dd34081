"""Language identification of words in code-switched text by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datashelf.llm.common import keyed

LETTERS = re.compile(r"[^\W\d_]+")
TABLE_BITS = 17
NGRAMS = (1, 2, 3, 4)  # over ^word$: those that hold ^ or $ are the word's affixes
LEXICON_COUNT, LEXICON_SHARE = 4, 0.9
CHUNK = 32
CACHED_WORDS = 200_000
BATCH_CHARS = 2_000_000
SLICE_ROWS = 250  # texts whose words are held at a time
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case. Signs of numbers such as a half or a circled one are no letters."""
    found = LETTERS.findall(text.lower())
    if found and not "".join(found).isalpha():
        found = [w for f in found for w in "".join([c if c.isalpha() else " " for c in f]).split()]
    return found


@dataclass
class Crf:
    """Weights of hashed n-grams and lexicon membership for each label, and transitions."""

    labels: list[str]
    lexicon: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = None  # (2 ** TABLE_BITS + labels, labels)
    transitions: np.ndarray = None  # (labels, labels), from row to column


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in a row, and where each word's begin. Every word has some."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    found, owner = [], []
    hashed = np.zeros(len(codes), np.uint64)
    for n in NGRAMS:
        span = len(codes) - n + 1
        if span <= 0:
            break
        hashed = hashed[:span] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
        inside = word[:span] == word[n - 1 :]
        x = hashed[inside]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append((x >> np.uint64(64 - TABLE_BITS)).astype(np.int64))
        owner.append(word[:span][inside])
    listed = [(i, lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    if listed:
        owner.append(np.array([i for i, _ in listed]))
        found.append(np.array([k for _, k in listed]) + (1 << TABLE_BITS))
    owner, found = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return found[order], np.searchsorted(owner[order], np.arange(len(words)))


def emissions(words: list[str], model: Crf) -> np.ndarray:
    """Score of each label for each word."""
    out = np.zeros((len(words), len(model.labels)))
    for at in range(0, len(words), 20_000):
        found, starts = word_features(words[at : at + 20_000], model.lexicon)
        out[at : at + 20_000] = np.add.reduceat(model.weights[found], starts, axis=0)
    return out


def train(texts: list[tuple[str, str]], *, length: int = 64, passes: int = 40, seed: int = 0) -> Crf:
    """Fit by gradient ascent on the likelihood of label sequences.

    Training sequences are runs of 8 to ``length`` words, each of one labelled text, laid end to end in random order
    and cut every ``length`` words: so they switch languages within, and transitions can be learned.
    """
    rng = np.random.default_rng(seed)
    model = Crf(sorted({label for _, label in texts}))
    k = len(model.labels)
    number = {label: i for i, label in enumerate(model.labels)}
    runs, counts = [], Counter()
    for text, label in texts:
        words = words_of(text)
        at = 0
        while at < len(words):
            size = int(rng.integers(8, length + 1))
            runs.append((words[at : at + size], number[label]))
            at += size
        counts.update((w, number[label]) for w in words)
    model.weights = np.zeros(((1 << TABLE_BITS) + k, k))
    model.transitions = np.zeros((k, k))
    if not runs:
        return model
    totals = Counter()
    for (w, _), n in counts.items():
        totals[w] += n
    model.lexicon = {
        w: i for (w, i), n in counts.items() if n >= LEXICON_COUNT and n >= LEXICON_SHARE * totals[w]
    }
    order = rng.permutation(len(runs))
    words = [w for i in order for w in runs[i][0]]
    gold = np.concatenate([np.full(len(runs[i][0]), runs[i][1]) for i in order])
    length = min(length, len(words))
    rows = len(words) // length
    distinct: dict[str, int] = {}
    ids = np.array([distinct.setdefault(w, len(distinct)) for w in words[: rows * length]])
    gold = gold[: rows * length].reshape(rows, length)
    found, starts = word_features(list(distinct), model.lexicon)
    owner = np.repeat(np.arange(len(distinct)), np.diff([*starts, len(found)]))
    truth = np.eye(k)[gold]
    seen = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
    parameters = [model.weights, model.transitions]
    first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    for step in range(1, passes + 1):
        scores = np.add.reduceat(model.weights[found], starts, axis=0)[ids].reshape(rows, length, k)
        marginal, pairs = _expectations(scores, model.transitions)
        error = (truth - marginal).reshape(-1, k)
        by_word = np.stack([np.bincount(ids, error[:, j], len(distinct)) for j in range(k)], 1)
        gradient = np.stack([np.bincount(found, by_word[owner, j], len(model.weights)) for j in range(k)], 1)
        moved = seen + _into(truth[:, 0], np.exp(model.transitions)) - pairs
        for p, g, a, b in zip(parameters, (gradient - model.weights, moved), first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p += 0.1 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    return model


def _expectations(scores: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities and expected label pairs of equally long sequences, by forward-backward."""
    rows, length, k = scores.shape
    e, t = np.exp(scores - scores.max(2, keepdims=True)), np.exp(transitions)
    ahead, behind = np.empty_like(e), np.empty_like(e)
    v = np.ones((rows, k))
    for s in range(length):
        v = (v @ t) * e[:, s]
        v /= v.sum(1, keepdims=True)
        ahead[:, s] = v
    v = np.ones((rows, k))
    for s in reversed(range(length)):
        behind[:, s] = v
        v = (v * e[:, s]) @ t.T
        v /= v.sum(1, keepdims=True)
    marginal = ahead * behind
    marginal /= marginal.sum(2, keepdims=True)
    right = e[:, 1:] * behind[:, 1:]
    norm = np.einsum("nti,ij,ntj->nt", ahead[:, :-1], t, right)
    pairs = np.einsum("nti,ntj->ij", ahead[:, :-1] / norm[:, :, None], right) * t
    return marginal, pairs + _into(marginal[:, 0], t)


def _into(first: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Expected pairs of what stands before a sequence, which may be any label, and its first label."""
    return t / t.sum(0) * first.sum(0)


def label_sums(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """For each text, the sum over its words of the label probabilities (forward-backward over the whole text).

    ``scores`` holds the words of all texts in a row, ``sizes`` how many each has (none has 0). Texts are cut into
    chunks. The product of each chunk's matrices gives the vectors at all chunk borders, and from these the words
    within all chunks follow at once: the same numbers as one pass from word to word, in steps of many texts.
    """
    k = scores.shape[1]
    t = np.exp(transitions)
    chunks = -(-sizes // CHUNK)
    first_chunk = np.concatenate([[0], np.cumsum(chunks)[:-1]])
    first_word = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(text)) - first_word[text]
    e = np.ones((int(chunks.sum()), CHUNK, k))
    used = np.zeros(e.shape[:2], bool)
    at = (first_chunk[text] + place // CHUNK, place % CHUNK)
    e[at] = np.exp(scores - scores.max(1, keepdims=True))
    used[at] = True

    product = np.broadcast_to(np.eye(k), (len(e), k, k)).copy()
    for s in range(CHUNK):
        step = (product.reshape(-1, k) @ t).reshape(-1, k, k) * e[:, s, None, :]
        step /= step.max((1, 2), keepdims=True)
        product = np.where(used[:, s, None, None], step, product)
    ahead, behind = np.ones((len(e), k)), np.ones((len(e), k))
    order = np.argsort(-chunks, kind="stable")
    ranked = -chunks[order]
    for j in range(1, int(chunks.max())):
        active = order[: np.searchsorted(ranked, -j)]
        c = first_chunk[active] + j
        v = np.einsum("ni,nij->nj", ahead[c - 1], product[c - 1])
        ahead[c] = v / v.sum(1, keepdims=True)
        c = first_chunk[active] + chunks[active] - 1 - j
        v = np.einsum("nij,nj->ni", product[c + 1], behind[c + 1])
        behind[c] = v / v.sum(1, keepdims=True)

    within = np.empty((CHUNK, len(e), k))
    v = ahead
    for s in range(CHUNK):
        step = (v @ t) * e[:, s]
        v = np.where(used[:, s, None], step / step.sum(1, keepdims=True), v)
        within[s] = v
    sums, v = np.zeros((len(e), k)), behind
    for s in reversed(range(CHUNK)):
        marginal = within[s] * v
        sums += np.where(used[:, s, None], marginal / marginal.sum(1, keepdims=True), 0)
        step = (v * e[:, s]) @ t.T
        v = np.where(used[:, s, None], step / step.sum(1, keepdims=True), v)
    return np.add.reduceat(sums, first_chunk, axis=0)


def labeller(model: Crf):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        scores = np.empty((0, len(model.labels)))
        for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            texts = [words_of(t) if t else [] for t in batch.column("text").to_pylist()]
            names, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
            at = 0
            while at < len(texts) and model.labels:
                group, chars = [], 0
                while at < len(texts) and (not group or chars < BATCH_CHARS):
                    if texts[at]:
                        group.append(at)
                        chars += 6 * len(texts[at])
                    at += 1
                if not group:
                    break
                if len(known) > CACHED_WORDS:
                    known, scores = {}, scores[:0]
                before = len(known)
                ids = np.array([known.setdefault(w, len(known)) for i in group for w in texts[i]])
                if len(known) > before:
                    with np.errstate(over="ignore"):
                        scores = np.concatenate([scores, emissions(list(known)[before:], model)])
                sizes = np.array([len(texts[i]) for i in group])
                share = label_sums(scores[ids], sizes, model.transitions) / sizes[:, None]
                for i, best, p in zip(group, share.argmax(1), share.max(1)):
                    names[i], sure[i] = model.labels[best], min(1.0, max(0.0, float(p)))
            columns = [batch.column(c) for c in batch.schema.names if c != "text"]
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch([*columns, pa.array(names, pa.string()), pa.array(sure, pa.float64())],
                                  names=[*kept, "lang_pred", "score"])

    return label


def fit(docs: DataFrame, *, train_docs: int = 150, train_chars: int = 1500, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Crf:
    """Fit on a bounded sample: about ``train_docs`` documents of each language, ``train_chars`` characters of each.

    Only documents with an id, a text and a language, and crc32(id as text) mod 4 other than 2. The sample goes by a
    hash of the id, so the counts by language are all that is gathered before it.
    """
    usable = docs.select(
        F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").alias("lang"),
    ).filter("id is not null and text is not null and lang is not null").filter(F.crc32(F.col("id").cast("binary")) % 4 != 2)
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return Crf([])
    spread = 1 << 30
    bounds = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(spread, spread * train_docs // n + 1))])
    chosen = usable.filter(F.pmod(F.xxhash64("id"), F.lit(spread)) < bounds[F.col("lang")])
    rows = chosen.select("id", F.substring("text", 1, train_chars).alias("text"), "lang").collect()
    with np.errstate(over="ignore"):
        return train([(r.text, r.lang) for r in sorted(rows)])


def predict_language(docs: DataFrame, model: Crf | None = None, *, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The language of every whole text: (doc_id, held_out, lang_pred, score).

    The CRF gives each word (run of letters) label probabilities that depend on the whole text; the language is the
    one with the largest sum, the score its mean probability. Prediction sees nothing but the text. A text that is null
    or has no letter is ``und`` with score 0, as is every text if no row is labelled. A null id is held out. Repeated
    rows are rows of their own; an empty table gives no rows.
    """
    model = fit(docs, id_col=id_col, text_col=text_col) if model is None else model
    held_out = F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(True))
    source = keyed(docs, doc_id=id_col, held_out=held_out, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        labeller(model), f"row long, doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
