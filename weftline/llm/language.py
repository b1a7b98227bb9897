"""Language identification by a linear-chain conditional random field over the words of a text.

Every word has a label.  Its features are its prefixes and suffixes, its letter n-grams and, where the word
is in the lexicon of the training texts, the word itself; neighbouring labels are tied by learned
transitions, so that a text can change its language and a word that several languages share follows its
neighbours.  Forward-backward gives the probability of each label for each word.

The model is fitted on the driver on a bounded sample of labelled documents: at most ``per_language`` whole
documents of at most ``max_chars`` characters for each language, drawn by a hash.  Half of the training
sequences are cut from one document, half are joined from pieces of several, because a corpus labelled per
document shows no change of language otherwise.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import binary_texts, grouped, map_in_arrow, without_text

BUCKETS = 1 << 16
STEP = 256  # words that are computed one after the other; longer texts are cut and joined exactly
BATCH_BYTES = 1_000_000
MEMO_WORDS = 250_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"


def core(word: str) -> str:
    """A word as the features see it: lower-case letters only, inner signs kept."""
    word = word.lower()
    if word.isalpha():
        return word
    start, end = 0, len(word)
    while start < end and not word[start].isalpha():
        start += 1
    while end > start and not word[end - 1].isalpha():
        end -= 1
    return word[start:end]


def features(cores: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, word each belongs to) for words that are not empty: lexicon entry, affixes of up to four
    letters, and 2- and 3-grams, hashed into ``BUCKETS``."""
    letters = np.frombuffer("".join(cores).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, cores), np.int64, len(cores))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    word = np.repeat(np.arange(len(cores)), lengths)
    left = ends[word] - np.arange(len(letters))  # letters from here to the end of the word
    numbers, owners = [], []

    def add(kind: int, first: np.ndarray, n: int) -> None:
        value = np.full(len(first), kind + 1, np.uint64)
        for k in range(n):
            value = value * MULTIPLIER + letters[first + k]
        value = (value ^ (value >> np.uint64(31))) * MULTIPLIER
        numbers.append((value >> np.uint64(40)).astype(np.int64) % BUCKETS + len(lexicon))
        owners.append(word[first])

    for n in (2, 3):
        add(0, np.flatnonzero(left >= n), n)
    for n in (1, 2, 3, 4):
        long = lengths >= n
        add(1, starts[long], n)
        add(2, ends[long] - n, n)
    known = np.fromiter((lexicon.get(c, -1) for c in cores), np.int64, len(cores))
    numbers.append(known[known >= 0])
    owners.append(np.flatnonzero(known >= 0))
    return np.concatenate(numbers), np.concatenate(owners)


def step_messages(potential, starts, counts, transition, entry):
    """Forward messages of segments, all at once, step by step.

    ``potential`` holds the words of all segments, ``starts`` and ``counts`` (descending) where they lie.
    ``entry`` holds each segment's message before its first word, of any leading shape.
    """
    out = np.empty((len(potential), *entry.shape[1:]))
    state = entry
    for t in range(counts[0] if len(counts) else 0):
        n = int(np.searchsorted(-counts, -t, "left"))
        rows = starts[:n] + t
        word = potential[rows]
        state = (state[:n] @ transition) * (word if state.ndim == 2 else word[:, None, :])
        state = state / state.sum(axis=tuple(range(1, state.ndim)), keepdims=True)
        out[rows] = state
    return out


def marginals(potential: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Label probabilities of each word; ``lengths`` are the words of each text in ``potential``.

    Texts of more than ``STEP`` words are cut.  The product of the steps of a segment is a small matrix, so
    the messages that enter the segments follow from one pass over these matrices, without loss.
    """
    n_labels = potential.shape[1]
    if not len(potential):
        return np.empty((0, n_labels))
    per_text = -(-lengths // STEP)
    text = np.repeat(np.arange(len(lengths)), per_text)
    place = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    starts = np.repeat(np.cumsum(lengths) - lengths, per_text) + place * STEP
    counts = np.minimum(STEP, np.repeat(lengths, per_text) - place * STEP)
    before = np.full((len(text), n_labels), 1.0 / n_labels)
    after = np.ones((len(text), n_labels))
    long = np.flatnonzero(np.repeat(per_text, per_text) > 1)
    if len(long):
        order = long[np.argsort(-counts[long], kind="stable")]
        unit = np.broadcast_to(np.eye(n_labels), (len(order), n_labels, n_labels))
        through = step_messages(potential, starts[order], counts[order], transition, unit)
        product = {k: through[starts[k] + counts[k] - 1] for k in order}
        for k in long:
            if place[k]:
                before[k] = before[k - 1] @ product[k - 1]
                before[k] /= before[k].sum()
        for k in long[::-1]:
            if place[k] < per_text[text[k]] - 1:
                after[k] = product[k + 1] @ after[k + 1]
                after[k] /= after[k].sum()
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    alpha = step_messages(potential, starts, counts, transition, before[order])
    beta = np.empty_like(alpha)
    state = after[order]
    last = starts + counts - 1
    beta[last] = state
    for t in range(1, counts[0]):
        n = int(np.searchsorted(-counts, -t, "left"))
        rows = last[:n] - t
        state = (potential[rows + 1] * state[:n]) @ transition.T
        state = state / state.sum(axis=1, keepdims=True)
        beta[rows] = state
    product = alpha * beta
    return product / product.sum(axis=1, keepdims=True)


@dataclass
class Model:
    """Languages, lexicon, feature weights (feature, language) and transitions (from, to), not logarithmic."""

    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray
    transition: np.ndarray

    def scores(self, cores: list[str]) -> np.ndarray:
        """Emission scores of words, the log of their potentials; words without letters say nothing."""
        out = np.zeros((len(cores), len(self.languages)))
        real = np.flatnonzero([bool(c) for c in cores])
        if len(real):
            numbers, owners = features([cores[i] for i in real], self.lexicon)
            for k in range(len(self.languages)):
                out[real, k] = np.bincount(owners, self.weights[numbers, k], len(real))
        return out


class _Memo:
    """Scores of the words seen so far; emptied when it holds ``MEMO_WORDS``."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self):
        self.rows: dict[bytes, int] = {}
        self.scores = np.empty((0, len(self.model.languages)))
        self.letters = np.empty(0, bool)

    def rows_of(self, words: list[bytes]) -> np.ndarray:
        new = [word for word in set(words) if word not in self.rows]
        if len(self.rows) + len(new) > MEMO_WORDS:
            self.clear()
            new = list(set(words))
        if new:
            cores = [core(word.decode("utf-8", "replace")) for word in new]
            first = len(self.rows)
            self.rows.update(zip(new, range(first, first + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, self.model.scores(cores)])
            self.letters = np.concatenate([self.letters, np.array([bool(c) for c in cores])])
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))


def _label(memo: _Memo, texts: list[bytes], spans: bool) -> list[tuple]:
    """(language, score, spans) for texts that are worked on together."""
    model = memo.model
    split = [text.split() for text in texts]
    rows = memo.rows_of([word for words in split for word in words])
    score, letters = memo.scores[rows], memo.letters[rows]
    potential = np.exp(score - score.max(axis=1, keepdims=True, initial=-np.inf)) + 1e-12
    lengths = np.array([len(words) for words in split], np.int64)
    chances = marginals(potential, lengths, model.transition)
    out = []
    for start, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
        own = chances[start : start + n]
        voting = letters[start : start + n]
        if not voting.any():
            out.append((UNKNOWN, 0.0, []))
            continue
        mean = own[voting].mean(axis=0)
        best = int(mean.argmax())
        runs = []
        if spans:
            label = own.argmax(axis=1)
            edges = np.flatnonzero(np.diff(label)) + 1
            for a, b in zip(np.r_[0, edges], np.r_[edges, n], strict=True):
                runs.append({"first": int(a), "end": int(b), "lang": model.languages[label[a]]})
        out.append((model.languages[best], float(min(1.0, mean[best])), runs))
    return out


def training_sample(
    docs: DataFrame, per_language: int = 150, max_chars: int = 50_000, seed: int = 42
) -> dict[str, list[str]]:
    """Texts by language: the documents with the smallest hashes of id and length, in the order of the hash.

    Only ids and lengths are ranked.  The chosen ones, ``per_language`` of each language, are broadcast, so that no
    text moves but theirs; one text for each comes to the driver, however often its row repeats.  Of a text above
    ``max_chars`` the sample takes that many characters from a seeded place on.
    """
    length = F.length("text")
    draw = F.xxhash64(F.lit(seed), "doc_id", length)
    keyed = docs.select("lang", "text", draw.alias("draw")).filter(F.col("lang").isNotNull() & (length >= 1))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    ranked = keyed.select("lang", "draw").distinct().withColumn("rank", rank)
    chosen = F.broadcast(ranked.filter(F.col("rank") <= per_language).drop("rank"))
    place = F.pmod(F.col("draw"), F.greatest(length - max_chars, F.lit(0)) + 1).cast("int") + 1
    piece = F.substring("text", place, F.lit(max_chars))
    drawn = keyed.join(chosen, ["lang", "draw"]).groupBy("lang", "draw").agg(F.min(piece).alias("text"))
    out: dict[str, list[str]] = {}
    for row in sorted(drawn.collect(), key=lambda r: (r["lang"], r["draw"])):
        out.setdefault(row["lang"], []).append(row["text"])
    return out


def _sequences(sample: dict[str, list[str]], rng: np.random.Generator, length: int = 64):
    """Training words and labels: pieces of one document, and sequences joined from pieces of several."""
    documents = [
        (label, [core(w) for w in text.split()]) for label, lang in enumerate(sample) for text in sample[lang]
    ]
    documents = [(label, [w for w in words if w]) for label, words in documents]
    words, labels = [], []
    pieces: list[tuple[int, list[str]]] = []
    for label, own in documents:
        for i in range(0, len(own), length):
            piece = own[i : i + length]
            if (i // length) % 2:
                words += piece + [""] * (length - len(piece))
                labels += [label] * length
            else:
                while piece:
                    n = int(rng.integers(4, 40))
                    pieces.append((label, piece[:n]))
                    piece = piece[n:]
    mixed_words, mixed_labels = [], []
    for k in rng.permutation(len(pieces)):
        label, piece = pieces[k]
        mixed_words += piece
        mixed_labels += [label] * len(piece)
    spare = -len(mixed_words) % length
    mixed_words += [""] * spare
    mixed_labels += [mixed_labels[-1] if mixed_labels else 0] * spare
    return words + mixed_words, np.array(labels + mixed_labels, np.int64), length


def fit(
    sample: dict[str, list[str]],
    lexicon_size: int = 20_000,
    rounds: int = 25,
    rate: float = 0.5,
    decay: float = 1e-6,
    seed: int = 42,
) -> Model:
    """Maximum likelihood with a little weight decay, by AdaGrad on the whole sample."""
    languages = sorted(sample)
    sample = {lang: sample[lang] for lang in languages}
    words, labels, length = _sequences(sample, np.random.default_rng(seed))
    counts = Counter(word for word in words if word)
    common = sorted((w for w, n in counts.items() if n > 2), key=lambda w: (-counts[w], w))[:lexicon_size]
    lexicon = {word: i for i, word in enumerate(common)}
    n_labels = len(languages)
    model = Model(languages, lexicon, np.zeros((len(lexicon) + BUCKETS, n_labels)), np.full((n_labels,) * 2, 1.0))
    if n_labels < 2 or not counts:
        return model
    distinct = sorted(counts)
    place = {word: i for i, word in enumerate(distinct)}
    rows = np.fromiter((place.get(w, -1) for w in words), np.int64, len(words))
    real = rows >= 0
    flat, owner = features(distinct, lexicon)
    lengths = np.full(len(words) // length, length)
    log_transition = np.zeros((n_labels, n_labels))
    steps = np.full(model.weights.shape, 1e-3), np.full(log_transition.shape, 1e-3)
    inner = np.arange(len(words)) % length > 0
    seen = np.zeros((len(words), n_labels))
    seen[np.arange(len(words)), labels] = 1
    seen_pairs = np.zeros((n_labels, n_labels))
    np.add.at(seen_pairs, (labels[np.flatnonzero(inner) - 1], labels[inner]), 1)
    for _ in range(rounds):
        per_word = np.stack(
            [np.bincount(owner, model.weights[flat, k], len(distinct)) for k in range(n_labels)], axis=1
        )
        score = np.where(real[:, None], per_word[rows], 0.0)
        potential = np.exp(score - score.max(axis=1, keepdims=True)) + 1e-12
        transition = np.exp(log_transition - log_transition.max())
        chances, pairs = _expected(potential, length, transition)
        gap = np.where(real[:, None], seen - chances, 0.0)
        by_word = np.stack(
            [np.bincount(rows[real], gap[real, k], len(distinct)) for k in range(n_labels)], axis=1
        )
        by_feature = np.stack(
            [np.bincount(flat, by_word[owner, k], len(model.weights)) for k in range(n_labels)], axis=1
        )
        for value, slope, step in (
            (model.weights, by_feature / len(words) - decay * model.weights, steps[0]),
            (log_transition, (seen_pairs - pairs) / len(words), steps[1]),
        ):
            step += slope**2
            value += rate * slope / np.sqrt(step)
    model.transition = np.exp(log_transition - log_transition.max())
    return model


def _expected(potential: np.ndarray, length: int, transition: np.ndarray):
    """Label probabilities of each word and the expected number of each transition, for equal sequences."""
    n_labels = potential.shape[1]
    steps = potential.reshape(-1, length, n_labels)
    alpha, beta = np.empty_like(steps), np.empty_like(steps)
    state = np.full((len(steps), n_labels), 1.0 / n_labels)
    for t in range(length):
        state = (state @ transition) * steps[:, t]
        state /= state.sum(axis=1, keepdims=True)
        alpha[:, t] = state
    state = np.ones((len(steps), n_labels))
    beta[:, -1] = state
    for t in range(length - 2, -1, -1):
        state = (steps[:, t + 1] * state) @ transition.T
        state /= state.sum(axis=1, keepdims=True)
        beta[:, t] = state
    pairs = np.zeros((n_labels, n_labels))
    for t in range(1, length):
        right = steps[:, t] * beta[:, t]
        norm = np.einsum("si,ij,sj->s", alpha[:, t - 1], transition, right)
        pairs += np.einsum("si,sj->ij", alpha[:, t - 1] / norm[:, None], right) * transition
    chances = alpha * beta
    return (chances / chances.sum(axis=2, keepdims=True)).reshape(-1, n_labels), pairs


def held_out(doc_id: Column | str) -> Column:
    """Documents that training must not see: crc32 of the id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_documents(docs: DataFrame, per_language: int = 150, **settings) -> Model:
    """The model of the labelled documents that are not held out; ``docs(doc_id, text, lang)``."""
    return fit(training_sample(docs.filter(~held_out("doc_id")), per_language), **settings)


def identify(docs: DataFrame, model: Model, spans: bool = False, carry: Sequence[str] | None = None) -> DataFrame:
    """The ``carry`` columns of ``docs``, all by default, as the struct ``row``, with ``lang_pred`` and
    ``score``, the mean probability of that language over the words with letters, and with ``spans`` the runs
    of words of one language (first, end, lang).

    Null texts, texts without a letter and a model without languages give ``und`` with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carry = list(carry or docs.columns)
    kinds = [("lang_pred", pa.string()), ("score", pa.float64())]
    if spans:
        kinds.append(("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
    kept = ["rest", "seen"] if "text" in carry else ["rest"]

    def label(batches):
        memo = _Memo(shared.value)
        for batch in batches:
            found = []
            for group in grouped(binary_texts(batch.column("seen")), BATCH_BYTES):
                found += _label(memo, group, spans) if memo.model.languages else [(UNKNOWN, 0.0, [])] * len(group)
            columns = [batch.column(name) for name in kept]
            columns += [pa.array([f[i] for f in found], kind) for i, (_, kind) in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *(name for name, _ in kinds)])

    rows, again = without_text(docs, carry)
    found = "lang_pred string, score double" + ", spans array<struct<first bigint, end bigint, lang string>>" * spans
    schema = T.StructType([*(rows.schema[name] for name in kept), *T.StructType.fromDDL(found)])
    return map_in_arrow(rows, label, schema).select(again, *(name for name, _ in kinds))


def in_a_language(docs: DataFrame, model: Model, agreement: float = 1 / 15) -> DataFrame:
    """The rows of ``docs`` with a language: not ``und``, and the words agree on it.

    ``agreement`` is the part of the way from what a guess among the learned languages scores, 1 / L, to 1 that the
    score has to cover: 0.3 for four languages.
    """
    guess = 1.0 / max(1, len(model.languages))
    least = guess + agreement * (1.0 - guess)
    found = identify(docs, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select("row.*")
