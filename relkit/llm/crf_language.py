"""Language identification with a linear-chain conditional random field.

Every word of a text gets a language.  A word's features are the character
n-grams of the word between two end marks (those that hold a mark are its
affixes) and whether the word stands in the lexicon of a language; learned
transitions tie neighbouring words, so a text may switch languages.  The
posterior of every word comes from forward-backward over the whole text;
the text's language is the one with the largest share of its words.

Fitting takes a bounded sample: of each language the documents with the
smallest hash of their id, ``sample_per_language`` or as many as keep all
languages within ``SAMPLE`` documents (8 at least), and
``segment_words`` consecutive words of each.  Segments of different
documents are strung together, so that switches are seen.

Any number of languages is learned.  One field tells ``max_languages``
labels apart.  With more languages the fields form a chain: the first one
tells the most frequent languages apart, and all others, as one label, go
on to the next field.  The weights of all fields together are at most
``WEIGHTS`` (fields of a long chain hash their n-grams to fewer weights),
so the broadcast model is at most 256 MB whatever the data holds.

Forward-backward runs over blocks of words, all blocks of a slice of
documents at a time: first each block's transfer matrix, then the vectors
that enter and leave each block, then the words inside.  The result is
that of the plain recursion (tested), at any text length.

Defined results: a text that is null or has no letter is ``und`` with
score 0; so is every text if there is nothing to learn from.  Ties go to
the language first in order.  A null id is carried along; repeated rows
give repeated results; an empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relkit.llm.common import pinned, slices

SAMPLE_PER_LANGUAGE = 400
SEGMENT_WORDS = 64
MAX_LANGUAGES = 64
BITS = 18
ROUNDS = 40
BLOCK = 64                       # words of a block in forward-backward
_SLICE_WORDS = 50_000            # a worker keeps what one slice took, whatever it runs next
_SLICE_CHARS = 1_000_000
SAMPLE = 3200                    # documents of a sample, if it has few languages
SAMPLE_LEAST = 8                 # documents of a language, whatever their number
WEIGHTS = 1 << 26                # of all fields
OTHER = "\U0010ffff"             # the languages of the later fields
BROADCAST_LANGUAGES = 100_000
_KNOWN_WORDS = 50_000            # entries of a task's word cache
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")
_MULT = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def grams(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams (2 to 4 characters, end marks included) of every
    word: feature numbers and the word of each."""
    flat = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "replace"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    features, owners = [], []
    with np.errstate(over="ignore"):
        h = flat * _MULT[0]
        for n in range(2, 5):
            if len(flat) < n:
                break
            h = h[:len(flat) - n + 1] + flat[n - 1:] * _MULT[n - 1] + np.uint32(n)
            same = word[:len(flat) - n + 1] == word[n - 1:]
            x = h[same]
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            x ^= x >> np.uint32(12)
            features.append(((x * np.uint32(0x297A2D39)) >> np.uint32(32 - bits)).astype(np.int64))
            owners.append(word[:len(flat) - n + 1][same])
    return np.concatenate(features), np.concatenate(owners)


@dataclass
class Model:
    languages: list[str]
    bits: int
    weights: np.ndarray              # 2**bits x languages
    lexicon: dict[str, int]          # word -> the language whose lexicon holds it
    lexicon_weights: np.ndarray      # languages (+ 1 row for none) x languages
    transitions: np.ndarray          # from x to, log
    start: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission scores of words, words x languages."""
        if not words:
            return np.zeros((0, len(self.languages)), np.float32)
        f, owner = grams(words, self.bits)
        out = np.stack([np.bincount(owner, self.weights[f, k], len(words))
                        for k in range(len(self.languages))], axis=1)
        lex = np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))
        return (out + self.lexicon_weights[lex]).astype(np.float32)


def _fb(p: np.ndarray, m: np.ndarray, start: np.ndarray, real: np.ndarray
        ) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (steps x sequences x languages) and summed posteriors of
    neighbours (languages x languages), for training; p: exponentiated
    emissions, real: which steps are words."""
    steps, n, k = p.shape
    alpha, beta = np.empty_like(p), np.ones_like(p)
    for t in range(steps):
        a = (start if t == 0 else alpha[t - 1] @ m) * p[t]
        a = np.where(real[t][:, None], a, alpha[t - 1] if t else 1.0)
        alpha[t] = a / a.sum(1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        b = (beta[t + 1] * p[t + 1]) @ m.T
        b = np.where(real[t + 1][:, None], b, beta[t + 1])
        beta[t] = b / b.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(2, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(1, steps):
        x = alpha[t - 1][:, :, None] * m * (p[t] * beta[t])[:, None, :]
        x /= x.sum((1, 2), keepdims=True)
        pairs += x[real[t]].sum(0)
    return gamma, pairs


def fit(segments: list[tuple[str, list[str]]], bits: int = BITS, rounds: int = ROUNDS,
        segment_words: int = SEGMENT_WORDS, l2: float = 1e-4, seed: int = 7) -> Model | None:
    """The model fitted on (language, words) segments, by full-batch Adam on
    the conditional likelihood of word labels."""
    segments = sorted((lang, ws) for lang, ws in segments if ws)
    languages = sorted({lang for lang, _ in segments})
    k = len(languages)
    if not k:
        return None
    number = {x: i for i, x in enumerate(languages)}
    counts = Counter((w, number[lang]) for lang, ws in segments for w in ws)
    total = Counter()
    for (w, _), n in counts.items():
        total[w] += n
    lexicon = {w: i for (w, i), n in counts.items() if n >= 3 and n >= 0.8 * total[w]}
    # Strings of pieces from different documents, for the transitions.
    rng = np.random.default_rng(seed)
    pieces = []
    for lang, ws in segments:
        step = int(rng.integers(segment_words // 4, segment_words + 1))
        pieces += [(number[lang], ws[a:a + step]) for a in range(0, len(ws), step)]
    rng.shuffle(pieces)
    labels = np.concatenate([np.full(len(ws), i) for i, ws in pieces])
    types: dict[str, int] = {}
    ids = np.array([types.setdefault(w, len(types)) for _, ws in pieces for w in ws])
    n_seq = -(-len(ids) // segment_words)
    pad = n_seq * segment_words - len(ids)

    def shaped(x: np.ndarray) -> np.ndarray:
        return np.append(x, np.zeros(pad, x.dtype)).reshape(n_seq, segment_words).T

    ids2, labels2, real = shaped(ids), shaped(labels), shaped(np.ones(len(ids), bool))
    words = list(types)
    f, owner = grams(words, bits)
    used, f = np.unique(f, return_inverse=True)
    lex = np.array([lexicon.get(w, k) for w in words])
    theta = {"w": np.zeros((len(used), k)), "lex": np.zeros((k + 1, k)),
             "t": np.eye(k) * 2.0, "s": np.zeros(k)}
    moment = {x: (np.zeros_like(v), np.zeros_like(v)) for x, v in theta.items()}
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (labels2[:-1][real[1:]], labels2[1:][real[1:]]), 1.0)
    onehot = np.eye(k)
    for r in range(1, rounds + 1):
        e = np.stack([np.bincount(owner, theta["w"][f, j], len(words)) for j in range(k)], 1)
        e += theta["lex"][lex]
        e -= e.max(1, keepdims=True)
        p = np.exp(e)[ids2]
        gamma, pairs = _fb(p, np.exp(theta["t"]), np.exp(theta["s"]), real)
        diff = (gamma - onehot[labels2]) * real[:, :, None]
        by_type = np.stack([np.bincount(ids2.ravel(), diff[:, :, j].ravel(), len(words))
                            for j in range(k)], 1)
        grad = {"w": np.stack([np.bincount(f, by_type[owner, j], len(used)) for j in range(k)], 1),
                "lex": np.stack([np.bincount(lex, by_type[:, j], k + 1) for j in range(k)], 1),
                "t": pairs - gold_pairs, "s": diff[0].sum(0)}
        for x, v in theta.items():
            g = grad[x] / len(ids) + l2 * v * (x != "t")
            m1, m2 = moment[x]
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            v -= 0.1 * (m1 / (1 - 0.9 ** r)) / (np.sqrt(m2 / (1 - 0.99 ** r)) + 1e-9)
    weights = np.zeros((1 << bits, k), np.float32)
    weights[used] = theta["w"]
    return Model(languages, bits, weights, lexicon, theta["lex"].astype(np.float32),
                 theta["t"], theta["s"])


def fit_chain(segments: list[tuple[str, list[str]]], max_languages: int = MAX_LANGUAGES, **options) -> list[Model]:
    """One field, or a chain of them if there are more languages; those
    with the most segments come first."""
    of = Counter(lang for lang, ws in segments if ws)
    rest = sorted(of, key=lambda x: (-of[x], x))
    if not rest:
        return []
    if len(rest) <= max_languages:
        return [fit(segments, **options)]
    fields = -(-(len(rest) - 1) // (max_languages - 1))
    bits = min(BITS, (WEIGHTS // (fields * max_languages)).bit_length() - 1)
    chain = []
    while rest:
        cut = len(rest) if len(rest) <= max_languages else max_languages - 1
        own, rest = set(rest[:cut]), rest[cut:]
        later = sorted((x for x in segments if x[0] in set(rest)), key=lambda x: (x[1], x[0]))
        step = max(1, len(later) // (SAMPLE // 2))
        part = [x for x in segments if x[0] in own] + [(OTHER, ws) for _, ws in later[::step]]
        chain.append(fit(part, bits=bits, **options))
    return chain


def shares(emissions: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Summed posteriors of the words of each document, documents x
    languages.  emissions: scores of all words, document after document;
    every document has a word."""
    k = len(model.languages)
    m = np.exp(model.transitions - model.transitions.max())
    start = np.exp(model.start - model.start.max())
    p_flat = np.exp(emissions - emissions.max(1, keepdims=True)).astype(np.float64) + 1e-30
    blocks = -(-lengths // BLOCK)
    n = int(blocks.sum())
    first = np.cumsum(blocks) - blocks                   # first block of each document
    doc_of = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(n) - first[doc_of]
    left = np.minimum(BLOCK, lengths[doc_of] - nth * BLOCK)
    begin = (np.cumsum(lengths) - lengths)[doc_of] + nth * BLOCK
    at = begin[:, None] + np.arange(BLOCK)
    real = np.arange(BLOCK) < left[:, None]
    p = p_flat[np.where(real, at, 0)]                    # blocks x BLOCK x languages
    enter, leave = np.tile(start, (n, 1)), np.ones((n, k))
    heads = nth == 0

    if blocks.max() > 1:
        long = np.flatnonzero(blocks[doc_of] > 1)
        q = np.tile(np.eye(k), (len(long), 1, 1))
        pl, rl, hl = p[long], real[long], heads[long]
        for t in range(BLOCK):
            step = (q.reshape(-1, k) @ m).reshape(q.shape)
            if t == 0 and hl.any():
                step[hl] = start
            step *= pl[:, t][:, None, :]
            step /= step.sum((1, 2), keepdims=True)
            q = np.where(rl[:, t][:, None, None], step, q)
        place = np.full(n, -1)
        place[long] = np.arange(len(long))
        for b in range(1, int(blocks.max())):
            d = np.flatnonzero(blocks > b)
            x = first[d] + b
            v = np.einsum("ni,nij->nj", enter[x - 1], q[place[x - 1]])
            enter[x] = v / v.sum(1, keepdims=True)
        for b in range(int(blocks.max()) - 2, -1, -1):
            d = np.flatnonzero(blocks > b + 1)
            x = first[d] + b
            v = np.einsum("nij,nj->ni", q[place[x + 1]], leave[x + 1])
            leave[x] = v / v.sum(1, keepdims=True)

    alpha = np.empty_like(p)
    a = enter
    for t in range(BLOCK):
        step = a @ m
        if t == 0:
            step[heads] = start
        step *= p[:, t]
        a = np.where(real[:, t][:, None], step / step.sum(1, keepdims=True), a)
        alpha[:, t] = a
    total = np.zeros((n, k))
    b = leave
    for t in range(BLOCK - 1, -1, -1):
        g = alpha[:, t] * b
        total += np.where(real[:, t][:, None], g / g.sum(1, keepdims=True), 0)
        step = (b * p[:, t]) @ m.T
        b = np.where(real[:, t][:, None], step / step.sum(1, keepdims=True), b)
    return np.add.reduceat(total, first, axis=0)


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces that end between words."""
    a = 0
    while a < len(text):
        b = a + _SLICE_CHARS
        while b < len(text) and _WORD.match(text[b]):
            b += 1
        yield text[a:b]
        a = b


class _Known(dict):
    """Word -> row of a growing table of emission scores."""

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = n = len(self)
        return n


class Labeller:
    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.known = _Known()
        self.known.fresh = []
        self.table = np.zeros((1024, len(self.model.languages)), np.float32)

    def emissions(self, text: str) -> np.ndarray | None:
        """Scores of the words of a text; None if it has no letter."""
        out, lettered = [], False
        for piece in _pieces(text):
            words = _WORD.findall(piece.lower())
            if not words:
                continue
            lettered = lettered or any(c.isalpha() for w in words for c in w)
            if len(self.known) > _KNOWN_WORDS:
                self._reset()
            done = len(self.known)
            ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            if fresh := self.known.fresh:
                while len(self.known) > len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[done:len(self.known)] = self.model.scores(fresh)
                self.known.fresh = []
            out.append(self.table[ids])
        return np.concatenate(out) if lettered else None


def label(chain: list[Labeller], texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text: what a field leaves to the later
    ones goes on to the next, and scores multiply."""
    pred, score = _label(chain[0] if chain else None, texts)
    for labeller in chain[1:]:
        on = [i for i, p in enumerate(pred) if p == OTHER]
        if not on:
            break
        for i, p, x in zip(on, *_label(labeller, [texts[i] for i in on])):
            pred[i], score[i] = p, score[i] * x
    return pred, score


def _label(labeller: Labeller | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text; documents are worked on in slices
    of bounded size."""
    pred, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    held: list[tuple[int, np.ndarray]] = []

    def decide() -> None:
        if not held:
            return
        model = labeller.model
        lengths = np.array([len(e) for _, e in held])
        got = shares(np.concatenate([e for _, e in held]), lengths, model)
        for (i, _), j, row, n in zip(held, got.argmax(1).tolist(), got, lengths.tolist()):
            pred[i] = model.languages[j]
            score[i] = min(1.0, max(0.0, float(row[j]) / n))
        held.clear()

    words = 0
    for i, text in enumerate(texts if labeller else []):
        e = labeller.emissions(text) if text else None
        if e is not None:
            held.append((i, e))
            words += len(e)
            if words >= _SLICE_WORDS:
                decide()
                words = 0
    decide()
    return pred, score


def _predict(handle):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = [Labeller(m) for m in handle.value]
        for batch in slices(batches):
            pred, score = label(chain, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                ["id", "lang_pred", "score"])
    return run


def _keep(handle, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = [Labeller(m) for m in handle.value]
        for batch in slices(batches):
            pred, _ = label(chain, batch.column(text_col).to_pylist())
            yield batch.filter(pa.array([p != UNDETERMINED for p in pred], pa.bool_()))
    return run


def _segments(words: int):
    """Some consecutive words from the middle of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                mid = max(0, len(text) // 2 - 32 * words)
                own = _WORD.findall(text[mid:mid + 64 * words].lower())
                a = max(0, len(own) // 2 - words // 2)
                out.append(own[a:a + words])
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(out, pa.list_(pa.string()))], ["lang", "words"])
    return run


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str,
           sample_per_language: int, segment_words: int) -> list[tuple[str, list[str]]]:
    """The bounded training sample, as (language, words)."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    own = rows.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"))
    counts = pinned(own.groupBy("lang").agg(F.count(F.lit(1)).alias("of")))
    languages = counts.count()
    sample_per_language = min(sample_per_language, max(SAMPLE_LEAST, SAMPLE // max(1, languages)))
    if languages <= BROADCAST_LANGUAGES:
        counts = F.broadcast(counts)
    # Hashes below a bound that some times the sample's size stay under, so
    # few rows of a language meet for the choice of the smallest.
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    near = place < F.lit(float(1 << 40)) * (4 * sample_per_language) / F.col("of")
    first = Window.partitionBy("lang").orderBy("place", "id")
    chosen = (own.join(counts, "lang").withColumn("place", place).where(near)
                 .withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample_per_language)
                 .select("id", "lang").collect())
    spark = docs.sparkSession
    if not chosen:
        return []
    # a bounded number of rows of each language
    keys = spark.createDataFrame(sorted({(r.id, r.lang) for r in chosen}, key=str), "id string, lang string")
    texts = (rows.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"),
                         F.col(text_col).alias("text"))
                 .join(F.broadcast(keys), ["id", "lang"], "left_semi").select("lang", "text"))
    got = texts.mapInArrow(_segments(segment_words), "lang string, words array<string>").collect()
    return [(r.lang, list(r.words)) for r in got]


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_per_language: int = SAMPLE_PER_LANGUAGE, segment_words: int = SEGMENT_WORDS,
          max_languages: int = MAX_LANGUAGES) -> list[Model]:
    return fit_chain(sample(docs.where(~held_out(id_col)), id_col, text_col, lang_col, sample_per_language, segment_words),
                     max_languages, segment_words=segment_words)


def identify(docs: DataFrame, model: list[Model], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score (share of its words)."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    handle = docs.sparkSession.sparkContext.broadcast(model)
    kind = own.schema["id"].dataType.simpleString()
    return (own.mapInArrow(_predict(handle), f"id {kind}, lang_pred string, score double")
               .withColumnRenamed("id", id_col))


def predict_all(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", **options) -> DataFrame:
    """Fits on the documents that are not held out and labels them all:
    id, held_out, lang_pred, score."""
    model = learn(docs, id_col, text_col, lang_col, **options)
    got = identify(docs, model, id_col, text_col)
    return got.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", **options) -> DataFrame:
    """``docs`` without the documents that have no language (``und``).  A
    text in several languages stays, whatever the share of each.  All
    columns stay; the language column is not changed."""
    model = learn(docs, id_col, text_col, lang_col, **options)
    handle = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_keep(handle, text_col), docs.schema)
