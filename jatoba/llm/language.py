"""Language identification by a linear-chain conditional random field over words.

Every word gets a score per language from affixes, byte n-grams inside it and membership in
the languages' lexicons; learned transitions tie neighbouring words together, so that runs of
one language in code-switched text are found by forward-backward. A document's language is the
one with the largest sum of word marginals.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from jatoba.llm.text import Memory, Words, batch_bytes, find_words, give_back, hash_words, held, released, row_slices, run_ranges, text_of, whole_row

STEP_BYTES = 1 << 20
SAMPLE_DOCS = 200
"""Documents per language that the model is fitted on, in expectation."""
SAMPLE_CHARS = 20_000
"""Of a longer document that is drawn for the fit, about this much is taken, from ``PIECES`` places."""
PIECES = 4
MANY_LANGUAGES = 64
"""With more languages than this, all are learned, but from fewer documents each, and less text is worked on in one go."""
DIMENSIONS = 1 << 16
FITTED_WORDS = 1 << 12
SEGMENT = 64
"""Words whose transfer matrix is multiplied up before segments are chained."""
UNKNOWN = "und"
_SPANS = "array<struct<lang:string,first:int,words:int>>"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes in lower case (ASCII and the Latin-1 letters), with 0 for what is no letter."""
    out = np.where(_LETTER[data], data, 0).astype(np.uint8)
    out[(data >= 65) & (data <= 90)] += 32
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[latin] += 32
    return out


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the features of each word, one after the other, and where each word's begin.

    A feature is an affix of one to four bytes, an n-gram of one to four bytes anywhere, or
    the word itself; bytes are those of the folded word between two boundary marks.
    """
    lengths = ends - starts
    at = run_ranges(starts, lengths)
    text = np.zeros(int(lengths.sum()) + 2 * len(starts), np.uint64)
    begin = np.cumsum(lengths + 2) - lengths - 2
    text[run_ranges(begin + 1, lengths)] = data[at].astype(np.uint64) + np.uint64(2)
    text[begin] = text[begin + lengths + 1] = 1
    owner = np.repeat(np.arange(len(starts)), lengths + 2)
    rows, found, gram = [], [], np.zeros(len(text), np.uint64)
    for n in range(1, 5):
        gram = gram[: len(text) - n + 1] * np.uint64(259) + text[n - 1 :]
        inside = owner[: len(gram)] == owner[n - 1 :]
        rows.append(owner[: len(gram)][inside])
        found.append(gram[inside] * np.uint64(4) + np.uint64(n - 1))
    # The whole word: its bytes weighed by their place in the word.
    place = np.arange(len(text)) - np.repeat(begin, lengths + 2) + 1
    weighed = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text + np.uint64(7)) * (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(0xD6E8FEB86659FD93)), out=weighed[1:])
    rows.append(np.arange(len(starts)))
    found.append(weighed[begin + lengths + 2] - weighed[begin])
    rows, found = np.concatenate(rows), np.concatenate(found)
    found = (found * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - 16)
    order = np.argsort(rows, kind="stable")
    return found[order].astype(np.int64), np.searchsorted(rows[order], np.arange(len(starts)))


def forward_backward(score: np.ndarray, transition: np.ndarray, start: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Word marginals of sequences laid end to end; sequence i is ``first[i]:first[i + 1]``.

    Sequences are cut into segments, and all segments advance together: first their transfer
    matrices, then, chained segment by segment, the messages at their ends, then the words.
    """
    lengths, labels = np.diff(first), len(start)
    out = np.full(score.shape, 1.0 / labels)
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    segments = -(-lengths[full] // SEGMENT)
    of = np.repeat(np.arange(len(full)), segments)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(segments) - segments, segments)
    begin = first[full][of] + nth * SEGMENT
    size = np.minimum(first[full + 1][of] - begin, SEGMENT)
    here = np.arange(SEGMENT)[None, :] < size[:, None]
    at = np.where(here, begin[:, None] + np.arange(SEGMENT)[None, :], 0)
    emit = np.exp(score - score.max(axis=1, keepdims=True))[at]
    step = np.exp(transition - transition.max())
    product = np.broadcast_to(np.eye(labels), (len(of), labels, labels)).copy()
    for t in range(SEGMENT):
        now = here[:, t]
        moved = (product[now].reshape(-1, labels) @ step).reshape(-1, labels, labels) * emit[now, t][:, None, :]
        product[now] = moved / moved.sum(axis=(1, 2), keepdims=True)
    into, back = np.empty((len(of), labels)), np.ones((len(of), labels))
    # The message before the first word is such that one step gives the start scores.
    prior = np.exp(start - start.max())
    top = int(segments.max())
    place = np.cumsum(segments) - segments
    for k in range(top):
        now = place[segments > k] + k
        if k == 0:
            into[now] = np.linalg.solve(step.T, prior)
        else:
            moved = np.einsum("si,sij->sj", into[now - 1], product[now - 1])
            into[now] = moved / np.abs(moved).sum(axis=1, keepdims=True)
    for k in range(top - 2, -1, -1):
        now = place[segments > k + 1] + k
        moved = np.einsum("sij,sj->si", product[now + 1], back[now + 1])
        back[now] = moved / moved.sum(axis=1, keepdims=True)
    ahead = np.empty((len(of), SEGMENT, labels))
    message = into
    for t in range(SEGMENT):
        moved = (message @ step) * emit[:, t]
        message = np.where(here[:, t, None], moved / np.maximum(np.abs(moved).sum(axis=1, keepdims=True), 1e-300), message)
        ahead[:, t] = message
    message = back
    for t in range(SEGMENT - 1, -1, -1):
        ahead[:, t] *= message
        moved = (message * emit[:, t]) @ step.T
        message = np.where(here[:, t, None], moved / np.maximum(moved.sum(axis=1, keepdims=True), 1e-300), message)
    ahead = np.maximum(ahead, 0)
    out[at[here]] = (ahead / np.maximum(ahead.sum(axis=2, keepdims=True), 1e-300))[here]
    return out


@dataclass
class Crf:
    """A fitted model; ``name`` tells models apart in a worker's memory."""

    labels: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    lexicon_labels: np.ndarray
    lexicon_weights: np.ndarray
    transition: np.ndarray
    start: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def emissions(self, words: Words, at: np.ndarray) -> np.ndarray:
        plain = folded(words.data)
        index, begin = word_features(plain, words.starts[at], words.ends[at])
        score = np.add.reduceat(self.weights[index], begin, axis=0) if len(at) else np.zeros((0, len(self.labels)))
        score = score + self.lexicon_weights[self.entries(hash_words(Words(plain, words.starts[at], words.ends[at], words.first)))]
        letters = np.zeros(len(plain) + 1, np.int64)
        np.cumsum(plain > 0, out=letters[1:])
        score[letters[words.ends[at]] == letters[words.starts[at]]] = 0
        return score.astype(np.float32)

    def entries(self, hashes: np.ndarray) -> np.ndarray:
        """The label in whose lexicon a word is, or the last row for none."""
        if not len(self.lexicon):
            return np.full(len(hashes), len(self.labels))
        place = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[place] == hashes, self.lexicon_labels[place], len(self.labels))


def _features_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of many words and how many each has, a few thousand words at a time."""
    index, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for a in range(0, len(starts), FITTED_WORDS):
        found, begin = word_features(data, starts[a : a + FITTED_WORDS], ends[a : a + FITTED_WORDS])
        index.append(found.astype(np.int32))
        counts.append(np.diff(np.append(begin, len(found))))
    return np.concatenate(index), np.concatenate(counts)


def fit(texts: list[str], langs: list[str], seed: int = 2, epochs: int = 6, words_in_sequence: int = 48) -> Crf:
    """Fit a field to labelled texts.

    Sequences that switch between languages are put together from runs of words of the
    documents, so that emissions and transitions are learned on code-switched text.
    """
    rng = np.random.default_rng(seed)
    labels = sorted(set(langs))
    data, offsets = batch_bytes(pa.array(texts, pa.string()))
    words = find_words(data, offsets)
    plain = folded(data)
    hashes = hash_words(Words(plain, words.starts, words.ends, words.first))
    label = np.array([labels.index(x) for x in langs])[words.rows()]
    distinct, where, which = np.unique(hashes, return_index=True, return_inverse=True)
    counts = np.zeros((len(distinct), len(labels)))
    np.add.at(counts, (which, label), 1)
    total = counts.sum(axis=1)
    listed = (total >= 3) & (counts.max(axis=1, initial=0) >= 0.8 * total)
    index, per_word = _features_of(plain, words.starts[where], words.ends[where])
    begin = np.cumsum(per_word) - per_word
    model = Crf(
        labels,
        np.zeros((DIMENSIONS, len(labels))),
        distinct[listed],
        counts.argmax(axis=1)[listed],
        np.zeros((len(labels) + 1, len(labels))),
        np.zeros((len(labels), len(labels))),
        np.zeros(len(labels)),
    )
    entry = model.entries(distinct)
    # Runs of 4 to 24 words of one document each.
    runs, of = [], []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        while a < b:
            c = min(b, a + int(rng.integers(4, 25)))
            runs.append((a, c))
            of.append(label[a])
            a = c
    order = rng.permutation(len(runs))
    by_label = [[runs[i] for i in order if of[i] == k] for k in range(len(labels))]
    sequences, gold = [], []
    for _ in range(max(1, len(words) // words_in_sequence)):
        parts, k = [], int(rng.integers(len(labels)))
        while sum(b - a for a, b in parts) < words_in_sequence:
            if by_label[k]:
                parts.append(by_label[k][int(rng.integers(len(by_label[k])))])
            if rng.random() < 0.3:
                k = int(rng.integers(len(labels)))
        at = np.concatenate([np.arange(a, b) for a, b in parts])[:words_in_sequence]
        sequences.append(which[at])
        gold.append(label[at])
    sequences, gold = np.array(sequences), np.array(gold)
    parameters = [model.weights, model.lexicon_weights, model.transition, model.start]
    squares = [np.full(p.shape, 1e-6) for p in parameters]
    width = 128
    for _ in range(epochs):
        for k in range(0, len(sequences), width):
            batch, truth = sequences[k : k + width], gold[k : k + width]
            flat = batch.ravel()
            n = per_word[flat]
            features = index[run_ranges(begin[flat], n)]
            score = np.add.reduceat(model.weights[features], np.cumsum(n) - n, axis=0) + model.lexicon_weights[entry[flat]]
            gradients = _gradients(score.reshape(*batch.shape, -1), truth, model.transition, model.start)
            per, pairs, firsts = gradients
            per = per.reshape(len(flat), -1)
            spread = np.stack([np.bincount(features, np.repeat(per[:, j], n), DIMENSIONS) for j in range(len(labels))], axis=1)
            lexical = np.zeros_like(model.lexicon_weights)
            np.add.at(lexical, entry[flat], per)
            for p, square, g in zip(parameters, squares, (spread, lexical, pairs, firsts), strict=True):
                g = g / len(batch) - 1e-5 * p
                square += g * g
                p += 0.1 * g / np.sqrt(square)
    model.weights = model.weights.astype(np.float32)
    return model


def _gradients(score, truth, transition, start):
    """Observed minus expected counts of a batch of equally long sequences."""
    batch, time, labels = score.shape
    emit = np.exp(score - score.max(axis=2, keepdims=True))
    step = np.exp(transition - transition.max())
    ahead, behind = np.empty_like(emit), np.ones_like(emit)
    message = np.exp(start - start.max()) * emit[:, 0]
    for t in range(time):
        if t:
            message = (message @ step) * emit[:, t]
        message = message / message.sum(axis=1, keepdims=True)
        ahead[:, t] = message
    for t in range(time - 2, -1, -1):
        moved = (behind[:, t + 1] * emit[:, t + 1]) @ step.T
        behind[:, t] = moved / moved.sum(axis=1, keepdims=True)
    marginal = ahead * behind
    marginal /= marginal.sum(axis=2, keepdims=True)
    left, right = ahead[:, :-1].reshape(-1, labels), (behind * emit)[:, 1:].reshape(-1, labels)
    pairs = step * ((left / ((left @ step) * right).sum(axis=1, keepdims=True)).T @ right)
    seen = np.eye(labels)[truth]
    observed = np.zeros((labels, labels))
    np.add.at(observed, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
    return seen - marginal, observed - pairs, (seen - marginal)[:, 0].sum(axis=0)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a NULL id is not held out, and not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_documents(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Crf | None:
    """Fit to a sample of the labelled documents that are not held out; None if there are none with a letter.

    Every language is learned, whatever the length of its documents: each is drawn by a hash of
    the id, with the share that gives ``sample_docs`` documents in expectation (fewer if there
    are more than 64 languages), and with one document at least. Rows of one id and language
    count once. Of a document longer than ``sample_chars``, pieces of it are learned.
    """
    text, draw = F.col("text"), F.pmod(F.xxhash64(F.lit("fit"), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    learned = (
        docs.select(F.col("lang").cast("string"), F.col("doc_id"), F.col("text").cast("string"))
        .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & text.rlike(r"\p{L}"))
        .withColumn("draw", draw)
    )
    counts = learned.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"), F.min("draw").alias("least")).collect()
    if not counts:
        return None
    each = sample_docs * min(1.0, (MANY_LANGUAGES / len(counts)) ** 2)
    shares = docs.sparkSession.createDataFrame([(r.lang, max(each / max(r.n, 1), r.least)) for r in counts], "_lang string, share double")
    drawn = learned.join(F.broadcast(shares), (F.col("lang") == F.col("_lang")) & (F.col("draw") <= F.col("share")))
    taken = F.when(F.char_length(text) <= sample_chars, text).otherwise(_excerpt(text, F.col("doc_id"), sample_chars))
    rows = sorted(drawn.groupBy("lang", "doc_id").agg(F.min(taken).alias("text")).select("lang", "text").collect())
    model = fit([r.text for r in rows], [r.lang for r in rows])
    give_back()
    return model


def _excerpt(text: Column, doc_id: Column, chars: int) -> Column:
    """Whole words from a few places of a long text that a hash of the id picks, the first letter's among them."""
    size = -(-chars // PIECES)
    found = []
    for i in range(PIECES):
        place = F.pmod(F.xxhash64(F.lit(i), doc_id), F.greatest(F.char_length(text) - size, F.lit(1))) if i else F.regexp_instr(text, F.lit(r"\p{L}")) - 1
        piece = F.substr(text, place.cast("int") + 1, F.lit(size))
        whole = F.regexp_replace(piece, r"^\S+|\S+$" if i else r"\S+$", "")
        found.append(F.when(whole.rlike(r"\p{L}"), whole).otherwise(piece))
    return F.concat_ws(" ", *found)


def _memory(model: Crf) -> Memory:
    most = int((1 << 20) * min(1.0, MANY_LANGUAGES / len(model.labels)))
    return held(model.name, lambda: Memory(model.emissions, len(model.labels), np.float32, most))


def word_marginals(model: Crf, column: pa.Array) -> tuple[Words, np.ndarray]:
    data, offsets = batch_bytes(column)
    words = find_words(data, offsets)
    score = _memory(model)(words, hash_words(words))
    return words, forward_backward(score.astype(np.float64), model.transition, model.start, words.first)


def predict(docs: DataFrame, model: Crf | None, spans: bool = False) -> DataFrame:
    """``lang_pred, score[, spans]`` next to all columns of ``docs``.

    The score is the mean marginal, over words with letters, of the language predicted.
    ``spans`` lists the runs of words with one most probable language as (lang, first word,
    words). NULL texts and texts without a letter get ``und`` and score 0, as do all texts if
    there is no model. Equal rows get equal results, long texts are read whole, and no column
    but the text is looked at. A column of ``docs`` that is called like a new one gives way.
    """
    added = {"lang_pred": "string", "score": "double"} | ({"spans": _SPANS} if spans else {})
    own = [F.col(f"row.`{c}`") for c in docs.columns if c not in added]
    if model is None:
        plain = {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "spans": F.array().cast(_SPANS)}
        return docs.select(whole_row(docs)).select(*own, *[plain[c].alias(c) for c in added])

    step = int(STEP_BYTES * min(1.0, (MANY_LANGUAGES / len(model.labels)) ** 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, text in row_slices(whole, text_of(whole.column("row")), step):
                words, marginal = word_marginals(model, text)
                letters = np.zeros(len(words.data) + 1, np.int64)
                np.cumsum(_LETTER[words.data], out=letters[1:])
                counted = letters[words.ends] > letters[words.starts]
                sums = np.zeros((len(words) + 1, len(model.labels)))
                np.cumsum(marginal * counted[:, None], axis=0, out=sums[1:])
                each = sums[words.first[1:]] - sums[words.first[:-1]]
                n = np.zeros(len(words) + 1)
                np.cumsum(counted, out=n[1:])
                n = n[words.first[1:]] - n[words.first[:-1]]
                best = each.argmax(axis=1)
                known = np.array(batch.column("letter").to_pylist(), bool) & (n > 0)
                score = np.where(known, each[np.arange(len(best)), best] / np.maximum(n, 1), 0.0)
                columns = {
                    "row": batch.column("row"),
                    "lang_pred": pa.array(np.where(known, np.array(model.labels, object)[best], UNKNOWN), pa.string()),
                    "score": pa.array(np.clip(score, 0, 1)),
                }
                if spans:
                    columns["spans"] = _spans(model, words, marginal)
                yield pa.record_batch(columns)

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter")
    made = StructType([StructField("row", docs.schema), *StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in added.items())).fields])
    found = docs.select(letter, whole_row(docs)).mapInArrow(released(run), made)
    return found.select(*own, *added)


def _spans(model: Crf, words: Words, marginal: np.ndarray) -> pa.Array:
    best, rows = marginal.argmax(axis=1), words.rows()
    new = np.flatnonzero((np.diff(best, prepend=-1) != 0) | (np.diff(rows, prepend=-1) != 0))
    size = np.diff(np.append(new, len(best)))
    runs = pa.StructArray.from_arrays(
        [pa.array(np.array(model.labels, object)[best[new]], pa.string()), pa.array((new - words.first[rows[new]]).astype(np.int32)), pa.array(size.astype(np.int32))],
        ["lang", "first", "words"],
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[new], np.arange(len(words.first))).astype(np.int32)), runs)


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of documents."""
    model = fit_documents(docs, sample_docs)
    found = predict(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least_score: float = 0.3, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The documents without those of no language: ``und``, or with a score below ``least_score``; all of them if nothing could be learned."""
    model = fit_documents(docs, sample_docs)
    if model is None:
        return docs
    names = [f"c{i}" for i in range(len(docs.columns))]
    # Under names that clash with nothing, but for the text.
    plain = docs.toDF(*["text" if c == "text" else n for c, n in zip(docs.columns, names, strict=True)])
    found = predict(plain, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return found.drop("lang_pred", "score").toDF(*docs.columns)
