"""Languages of a document as a mixture: proportions by expectation-maximisation from n-gram likelihoods.

A model holds, for each language, the smoothed log probabilities of hashed byte trigrams of words, counted over
all documents with a language. A document is a mixture: each of its words has a likelihood under every language, and EM
finds the proportions. The set of languages is chosen by a penalised likelihood (BIC): the least language leaves
for as long as the fit without it is not worse by more than the penalty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .columns import with_new
from .words import LETTER_BYTES, Words, extended, pieces

GRAM_BITS = 16
#: Rounds of EM from even proportions, and after a language has left.
ROUNDS, MORE_ROUNDS = 12, 6
#: Proportions below which languages leave together after the first fit.
NEGLIGIBLE = 1e-3
#: Languages that a task counts at once; beyond, it hands on what it has counted.
OPEN_LANGUAGES = 64
#: Languages that a document may be a mixture of. If the model knows more, a first round over all of them chooses these for each document.
CANDIDATES = 64


@dataclass
class Model:
    """``languages`` and, a row for each, the log probability of every hashed trigram."""

    languages: list[str]
    log_p: np.ndarray


def grams(words: Words) -> np.ndarray:
    """Hashed trigrams around each byte of each word, with 0 beyond the ends of the word."""
    data = words.data.astype(np.uint32)
    at = np.flatnonzero(data)
    inner = np.zeros(len(data) + 2, np.uint32)
    inner[1:-1] = data
    before, after = inner[:-2].copy(), inner[2:].copy()
    before[words.begin] = 0
    after[words.end - 1] = 0
    code = (before[at] << np.uint32(16)) | (data[at] << np.uint32(8)) | after[at]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, gram, n)`` of a task; gram -1 counts documents."""
    size = 1 << GRAM_BITS
    open_counts: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, counts in open_counts.items():
            at = np.flatnonzero(counts)
            grams_of = np.where(at == size, -1, at).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(grams_of), pa.array(counts[at])], ["lang", "gram", "n"])
        open_counts.clear()

    for batch in pieces(batches):
        words = Words(batch.column(0), LETTER_BYTES)
        gram = grams(words)
        starts = np.concatenate([[0], np.cumsum(words.end - words.begin)])[words.first]
        langs = batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            if lang not in open_counts and len(open_counts) >= OPEN_LANGUAGES:
                yield from rows()
            own = [i for i, x in enumerate(langs) if x == lang]
            counts = open_counts.setdefault(lang, np.zeros(size + 1, np.int64))
            counts[:size] += np.bincount(np.concatenate([gram[starts[i] : starts[i + 1]] for i in own]), minlength=size)
            counts[size] += len(own)
    yield from rows()


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count trigrams by language over all rows with a text and a language; every language that occurs is learnt.

    The model is a table of languages by 2 ** 16 numbers, which grows with the languages and not with the texts. Without such rows it
    knows no language.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = rows.mapInArrow(_counted, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    with written(counts, "gram-counts") as counts:
        languages = sorted(r["lang"] for r in counts.where("gram = -1").select("lang").collect())
        table = np.zeros((len(languages), 1 << GRAM_BITS), np.float32 if len(languages) > CANDIDATES else np.float64)
        which = {x: i for i, x in enumerate(languages)}
        for at in range(0, len(languages), CANDIDATES):
            found = counts.where((F.col("gram") >= 0) & F.col("lang").isin(languages[at : at + CANDIDATES])).toArrow()
            row = np.array([which[x] for x in found["lang"].to_pylist()], np.int64)
            table[row, found["gram"].to_numpy()] = found["n"].to_numpy()
    smooth = table + 0.5
    return Model(languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32))


def mixtures(likelihood: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Proportions of the languages in each document, 0 for those that the penalised likelihood leaves out.

    ``likelihood``: a row for each word, a column for each language, 1 at most; ``first``: first word of each document, with the end;
    every document has a word.
    """
    docs, langs = len(first) - 1, likelihood.shape[1]
    share = np.full((docs, langs), 1 / langs, np.float32)

    def fit(share: np.ndarray, words: np.ndarray, doc: np.ndarray, starts: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        count = np.diff(np.append(starts, len(words)))[:, None]
        for _ in range(rounds):
            joint = words * share[doc]
            joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)
            share = np.add.reduceat(joint, starts, axis=0) / count
        total = np.log(np.maximum((words * share[doc]).sum(axis=1, dtype=np.float64), 1e-30))
        return share, np.add.reduceat(total, starts)

    count = np.diff(first)
    doc = np.repeat(np.arange(docs), count)
    penalty = 0.5 * np.log(np.maximum(count, 2))
    share, _ = fit(share, likelihood, doc, first[:-1], ROUNDS)
    share[share < NEGLIGIBLE] = 0
    share /= share.sum(axis=1, keepdims=True)
    share, value = fit(share, likelihood, doc, first[:-1], 1)
    active = np.flatnonzero((share > 0).sum(axis=1) > 1)
    while len(active):
        starts = np.cumsum(count[active]) - count[active]
        at = np.repeat(first[:-1][active] - starts, count[active]) + np.arange(count[active].sum())
        trial = share[active].copy()
        trial[np.arange(len(active)), np.where(trial > 0, trial, 2).argmin(axis=1)] = 0
        trial /= trial.sum(axis=1, keepdims=True)
        trial, without = fit(trial, likelihood[at], np.repeat(np.arange(len(active)), count[active]), starts, MORE_ROUNDS)
        better = without + penalty[active] >= value[active]
        share[active[better]], value[active[better]] = trial[better], without[better]
        active = active[better & ((trial > 0).sum(axis=1) > 1)]
    return share


def first_round(value: Callable[[int], np.ndarray], languages: int, first: np.ndarray, most: int) -> np.ndarray:
    """For each document the ``most`` languages with the largest proportions after one round of EM from even ones, in order of number.

    ``value`` gives the log likelihoods of all words under one language, so that memory holds those of a few languages at a time.
    """
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    top = np.full(len(doc), -np.inf)
    for j in range(languages):
        top = np.maximum(top, value(j))
    total = np.zeros(len(doc))
    for j in range(languages):
        total += np.exp(value(j) - top)
    share = np.stack([np.bincount(doc, np.exp(value(j) - top) / total, minlength=len(count)) for j in range(languages)], axis=1)
    chosen = np.argpartition(-share, most - 1, axis=1)[:, :most]
    return np.sort(chosen, axis=1)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _mix_candidates(share: np.ndarray, filled: np.ndarray, value: Callable[[int], np.ndarray], first: np.ndarray) -> None:
    """Fill in the proportions of the ``filled`` documents, each a mixture of its own candidates."""
    chosen = first_round(value, share.shape[1], first, CANDIDATES)
    doc = np.repeat(np.arange(len(filled)), np.diff(first))
    own = np.zeros((len(doc), CANDIDATES), np.float32)
    for j in np.unique(chosen):
        docs, slots = np.nonzero(chosen == j)
        slot = np.full(len(filled), -1)
        slot[docs] = slots
        at = np.flatnonzero(slot[doc] >= 0)
        own[at, slot[doc[at]]] = value(j)[at]
    own -= own.max(axis=1, keepdims=True)
    found = mixtures(np.exp(own), first)
    share[filled[:, None], chosen] = found


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``lang_pred``, the language of the largest proportion, its ``score``, and ``languages``, the chosen set.

    ``und``, score 0 and no languages where the text is null or has no letter, or the model knows no language. Whole texts
    count, however long; equal texts get equal results. A model may know any number of languages; a document is a mixture of ``CANDIDATES`` at most. Columns of ``docs`` with one of the new names are replaced.
    """
    return with_new(docs, (text,), lambda plain: _predicted(plain, model, text))


def _predicted(docs: DataFrame, model: Model, text: str) -> DataFrame:
    names = ["lang_pred", "score", "languages"]
    schema = extended(docs.schema, "lang_pred string, score double, languages array<string>")
    known = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_p))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, log_p = known.value
        for batch in pieces(batches, text):
            column = batch.column(text)
            words = Words(column, LETTER_BYTES)
            n = batch.num_rows
            share = np.zeros((n, len(languages)))
            filled = np.flatnonzero(words.count)
            if len(filled) and languages:
                gram = grams(words)
                starts = np.cumsum(words.end - words.begin) - (words.end - words.begin)
                first = np.append(words.first[filled], len(words.begin))
                if len(languages) <= CANDIDATES:
                    value = np.stack([np.add.reduceat(row[gram], starts) for row in log_p], axis=1)
                    value -= value.max(axis=1, keepdims=True)
                    share[filled] = mixtures(np.exp(value), first)
                else:
                    _mix_candidates(share, filled, lambda j: np.add.reduceat(log_p[j][gram], starts), first)
                ascii_letter = np.add.reduceat((words.data >= 0x61) & (words.data <= 0x7A), words.offsets[:-1][filled], dtype=np.int64) > 0
                for row in filled[~ascii_letter]:
                    if not _has_letter(column[int(row)].as_py()):
                        share[row] = 0
            best = share.argmax(axis=1) if languages else np.zeros(n, int)
            score = share.max(axis=1, initial=0)
            lang = [languages[b] if s > 0 else "und" for b, s in zip(best, score, strict=True)]
            chosen = [[languages[j] for j in np.flatnonzero(row)] for row in share]
            new = [pa.array(lang, pa.string()), pa.array(np.minimum(score, 1.0)), pa.array(chosen, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    return docs.mapInArrow(predicted, schema)
