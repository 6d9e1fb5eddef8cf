"""Language identification: whole words first, then shorter and shorter character n-grams."""

from __future__ import annotations

import re
import sys
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Tables, few, free_name

#: Word characters that are neither letters nor decimal digits: fractions, superscripts, Roman and circled numerals.
NUMERALS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
BLANKED = {ord(c): " " for c in NUMERALS}
LETTERS = re.compile(r"[^\W\d_]+")
SAMPLE_PER_LANG, LONGEST, PENALTY = 1500, 5, 7.0
UNKNOWN = "und"
#: A document stays in the corpus from the first score on; from the second on a prediction may contradict its label.
LEAST, SURE = 0.5, 0.9


def lettered(text: str) -> str:
    """``text`` with spaces for numerals, so that ``LETTERS`` finds letters alone."""
    return text if text.isascii() or NUMERALS.isdisjoint(text) else text.translate(BLANKED)


def sample_labelled(docs: DataFrame, tables: Tables, per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """lang, text of about ``per_lang`` documents a language, all if there are fewer.

    Only documents with a language and crc32(doc_id as text) mod 3 other than 1 are eligible. The
    bound is this documented parameter; membership is by a hash of the id, so it doesn't depend on
    order or partitions. Rows that repeat an id are in or out together.
    """
    count = free_name(docs, "n")
    can = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out())
    per = tables.written(can.groupBy("lang").agg(F.count("*").alias(count)))
    u = F.pmod(F.xxhash64(F.lit("langid"), F.col("doc_id").cast("string")), F.lit(1 << 40)) / float(1 << 40)
    return can.join(few(per), "lang").where(u * F.col(count) < per_lang).select("lang", "text")


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def word_counts(sample: DataFrame) -> DataFrame:
    """lang, word, n over the sample."""

    def run(batches):
        for batch in batches:
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[lang].update(LETTERS.findall(lettered(text.as_py().lower())))
            rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*rows)) or [(), (), ()], (pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])

    return sample.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Mean negative log10 relative frequency per word; the lowest language wins.

    A word that some language's list holds is scored by whole-word frequency, with a fixed penalty
    where a list lacks it. Any other word, padded by spaces, is scored by the longest n-grams of
    which some language knows at least one, as the mean over those known; unseen down to single
    characters, it says nothing.
    """

    def __init__(self, counts: list[tuple[str, str, int]], longest: int = LONGEST):
        self.langs = sorted({lang for lang, _, _ in counts})
        at = {lang: k for k, lang in enumerate(self.langs)}
        self.rows, self.index = [], []
        for size in range(longest + 1):
            index: dict[str, int] = {}
            cell, times = array("q"), array("q")
            for lang, word, n in counts:
                padded = f" {word} "
                for gram in (padded[i : i + size] for i in range(len(padded) - size + 1)) if size else (word,):
                    cell.append(index.setdefault(gram, len(index)) * len(at) + at[lang])
                    times.append(n)
            grid = np.bincount(np.frombuffer(cell, np.int64), np.frombuffer(times, np.int64), len(index) * len(at)) if cell else np.zeros(0)
            grid = grid.reshape(len(index), len(at))
            total = np.maximum(grid.sum(axis=0), 1)
            self.rows.append(np.where(grid > 0, np.log10(total) - np.log10(np.maximum(grid, 1)), PENALTY))
            self.index.append(index)
        self.longest, self.memo = longest, {}

    def backoff(self, word: str) -> np.ndarray | None:
        if word in self.memo:
            return self.memo[word]
        cost, padded = None, f" {word} "
        for size in range(self.longest, 0, -1):
            get = self.index[size].get
            known = [k for i in range(len(padded) - size + 1) if (k := get(padded[i : i + size])) is not None]
            if known:
                cost = self.rows[size][known].mean(axis=0)
                break
        if len(word) <= 40:
            if len(self.memo) > 100_000:
                self.memo.clear()
            self.memo[word] = cost
        return cost

    def predict(self, text: str | None) -> tuple[str, float]:
        words = Counter(LETTERS.findall(lettered((text or "").lower())))
        if not words or not self.langs:
            return UNKNOWN, 0.0
        get, known, times, total, seen = self.index[0].get, [], [], np.zeros(len(self.langs)), 0
        for w, n in words.items():
            k = get(w)
            if k is not None:
                known.append(k)
                times.append(n)
            elif (cost := self.backoff(w)) is not None:
                total += n * cost
                seen += n
        if known:
            total += np.array(times, float) @ self.rows[0][known]
            seen += sum(times)
        mean = total / max(seen, 1)
        best = int(np.argmin(mean))
        return self.langs[best], float(1 / np.sum(10.0 ** (mean[best] - mean)))


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """A model from every word of the sample; ``per_lang`` bounds the documents it is learnt from, and so what is broadcast."""
    with Tables() as tables:
        return Model(sorted((r.lang, r.word, r.n) for r in word_counts(sample_labelled(docs, tables, per_lang)).toLocalIterator()))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for whole texts; only the text decides.

    No letters or null text: ``und`` with score 0; a model without languages: all ``und``. A null doc_id isn't
    held out; repeated rows are one row each; an empty table gives none; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            got = [m.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return d.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_digest(docs: DataFrame) -> DataFrame:
    """``identify`` by a model of the same table; nulls, repeats and empty tables as there, tables without labels give ``und``."""
    return identify(docs, train(docs))


def accepts(model: Model, text: str | None, label: str | None, least: float = LEAST, sure: float = SURE) -> bool:
    """Whether a document is in some language, and in the one it is said to be in.

    Rejected are texts that no language explains (``und``), texts for which no language is more likely than all
    others together (``least``), and labels that a sure prediction of another language contradicts. A label that
    was never learnt is not contradicted. A model without languages accepts every text with a letter.
    """
    if not model.langs:
        return LETTERS.search(lettered(text or "")) is not None
    lang, score = model.predict(text)
    return lang != UNKNOWN and score >= least and not (label != lang and score >= sure and label in model.langs)


def keep_identified(docs: DataFrame, model: Model, least: float = LEAST, sure: float = SURE) -> DataFrame:
    """The documents that ``accepts`` takes, as they came; an empty table gives an empty one, repeated rows are judged alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text, label = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        m = shared.value
        for batch in batches:
            stays = [accepts(m, t.as_py(), x.as_py(), least, sure) for t, x in zip(batch.column(text), batch.column(label))]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
