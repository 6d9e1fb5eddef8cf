"""Spelling variants: words one edit apart, found in a trie over the counts of letter groups."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import Tables, few, written

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters whose code points agree in their last four bits are a group; groups of frequent letters come first, so that shards named by the first counts are even.
GROUPS = (5, 1, 4, 14, 9, 2, 3, 15, 12, 8, 13, 0, 7, 6, 11, 10)
#: Levels of the trie that may name a shard, and words a shard of it at most; one with more is dealt in chunks.
LEVELS, SHARD = 8, 1 << 15
#: Pairs of a word and a subtree's word that are compared at once.
PAIRS = 1 << 13
#: A word names its form if it is so many times as frequent.
TIMES = 2


def runs(docs: DataFrame) -> DataFrame:
    """run: every maximal run of letters, with A-Z in lower case; one code point is deleted where 97 divides the crc32 of the doc_id and the run.

    A null doc_id counts as an empty string. Null text has no runs.
    """
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    d = docs.select(ident.alias("id"), F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("w"))
    d = d.select("w", F.crc32(F.concat("id", F.lit(":"), "w").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("w")).cast("int")
    less = F.concat(F.substring(F.col("w"), F.lit(1), at), F.substring(F.col("w"), at + 2, F.length("w")))
    return d.select(F.when(F.col("h") % 97 == 0, less).otherwise(F.col("w")).alias("run"))


def vocabulary(docs: DataFrame, least_length: int = 5, least: int = 3) -> DataFrame:
    """word, n: the words of at least so many code points and occurrences. Counts are partial before they move."""
    w = runs(docs).where(F.length("run") >= least_length)
    return w.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _group_count(word: Column, group: int) -> Column:
    letters = "".join(chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)) if c & 15 == group)
    return F.length(word) - F.length(F.translate(word, letters, ""))


def vectors(words: list[str]) -> np.ndarray:
    """Counts of the letter groups of each word, a row a word. Counts over 100 stand as 100, which never parts near words."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    points = np.frombuffer("".join(words).encode("utf-16-le"), dtype=np.uint16)
    cell = np.repeat(np.arange(len(words)), lengths) * 16 + (points & 15)
    counts = np.bincount(cell, minlength=16 * len(words)).reshape(-1, 16)
    return np.minimum(counts, 100).astype(np.int8)[:, list(GROUPS)]


def ends(words: list[str]) -> np.ndarray:
    """The first and last two, and the first and last three code points of each word as numbers; zeros in words under five, or seven, code points."""
    pack = lambda part: sum(ord(c) << 21 * k for k, c in enumerate(part))
    rows = [(pack(w[:2]), pack(w[-2:]), pack(w[:3]), pack(w[-3:])) if len(w) >= 7 else (pack(w[:2]), pack(w[-2:]), 0, 0) if len(w) >= 5 else (0, 0, 0, 0) for w in words]
    return np.array(rows, dtype=np.int64).reshape(-1, 2, 2)


def one_edit(a: str, b: str) -> bool:
    """Whether two different words differ by one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    for x, y in zip(a, b):  # noqa: B905
        if x != y:
            break
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class Trie:
    """Words in the order of their vectors: a node is a range of words that agree in the first counts, its children are the ranges by the next count."""

    def __init__(self, words: list[str]):
        v = vectors(words)
        order = np.lexsort(v.T[::-1])
        self.words, self.v = [words[i] for i in order], v[order]
        self.ends = ends(self.words)

    def near(self, words: list[str]):
        """(i, j) for each word i of ``words`` and word j of the trie that are one edit apart.

        Depth first, with all words that can still reach a node at once. A count above the node's spends a word's surplus, one below its deficit; there is one
        of each to spend, as one edit adds to one group, takes from one, or both. Subtrees of few pairs are compared in all their remaining counts. One edit
        leaves the first or the last two letters of words of five or more, or three of seven or more, as they were; pairs for which that holds are verified letter by letter.
        """
        v, n = (vectors(words), ends(words)), np.arange(len(words))
        stack = [(0, len(self.words), 0, n, np.ones(len(n), np.int8), np.ones(len(n), np.int8))] if len(n) and self.words else []
        while stack:
            lo, hi, depth, q, surplus, deficit = stack.pop()
            if depth == len(GROUPS) or (hi - lo) * len(q) <= PAIRS:
                yield from self._verified(words, v, lo, hi, depth, q, surplus, deficit)
                continue
            column, own = self.v[lo:hi, depth], v[0][q, depth]
            starts = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1, [hi - lo]))
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                more = own - column[a]
                at = np.flatnonzero((more <= surplus) & (-more <= deficit))
                if len(at):
                    more = more[at]
                    stack.append((lo + a, lo + b, depth + 1, q[at], surplus[at] - np.maximum(more, 0), deficit[at] - np.maximum(-more, 0)))

    def _verified(self, words, v, lo, hi, depth, q, surplus, deficit):
        step = max(1, PAIRS // (hi - lo))
        for k in range(0, len(q), step):
            part = slice(k, k + step)
            more = v[0][q[part], None, depth:] - self.v[None, lo:hi, depth:]
            fits = (np.maximum(more, 0).sum(-1) <= surplus[part, None]) & (np.maximum(-more, 0).sum(-1) <= deficit[part, None])
            i, j = np.nonzero(fits)
            i, j = q[k + i], lo + j
            one, other = v[1][i], self.ends[j]
            kept = ((one == other) | (one == 0) | (other == 0)).any(2).all(1)
            for i, j in zip(i[kept].tolist(), j[kept].tolist(), strict=True):
                a, b = words[i], self.words[j]
                if a != b and one_edit(a, b):
                    yield i, j


def _shards(words: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """The words with the name of their shard, and (shard, chunks, pieces) of every shard.

    A shard is named by the counts of the first groups, of as few as leave ``SHARD`` words or fewer in each if that can be. Larger ones are dealt in chunks, and their visitors in pieces.
    """
    levels = [f"k{i}" for i in range(LEVELS)]
    w = words.select("word", "n", *[_group_count(F.col("word"), g).alias(k) for k, g in zip(levels, GROUPS, strict=False)])
    prefix = lambda m: F.concat_ws(".", *levels[:m])
    sizes = w.rollup(*levels).agg(F.count("*").alias("n"), F.grouping_id().alias("g")).groupBy("g").agg(F.max("n").alias("n"))
    largest = {LEVELS - int(r["g"]).bit_length(): r["n"] for r in sizes.collect()}  # a row a level
    depth = next((m for m in range(1, LEVELS) if largest.get(m, 0) <= SHARD), LEVELS)
    keyed = w.select("word", "n", *levels[:depth])
    per = tables.written(keyed.groupBy(*levels[:depth]).agg(F.count("*").alias("n")).withColumn("shard", prefix(depth)))
    own = [F.col(k) for k in levels[:depth]]
    visits = per.select("n", F.explode(_later(own)).alias("shard")).groupBy("shard").agg(F.sum("n").alias("visitors"))
    chunks = F.ceil(F.col("n") / SHARD)
    shards = per.join(visits, "shard", "left").select(
        "shard", chunks.cast("int").alias("chunks"), F.greatest(F.ceil((F.coalesce("visitors", F.lit(0)) + F.when(chunks > 1, F.col("n")).otherwise(0)) / (4 * SHARD)), F.lit(1)).cast("int").alias("pieces")
    )
    return keyed.select("word", "n", prefix(depth).alias("shard"), _later(own).alias("later")), tables.written(shards)


def _later(counts: list[Column]) -> Column:
    """Names of the shards that a word of these counts can be near to and that stand above its own: one count more, and perhaps a later one less."""
    name = lambda c: F.concat_ws(".", *c)
    out = []
    for i in range(len(counts)):
        up = [c + int(j == i) for j, c in enumerate(counts)]
        out.append(name(up))
        out += [name([*up[:j], up[j] - 1, *up[j + 1 :]]) for j in range(i + 1, len(counts))]
    return F.array(*out)


def near_counts(words: DataFrame) -> DataFrame:
    """(word, n), a written table -> word, n_near, best_n, best: how many words are one edit away, and the most frequent of them (the smallest if several are).

    The first levels of the trie name shards, the rest is built where a shard's words meet. A word goes to its own shard and, as a visitor, to those above that
    its surplus and deficit reach, so that each pair is met once; what a shard finds is one row a word, never a row a pair.
    """
    with Tables() as tables:
        w, shards = _shards(words, tables)
        shards = few(shards)
        deal = lambda by, m: F.pmod(F.xxhash64(F.lit(by), "word"), F.col(m)).cast("int")
        all_of = lambda m: F.sequence(F.lit(0), F.col(m) - 1)
        homes = w.select("word", "n", "shard").join(shards, "shard").withColumn("chunk", deal(1, "chunks"))
        trees = homes.select("shard", "chunk", F.explode(all_of("pieces")).alias("piece"), "word", "n", F.lit(0).alias("role"))
        within = homes.where("chunk > 0").select("shard", F.explode(F.sequence(F.lit(0), F.col("chunk") - 1)).alias("chunk"), deal(2, "pieces").alias("piece"), "word", "n", F.lit(1).alias("role"))
        visitors = w.select("word", "n", F.explode("later").alias("shard")).join(shards, "shard")
        visitors = visitors.select("shard", F.explode(all_of("chunks")).alias("chunk"), deal(2, "pieces").alias("piece"), "word", "n", F.lit(1).alias("role"))
        met = trees.unionByName(within).unionByName(visitors).groupBy("shard", "chunk", "piece")
        found = met.applyInPandas(_met, "word string, n_near long, best_n long, best string")
        best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
        out = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
        return written(out.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")))


def _met(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The words of a chunk (role 0) and its visitors (role 1) -> for each word with a near one: their number and the best. Pairs inside the chunk count in its first piece only."""
    home, guests = pdf[pdf["role"] == 0], pdf[pdf["role"] == 1]
    n = dict(zip(pdf["word"], pdf["n"].tolist(), strict=True))
    tree, seen, best = Trie(home["word"].tolist()), defaultdict(int), {}

    def note(a: str, b: str) -> None:
        seen[a] += 1
        if a not in best or (-n[b], b) < best[a]:
            best[a] = (-n[b], b)

    asked = guests["word"].tolist()
    for i, j in tree.near(asked):
        a, b = asked[i], tree.words[j]
        note(a, b)
        note(b, a)
    if key[2] == 0:
        for i, j in tree.near(tree.words):
            note(tree.words[i], tree.words[j])
    return pd.DataFrame([(w, k, -best[w][0], best[w][1]) for w, k in seen.items()], columns=["word", "n_near", "best_n", "best"])


def _roots(forms: DataFrame, tables: Tables) -> DataFrame:
    """(word, form) -> (word, root): each step replaces a word's target by the target's own, so a chain halves. Frequencies at least double along a chain, so there are few steps."""
    at = tables.written(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = tables.written(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        at = step.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of ``documents``.

    ``form`` is the most frequent near word (ties: the smallest by code points) if it is at least twice as frequent, ``root`` the end of the chain of forms.
    Null and empty texts have no words; repeated rows count each; an empty table gives no rows; only doc_id and text are read.
    """
    with Tables() as tables:
        words = tables.written(vocabulary(docs))
        near = tables.keep(near_counts(words))
        formed = F.col("best_n") >= TIMES * F.col("n")
        d = tables.written(words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")
        ))
        roots = _roots(d.where("form IS NOT NULL").select("word", "form"), tables)
        return written(d.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
