"""Katz backoff language model: counted, discounted, normalised and evaluated in buckets of contexts.

Each task turns its documents into chunks and writes, for every bucket of
context words, one compact block: the bigrams of the chunk, their training counts and the documents
they occur in. A bucketed table holds the blocks, so that both later passes find all blocks of a
context together without another shuffle: one pass merges counts and takes the counts of counts, the
other turns merged counts into discounted probabilities and backoff weights and scores the documents.

A context that many tokens follow is dealt over several buckets by the words after it, so no bucket
grows with the commonest word; the sums over such a context are added up from its buckets.

The rounds read the documents anew. Chunks and documents are therefore named by what they hold, never by
their place, so the order of rows may differ from round to round.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .scratch import Tables, release, written

CHUNK_TOKENS, CUT = 1_200_000, 5
#: Bytes of text per bucket: a bucket is one task's work.
BUCKET_BYTES = 8 << 20
#: A context of more tokens is dealt over several buckets, of about so many each. Which words are is estimated on a share of the
#: documents and only sets the layout: every token is counted and scored, however its context is dealt.
PART_TOKENS, SHARE = 350_000, 16
#: The corpus is read once a round, each for its share of the buckets: what is shuffled at once shrinks accordingly.
ROUNDS = 4
BEGIN, END = b"\n<s>", b"\n</s>"  # no word holds white space


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 10 == 0


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed: high bytes of sorted or small numbers nearly vanish."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
        out += [f"{a.dtype.str}{len(a)};".encode(), planes.tobytes()]
    return zstandard.compress(b"".join(out), 1)


def unpack(raw: bytes, most: int = 99) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(raw), 0, []
    while at < len(raw) and len(out) < most:
        end = raw.index(b";", at)
        kind, n = np.dtype(raw[at : at + 3].decode()), int(raw[at + 3 : end])
        at = end + 1 + n * kind.itemsize
        out.append(np.frombuffer(raw, np.uint8, n * kind.itemsize, end + 1).reshape(kind.itemsize, n).T.copy().view(kind).ravel())
    return out


class _Vocabulary(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _hashes(words: _Vocabulary) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _words(batches):
    """Words of the texts by their hash, with their counts as contexts; those met once in a task are left out."""
    words, n = _Vocabulary(), np.zeros(0, np.int64)
    for batch in batches:
        met = [np.zeros(0, np.int64)]
        for text in batch.column(0).cast(pa.binary()):
            w = [BEGIN, *text.as_py().lower().split()]
            met.append(np.fromiter(map(words.__getitem__, w), np.int64, len(w)))
        more = np.bincount(np.concatenate(met), minlength=len(words))
        more[: len(n)] += n
        n = more
    own = n > 1
    yield pa.RecordBatch.from_arrays([pa.array(_hashes(words)[own].view(np.int64)), pa.array(n[own].astype(np.int64))], ["word", "n"])


def _heavy(d: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, of the words that more than about ``PART_TOKENS`` tokens follow, and the number of buckets for each: at most one per so many tokens."""
    n = F.sum("n") * SHARE
    per = d.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARE)) == 0).select("text").mapInArrow(_words, "word long, n long").groupBy("word").agg(n.alias("n"))
    rows = per.where(F.col("n") > PART_TOKENS).collect()
    word, n = np.array([r.word for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows], np.int64)
    order = np.argsort(word)
    return word[order], np.minimum(-(-n[order] // PART_TOKENS), buckets)


def _among(heavy: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """The place of each hash among the heavy ones, -1 for others."""
    if not len(heavy):
        return np.full(len(hashed), -1)
    at = np.minimum(np.searchsorted(heavy, hashed), len(heavy) - 1)
    return np.where(heavy[at] == hashed, at, -1)


def _chunk(docs: list[tuple], ids: list[np.ndarray], words: _Vocabulary, buckets: int, turn: int, heavy: tuple[np.ndarray, np.ndarray]):
    """Rows (kind, bucket, payload) of one chunk: bigrams 'b', words 'u' of this round's buckets, and its documents 'm'."""
    hashed = _hashes(words)
    lengths = np.array([len(x) - 1 for x in ids])
    known = np.array([not d[1] for d in docs])
    doc = np.repeat(np.arange(len(docs), dtype=np.uint32), lengths)
    before, after = np.concatenate([x[:-1] for x in ids]), np.concatenate([x[1:] for x in ids])
    counts = np.bincount(after, weights=np.repeat(known, lengths), minlength=len(words)).astype(np.uint32)
    # A heavy word counts as a context for each of its parts; the word after it says which.
    which = _among(heavy[0], hashed)
    common = np.flatnonzero(which >= 0)
    parts = np.ones(len(words), np.int64)
    parts[common] = heavy[1][which[common]]
    first = np.arange(len(words))
    first[common] = len(words) + np.cumsum(parts[common]) - parts[common]
    word = np.concatenate([np.arange(len(words)), np.repeat(common, parts[common])])
    home = (hashed % np.uint64(buckets)).astype(np.int64)
    place_of = (home[word] + np.arange(len(word)) - first[word]) % buckets
    place_of[: len(words)] = home
    context = first[before]
    if len(common):
        deal = np.flatnonzero(parts[before] > 1)
        context[deal] += (hashed[after[deal]] >> np.uint64(32)).astype(np.int64) % parts[before[deal]]
    own = place_of[context] % ROUNDS == turn
    context, after, doc = context[own], after[own], doc[own]
    # Contexts in the order of their bucket and hash; then one sort gives bigrams, counts and postings.
    order = np.lexsort((hashed[word], place_of))
    place = np.empty(len(word), np.int64)
    place[order] = np.arange(len(word))
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(hashed)] = np.arange(len(words))
    key = place[context] * len(words) + rank[after]
    del before, after, context, own
    if len(key):
        sort = np.argsort(key, kind="stable")
        key, doc = key[sort], doc[sort]
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        times = np.diff(np.append(starts, len(key))).astype(np.uint32)
        train = np.add.reduceat(known[doc].astype(np.int64), starts).astype(np.uint32)
        pre, cur = order[key[starts] // len(words)], np.sort(hashed)[key[starts] % len(words)]
        edges = np.searchsorted(place_of[pre], np.arange(buckets + 1))
        tokens = np.append(starts, len(key))
        for b in range(turn, buckets, ROUNDS):
            lo, hi = edges[b], edges[b + 1]
            if lo < hi:
                p = hashed[word[pre[lo:hi]]]
                runs = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
                yield "b", b, pack(p[runs], np.diff(np.append(runs, hi - lo)).astype(np.uint32), cur[lo:hi], train[lo:hi], times[lo:hi], doc[tokens[lo] : tokens[hi]])
    trained = np.flatnonzero((counts > 0) & (home % ROUNDS == turn))
    trained = trained[np.lexsort((hashed[trained], home[trained]))]
    edges = np.searchsorted(home[trained], np.arange(buckets + 1))
    for b in range(turn, buckets, ROUNDS):
        u = trained[edges[b] : edges[b + 1]]
        if len(u):
            yield "u", b, pack(hashed[u], counts[u])
    yield "m", int(hashed[-1] % np.uint64(buckets)), pack(*_identity(docs), lengths.astype(np.int64))


def _identity(docs: list[tuple]) -> list[np.ndarray]:
    """Ids, which are null, which are held out, and hashes of the texts: documents equal in all of these score alike."""
    return [np.array([d[0] or 0 for d in docs], np.int64), np.array([d[0] is None for d in docs], np.uint8), np.array([d[1] for d in docs], bool), np.array([d[2] for d in docs], np.uint64)]


def _emit(buckets: int, turn: int, heavy: tuple[np.ndarray, np.ndarray]):
    def emit(batches):
        docs, ids, n, words = [], [], 0, _Vocabulary()

        def rows():
            kinds, homes, payloads = zip(*_chunk(docs, ids, words, buckets, turn, heavy))
            chunk = xxhash.xxh64_intdigest(b"".join(x.tobytes() for x in _identity(docs))) >> 1
            return pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(homes, pa.int32()), pa.array([chunk] * len(kinds), pa.int64()), pa.array(payloads, pa.binary())],
                ["kind", "bucket", "chunk", "payload"],
            )

        for batch in batches:
            for doc_id, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                raw = text.as_py()
                w = [BEGIN, *raw.lower().split(), END]
                ids.append(np.fromiter(map(words.__getitem__, w), np.int32, len(w)))
                docs.append((doc_id, held, xxhash.xxh64_intdigest(raw)))
                n += len(w)
                if n >= CHUNK_TOKENS:
                    yield rows()
                    docs, ids, n, words = [], [], 0, _Vocabulary()
        if docs:
            yield rows()

    return emit


def _merged(blocks: list[list[np.ndarray]]):
    """Context, word and count of each distinct bigram, and each block entry's place among them."""
    pre = np.concatenate([np.repeat(b[0], b[1]) for b in blocks])
    cur = np.concatenate([b[2] for b in blocks])
    order = np.lexsort((cur, pre))
    p, c = pre[order], cur[order]
    new = np.concatenate(([True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])))
    starts = np.flatnonzero(new)
    del pre, cur
    p, c = p[starts], c[starts]
    place = np.empty(len(order), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return p, c, np.add.reduceat(np.concatenate([b[3] for b in blocks])[order], starts, dtype=np.int64), place


def _tally(counts: np.ndarray) -> np.ndarray:
    """Counts of the counts 1 to CUT + 1, then the sum and the number of all above 0."""
    return np.append(np.bincount(counts[(counts > 0) & (counts <= CUT + 1)], minlength=CUT + 2)[1:], [counts.sum(), (counts > 0).sum()]).astype(np.int64)


def _count(buckets: int, heavy: np.ndarray):
    """A bucket's tallies ('s'), its words ('u'), the words it must ask for ('a', by their bucket); of each heavy context in it the tally ('t') and the words seen after it ('w', by their bucket)."""

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket, rows = int(pdf["bucket"].iloc[0]), []
        u = [unpack(x) for x in pdf["payload"][pdf["kind"] == "u"]]
        b = [unpack(x, 4) for x in pdf["payload"][pdf["kind"] == "b"]]  # without documents
        tally = [np.zeros(CUT + 3, np.int64)] * 2
        if u:
            w, inverse = np.unique(np.concatenate([x[0] for x in u]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([x[1] for x in u])).astype(np.int64)
            tally[0] = _tally(n)
            rows.append(("u", bucket, -1, pack(w, n)))
        if b:
            pre, cur, n, _ = _merged(b)
            tally[1] = _tally(n)
            which = _among(heavy, pre)
            for h in np.unique(which[which >= 0]):
                own = which == h
                rows.append(("t", -1, int(h), _tally(n[own]).tobytes()))
                for k, w in _asked(cur[own & (n > 0)], buckets):
                    rows.append(("w", k, int(h), pack(w)))
            for k, w in _asked(cur, buckets):
                rows.append(("a", k, bucket, pack(w)))
        rows.append(("s", -1, bucket, np.concatenate(tally).tobytes()))
        return pd.DataFrame(rows, columns=["kind", "to", "source", "payload"])

    return count


def _asked(cur: np.ndarray, buckets: int):
    words = np.unique(cur)
    home = (words % np.uint64(buckets)).astype(np.int64)
    for k in np.unique(home):
        yield int(k), words[home == k]


def _counts(words: pd.DataFrame):
    """hashes -> counts, 0 for words that aren't there."""
    w, n = unpack(words["words"].iloc[0]) if len(words) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def of(q: np.ndarray) -> np.ndarray:
        if not len(w):
            return np.zeros(len(q), np.int64)
        at = np.minimum(np.searchsorted(w, q), len(w) - 1)
        return np.where(w[at] == q, n[at], 0)

    return of


def _answer(key, asks: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
    of = _counts(words)
    return pd.DataFrame([(x.source, x.to, pack(of(unpack(x.payload)[0]))) for x in asks.itertuples()], columns=["bucket", "home", "payload"])


def _seen(uni: np.ndarray):
    """The unigram mass of the words seen after a heavy context, as far as one bucket holds them."""

    def seen(key, asks: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        of, single = _counts(words), unigram_model(uni)
        return pd.DataFrame([(x.source, float(single(of(unpack(x.payload)[0])).sum())) for x in asks.itertuples()], columns=["source", "mass"])

    return seen


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's factors for the counts 0 to CUT (the first unused); 1 where the counts of counts don't allow one."""
    d = np.ones(CUT + 1)
    if n[0] > 0 and (common := (CUT + 1) * n[CUT] / n[0]) < 1:
        for r in range(1, CUT + 1):
            if n[r - 1] > 0 and 0 < (x := ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common)) <= 1:
                d[r] = x
    return d


def unigram_model(n: np.ndarray):
    """counts -> probability; 0 gives that of the one unknown word, what the known ones leave."""
    d, total = discounts(n), float(n[CUT + 1])
    kept = sum(d[r] * r * n[r - 1] for r in range(1, CUT + 1)) + total - sum(r * n[r - 1] for r in range(1, CUT + 1))
    if total - kept < 1e-9:
        total += 1  # nothing was discounted: as if one unknown word had been seen
    unknown = (total - kept) / total if total else 1.0
    return lambda c: np.where(c > 0, np.where(c <= CUT, d[np.minimum(c, CUT)], 1.0) * c / max(total, 1), unknown)


def _whole_contexts(counted: DataFrame, words: DataFrame, number: int, uni: np.ndarray, bi: np.ndarray) -> np.ndarray:
    """Of each heavy context, over all its buckets: its tokens, what discounts leave of them, and the unigram mass of the words seen after it."""
    sums = np.zeros((3, number))
    if number:
        tally, r, d = np.zeros((number, CUT + 3)), np.arange(1, CUT + 1), discounts(bi)[1:]
        for row in counted.where("kind = 't'").select("source", "payload").toLocalIterator():  # 8 numbers for each bucket of a heavy context
            tally[row[0]] += np.frombuffer(row[1], np.int64)
        sums[0] = tally[:, CUT + 1]
        sums[1] = sums[0] + (tally[:, :CUT] * r * (d - 1)).sum(axis=1)
        asks = counted.where("kind = 'w'").select("to", "source", "payload")
        mass = asks.groupBy("to").cogroup(words.groupBy("own")).applyInPandas(_seen(uni), "source int, mass double")
        for row in mass.groupBy("source").agg(F.sum("mass")).toLocalIterator():
            sums[2, row[0]] = row[1]
    return sums


def _score(buckets: int, uni: np.ndarray, bi: np.ndarray, heavy: np.ndarray, whole: np.ndarray):
    """Sums per chunk and document of a bucket's log probabilities, the model's and the base's, its known tokens and all of its tokens."""

    def score(key, pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        b = pdf[pdf["kind"] == "b"]
        if not len(b):
            return pd.DataFrame({"chunk": [], "kind": [], "payload": []})
        blocks = [unpack(x) for x in b["payload"]]
        pre, cur, n, place = _merged(blocks)
        words = np.unique(cur)
        count = np.zeros(len(words), np.int64)
        home = (words % np.uint64(buckets)).astype(np.int64)
        for x in answers.itertuples():
            count[home == x.home] = unpack(x.payload)[0]
        count = count[np.searchsorted(words, cur)]
        single = unigram_model(uni)(count)
        new = np.concatenate(([True], pre[1:] != pre[:-1]))
        starts, context = np.flatnonzero(new), np.cumsum(new) - 1
        per = lambda x: np.add.reduceat(x, starts)
        d = discounts(bi)
        mass = np.where(n <= CUT, d[np.minimum(n, CUT)], 1.0) * n * (n > 0)
        total, kept, met = per(n).astype(float), per(mass), per(np.where(n > 0, single, 0.0))
        which = _among(heavy, pre[starts])
        for of, sums in zip((total, kept, met), whole):
            of[which >= 0] = sums[which[which >= 0]]
        total += (total > 0) & (total - kept < 1e-9)
        alpha = np.where(total > 0, 1 - kept / np.maximum(total, 1), 1.0) / (1 - met)
        seen = n > 0
        logp = np.log10(np.where(seen, mass / np.maximum(total, 1)[context], alpha[context] * single))
        base = np.log10((count + 0.1) / (uni[CUT + 1] + 0.1 * (uni[CUT + 2] + 1)))
        known = (count > 0).astype(float)
        rows, at = [], 0
        for x, block in zip(b.itertuples(), blocks):
            own = np.repeat(place[at : at + len(block[2])], block[4])
            at += len(block[2])
            sums = [np.bincount(block[5], weights=v[own]) for v in (logp, base)]
            rows.append((x.chunk, "p", pack(*sums, np.bincount(block[5], weights=known[own]).astype(np.uint32), np.bincount(block[5]).astype(np.uint32))))
        return pd.DataFrame(rows, columns=["chunk", "kind", "payload"])

    return score


def _documents(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents of a chunk with what its buckets add up to, and how often the chunk was read, ``times``."""
    m = pdf["payload"][pdf["kind"] == "m"]
    ids, missing, held, text, n = unpack(m.iloc[0]) if len(m) else [np.zeros(0, k) for k in (np.int64, np.uint8, bool, np.uint64, np.int64)]
    sums = np.zeros((4, len(ids)))
    for x in pdf["payload"][pdf["kind"] == "p"] if len(m) else ():
        for k, a in enumerate(unpack(x)):
            sums[k, : len(a)] += a
    return pd.DataFrame({
        "doc_id": pd.Series(ids, dtype="Int64").mask(missing.astype(bool)), "held_out": held.astype(bool), "text_hash": text.view(np.int64), "n_tokens": n,
        "times": np.full(len(ids), len(m), np.int64), "met": sums[3].astype(np.int64), "n_known": sums[2].astype(np.int64), "base_score": sums[1], "score": sums[0],
    })


def _whole(parts: DataFrame, total: int) -> DataFrame:
    """A row per document from the sums of its chunks, which every round may have cut anew; an error if rounds did not read the same documents."""
    per = parts.groupBy("chunk").applyInPandas(_documents, "doc_id long, held_out boolean, text_hash long, n_tokens long, times long, met long, n_known long, base_score double, score double")
    per = per.groupBy("doc_id", "held_out", "text_hash", "n_tokens").agg(*[F.sum(c).alias(c) for c in ("times", "met", "n_known", "base_score", "score")])
    same = (F.col("times") % ROUNDS == 0) & (F.col("met") * ROUNDS == F.col("n_tokens") * F.col("times"))
    per = per.where(F.when(same, True).otherwise(F.raise_error(F.lit("documents changed while the model read them")).cast("boolean")))
    per = per.withColumn("copies", (F.col("times") / ROUNDS).cast("long")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    each = lambda c: F.col(c) / F.col("copies")
    return per.select(
        "doc_id", "held_out", "n_tokens", each("n_known").cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        each("base_score").alias("base_score"), each("score").alias("score"),
    )


def language_model_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for whole texts.

    A bigram Katz model of the documents whose id isn't held out, applied to all of them, token by
    token: a seen bigram has its Good-Turing discounted share of its context; any other has the
    context's backoff weight times the word's discounted unigram probability, and a word never
    seen has the unigram mass that discounting left. The weight of a context is its undiscounted
    rest over the unigram mass of the words not seen after it, so each context sums to exactly 1.
    Contexts without any discount count one more event, so that a rest exists.

    Words are held by 64-bit hashes. Null and empty texts hold just the end token; a null doc_id is
    trained on, not held out; repeated rows count each. ``docs`` is read several times, in any order of
    rows; if documents themselves differ between the times, an error says so. No training documents: every
    token is unknown with probability 1, and the base's N and V are 0. An empty table gives none.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out(), F.lit(False)).alias("held"), F.coalesce("text", F.lit("")).alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    heavy = _heavy(d, buckets)
    release(spark)
    name = f"lendgrid_grams_{uuid.uuid4().hex}"
    tables = Tables()
    try:
        for turn in range(ROUNDS):
            grams = d.mapInArrow(_emit(buckets, turn, heavy), "kind string, bucket int, chunk long, payload binary").repartition(buckets, "bucket")
            grams.write.mode("append").option("compression", "none").bucketBy(buckets, "bucket").saveAsTable(name)
            del grams
            release(spark)
        table = spark.table(name)
        counted = tables.written(table.where("kind <> 'm'").groupBy("bucket").applyInPandas(_count(buckets, heavy[0]), "kind string, to int, source int, payload binary"))
        tally = np.zeros(2 * (CUT + 3), np.int64)
        for row in counted.where("kind = 's'").select("payload").toLocalIterator():  # 16 numbers a bucket
            tally += np.frombuffer(row[0], np.int64)
        uni, bi = tally[: CUT + 3], tally[CUT + 3 :]
        asks = counted.where("kind = 'a'").select("to", "source", "payload")
        words = counted.where("kind = 'u'").select(F.col("to").alias("own"), F.col("payload").alias("words"))
        whole = _whole_contexts(counted, words, len(heavy[0]), uni, bi)
        answers = tables.written(asks.groupBy("to").cogroup(words.groupBy("own")).applyInPandas(_answer, "bucket int, home int, payload binary"))
        del asks, words
        tables.discard(counted)  # what was asked goes, here and from the shuffle, before the sums of documents are shuffled
        release(spark)
        sums = table.where("kind = 'b'").groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInPandas(_score(buckets, uni, bi, heavy[0], whole), "chunk long, kind string, payload binary")
        parts = table.where("kind = 'm'").select("chunk", "kind", "payload").union(sums)
        return written(_whole(parts, int(uni[CUT + 1])))
    finally:
        tables.__exit__()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
