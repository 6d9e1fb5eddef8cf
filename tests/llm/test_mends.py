"""Cases that earlier versions got wrong."""

import unicodedata

import numpy as np
import pyarrow as pa
import pickle
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from lendgrid.llm import hnsw, katz, langid, lines, scratch
from tests.llm.test_corpus import corpus, docs, katz_brute  # noqa: F401


def test_letters_are_of_category_l(spark):
    for c in map(chr, range(0x3000)):
        assert bool(langid.LETTERS.fullmatch(langid.lettered(c))) == unicodedata.category(c).startswith("L"), hex(ord(c))
    rows = [(i, "the house and the garden of the king", "en", None) for i in range(40)] + [(100 + k, t, "en", None) for k, t in enumerate(("½ ²", "Ⅷ ①", "12 _ ٣", None))]
    got = {r.doc_id: r for r in langid.language_digest(docs(spark, rows)).collect()}
    assert {got[100 + k].lang_pred for k in range(4)} == {"und"} and got[0].lang_pred == "en"


def test_own_vector_counts_once_whether_a_beam_meets_it_or_not(monkeypatch):
    """Three copies of one vector and two near ones: 2 + 2 links each way, also where the search of a vector misses itself."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    v = np.stack([base, base * 1.0001 + 1e-4, -base])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0, 0], pa.int32()), pa.array([10, 20, 30]), pa.array([3, 2, 1]), pa.array(v.tolist())], ["slot", "name", "copies", "embedding"])
    real = hnsw.links

    def counts():
        row = next(iter(hnsw._build(0.98)([batch])))
        names, n, _ = pickle.loads(row.column(3)[0].as_py())
        return dict(zip(names.tolist(), n.tolist(), strict=True))

    want = {10: 4, 20: 4, 30: 0}
    assert counts() == want
    monkeypatch.setattr(hnsw, "links", lambda *a: [got[got != k] for k, got in enumerate(real(*a))])
    assert counts() == want


def test_clusters_and_lone_vectors(spark):
    """Links of 2,000 clustered and lone vectors against brute force: recall 0.9 or more, none made up, none negative."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(120, 16))
    v = np.concatenate([np.repeat(centres, 12, axis=0) + rng.normal(size=(1440, 16)) * 0.06, rng.normal(size=(560, 16))])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    df = spark.createDataFrame([(i, x.tolist(), "a") for i, x in enumerate(v)], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: r.n_links for r in hnsw.near_vectors(df, shard_rows=700).collect()}
    n = np.array([got[i] for i in range(len(v))])
    assert (n >= 0).all() and (n <= want).all() and n.sum() >= 0.98 * want.sum() > 1000


def _dealt_anew(df, change=False):
    """The rows of ``df`` in an order, and in partitions, that differ each time they are read; with ``change``, so do their texts."""

    def deal(batches):
        rng = np.random.default_rng()
        for b in batches:
            b = b.sample(frac=1, random_state=rng)
            if change:
                b["text"] = [f"{t} {x}" for t, x in zip(b["text"], rng.integers(1 << 60, size=len(b)))]
            yield b.assign(dealt=rng.integers(1 << 40, size=len(b)))

    return df.mapInPandas(deal, T.StructType([*df.schema.fields, T.StructField("dealt", T.LongType())])).repartition(3, "dealt")


def _scores(df):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz.language_model_scores(df).collect())


def test_katz_over_rows_dealt_anew_each_time(spark, corpus):  # noqa: F811
    assert _scores(_dealt_anew(docs(spark, corpus))) == Counter(katz_brute(corpus))


def test_katz_counts_every_copy_of_equal_chunks(spark, corpus):  # noqa: F811
    """Two partitions that hold the same rows in the same order."""
    some = [r for r in corpus[:40]]
    twice = docs(spark, some).coalesce(1).union(docs(spark, some).coalesce(1))
    assert _scores(twice) == Counter(katz_brute(some + some))


def test_katz_reports_documents_that_change(spark):
    rows = [(i, f"some words of document {i}", "en", None) for i in range(30)]
    with pytest.raises(Exception, match="documents changed"):
        katz.language_model_scores(_dealt_anew(docs(spark, rows), True)).collect()


def test_katz_deals_common_contexts_over_buckets(spark, corpus, monkeypatch):  # noqa: F811
    """No bucket holds a common context alone, also one pair too common to be dealt, and scores stay those of whole contexts."""
    monkeypatch.setattr(katz, "PART_TOKENS", 40)
    monkeypatch.setattr(katz, "SHARE", 1)
    some = corpus + [(10_000 + i, " ".join(f"the w{(i * 40 + k) % 700} of" for k in range(40)), "en", None) for i in range(30)]
    df, buckets = docs(spark, some), 16
    assert _scores(df) == Counter(katz_brute(some))
    heavy = katz._heavy(df.fillna("", "text"), buckets)
    the = katz.xxhash.xxh64_intdigest(b"the")
    assert dict(zip(heavy[0].tolist(), heavy[1].tolist()))[the] == buckets
    rows = [(r.doc_id, False, r.text or "") for r in df.select("doc_id", "text").collect()]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])], ["doc_id", "held", "text"])
    held = Counter()
    for turn in range(katz.ROUNDS):
        for out in katz._emit(buckets, turn, heavy)([batch]):
            for r in out.to_pylist():
                if r["kind"] == "b":
                    assert r["bucket"] % katz.ROUNDS == turn
                    pre, runs, _, _, times, _ = katz.unpack(r["payload"])
                    held[r["bucket"]] += int(times[np.repeat(pre, runs) == the].sum())
    assert len(held) == buckets and sum(held.values()) >= 1200 and max(held.values()) < 0.15 * sum(held.values())


def test_line_tables_go_before_lines_are_joined(spark, monkeypatch):
    """When the result is written, of all tables only lines, roots and what keeps a line are left."""
    made = []

    class Counted(lines.Tables):
        def __init__(self):
            super().__init__()
            made.append(self)

        def __exit__(self, *error):
            super().__exit__(*error)
            self.made = []

    left = []
    monkeypatch.setattr(lines, "Tables", Counted)
    monkeypatch.setattr(lines, "written", lambda df: (left.append(sum(len(t.made) for t in made)), scratch.written(df))[1])
    docs = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog\nsomething else altogether"), (2, "the quick brown fox jumps over the lazy dogs")], "doc_id long, text string")
    rows = {(r.doc_id, r.line_no): r.kept for r in lines.line_components(docs).collect()}
    assert rows == {(1, 0): True, (1, 1): True, (2, 0): False} and left == [4]


def test_near_copies_give_few_pairs(spark):
    """200 sets near one base, each with elements of a small pool: any two share rare elements early, but few can be similar."""
    rng = random.Random(8)
    sets = [(i, rng.sample(range(200), 180) + rng.sample(range(1000, 1200), 20)) for i in range(200)]
    sets += [(1000 + i, g[:-1] + [5000 + i]) for i, g in sets[:20]]
    j = {k: {*g} for k, g in sets}
    want = {(a, b) for a in j for b in j if a < b and len(j[a] & j[b]) >= 0.8 * len(j[a] | j[b])}
    roots = spark.createDataFrame([(k, k) for k in j], "k1 long, root long")
    with lines.Tables() as tables:
        got = {(min(r.a, r.b), max(r.a, r.b)) for r in lines.prefix_pairs(spark.createDataFrame(sets, "k1 long, g array<int>"), roots, tables).collect()}
    assert len(want) >= 20 and want <= got and len(got) < len(want) + 200


def test_lines_are_shuffled_a_deal_at_a_time_where_tables_are_not_few(spark, monkeypatch):
    """With no table small enough to broadcast: bands of one deal, an eighth of the lines, some prefixes and pairs at a time; the result is the same."""
    rng = random.Random(11)
    word = lambda: f"{rng.randrange(10**6):06d}"
    base, texts = [word() for _ in range(40)], []
    for _ in range(40):
        w = list(base)
        for k in rng.sample(range(40), 3):
            w[k] = word()
        texts.append(" ".join(w))
    texts += [" ".join(word() for _ in range(12)) for _ in range(30)]
    table = docs(spark, [(i, t, None, None) for i, t in enumerate(texts + texts[:5])])
    want = sorted(map(tuple, lines.line_components(table).collect()))
    deals, text, pairs = [], [], []

    def counted(f, note):
        return lambda *a, **b: (note(*a), f(*a, **b))[1]

    monkeypatch.setattr(scratch, "FEW", 0)
    monkeypatch.setattr(lines, "FEW", 0)
    monkeypatch.setattr(lines, "CROWDED", 4)
    monkeypatch.setattr(lines, "PREFIXES", 2000)
    monkeypatch.setattr(lines, "PAIRS", 30)
    monkeypatch.setattr(lines, "band_rows", counted(lines.band_rows, lambda sigs, of: deals.append(list(of))))
    monkeypatch.setattr(lines, "shingle_sets", counted(lines.shingle_sets, lambda own, wanted: text.append(own.count())))
    monkeypatch.setattr(lines, "similar_pairs", counted(lines.similar_pairs, lambda p, sets: pairs.append(p.count())))
    got = sorted(map(tuple, lines.line_components(table).collect()))
    assert len(got) == 75 and got == want
    assert len(deals) == 2 * lines.DEALS and all(len(d) == 1 for d in deals)
    assert sum(text) == 75 and max(text) < 30 and len(pairs) > 3 and max(pairs) < 60
