"""Sharding, spelling variants and fill-in-middle against brute force, on nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lendgrid.llm import fim, sharding, spelling
from tests.llm.test_corpus import corpus, docs  # noqa: F401

# --- sharding -----------------------------------------------------------------------------------


def test_fisher_yates_is_even():
    seen = Counter(tuple(sharding.fisher_yates(3, s)) for s in range(6000))
    assert len(seen) == 6 and all(abs(n - 1000) < 150 for n in seen.values())
    assert sharding.fisher_yates(0, 1) == [] and sharding.fisher_yates(1, 1) == [0]


def test_shards(spark, corpus):  # noqa: F811
    d = docs(spark, corpus)
    rows = sharding.shard_digest(d).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _, _ in corpus)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values()) and {len(s) for s in shards.values()} <= {len(rows) // 40, len(rows) // 40 + 1}
    assert len(shards) == 40 and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert sharding.shard_digest(docs(spark, [])).count() == 0
    assert sorted((r.shard, r.slot) for r in sharding.shard_digest(docs(spark, corpus[:3])).collect()) == [(0, 0), (13, 0), (26, 0)]


def test_order_depends_on_rows_alone(spark, corpus):  # noqa: F811
    key = lambda r: (-1 if r.row.doc_id is None else r.row.doc_id, r.row.text or "", r.row.source or "")
    order = lambda d, **k: [key(r) for r in sharding.shuffled(d, bucket_bytes=4000, **k).orderBy("position").collect()]
    d = docs(spark, corpus)
    one = order(d)
    assert one == order(d.orderBy(F.rand()).repartition(7)) and one != order(d, seed=12) and one != sorted(one)
    assert sharding.shuffled(d).select("row.*").columns == d.columns


def test_shuffle_follows_the_method(spark, corpus):  # noqa: F811
    """Places of a table in one bucket, from the hashes and the swaps written out."""
    d = docs(spark, corpus[:50])
    named = sorted((r.h, r.doc_id) for r in d.select("doc_id", F.xxhash64(F.lit(11), *d.columns).alias("h")).collect())
    rng, place = random.Random(11 * 0x9E3779B1).random, list(range(50))
    for i in reversed(range(1, 50)):
        j = int(rng() * (i + 1))
        place[i], place[j] = place[j], place[i]
    got = {r.row.doc_id: r.position for r in sharding.shuffled(d).collect()}
    assert got == {doc: p for (_, doc), p in zip(named, place, strict=True)}


def test_heavy_copies_are_spread(spark):
    rows = [(7, "same " * 20, None, "s")] * 600 + [(1000 + i, "other text", None, None) for i in range(300)]
    out = sharding.shuffled(docs(spark, rows), bucket_bytes=4000)
    at = [(r.position, r.row.doc_id) for r in out.select("position", "row").collect()]
    assert sorted(p for p, _ in at) == list(range(900)) and Counter(i for _, i in at)[7] == 600
    quarters = Counter(p // 225 for p, i in at if i == 7)
    assert all(100 < quarters[q] < 200 for q in range(4))


def test_written_shards(spark, corpus, tmp_path):  # noqa: F811
    sharding.write_shards(docs(spark, corpus), str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(corpus) and back.select("shard").distinct().count() == 5


# --- spelling variants --------------------------------------------------------------------------

FOLD = str.maketrans(spelling.UPPER, spelling.LOWER)


def letters(c):
    return "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ"


def counted(rows):
    n = Counter()
    for i, t, _, _ in rows:
        run = ""
        for c in (t or "") + " ":
            if letters(c):
                run += c
            elif run:
                w = run.translate(FOLD)
                h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
                if h % 97 == 0:
                    w = w[: h % len(w)] + w[h % len(w) + 1 :]
                n[w] += 1
                run = ""
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def variants(n):
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) <= 1 and distance(v, w) == 1] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    def root(w):
        return root(form[w]) if w in form else w
    return {(w, form.get(w), root(w), k, len(near[w]), n[form[w]] if w in form else None) for w, k in n.items()}


def noisy(rng, base, n):
    out = []
    for _ in range(n):
        w = list(rng.choice(base))
        if rng.random() < 0.3:
            at = rng.randrange(len(w))
            w[at : at + rng.choice((0, 1))] = rng.choice(("", "x", "é", "ÿ", "E"))
        out.append("".join(w))
    return " ".join(out)


def rows_of(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 9))) for _ in range(25)]
    rows = [(i, noisy(rng, base, 120), "en", "s") for i in range(40)]
    rows.append((93, "chainaa " * 3 + "chainab " * 8 + "chainbb " * 20, "en", "s"))
    return [*rows, (90, None, None, None), (91, "", None, None), (None, "abcde " * 4 + base[0] * 2, None, None), (92, "z" * 70_000 + " " + "z" * 69_999, None, None), (3, rows[3][1], None, None), *[(100 + i, "Straße ×÷ STRASSE Ærøskøbing \U0001d400bcdef", None, None) for i in range(3)]]


def as_set(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling(spark, seed):
    rows = rows_of(seed)
    want = variants(counted(rows))
    got = as_set(spelling.spelling_variants(docs(spark, rows)))
    assert got == want and ("chainaa", "chainab", "chainbb", 3, 1, 8) in want


def test_spelling_of_crowded_shards(spark, monkeypatch):
    """Shards larger than a task may hold are dealt in chunks and pieces, whatever the levels can part."""
    monkeypatch.setattr(spelling, "SHARD", 8)
    monkeypatch.setattr(spelling, "PAIRS", 16)
    rows = rows_of(3)
    assert as_set(spelling.spelling_variants(docs(spark, rows))) == variants(counted(rows))


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(docs(spark, [])).count() == 0
    assert as_set(spelling.spelling_variants(docs(spark, [(1, "alone alone alone", None, None)]))) <= {("alone", None, "alone", 3, 0, None)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abpqé", min_size=1, max_size=9), min_size=1, max_size=40, unique=True))
def test_trie(words):
    found = {frozenset((words_[i], t.words[j])) for t in [spelling.Trie(words)] for words_ in [words] for i, j in t.near(words)}
    assert found == {frozenset((a, b)) for a in words for b in words if distance(a, b) == 1}


# --- fill in the middle -------------------------------------------------------------------------


def plain_fim(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


SHA = lambda t: hashlib.sha256(t.encode()).hexdigest()


def test_fim(spark, corpus):  # noqa: F811
    rows = [*corpus, (3000, "with <P> inside", None, None), (3001, "<M>", None, None), (3002, "é𝄞" * 40_000, None, None), *[(4000 + i, "<" * (i % 5) + "P>S>" * i, None, None) for i in range(60)]]
    got = Counter(tuple(r) for r in fim.fim_digest(docs(spark, rows)).collect())
    want = Counter()
    for i, t, _, _ in rows:
        *x, out = plain_fim(i, t)
        want[(i, *x, SHA(out), SHA(t or ""))] += 1
    assert got == want and {k[2] for k in want} == {"plain", "psm", "spm"}
    assert fim.fim_digest(docs(spark, [])).count() == 0
    texts = {(r.doc_id, r.form, r.output, r.row.size) for r in fim.outputs(docs(spark, rows)).collect()}
    assert texts == {(i, plain_fim(i, t)[1], plain_fim(i, t)[4], "x") for i, t, _, _ in rows}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="a<PSM>é𝄞\n", max_size=60), st.integers(0, 60), st.integers(0, 60), st.sampled_from(["psm", "spm"]), st.integers(1, 9))
def test_frames(text, x, y, form, frame):
    before, fim.FRAME = fim.FRAME, frame
    try:
        f = fim.Frames()
        f.add(text)
        a, b = sorted((x % (len(text) + 1), y % (len(text) + 1)))
        assert "".join(f.read(a, b)) == text[a:b] and f.n == len(text)
        if not any(m in text for m in ("<P>", "<S>", "<M>")):
            out = fim.arranged(f, form, a, b)
            parts = {"<P>": text[:a], "<S>": text[b:], "<M>": text[a:b]}
            marks = ("<P>", "<S>", "<M>") if form == "psm" else ("<S>", "<P>", "<M>")
            assert "".join(out.read()) == "".join(m + parts[m] for m in marks)
            assert "".join(p for s in fim.restored_spans(out, form) for p in out.read(*s)) == text
    finally:
        fim.FRAME = before


def test_only_cut_frames_are_opened(monkeypatch):
    f = fim.Frames()
    f.add("abcdefgh" * 40_000)
    opened = []
    real = fim._open
    monkeypatch.setattr(fim, "_open", lambda frame: opened.append(1) or real(frame))
    out = fim.arranged(f, "psm", 100_001, 200_001)
    assert len(opened) == 4 and len(f.data) == 20  # the frames of both cuts, once for each side
    assert out.sha256() == SHA("<P>" + ("abcdefgh" * 40_000)[:100_001] + "<S>" + ("abcdefgh" * 40_000)[200_001:] + "<M>" + ("abcdefgh" * 40_000)[100_001:200_001])
