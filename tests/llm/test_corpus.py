"""The ten corpus operators against brute force, on nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings, strategies as st

from lendgrid.llm import bpe, hnsw, html_text, katz, langid, licences, lines, mixing, mtree, simhash
from lendgrid.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, Fp int, kept int"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def docs(spark, rows):
    """(doc_id, text, lang, source) rows, with columns that clash with names inside the operators."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "x", 1, 2) for i, t, lang, s in rows], DOCS)


def words(rng, n, vocab=400):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % vocab}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randint(1, 60)), "en", f"s{i % 4}") for i in range(120)]
    rows += [(1000 + i, rows[3][1], "en", "s0") for i in range(5)]
    rows += [(2000, None, None, None), (2001, "", "en", None), (2002, " \t\n", "en", "s1"), (None, "null id here", "en", "s2"), (2003, words(rng, 9000), "en", "s3"), (7, rows[7][1], "en", "s3")]
    return rows


# --- licences -----------------------------------------------------------------------------------


def test_licences(spark):
    mit = licences.TEMPLATES["MIT"]
    rows = [
        (1, "Some words.\nLicensed under CC BY-NC 4.0.\nmore words", None, None), (2, mit.replace(". ", ".\n"), None, None), (3, "nothing here at all", None, None),
        (4, None, None, None), (5, "", None, None), (6, mit.upper() + " " + "tail " * 10, None, None), (7, "x y z " * 30000, None, None), (8, mit[:200], None, None),
    ]
    got = {r.doc_id: r for r in licences.scanned(docs(spark, rows)).collect()}
    assert got[1].licence == "CC-BY-NC-4.0 notice" and got[1].dice == 1.0 and got[1].found[0].first_line == 1
    assert got[2].licence == "MIT" and got[6].licence == "MIT"
    assert [got[k].licence for k in (3, 4, 5, 7, 8)] == [None] * 5
    assert licences.scanned(docs(spark, [])).count() == 0


def test_licences_inside_documents():
    s, around = licences.Scanner(licences.TEMPLATES, licences.LEAST), "some words before and after " * 40
    for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0 header", "GPL-3.0 header"):
        text = licences.TEMPLATES[name]
        third = len(text) // 3
        laid_out = "\n\n".join([around, text[:third].rsplit(" ", 1)[0], text[len(text[:third].rsplit(" ", 1)[0]) :].strip(), around])
        (got,) = [x for x in s.scan(laid_out) if x[0] == name]
        assert got == (name, 1.0, 2, 4)
    assert s.scan("This library of ours is released under the MIT License. See the wiki for more of this and that.") == [("MIT notice", 1.0, 0, 0)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from("licensed under the apache license version 2 0 mit gnu general public this work is".split()), max_size=30))
def test_size_bounds_lose_no_template(tokens):
    s = licences.Scanner(licences.TEMPLATES, 0.5)
    pairs = licences.bigrams(tokens)
    best = max(((2 * len(pairs & g) / (len(pairs) + len(g)), n) for g, n in zip(s.grams, s.names)), default=(0, ""), key=lambda x: x[0])
    got = s.best(tokens)
    assert (got is None) == (best[0] < 0.5) and (got is None or math.isclose(got[0], best[0]))


def test_windows_equal_brute_force():
    """For each template the best of all runs of words, whatever they begin and end with, is the best that ``windows`` finds."""
    rng, found = random.Random(11), 0
    for turn in range(120):
        letters = "abcdefgh"[: rng.choice((3, 5, 8))]
        templates = {f"t{k}": " ".join(rng.choices(letters, k=rng.randint(2, 14))) for k in range(4)}
        words = rng.choices(letters, k=rng.randint(0, 40))
        if turn % 2:
            part = templates["t1"].split()
            words[len(words) // 2 : len(words) // 2] = part[: rng.randint(2, len(part))]
        least = rng.choice((0.5, 0.8, 0.9))
        got = licences.Scanner(templates, least).windows(words)
        for name, text in templates.items():
            grams = licences.bigrams(text.split())
            dice = lambda a, b: 2 * len(licences.bigrams(words[a : b + 1]) & grams) / (len(licences.bigrams(words[a : b + 1])) + len(grams))  # noqa: B023, E731
            every = [dice(a, b) for a in range(len(words)) for b in range(a + 1, len(words))]
            mine = [(d, a, b) for d, a, b, n in got if n == name]
            assert all(d == dice(a, b) >= least for d, a, b in mine)
            assert max((d for d, _, _ in mine), default=None) == max((d for d in every if d >= least), default=None), (words, text)
            found += bool(mine)
    assert found > 100


# --- embeddings ---------------------------------------------------------------------------------


def vectors(n=300, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dim))
    v = [(i, (base[i % 12] + rng.normal(size=dim) * (0.03 if i % 3 else 0.5)).astype(np.float32).tolist(), int(i % 12 % 2)) for i in range(n)]
    v += [(n + i, v[5][1], v[5][2]) for i in range(4)] + [(n + 10, v[5][1], 1 - v[5][2]), (n + 11, [2 * x for x in v[5][1]], v[5][2])]
    v += [(n + 20, None, 1), (n + 21, [0.0] * dim, 1), (n + 22, [float("nan")] * dim, 1), (n + 23, [None] + [1.0] * (dim - 1), 1), (n + 24, v[0][1], None), (n + 25, [float("inf")] * dim, 0), (n + 26, [], 0), (n + 27, [1.0], 0)]
    return v


def frame(spark, v):
    return spark.createDataFrame([(*x, 5) for x in v], "vec_id long, embedding array<float>, label int, rep int")


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_near_vectors(spark, shard_rows):
    v = vectors()
    good = [x for x in v if x[2] is not None and x[1] and None not in x[1] and np.isfinite(x[1]).all() and any(x[1])]
    links, comp = defaultdict(set), {x[0]: x[0] for x in v}
    for a in good:
        for b in good:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.98:
                    links[a[0]].add(b[0])
    for _ in range(len(v)):
        new = {i: min([comp[i], *(comp[j] for j in links[i])]) for i in comp}
        if new == comp:
            break
        comp = new
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_vectors(frame(spark, v), shard_rows=shard_rows).collect()}
    assert got == {i: (len(links[i]), comp[i], comp[i] == i) for i in comp}
    assert sum(map(len, links.values())) > 500


def test_near_vectors_empty(spark):
    assert hnsw.near_vectors(frame(spark, [])).count() == 0


@pytest.mark.parametrize("tree_rows", [8192, 50])
def test_top_inner_products(spark, tree_rows):
    v = [(i, x, label) for i, x, label in vectors(dim=8)]
    f = frame(spark, v)
    good = {i: np.floor(256 * np.array(x, float)).astype(np.int64) for i, x, _ in v if x and None not in x and np.isfinite(x).all()}
    want = set()
    for q in good:
        if q % 7 == 0:
            s = sorted((-int(good[q] @ y), i) for i, y in good.items() if i != q and len(y) == len(good[q]))[:5]
            want |= {(q, k, i, -s0) for k, (s0, i) in enumerate(s, 1)}
    got = mtree.top_inner_products(f, f.where("vec_id % 7 = 0"), tree_rows=tree_rows).select("query_id", "rank", "vec_id", "score")
    assert {tuple(r) for r in got.collect()} == want
    assert mtree.top_inner_products(frame(spark, []), frame(spark, [])).count() == 0


# --- byte-level BPE -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    c = bpe.codec(bpe.read_ranks(PATH), PATTERN)
    return c, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=c.ranks, special_tokens={})


def same(coder, text):
    packed = coder[0].encode_packed(text)
    assert list(memoryview(packed).cast("I")) == coder[1].encode_ordinary(text)
    assert coder[0].decode_packed(packed) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("abeinrst hoé\n\t ß日01.,!", max_size=80))
def test_bpe_equals_merges(coder, text):
    same(coder, text)


def test_bpe_on_joined_tokens(coder):
    rng, every = random.Random(2), [b.decode("utf-8", "ignore") for b in coder[0].ranks]
    for _ in range(3000):
        same(coder, "".join(rng.choice(every) for _ in range(rng.randint(1, 5))))
    for text in ("a" * 20000, "ab" * 5000, "日" * 3000, " " * 4000, "!?" * 5000, "<|endoftext|>"):
        same(coder, text)


def test_bpe_digest(spark, coder, corpus):
    want = Counter()
    for i, t, *_ in corpus:
        ids = coder[1].encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.bpe_digest(docs(spark, corpus), PATH, PATTERN).collect())) == want
    full = {r.doc_id: r for r in bpe.tokenized(docs(spark, corpus), PATH, PATTERN).collect()}
    assert full[0].ids == coder[1].encode_ordinary(corpus[0][1]) and bytes(full[0].decoded).decode() == corpus[0][1]
    assert bpe.bpe_digest(docs(spark, []), PATH, PATTERN).count() == 0


# --- HTML ---------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div id="cookie-notice">We use cookies on this long notice of many words indeed.</div>
{article}<aside>Related things</aside><form><label>Mail</label><input></form><section class="comments"><p>First! A long comment of a reader that goes on and on and on.</p></section>
<footer>&copy; me</footer></body></html>"""


def test_html_article():
    a = "<article><h1>A &amp; B</h1><p><b>One  two\n three<br>four<p>Fünf &lt;sechs&gt;.</p><p>x.</p></article>"
    assert html_text.main_text(PAGE.format(article=a)) == "A & B One two three four Fünf <sechs>. x."


def test_html_without_article_tags():
    a = "<div><div>" + "".join(f"<p>Paragraph {i} has some twelve words of running text for the reader here.</p>" for i in range(5)) + "</div></div>"
    got = html_text.main_text(PAGE.format(article=a))
    assert got.startswith("Paragraph 0") and got.endswith("reader here.") and "cookies" not in got and "comment" not in got and "Home" not in got


def test_html_odd_inputs(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p></p>"), (None, "u", "plain words only"), (5, "u", "<article>" + "<p>ab cd</p>" * 20000), (6, "u", "<div><<p>a < b</p"), (1, "u", None)]
    p = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extracted(p).collect()
    assert len(got) == 7 and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == by[3].text == "" and by[None].text == "plain words only" and by[5].text == "ab cd " * 19999 + "ab cd"


def test_html_marks_and_sections(spark):
    text = html_text.main_text
    assert text("<article><p>one</p><![foo bar]><p>two words here</p><![ x") == "one two words here"
    page = "<body><p class='cookie-notice'>We use cookies</p><article><p>Body text of the page goes here.</p><p hidden>no</p><p class=ad>buy</p><p>end</p></article></body>"
    assert text(page) == "Body text of the page goes here. end"
    assert text("<article class='post has-comments'><p>Some text here</p></article>") == "Some text here"
    assert text("<div id=page class=no-sidebar><p>Some text that is long enough</p></div>") == "Some text that is long enough"
    assert text("<form><div class='article social-policy'><p>text of the page</p></div><div class=ad>x</div></form>") == "text of the page"
    cards = "<article>card one</article><article>card two</article>"
    body = "".join(f"<p>Paragraph {i} of a body that is in no article at all, as long as it is.</p>" for i in range(4))
    assert text(cards + f"<div>{body}</div>").startswith("Paragraph 0") and "card" not in text(cards + f"<div>{body}</div>")
    rows = [(i, "u", h) for i, h in enumerate(["<![foo bar]>", "<![ x", "<!", "<", "&#x;", "<a b='", "<![CDATA[x]]>y", "<p>" * 3000 + "deep"])]
    got = {r.page_id: r.text for r in html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == got[1] == "" and got[6] == "y" and got[7] == "deep"


def regions_brute(ratios, scoped):
    """The same by plain sums: kernel, two thresholds, runs with a seed."""
    n, w = len(ratios), [math.exp(-(d * d) / (2 * html_text.SIGMA**2)) for d in range(html_text.REACH + 1)]
    near = [[j for j in range(n) if abs(i - j) <= html_text.REACH] for i in range(n)]
    s = [sum(w[abs(i - j)] * ratios[j] for j in near[i]) / sum(w[abs(i - j)] for j in near[i]) for i in range(n)]
    mean = sum(s) / n
    least = min(math.sqrt(sum((x - mean) ** 2 for x in s) / n), max(s) / 2)
    taken = [False] * n
    for i in (i for i in range(n) if s[i] >= least and s[i] > 0):
        for step in (1, -1):
            j = i
            while 0 <= j < n and s[j] > 0 and s[j] >= html_text.EDGES[int(scoped[j])] * least:
                taken[j] = True
                j += step
    return taken


def test_regions_equal_brute_force():
    rng = random.Random(9)
    for _ in range(300):
        n = rng.randint(1, 40)
        ratios = [rng.choice([0, 0, 0, 1, 3, rng.random() * 100]) for _ in range(n)]
        scoped = [rng.random() < 0.5 for _ in range(n)]
        if any(ratios):
            assert html_text.regions(html_text.smooth(np.array(ratios, float)), np.array(scoped)).tolist() == regions_brute(ratios, scoped)


def test_smoothing_is_gaussian():
    x = np.array([0, 0, 0, 0, 10, 0, 0, 0, 0.0])
    s = html_text.smooth(x)
    assert s.argmax() == 4 and np.allclose(s, s[::-1]) and s[0] == 0


# --- language -----------------------------------------------------------------------------------


def test_language(spark):
    rng, syl = random.Random(3), {"en": "th er on an ing ed", "de": "sch ein ung ch keit üb", "fr": "eau oi ment ç ê qu"}
    say = lambda lang, n: " ".join("".join(rng.choice(syl[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = [(i, say(lang, rng.randint(5, 40)), lang, "s") for i in range(300) for lang in [list(syl)[i % 3]]]
    rows += [(900, None, "en", "s"), (901, "", None, "s"), (902, "123 ... !!", "de", "s"), (903, say("de", 20000), None, "s"), (None, say("fr", 30), "fr", "s"), (904, "日本", None, None)]
    d = docs(spark, rows)
    got = langid.language_digest(d).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and by[903].lang_pred == "de" and by[None].lang_pred == "fr"
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(300))
    out = [by[i].lang_pred == rows[i][2] for i in range(300) if by[i].held_out]
    assert sum(out) / len(out) > 0.95
    model = langid.train(d)
    kept = langid.keep_identified(d, model)
    assert kept.schema == d.schema and {900, 901, 902}.isdisjoint({r.doc_id for r in kept.collect()})
    odd = docs(spark, [(1, say("de", 60), "de", "s"), (2, say("de", 60), "fr", "s"), (3, say("de", 60), None, "s"), (4, say("de", 60), "xx", "s"), (5, say("de", 60) + " " + say("fr", 60), "de", "s")])
    by = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, model).collect()}
    assert by[2][0] == "de" and by[2][1] >= langid.SURE
    assert {1, 3, 4} <= {r.doc_id for r in langid.keep_identified(odd, model).collect()} <= {1, 3, 4, 5}
    assert sorted(r.doc_id for r in langid.keep_identified(odd, model, least=by[5][1] + 1e-9).collect()) == [1, 3, 4]
    named = d.select("*", *[lines.F.lit("x").alias(c) for c in ("n", "__n", "word", "score")])
    assert langid.train(named).index == model.index
    assert {r.lang_pred for r in langid.language_digest(docs(spark, [(1, "ab", None, None)])).collect()} == {"und"}
    assert langid.language_digest(docs(spark, [])).count() == 0


def test_unlabelled_table_keeps_its_documents(spark):
    d = docs(spark, [(1, "plain words", None, None), (2, "12 34", None, None), (3, None, None, None), (4, "", None, None), (5, "übrig", None, None)])
    assert sorted(r.doc_id for r in langid.keep_identified(d, langid.train(d)).collect()) == [1, 5]


def language_brute(train, text, longest=5):
    """Costs by plain counting, one word at a time: the whole word if any language has it, else its longest known n-grams."""
    langs = sorted({lang for lang, _ in train})
    word = {x: Counter() for x in langs}
    for lang, t in train:
        word[lang].update(langid.LETTERS.findall(t.lower()))
    gram = {(x, k): Counter() for x in langs for k in range(1, longest + 1)}
    for x in langs:
        for w, n in word[x].items():
            for k in range(1, longest + 1):
                for i in range(len(w) + 3 - k):
                    gram[x, k][f" {w} "[i : i + k]] += n
    cost = lambda c, y: math.log10(sum(c.values())) - math.log10(c[y]) if c[y] else langid.PENALTY
    total, seen = dict.fromkeys(langs, 0.0), 0
    for w in langid.LETTERS.findall(text.lower()):
        own = None
        if any(w in word[x] for x in langs):
            own = {x: cost(word[x], w) for x in langs}
        for k in range(longest, 0, -1):
            if own is None:
                parts = [f" {w} "[i : i + k] for i in range(len(w) + 3 - k)]
                known = [y for y in parts if any(y in gram[x, k] for x in langs)]
                if known:
                    own = {x: sum(cost(gram[x, k], y) for y in known) / len(known) for x in langs}
        if own is not None:
            seen += 1
            total = {x: total[x] + own[x] for x in langs}
    mean = {x: total[x] / max(seen, 1) for x in langs}
    best = min(langs, key=lambda x: (mean[x], x))
    return best, 1 / sum(10 ** (mean[best] - mean[x]) for x in langs)


def test_language_equals_brute_force():
    rng = random.Random(12)
    letters = {"a": "abcde", "b": "cdefg", "c": "efghij"}
    say = lambda x, n: " ".join("".join(rng.choice(letters[x]) for _ in range(rng.randint(1, 6))) for _ in range(n))
    train = [(x, say(x, 60)) for x in letters for _ in range(3)]
    counts = Counter((x, w) for x, t in train for w in langid.LETTERS.findall(t))
    m = langid.Model([(x, w, n) for (x, w), n in counts.items()])
    for _ in range(300):
        text = say(rng.choice("abc"), rng.randint(1, 12)) + rng.choice(["", " zz", " 123", " ßé a"])
        want, got = language_brute(train, text), m.predict(text)
        assert got[0] == want[0] and math.isclose(got[1], want[1], rel_tol=1e-9)


def test_backoff_gets_shorter():
    m = langid.Model([("a", "thing", 5), ("b", "ding", 5)])
    assert m.predict("thing")[0] == "a" and m.predict("things")[0] == "a" and m.predict("dd")[0] == "b"
    assert m.backoff("§") is not None  # the padding's space is known


# --- lines --------------------------------------------------------------------------------------


def shingle_set(x):
    return {x} if len(x) < lines.SHINGLE else {x[i : i + lines.SHINGLE] for i in range(len(x) - lines.SHINGLE + 1)}


def test_line_components(spark):
    rng = random.Random(11)
    base = [words(rng, 30, 5000) for _ in range(25)]
    rows = []
    for i in range(60):
        ls = []
        for _ in range(rng.randint(1, 5)):
            w = rng.choice(base).split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = "changed"
            ls.append(" ".join(w) if rng.random() < 0.9 else words(rng, 12, 5000))
        rows.append((i, "\n".join(ls), "en", "s"))
    rows += [(100, None, None, None), (101, "", None, None), (102, "\n\n  \n", None, None), (103, "Ti.\nti. \nTi.", None, None), (104, words(rng, 8000, 5000), None, None), (None, base[0], None, None)]
    flat = [(i if i is not None else -1, k, x.strip(" \t\r").lower()) for i, t, *_ in rows for k, x in enumerate((t or "").split("\n")) if x.strip(" \t\r")]
    sets, root = [shingle_set(x) for *_, x in flat], list(range(len(flat)))
    top = lambda k: k if root[k] == k else top(root[k])
    for a in range(len(flat)):
        for b in range(a):
            if flat[a][2] == flat[b][2] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    first = {}
    for k, (i, n, _) in enumerate(flat):
        first[top(k)] = min(first.get(top(k), (i, n)), (i, n))
    want = {(i, n): first[top(k)] for k, (i, n, _) in enumerate(flat)}
    fix = lambda x: -1 if x is None else x
    got = {(fix(r.doc_id), r.line_no): (fix(r.keep_doc_id), r.keep_line_no) for r in lines.line_components(docs(spark, rows)).collect()}
    assert got.keys() == want.keys()
    assert sum(got[k] == want[k] for k in want) / len(want) >= 0.99  # banding is a matter of high recall
    kept = {k for k in got if got[k] == k}
    out = {r.doc_id: r.text for r in lines.dedup_lines(docs(spark, rows)).collect()}
    for i, t, *_ in rows:
        if i is not None and t and t.strip():
            left = [x for k, x in enumerate(t.split("\n")) if (i, k) in kept or not x.strip()]
            assert out.get(i, "") == "\n".join(left)
    assert lines.line_components(docs(spark, [])).count() == 0 and lines.dedup_lines(docs(spark, [])).count() == 0
    odd = docs(spark, rows).select("*", *[lines.F.lit(1).alias(c) for c in ("gone", "__gone", "line_no", "norm", "k1", "root")])
    assert lines.dedup_lines(odd).columns == odd.columns and {r.doc_id: r.text for r in lines.dedup_lines(odd).collect()} == out


def line_keys(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "norm string").select(lines.F.xxhash64("norm").alias("k1"), "norm")


def signed(x):
    k = xxhash.xxh64(x.encode(), seed=42).intdigest()
    return k - (1 << 64) if k >> 63 else k


def jaccard(x, y):
    a, b = shingle_set(x), shingle_set(y)
    return len(a & b) / len(a | b)


def band_pairs(spark, texts):
    """All pairs of lines that share a band and agree in enough minima."""
    sigs, met, per = lines.signatures(line_keys(spark, texts)).cache(), set(), defaultdict(list)
    for r in lines.band_rows(sigs, range(lines.DEALS)).collect():
        per[r.band].append(r.k1)
    for r in lines.shared_bands(sigs, range(lines.DEALS)).collect():
        assert (r.first, r.last, r.n) == (min(per[r.band]), max(per[r.band]), len(per[r.band]))
    m = {r.k1: list(r)[1:] for r in sigs.collect()}
    for own in per.values():
        met |= {(a, b) for a in own for b in own if a < b and sum(x == y for x, y in zip(m[a], m[b])) >= lines.AGREE}
    sigs.unpersist()
    return met


def edited(rng, made):
    x = words(rng, rng.randint(8, 30), 5000)
    if made % 3 == 1:
        x = x.replace(" ", "")
    y = list(x)
    if made % 3 == 2:
        y += [" ", rng.choice("0123456789")]
        x += f" {rng.choice('abc')}"
    for k in rng.sample(range(len(y)), max(1, len(y) // rng.choice([40, 50, 60]))):
        y[k] = rng.choice("0123456789é日")
    return x, "".join(y)


def test_bands_find_similar_lines(spark):
    """Measured: of pairs at a Jaccard of 0.80 to 0.85 at least 0.95 share a band, of those above at least 0.98."""
    rng, low, high = random.Random(5), [], []
    while len(low) < 500:
        x, y = edited(rng, len(low) + len(high))
        if x != y and jaccard(x, y) >= 0.8:
            (low if jaccard(x, y) < 0.85 else high).append((x, y))
    met = band_pairs(spark, {z for pair in low + high for z in pair})
    found = lambda made: sum((min(a, b), max(a, b)) in met for x, y in made for a, b in [(signed(x), signed(y))]) / len(made)
    assert found(low) >= 0.95 and found(high) >= 0.98


def test_minima_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [words(rng, n, 5000) for n in (1, 2, 5, 40, 3000)] + ["äöü日本 x", "aaaaaa", "abcde"]
    got = {r.k1: r for r in lines.signatures(line_keys(spark, texts + ["abcd"])).collect()}
    assert len(got) == sum(len(t) >= 5 for t in texts)
    every = sorted({g for t in texts if len(t) >= 5 for g in shingle_set(t)})
    hashed = dict(zip(every, (r[0] for r in spark.createDataFrame([(k, g) for k, g in enumerate(every)], "k int, g string").orderBy("k").select(lines.F.hash(lines.F.encode("g", "UTF-32"))).collect())))
    for t in (t for t in texts if len(t) >= 5):
        assert [got[signed(t)][f"m{i}"] for i in range(lines.MINIMA)] == [min(hashed[g] ^ m for g in shingle_set(t)) for m in lines.MASKS]


def roots_brute(texts):
    pairs = [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8]
    return pairs, components_brute(pairs, range(len(texts)))


def found_roots(spark, texts):
    return {r.doc_id: r.keep_doc_id for r in lines.line_components(docs(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()}


def test_crowded_bands_are_whole(spark):
    """Lines of one template whose own words put them around the threshold: large bands that are no cliques."""
    rng = random.Random(2)
    base = [f"{rng.randrange(10**5):05d}" for _ in range(60)]
    texts = []
    for _ in range(300):
        w = list(base)
        for k in rng.sample(range(60), 3):
            w[k] = f"{rng.randrange(10**5):05d}"
        texts.append(" ".join(w))
    pairs, root = roots_brute(texts)
    near = [p for p in pairs if jaccard(texts[p[0]], texts[p[1]]) < 0.85]
    got = found_roots(spark, texts)
    assert len(near) > 300 and len(set(root.values())) < 150
    assert sum(got[a] == got[b] for a, b in near) / len(near) >= 0.99
    assert len(set(got.values())) <= len(set(root.values())) + 2
    assert all(root[i] == root[got[i]] for i in got)


def test_crowded_bands_lose_no_pair(spark, monkeypatch):
    """300 pairs of lines that share most of a template: each line is similar to its partner alone."""
    rng, texts = random.Random(4), []
    shared = [f"shared{i}" for i in range(20)]
    for i in range(250):
        own = [f"{rng.randrange(10**6):06d}" for _ in range(5)]
        x = " ".join([*shared[:10], *own[:3], *shared[10:], *own[3:]])
        y = " ".join(f"{w[:2]}x{w[3:]}" if w in own[3:] else w for w in x.split())
        texts += [x, y]
    monkeypatch.setattr(lines, "CROWDED", 4)
    monkeypatch.setattr(lines, "SALTED", 20)
    _, root = roots_brute(texts)
    got = found_roots(spark, texts)
    met = band_pairs(spark, texts)
    both = [i for i in range(0, 500, 2) if (min(signed(texts[i]), signed(texts[i + 1])), max(signed(texts[i]), signed(texts[i + 1]))) in met]
    assert len(both) >= 240 and all(got[i] == got[i + 1] for i in both)
    assert all(root[i] == root[got[i]] for i in got)


def test_prefix_pairs_are_complete(spark, monkeypatch):
    monkeypatch.setattr(lines, "SALTED", 3)
    rng = random.Random(3)
    sets = [(i, rng.sample(range(-40, 40), rng.randint(1, 30))) for i in range(60)]
    sets += [(100 + i, (g + [50] if len(g) < 10 else g[1:] + [51]) if i % 2 else g) for i, g in sets]
    s = spark.createDataFrame(sets, "k1 long, g array<int>")
    roots = spark.createDataFrame([(k, k) for k, _ in sets], "k1 long, root long")
    j = {k: {*g} for k, g in sets}
    want = {(a, b) for a in j for b in j if a < b and len(j[a] & j[b]) >= 0.8 * len(j[a] | j[b])}
    with lines.Tables() as tables:
        got = [(min(r.a, r.b), max(r.a, r.b)) for r in lines.similar_pairs(lines.prefix_pairs(s, roots, tables), s).collect()]
    assert len(want) > 50 and len(got) == len(set(got)) and set(got) == want


# --- language model -----------------------------------------------------------------------------


def katz_brute(rows):
    tok = [(i, (t or "").encode().lower().split() + ["</s>"], i is not None and zlib.crc32(str(i).encode()) % 10 == 0) for i, t, *_ in rows]
    u, b = Counter(), Counter()
    for _, w, held in tok:
        if not held:
            u.update(w)
            b.update(zip(["<s>", *w], w))
    n, v = sum(u.values()), len(u)

    def factors(counts):
        c = np.zeros(katz.CUT + 1)
        for x in counts:
            if x <= katz.CUT + 1:
                c[x - 1] += 1
        return katz.discounts(c)

    du, db = factors(u.values()), factors(b.values())
    pu = {w: (du[c] if c <= katz.CUT else 1) * c / n for w, c in u.items()}
    unknown = 1 - sum(pu.values())
    if n and unknown < 1e-9 / n:
        pu = {w: p * n / (n + 1) for w, p in pu.items()}
        unknown = 1 / (n + 1)
    context, alpha = defaultdict(dict), {}
    for (h, w), c in b.items():
        context[h][w] = c
    for h, m in context.items():
        t, k = sum(m.values()), sum((db[c] if c <= katz.CUT else 1) * c for c in m.values())
        t += t - k < 1e-9
        alpha[h] = t, (1 - k / t) / (1 - sum(pu[w] for w in m))
    out = []
    for i, w, held in tok:
        s = base = 0.0
        for h, x in zip(["<s>", *w], w):
            c = context.get(h, {}).get(x, 0)
            s += math.log10((db[c] if c <= katz.CUT else 1) * c / alpha[h][0] if c else (alpha[h][1] if h in alpha else 1) * pu.get(x, unknown))
            base += math.log10((u.get(x, 0) + 0.1) / (n + 0.1 * (v + 1)))
        out.append((i, held, len(w), sum(x in u for x in w), n, round(base, 6), round(s, 6)))
    # every context sums to 1 over all words and the unknown one
    for h, m in list(context.items())[:50]:
        total = sum((db[c] if c <= katz.CUT else 1) * c / alpha[h][0] for c in m.values()) + alpha[h][1] * (unknown + sum(p for w, p in pu.items() if w not in m))
        assert math.isclose(total, 1, rel_tol=1e-9)
    return out


def test_katz(spark, corpus):
    want = Counter(katz_brute(corpus))
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz.language_model_scores(docs(spark, corpus)).collect())
    assert got == want
    assert katz.language_model_scores(docs(spark, [])).count() == 0


def test_katz_small_tables(spark):
    one = [(1, "a b", None, None)]
    assert Counter(katz_brute(one)) == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz.language_model_scores(docs(spark, one)).collect())
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = katz.language_model_scores(docs(spark, [(held, None, None, None)])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (1, 0, 0) and r.score == 0


# --- SimHash ------------------------------------------------------------------------------------


def fp_brute(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))]
    hs = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def components_brute(pairs, nodes):
    root = {n: n for n in nodes}
    for _ in range(len(nodes)):
        new = dict(root)
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b], root[a], root[b])
        if new == root:
            break
        root = new
    return root


def test_simhash(spark, corpus):
    rows = [r for r in corpus if r[0] is not None]
    rows += [(3000 + i, rows[20][1] + f" tail{i}", "en", "s") for i in range(3)]
    fps = {}
    for i, t, *_ in rows:
        fps[i] = fp_brute(t)
    pairs = [(a, b) for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2]
    comp = components_brute(pairs, fps)
    got = simhash.simhash_digest(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", comp[i]) for i in fps}
    kept = simhash.simhash_dedup(docs(spark, corpus))
    assert {r.doc_id for r in kept.select("doc_id").collect()} - {None} == set(components_brute([(a, b) for a, b in pairs if max(a, b) < 3000], [i for i in fps if i < 3000]).values())
    assert simhash.simhash_digest(docs(spark, [])).count() == 0


@pytest.mark.parametrize("crowded", [256, 3])
def test_fingerprint_links_are_complete(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {c for c in centres}
    for c in centres:
        for _ in range(40):
            x = c
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    with simhash.Tables() as tables:
        got = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), tables).collect()}
    assert got <= want
    assert components_brute(got, signed) == components_brute(want, signed)


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {k: v for k, v in components_brute(edges, {x for e in edges for x in e}).items() if k in nodes}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- mixing -------------------------------------------------------------------------------------


def targets_brute(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= 3 * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mix(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, rng.choice([1, 3, 8, 20, 300])), "en", rng.choice(["a", "a", "a", "a", "b", "c", "d", None])) for i in range(900)]
    rows += [(2000, None, None, "a"), (2001, "", None, "z"), (2002, words(rng, 3000), None, "b"), (None, "null id", None, "a"), (3, "again", None, "a"), (3, "again", None, "a")]
    sizes, src = defaultdict(int), {}
    for i, t, _, s in rows:
        sizes[s] += len((t or "").split())
        src[i] = s
    want = targets_brute(sizes)
    d = docs(spark, rows)
    got = mixing.mix_digest(d).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix_digest(d.repartition(3)).collect()))
    taken = defaultdict(int)
    for r in got:
        assert r.taken <= 3 * r.size
        assert math.isclose(r.target, want[src[r.doc_id]], rel_tol=1e-9, abs_tol=1e-9) and r.source_size == sizes[src[r.doc_id]]
        taken[src[r.doc_id]] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.05 * t + 320
    out = mixing.emit_mix(d)
    assert out.schema == d.schema
    assert sum(len((r.text or "").split()) for r in out.collect()) == sum(taken.values())
    assert mixing.mix_digest(docs(spark, [])).count() == 0 and mixing.emit_mix(docs(spark, [(1, None, None, None)])).count() == 0
    odd = d.select("*", *[lines.F.lit(1).alias(c) for c in ("__size", "row", "rank", "bucket", "salt", "copies", "id", "skey")])
    twice = mixing.emit_mix(mixing.emit_mix(odd))
    assert twice.columns == odd.columns and twice.count() > 0
