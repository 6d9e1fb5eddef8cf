"""The pipeline against a plain version of each stage."""

import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

from .test_corpus import PATH, PATTERN, components_brute, fp_brute, shingle_set, targets_brute, words

corpus_pipeline = pytest.importorskip("corpus_pipeline")
assert public_tokenizers


def line_stage(rows):
    flat = [(r["doc_id"], k, x.strip(" \t\r").lower()) for r in rows for k, x in enumerate((r["text"] or "").split("\n")) if x.strip(" \t\r")]
    sets = [shingle_set(x) for *_, x in flat]
    pairs = [(a, b) for a in range(len(flat)) for b in range(a) if flat[a][2] == flat[b][2] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = components_brute(pairs, range(len(flat)))
    first = {}
    for k, (i, n, _) in enumerate(flat):
        first[root[k]] = min(first.get(root[k], (i, n)), (i, n))
    gone = {(i, n) for k, (i, n, _) in enumerate(flat) if first[root[k]] != (i, n)}
    out = []
    for r in rows:
        if any(i == r["doc_id"] for i, _ in gone):
            text = "\n".join(x for k, x in enumerate(r["text"].split("\n")) if (r["doc_id"], k) not in gone)
            if text.strip(" \t\r\n"):
                out.append(r | {"text": text, "n_chars": len(text)})
        else:
            out.append(r)
    return out


def mix_stage(rows):
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in rows}
    per = defaultdict(int)
    for r in rows:
        per[r["source"]] += size[r["doc_id"]]
    goal = targets_brute(per)
    out = []
    for s in per:
        def bucket(n):
            return n if n < 100 else len(str(n)) * 100 + int(str(n)[:2])

        def salt(i):
            return int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 64

        own = sorted((r for r in rows if r["source"] == s), key=lambda r: (bucket(size[r["doc_id"]]), salt(r["doc_id"]), size[r["doc_id"]], r["doc_id"]))
        rate = goal[s] / per[s] if per[s] else 0.0
        u = int(hashlib.md5(("mix" + ("null" if s is None else "s" + s)).encode()).hexdigest()[:8], 16) / 2**32
        for k, r in enumerate(own, 1):
            out += [r] * min(3, math.floor(k * rate + u) - math.floor((k - 1) * rate + u))
    return out


def test_pipeline(spark, tmp_path):
    rng = random.Random(21)
    base = [words(rng, 35, 5000) for _ in range(40)]
    rows = []
    for i in range(150):
        text = "\n".join(rng.choice(base) if rng.random() < 0.2 else words(rng, rng.randint(5, 40), 5000) for _ in range(rng.randint(1, 4)))
        rows.append({"doc_id": i, "text": text, "lang": "en", "source": rng.choice(["a", "a", "a", "b", "c", None])})
    rows += [{"doc_id": 500, "text": "123 456", "lang": None, "source": "a"}, {"doc_id": 501, "text": None, "lang": "en", "source": "a"}, {"doc_id": 502, "text": rows[4]["text"], "lang": "en", "source": "b"}]
    rows = [r | {"n_chars": None if r["text"] is None else len(r["text"])} for r in rows]
    spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))

    kept = [r for r in rows if r["text"] and re.search(r"[^\W\d_]", r["text"])]
    kept = line_stage(kept)
    fps = {r["doc_id"]: fp_brute(r["text"]) for r in kept}
    comp = components_brute([(a, b) for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2], fps)
    kept = mix_stage([r for r in kept if comp[r["doc_id"]] == r["doc_id"]])
    ranks = corpus_pipeline.bpe.codec(corpus_pipeline.bpe.read_ranks(PATH), PATTERN).ranks
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in kept:
        ids = enc.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    got = Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert got == want


def test_stages(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "simhash_dedup", "mix", "tokens"]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, extra int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, str(tmp_path))
        assert out.columns == empty.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, str(tmp_path)).count() == 0
