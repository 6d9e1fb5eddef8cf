"""Byte-level BPE by longest matches and backtracking, without a merge loop."""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

CACHE_PIECES, CACHE_BYTES = 1 << 17, 48


class Codec:
    """Encoder and decoder for one rank table.

    A sequence of tokens is what the merges give exactly if every adjacent pair is compatible, that
    is, if merging the two tokens' bytes keeps the border between them. So a piece is encoded by
    taking the longest token at each position and, where it is incompatible with its left neighbour,
    the next shorter one; if none fits, the last token is shortened. Positions found to be dead
    ends are marked and not tried again, which bounds the work by the piece's length.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {i: b for b, i in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        usable = set()
        for b, i in sorted(ranks.items(), key=lambda x: x[1]):
            if len(b) == 1:
                usable.add(b)
            elif (halves := self._last_merge(b, i)) is not None:
                self.parts[i] = halves
                usable.add(b)
        self.shorter: dict[int, int] = {}
        self.find = ahocorasick.Automaton()
        for b in usable:
            self.find.add_word(b.decode("latin-1"), ranks[b])
            head = b[:-1]
            while head and head not in usable:
                head = head[:-1]
            self.shorter[ranks[b]] = ranks[head] if head else -1
        self.find.make_automaton()

    def _last_merge(self, b: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens that the merges join last into ``b``; None if they never give ``b``."""
        parts = [b[k : k + 1] for k in range(len(b))]
        while len(parts) > 2:
            best, at = rank, -1
            for k in range(len(parts) - 1):
                r = self.ranks.get(parts[k] + parts[k + 1], rank)
                if r < best:
                    best, at = r, k
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes end in these two tokens; memoised.

        Undo the two merge histories from the latest step back. At each step the tokens facing each
        other across the border must not have merged before the step just undone: the lower rank
        goes first, and of equal ranks the one further left.
        """
        known = self.fits.get((left, right))
        if known is not None:
            return known
        token, ranks, parts = self.token, self.ranks, self.parts
        a, b, ok = left, right, True
        before = (1 << 62, 0)
        while True:
            joint = ranks.get(token[a] + token[b])
            if joint is not None and (joint, 1) < before:
                ok = False
                break
            ha, hb = parts.get(a), parts.get(b)
            if ha is None and hb is None:
                break
            if hb is None or (ha is not None and a > b):
                before, a = (a, 1), ha[1]
            else:
                before, b = (b, 2), hb[0]
        if len(self.fits) > 1 << 20:
            self.fits.clear()
        self.fits[left, right] = ok
        return ok

    def encode_piece(self, b: bytes) -> list[int]:
        whole = self.ranks.get(b)
        if whole is not None:
            return [whole]
        text, n = b.decode("latin-1"), len(b)
        longest = lambda at: next(self.find.iter_long(text, at))[1]
        out, at, dead = [], 0, bytearray(n + 1)
        token = longest(0)
        while at < n:
            while token >= 0:
                end = at + len(self.token[token])
                if not dead[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest(at) if at < n else -1
            else:
                dead[at] = 1
                token = out.pop()
                at -= len(self.token[token])
                token = self.shorter[token]
        return out

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. Frequent pieces come from a bounded cache."""
        pieces, out = self.pieces, []
        for p in self.pattern.findall(text):
            ids = pieces.get(p)
            if ids is None:
                got = self.encode_piece(p.encode("utf-8"))
                ids = struct.pack(f"<{len(got)}I", *got)
                if len(p) <= CACHE_BYTES:
                    if len(pieces) >= CACHE_PIECES:
                        pieces.clear()
                    pieces[p] = ids
            out.append(ids)
        return b"".join(out)

    def decode_packed(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I")))


def read_ranks(path: str) -> bytes:
    """The rank file as it is, read on the driver; its size is the vocabulary's, not the data's."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def codec(rank_file: bytes, pattern: str) -> Codec:
    """One codec a process; executors' workers keep it from task to task."""
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in rank_file.splitlines() if x)}
    return Codec(ranks, pattern)


def tokenized(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int), decoded (binary): the operator's real output. Null text: empty."""
    return _coded(docs, path, pattern, "doc_id long, ids array<int>, decoded binary", _ids)


def bpe_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for whole texts.

    Null and empty texts give no tokens and the digests of nothing; repeated rows and null doc_ids
    stay one row each; other columns are not read. No special tokens are produced.
    """
    return _coded(docs, path, pattern, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)


def _coded(docs: DataFrame, path: str, pattern: str, schema: str, give) -> DataFrame:
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        c = codec(ranks.value, pattern)
        for batch in batches:
            yield give(c, batch.column(0), batch.column(1))

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def _digests(c: Codec, ids, texts):
    n, enc, dec = [], [], []
    for t in texts:
        packed = c.encode_packed(t.as_py())
        n.append(len(packed) // 4)
        enc.append(hashlib.sha256(packed).hexdigest())
        dec.append(hashlib.sha256(c.decode_packed(packed)).hexdigest())
    return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(enc, pa.string()), pa.array(dec, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _ids(c: Codec, ids, texts):
    packed = [c.encode_packed(t.as_py()) for t in texts]
    lists = pa.array([list(memoryview(p).cast("I")) for p in packed], pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([ids, lists, pa.array([c.decode_packed(p) for p in packed], pa.binary())], ["doc_id", "ids", "decoded"])
