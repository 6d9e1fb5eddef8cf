"""Fill-in-middle over texts stored as independent compressed frames that can be entered anywhere."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

#: The marks of the three parts; a text that holds one of them stays plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points a frame.
FRAME = 1 << 14
#: Percent of documents that are rearranged at most, and percent of these with the suffix first.
SHARE, SUFFIX_FIRST = 90, 20

FRAMES = "struct<ends: array<long>, data: array<binary>>"
_ARROW_FRAMES = pa.struct([("ends", pa.list_(pa.int64())), ("data", pa.list_(pa.binary()))])


class Frames:
    """A text as zstandard frames, with the number of code points up to the end of each."""

    def __init__(self, ends: Sequence[int] = (), data: Sequence[bytes] = ()):
        self.ends, self.data = list(ends), list(data)

    @property
    def n(self) -> int:
        return self.ends[-1] if self.ends else 0

    def add(self, text: str) -> None:
        """Append a text as frames of its own."""
        press = zstandard.ZstdCompressor(level=1)
        for at in range(0, len(text), FRAME):
            piece = text[at : at + FRAME]
            self.ends.append(self.n + len(piece))
            self.data.append(press.compress(piece.encode("utf-8")))

    def copy(self, other: Frames, a: int, b: int) -> None:
        """Append code points a to b of another text: frames that lie inside go over as they are, only the cut ones are opened."""
        k = bisect_right(other.ends, a)
        while a < b:
            start, end = other.ends[k - 1] if k else 0, other.ends[k]
            if a == start and end <= b:
                self.ends.append(self.n + end - start)
                self.data.append(other.data[k])
            else:
                self.add(_open(other.data[k])[a - start : b - start])
            a, k = end, k + 1

    def read(self, a: int = 0, b: int | None = None) -> Iterator[str]:
        """Code points a to b, a frame at a time."""
        b = self.n if b is None else b
        k = bisect_right(self.ends, a)
        while a < b:
            start = self.ends[k - 1] if k else 0
            yield _open(self.data[k])[a - start : b - start]
            a, k = self.ends[k], k + 1

    def find(self, mark: str, at: int) -> int:
        """Where ``mark`` first stands at or after code point ``at``; it may lie across frames."""
        held = ""
        for piece in self.read(at):
            held += piece
            k = held.find(mark)
            if k >= 0:
                return at + k
            keep = min(len(mark) - 1, len(held))
            at, held = at + len(held) - keep, held[len(held) - keep :]
        raise ValueError(f"{mark} is missing")

    def sha256(self, *spans: tuple[int, int]) -> str:
        """Digest of the whole text, or of spans of it one after the other."""
        digest = hashlib.sha256()
        for a, b in spans or ((0, self.n),):
            for piece in self.read(a, b):
                digest.update(piece.encode("utf-8"))
        return digest.hexdigest()


def _open(frame: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(frame).decode("utf-8")


def cuts(doc_id: int | None, n: int, marked: bool) -> tuple[str, int, int]:
    """form, end of the prefix and end of the middle, from the digest of ``1:`` and the doc_id (null: nothing)."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if n == 0 or marked or h3 % 100 >= SHARE:
        return "plain", a, b
    return "spm" if h4 % 100 < SUFFIX_FIRST else "psm", a, b


def arranged(text: Frames, form: str, a: int, b: int) -> Frames:
    """The output in the given form, out of the frames of the text."""
    if form == "plain":
        return text
    parts = {PREFIX: (0, a), SUFFIX: (b, text.n), MIDDLE: (a, b)}
    out = Frames()
    for mark in (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE):
        out.add(mark)
        out.copy(text, *parts[mark])
    return out


def restored_spans(out: Frames, form: str) -> list[tuple[int, int]]:
    """Where the original text stands in an output, in order: found from the output and the form alone."""
    if form == "plain":
        return [(0, out.n)]
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one = out.find(first, 0) + len(first)
    two = out.find(second, one)
    three = out.find(MIDDLE, two + len(second))
    lead, follow, middle = (one, two), (two + len(second), three), (three + len(MIDDLE), out.n)
    return [lead, middle, follow] if form == "psm" else [follow, middle, lead]


def framed(docs: DataFrame) -> DataFrame:
    """row (all columns of ``docs`` but the text, of any name), doc_id, marked, frames: the store of the texts.

    ``marked`` says that a text holds one of the three marks itself. Null text: no frames. A batch is as many rows as the session's
    ``spark.sql.execution.arrow.maxRecordsPerBatch``. The result can be written and read again like any table.
    """
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col("text"), F.lit(mark))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "text"]
    d = docs.select(F.struct(*kept).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(marked, F.lit(False)).alias("marked"), F.coalesce("text", F.lit("")).alias("frames"))
    schema = d.withColumn("frames", F.lit(None).cast(FRAMES)).schema

    def run(batches):
        for batch in batches:
            stored = []
            for t in batch.column("frames"):
                f = Frames()
                f.add(t.as_py())
                stored.append({"ends": f.ends, "data": f.data})
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "doc_id", "marked")), pa.array(stored, _ARROW_FRAMES)], ["row", "doc_id", "marked", "frames"])

    return d.mapInArrow(run, schema)


def fill_in_middle(stored: DataFrame) -> DataFrame:
    """What ``framed`` gives -> row, doc_id, n, form, prefix_chars, middle_chars, frames of the output."""
    schema = stored.select("row", "doc_id", F.lit(0).cast("long").alias("n"), F.lit("").alias("form"), *[F.lit(None).cast("long").alias(f"{c}_chars") for c in ("prefix", "middle")], "frames").schema
    names = schema.fieldNames()

    def run(batches):
        for batch in batches:
            out = [_filled(*x) for x in zip(batch.column("doc_id").to_pylist(), batch.column("marked").to_pylist(), batch.column("frames"), strict=True)]
            columns = [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64(), _ARROW_FRAMES))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *columns], names)

    return stored.mapInArrow(run, schema)


def _filled(doc_id: int | None, marked: bool, stored: pa.StructScalar) -> tuple:
    text = Frames(**stored.as_py())
    form, a, b = cuts(doc_id, text.n, marked)
    out, plain = arranged(text, form, a, b), form == "plain"
    return text.n, form, None if plain else a, None if plain else b - a, {"ends": out.ends, "data": out.data}


def outputs(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` but the text as row; doc_id, form and the output as one string."""
    filled = fill_in_middle(framed(docs))
    schema = filled.select("row", "doc_id", "form", F.lit("").alias("output")).schema

    def run(batches):
        for batch in batches:
            texts = ["".join(Frames(**f.as_py()).read()) for f in batch.column("frames")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "doc_id", "form")), pa.array(texts, pa.string())], ["row", "doc_id", "form", "output"])

    return filled.mapInArrow(run, schema)


def fim_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every whole text.

    Null and empty texts: plain, n 0, the digest of nothing. A null doc_id draws from the digest of ``1:``. Equal ids draw alike, so repeated rows give
    equal rows. An empty table gives an empty one. Columns other than doc_id and text are not read. The restored text is put together from the
    output's own marks, not from the cuts.
    """
    filled = fill_in_middle(framed(docs.select("doc_id", "text"))).drop("row")
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

    def run(batches):
        for batch in batches:
            outs, forms = [Frames(**f.as_py()) for f in batch.column("frames")], batch.column("form").to_pylist()
            made = pa.array([o.sha256() for o in outs], pa.string())
            back = pa.array([o.sha256(*restored_spans(o, form)) for o, form in zip(outs, forms, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")), made, back], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    return filled.mapInArrow(run, schema)


FIM_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS y,
             ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4 FROM d),
f AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b,
             CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""
