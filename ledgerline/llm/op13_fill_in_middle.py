"""Fill-in-the-middle: texts cut at two boundaries found by a learned rank index, and put together anew around markers.

A text's units (code points, or words with what follows them) have boundaries, byte offsets in its UTF-8 form: boundary r
is where unit r begins, and the last one is the text's end. The rank index fits all of them by pieces of straight lines,
each as long as one line stays within ERROR bytes of every boundary that it covers, and stores what the lines miss by as one
byte a boundary. A cut at rank r is predicted by its piece and corrected by the stored residual, which is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes by which a line may miss a boundary; residuals fit a signed byte.
ERROR = 100
#: Boundaries that a piece is tried on at first; twice as many each time that one line still fits.
STEP = 256
#: Markers of the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: Texts of a batch's bytes that one result holds at most, or a single text.
BYTES = 16 << 20
UNITS = ("char", "word")
_WORD = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+(?:[\x20\x09-\x0D]+\Z)?")


def boundaries(text: bytes, unit: str = "char") -> np.ndarray:
    """Offsets at which a text's units begin, and its end. White space belongs to the word after it, at the end to the last."""
    if unit == "char":
        starts = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    else:
        starts = np.array([m.start() for m in _WORD.finditer(text)] or [0] * bool(text), np.int64)
    return np.append(starts, len(text))


@dataclass(frozen=True)
class RankIndex:
    """Pieces (first rank, offset there, bytes a rank) and the residual of every boundary."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residuals: np.ndarray

    def offset(self, rank: int) -> int:
        """The exact offset of a boundary: its piece's prediction, corrected."""
        i = int(np.searchsorted(self.first, rank, "right")) - 1
        return _line(self.base[i], self.slope[i], rank - self.first[i]) + int(self.residuals[rank])


def _line(base, slope, ranks):
    return base + np.rint(slope * ranks).astype(np.int64)


def fitted(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """Pieces through ascending offsets, each from its first boundary on as far as one slope keeps all within error (1 to 127).

    The slopes that keep a boundary within error are a range; a piece ends where the ranges so far have nothing in common.
    """
    first, base, slope, residuals = [], [], [], np.empty(len(offsets), np.int8)
    at, n = 0, len(offsets)
    while at < n:
        low, high, end, size = -np.inf, np.inf, at + 1, STEP
        while end < n:
            ranks = np.arange(end - at, min(n, end + size) - at, dtype=np.float64)
            rise = (offsets[end : end + size] - offsets[at]).astype(np.float64)
            lows = np.maximum(np.maximum.accumulate((rise - error + 0.5) / ranks), low)
            highs = np.minimum(np.minimum.accumulate((rise + error - 0.5) / ranks), high)
            apart = lows > highs
            fit = int(apart.argmax()) if apart.any() else len(ranks)
            if fit:
                low, high, end = lows[fit - 1], highs[fit - 1], end + fit
            if fit < len(ranks):
                break
            size *= 2
        m = 0.0 if end == at + 1 else (low + high) / 2
        first.append(at)
        base.append(int(offsets[at]))
        slope.append(m)
        residuals[at:end] = offsets[at:end] - _line(base[-1], m, np.arange(end - at))
        at = end
    return RankIndex(np.array(first, np.int64), np.array(base, np.int64), np.array(slope), residuals)


def framed(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    """The parts of a text in the order of the form: plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle)."""
    p, s, m = (x.encode() for x in MARKS)
    return {"plain": prefix + middle + suffix, "psm": p + prefix + s + suffix + m + middle, "spm": s + suffix + p + prefix + m + middle}[form]


def restored(output: bytes, form: str) -> bytes:
    """The text that framed was given, from its output and form; the text must not hold a marker."""
    if form == "plain":
        return output
    p, s, m = (x.encode() for x in MARKS)
    a, b = (p, s) if form == "psm" else (s, p)
    one, _, rest = output[len(a) :].partition(b)
    two, _, middle = rest.partition(m)
    return one + middle + two if form == "psm" else two + middle + one


def transformed(docs: DataFrame, unit: str = "char", prefix: str = "1:", plain: int = 90, spm: int = 20, error: int = ERROR) -> DataFrame:
    """docs (doc_id, text) in fill-in-the-middle form.

    Rows (doc_id, n units, form, prefix_chars, middle_chars (units; null if plain), output, restored, output_sha256,
    restored_sha256, pieces of the index). Of the hex sha256 of prefix and doc_id, the first four groups of eight digits
    are h1 to h4: the cuts are the smaller and the larger of h1 % (n + 1) and h2 % (n + 1); the form is plain if
    h3 % 100 >= plain, if the text is empty or holds a marker, else spm if h4 % 100 < spm, else psm.

    Defined results: a null text is empty; a null doc_id hashes as an empty one; each row is by itself, so repeated rows
    give repeated results; a text of any length is cut whole, with memory for one text and its index; an empty table gives
    an empty result; other columns are not read.
    """
    if unit not in UNITS or not 1 <= error <= 127:
        raise ValueError(f"unknown unit {unit!r} or error {error} out of 1 to 127")
    seed = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored", "output_sha256", "restored_sha256", "pieces"]

    def cut(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32()]

        def told(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            rows, held = [], 0
            text_of = batch.column("text").cast(pa.binary())
            for i, (doc, seed) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("seed").to_pylist(), strict=True)):
                text = text_of[i].as_py() or b""
                h1, h2, h3, h4 = (int(seed[j : j + 8], 16) for j in (0, 8, 16, 24))
                index = fitted(boundaries(text, unit), error)
                n = len(index.residuals) - 1
                if not text or h3 % 100 >= plain or any(m.encode() in text for m in MARKS):
                    form, a, b = "plain", None, None
                    out = text
                else:
                    form = "spm" if h4 % 100 < spm else "psm"
                    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                    x, y = index.offset(a), index.offset(b)
                    out = framed(form, text[:x], text[x:y], text[y:])
                back = restored(out, form)
                rows.append((doc, n, form, a, None if b is None else b - a, out.decode(), back.decode(), sha256(out).hexdigest(), sha256(back).hexdigest(), len(index.first)))
                held += 2 * len(out)
                if held >= BYTES:
                    yield told(rows)
                    rows, held = [], 0
            if rows:
                yield told(rows)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", seed.alias("seed")).mapInArrow(cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string, output_sha256 string, restored_sha256 string, pieces int")
