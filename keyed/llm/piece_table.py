"""Fill-in-the-middle by a piece table.

A document is a list of descriptors (buffer, start, length) over immutable buffers: its own UTF-8 text and the sentinels.
Cutting splits a descriptor, an arrangement permutes them, the inverse permutation restores the order of the document, and
hashes stream over the descriptors; no buffer is changed or copied on the way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyed.llm.common import ready, replace_columns

#: Marks before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Descriptors of a marked document in its own order; what stands at each place of the two arrangements.
_MARKED = ("P", "prefix", "M", "middle", "S", "suffix")
ARRANGED = {"psm": ("P", "prefix", "S", "suffix", "M", "middle"), "spm": ("S", "suffix", "P", "prefix", "M", "middle")}
ORDER = {form: [_MARKED.index(x) for x in places] for form, places in ARRANGED.items()}


class PieceTable:
    """Descriptors over buffers. Every operation gives a new list; the buffers are shared."""

    def __init__(self, buffers: Sequence[bytes], pieces: Sequence[tuple[int, int, int]] | None = None):
        self.buffers = buffers
        self.pieces = [(0, 0, len(buffers[0]))] if pieces is None else list(pieces)

    def cut(self, *at: int) -> PieceTable:
        """Splits descriptors at these rising byte positions of the document; each cut adds one, an empty one at a border."""
        out, todo, passed = [], list(at), 0
        for buffer, start, length in self.pieces:
            while todo and passed <= todo[0] <= passed + length:
                left = todo.pop(0) - passed
                out.append((buffer, start, left))
                start, length, passed = start + left, length - left, passed + left
            out.append((buffer, start, length))
            passed += length
        return PieceTable(self.buffers, out)

    def before_each(self, buffers: Sequence[int]) -> PieceTable:
        """A descriptor of a whole buffer before each piece."""
        marked = [((b, 0, len(self.buffers[b])), p) for b, p in zip(buffers, self.pieces, strict=True)]
        return PieceTable(self.buffers, [x for pair in marked for x in pair])

    def permuted(self, order: Sequence[int]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def restored(self, order: Sequence[int]) -> PieceTable:
        """Undoes ``permuted(order)``."""
        return self.permuted(np.argsort(order))

    def every_other(self) -> PieceTable:
        return PieceTable(self.buffers, self.pieces[1::2])

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield memoryview(self.buffers[buffer])[start : start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.stream())


def arrange(text: bytes, form: str, prefix: int, middle_end: int, marks: Sequence[bytes]) -> PieceTable:
    """The document with prefix, middle and suffix cut at these code points, marked and in the order of the form."""
    if form == "plain":
        return PieceTable([text])
    ends = _code_point_starts(text)[[prefix, middle_end]].tolist()
    # buffers 1 to 3 are the marks of prefix, suffix and middle
    return PieceTable([text, *marks]).cut(*ends).before_each([1, 3, 2]).permuted(ORDER[form])


def restore(output: bytes, form: str, marks: Sequence[bytes]) -> PieceTable:
    """The document of an output: descriptors over the output, cut at its marks, put back in order, without the marks."""
    if form == "plain":
        return PieceTable([output])
    by_name = dict(zip("PSM", marks, strict=True))
    cuts, at = [], 0
    for name in ARRANGED[form][::2]:
        at = output.index(by_name[name], at)
        cuts += [at, at + len(by_name[name])]
        at = cuts[-1]
    return PieceTable([output]).cut(*cuts[1:]).restored(ORDER[form]).every_other()


def _code_point_starts(text: bytes) -> np.ndarray:
    """Byte position of every code point, and of the end."""
    codes = np.frombuffer(text, np.uint8)
    return np.append(np.flatnonzero((codes & 0xC0) != 0x80), len(text))


def _checked(sentinels: Sequence[str]) -> list[bytes]:
    """The marks; none may overlap another or itself, so that an output has one reading."""
    marks = [s.encode() for s in sentinels]
    for n, a in enumerate(marks):
        for m, b in enumerate(marks):
            if not a or (n != m and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b) + (n != m)))):
                raise ValueError(f"sentinels {sentinels} overlap")
    return marks


def plan(text: Column, doc_id: Column, sentinels: Sequence[str], seed: str, plain_from: int, spm_below: int) -> dict[str, Column]:
    """Form and cuts of a text, from the SHA-256 of seed and id: n, form, first and second cut (code points)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    n = F.length(text).cast("long")
    marked = F.lit(False)
    for s in sentinels:
        marked = marked | F.contains(text, F.lit(s))
    form = F.when((n == 0) | marked | (h[2] % 100 >= plain_from), "plain").when(h[3] % 100 < spm_below, "spm").otherwise("psm")
    return {"n": n, "form": form, "first": F.least(h[0] % (n + 1), h[1] % (n + 1)), "second": F.greatest(h[0] % (n + 1), h[1] % (n + 1))}


def fill_in_middle(docs: DataFrame, sentinels: Sequence[str] = SENTINELS, seed: str = "1", plain_from: int = 90, spm_below: int = 20, doc_id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """Rearranges each whole text for fill-in-the-middle training.

    Adds n (code points), form (``plain``, ``psm`` or ``spm``), prefix_chars and middle_chars (null if plain), fim_text (if
    ``with_text``), output_sha256 and restored_sha256: the hash of the text rebuilt from the output and the form alone. A text
    that is empty or holds a sentinel stays plain, and so does one whose third number is ``plain_from`` or more of 100.

    A null text is an empty one; a null id is hashed as the text ``null``. Copies and rows with the same id are arranged
    alike if their lengths agree. Other columns are kept, those named like a result give way to it. No rows give no rows.
    There is no shuffle; texts pass through Python in small Arrow batches.
    """
    ready(docs.sparkSession)
    marks = _checked(sentinels)
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    planned = plan(whole, F.col(f"`{doc_id}`"), sentinels, seed, plain_from, spm_below)

    def one(text: bytes, form: str, first: int, second: int) -> dict:
        arranged = arrange(text, form, first, second, marks)
        output = arranged.joined()
        found = {"output_sha256": arranged.sha256(), "restored_sha256": restore(output, form, marks).sha256()}
        return found | {"fim_text": output} if with_text else found

    fields = [("output_sha256", pa.string()), ("restored_sha256", pa.string())] + ([("fim_text", pa.binary())] if with_text else [])

    @F.arrow_udf("struct<" + ",".join(f"{k}:{'binary' if k == 'fim_text' else 'string'}" for k, _ in fields) + ">")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            rows = zip(*(c.to_pylist() for c in columns), strict=True)
            yield pa.array([one(*row) for row in rows], pa.struct(fields))

    made = run(whole.cast("binary"), planned["form"], planned["first"], planned["second"])
    cut = planned["form"] != "plain"
    new = {
        "n": planned["n"],
        "form": planned["form"],
        "prefix_chars": F.when(cut, planned["first"]),
        "middle_chars": F.when(cut, planned["second"] - planned["first"]),
        "__fim": made,
    }
    out = replace_columns(docs, new)
    results = {k: F.col("__fim")[k].cast("string") for k, _ in fields}
    return replace_columns(out, results).drop("__fim")


def restored_text(output: str, form: str, sentinels: Sequence[str] = SENTINELS) -> Column:
    """A column with the texts of outputs of ``fill_in_middle``. A null output or form gives null."""
    marks = _checked(sentinels)

    @F.arrow_udf("binary")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            rows = zip(outputs.to_pylist(), forms.to_pylist(), strict=True)
            yield pa.array([None if o is None or f is None else restore(o, f, marks).joined() for o, f in rows], pa.binary())

    return run(F.col(output).cast("binary"), F.col(form)).cast("string")
