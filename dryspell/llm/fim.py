"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put in another order behind marks.

Cuts are drawn in code points, texts are kept as UTF-8 bytes. A sparse index holds the position of each
multibyte character and the bytes that it and those before have in excess of one; a binary search in it turns
code points into bytes and back, and stretches of ASCII need arithmetic only.

A null text is empty, an empty text stays plain. The draw depends on the seed and the ``doc_id`` alone (a null
id draws as empty text), so rows that repeat an id are cut by the same numbers, each within its own length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.llm.words import Texts, pieces

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
ADDED = "output string, form string, n long, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long"


class Exceptions:
    """The multibyte characters of some UTF-8 bytes; everything between them is one byte a character."""

    def __init__(self, data: np.ndarray):
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate((np.zeros(1, np.int64), np.cumsum(extra)))
        self.char = self.byte - self.excess[:-1]

    def bytes_of(self, chars):
        """Byte positions of the characters at these positions; the end of the text is one."""
        return chars + self.excess[np.searchsorted(self.char, chars, side="left")]

    def chars_of(self, at):
        """Character positions of bytes where a character starts, or of the end of the text."""
        return at - self.excess[np.searchsorted(self.byte, at, side="left")]


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def transform(
    docs: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20, marks: tuple[str, str, str] = MARKS
) -> DataFrame:
    """``docs`` with ``output`` and how it was made: ``form`` (``plain``, ``psm`` or ``spm``), ``n`` code points,
    and the length of prefix and middle in code points and in bytes (null where plain).

    ``plain`` of 100 texts stay as they are, as do empty texts and texts that hold a mark already; ``spm`` of 100
    others have the suffix first. Other columns are carried along; those named like an added one are replaced.
    """
    added = [field.split()[0] for field in ADDED.split(", ")]
    others = [c for c in docs.columns if c not in ("doc_id", "text") and c.lower() not in added]
    p, s, m = (mark.encode() for mark in marks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = Texts(batch.column(1))
            index = Exceptions(texts.bytes)
            data, begin = texts.bytes.tobytes(), texts.offsets
            first = index.chars_of(begin)
            size = np.diff(first)
            drawn = np.array([draws(seed, d) for d in batch.column(0).to_pylist()], np.int64).reshape(-1, 4)
            cuts = np.sort(drawn[:, :2] % (size + 1)[:, None], axis=1)
            at = index.bytes_of(first[:-1, None] + cuts)
            outputs, forms = [], []
            for i, (a, e) in enumerate(zip(begin[:-1], begin[1:])):
                text = data[a:e]
                if not text or drawn[i, 2] % 100 >= 100 - plain or p in text or s in text or m in text:
                    outputs.append(text)
                    forms.append("plain")
                    continue
                one, two = at[i]
                if drawn[i, 3] % 100 < spm:
                    outputs.append(b"".join((s, data[two:e], p, data[a:one], m, data[one:two])))
                    forms.append("spm")
                else:
                    outputs.append(b"".join((p, data[a:one], s, data[two:e], m, data[one:two])))
                    forms.append("psm")
            whole = np.array([f == "plain" for f in forms], bool)
            lengths = [cuts[:, 0], cuts[:, 1] - cuts[:, 0], at[:, 0] - begin[:-1], at[:, 1] - at[:, 0]]
            columns = [pa.array(outputs, pa.binary()).cast(pa.string()), pa.array(forms, pa.string()), pa.array(size)]
            columns += [pa.array(x, pa.int64(), mask=whole) for x in lengths]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *added])

    # Other columns go through Python as one, whatever their names.
    rest = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in others]).alias("rest")
    held = docs.select(F.col("doc_id").cast("long"), "text", *([rest] if others else []))
    schema = T.StructType([*held.schema, *T.StructType.fromDDL(ADDED)])
    return held.mapInArrow(cut, schema).select("doc_id", "text", *(["rest.*"] if others else []), *added)


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text of an output: its parts, found by the marks, back in their order."""
    parts = F.split(output, "|".join(rf"\Q{mark}\E" for mark in marks))
    part = lambda k: F.get(parts, F.lit(k))
    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )
