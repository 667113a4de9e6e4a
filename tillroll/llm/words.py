"""Words of a batch of texts as numpy ids, by Arrow's compiled string kernels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Byte tables for bytes.translate. LOWER lower-cases A-Z only. WORD also turns every ASCII
#: byte but digits and letters into a space; bytes above 127 stay, as parts of words.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


class Words:
    """``ids``: the batch's words in order, as positions in ``distinct`` (an Arrow array);
    text k has ``ids[offsets[k]:offsets[k + 1]]``."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, distinct: pa.Array):
        self.ids, self.offsets, self.distinct = ids, offsets, distinct

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def strings(self) -> list[str]:
        return self.distinct.to_pylist()

    def binary(self) -> list[bytes]:
        return self.distinct.cast(pa.binary()).to_pylist()


def split_words(texts: list[str], table: bytes | None = WORD) -> Words:
    """Words between ASCII white space (0x09-0x0D, 0x20) after mapping bytes by ``table``."""
    arr = pa.array(texts, pa.string())
    if table is not None and len(arr):
        _, offsets, data = arr.buffers()
        if data is not None:
            arr = pa.Array.from_buffers(pa.string(), len(arr), [None, offsets, pa.py_buffer(data.to_pybytes().translate(table))])
    lists = pc.ascii_split_whitespace(arr)
    flat, offsets = lists.values, lists.offsets.to_numpy().astype(np.int64)
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        flat = flat.filter(pa.array(full))
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
    coded = flat.dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets, coded.dictionary)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start..start+length-1 of each pair, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)
