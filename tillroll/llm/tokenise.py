"""Token ids by a public tokenizer file, with a memo of atoms that tokenise alone.

The tokenizers library encodes under 1 MB a second, but a text's ids are the
ids of its pre-tokens in order, and pre-tokens repeat. A text is cut into atoms
where a pre-token surely begins; the ids of each distinct atom of a block are
taken from a bounded memo, or else from the library. ``ids_of`` therefore equals ``encode`` on the whole
text (tests hold it against that).
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa

from tillroll.llm.common import release_memory
from tillroll.llm.words import ragged

#: Latin letters that lower-case one by one and that no normal form merges with ASCII.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: An atom that is one pre-token of letters, with or without its space.
WORD = re.compile(rf" ?[{LETTERS}]+")
# Classes of bytes, as tables of 256.
_byte = np.arange(256)
ASCII_LETTER = (_byte | 32 >= 97) & (_byte | 32 <= 122) & (_byte < 128)
#: ASCII characters that are neither letters nor white space.
MARK = (_byte > 32) & (_byte < 127) & ~ASCII_LETTER
#: Entries of a memo's younger half.
MEMO_ITEMS = 300_000


class Memo:
    """A bounded map in two generations: what is asked for moves to the younger one; when that is full it
    becomes the older one, and what the older one still held is forgotten."""

    def __init__(self, items: int):
        self.items, self.young, self.old = items, {}, {}

    def many(self, keys: list[str]) -> list[bytes | None]:
        got = list(map(self.young.get, keys))
        if self.old and None in got:
            old, young = self.old.get, self.young
            for k, x in enumerate(got):
                if x is None and (x := old(keys[k])) is not None:
                    got[k] = young[keys[k]] = x
        return got

    def add(self, entries: dict[str, bytes]) -> None:
        self.young.update(entries)
        if len(self.young) > self.items:
            self.old, self.young = self.young, {}

    def rest(self) -> None:
        """Between tasks, when others need the worker's memory, only the younger generation stays."""
        self.old = {}
        release_memory()


_loaded: dict[str, "Encoder"] = {}


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.memo = Memo(MEMO_ITEMS)
        # How the file treats " word": lower-cased or not, with or without its space. An atom of
        # letters then goes to the library's model directly, past normaliser and pre-tokenizer.
        self.spell = {ord(c): self._pre(c) for c in map(chr, [32, *range(65, 91), *range(97, 123), *range(192, 256)])
                      if c not in "×÷"}

    def _pre(self, char: str) -> str:
        n = self.tokenizer.normalizer
        char = n.normalize_str(char) if n else char
        return "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(char))

    def _atoms(self, atoms: list[str]) -> list[bytes]:
        """The ids of each atom, from the library."""
        model, spell, code, word = self.tokenizer.model.tokenize, self.spell, self.code, WORD.fullmatch
        out = [array(code, [t.id for t in model(c.translate(spell))]).tobytes() if word(c) else None for c in atoms]
        if odd := [k for k, x in enumerate(out) if x is None]:
            for k, e in zip(odd, self.tokenizer.encode_batch_fast([atoms[k] for k in odd], add_special_tokens=False)):
                out[k] = array(code, e.ids).tobytes()
        return out

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """One array of ids for each text: its atoms, each looked up once."""
        data = "".join(texts).encode()
        if not data:
            return [np.zeros(0, self.dtype) for _ in texts]
        size = np.array([len(t.encode()) for t in texts], np.int64)
        starts = atom_starts(np.frombuffer(data, np.uint8), (np.cumsum(size) - size)[size > 0])
        offsets = pa.py_buffer(np.append(starts, len(data)))
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        atoms = coded.dictionary.to_pylist()
        got = self.memo.many(atoms)
        if missing := [k for k, x in enumerate(got) if x is None]:
            new = [atoms[k] for k in missing]
            found = self._atoms(new)
            self.memo.add(dict(zip(new, found)))
            for k, x in zip(missing, found):
                got[k] = x
        at = coded.indices.to_numpy(zero_copy_only=False)
        count = np.array(list(map(len, got)), np.int64) // self.dtype.itemsize
        lengths = count[at]
        flat = np.frombuffer(b"".join(got), self.dtype)[ragged((np.cumsum(count) - count)[at], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, np.concatenate([[0], np.cumsum(size)]))]
        return [flat[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]


def atom_starts(raw: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where atoms begin in UTF-8 bytes, given where texts begin: at a space before a character that is no
    space, and behind a letter at a mark or digit. Both file kinds begin a pre-token there."""
    ahead = np.concatenate([raw[1:], np.zeros(2, np.uint8)])
    after, third = ahead[:-1], ahead[1:]
    # U+0021-U+007E and U+00A1-U+02AF behind the space.
    solid = ((after > 32) & (after < 127)) | ((after >= 0xC3) & (after <= 0xC9)) | ((after == 0xC2) & (third >= 0xA1)) \
        | ((after == 0xCA) & (third <= 0xAF))
    begin = (raw == 32) & solid
    # A letter of LETTERS that is not ASCII ends with a byte behind 0xC3; 0x97 and 0xB7 are the signs among them.
    latin = np.concatenate([[False], (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)])
    begin[1:] |= MARK[raw[1:]] & (ASCII_LETTER[raw[:-1]] | latin[:-1])
    begin[texts] = True
    return np.flatnonzero(begin)


def encoder(path: str) -> Encoder:
    """The encoder of a file, loaded once for each Python worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
