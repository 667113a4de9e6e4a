"""SentencePiece (BPE) encoding with the original byte span of every piece, and decoding.

A text is normalised by the model's compiled character map: at each place the
longest key of its double-array trie is replaced, and each normalised character
keeps the byte of the text that it came from. The normalised text is cut where no
piece can reach across (before a run of the space mark), each distinct chunk of a
block is merged once, best score first and leftmost among equals, and the pieces'
character positions are read through the alignment: (begin, end) in bytes of the
original UTF-8 text. As the library does it, a character spelled in byte pieces
gives its span to the last of them, the others are empty at its begin.

Cases: a null or empty text has no pieces and decodes to the empty text; null ids
and repeated rows are kept; other columns are not looked at. A text is held whole
by one task (some 60 bytes a character while it is worked on), never cut. Models
of another kind than BPE with byte fallback, or with pieces that are user-defined
or unused, are refused with ValueError.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import id_and_text, row_chunks, table_batch
from tillroll.llm.words import ragged

MARK = "▁"  # stands for a space in pieces
#: Bytes of text that a task works on at once.
CHUNK_BYTES = 4 << 20
#: Chunks of more symbols are merged one by one with a heap, others as rows of a matrix of one of these widths.
WIDTHS = (6, 9, 12, 16, 24, 40)
NONE = np.int32(2**31 - 1)
CODES = 0x110000


# -------------------------------------------------------------------- model
def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, message[at:at + size]
            at += size


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie over UTF-8 bytes, then the replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size:]
        starts = bytes(b for b in range(256) if self.units and self._child(self._offset(self.units[0]), b) is not None)
        self.start = re.compile(b"[" + b"".join(b"\\x%02x" % b for b in starts) + b"]") if starts else None
        self.memo: dict[bytes, tuple[int, str]] = {}

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    def _child(self, node: int, byte: int) -> int | None:
        at = node ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, text: bytes, at: int) -> tuple[int, str]:
        """(bytes of the longest key at a place, its replacement), or (0, "")."""
        node, found = self._offset(self.units[0]), (0, "")
        for end in range(at, len(text)):
            node = self._child(node, text[end])
            if node is None:
                break
            unit = self.units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                begin = self.units[node] & 0x7FFFFFFF
                found = end + 1 - at, self.texts[begin:self.texts.index(b"\0", begin)].decode()
        return found

    def spots(self, text: bytes) -> Iterator[tuple[int, int, str]]:
        """(place, bytes, replacement) of every replaced key, from left to right."""
        at = 0
        while self.start and (hit := self.start.search(text, at)):
            at = hit.start()
            size, new = self.longest(text, at)
            if size:
                yield at, size, new
            at += size or 1  # the bytes after a character's first are no start of a key


class PieceModel:
    """A BPE model with byte fallback, from the bytes of its file."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        parts = list(fields(model))
        trainer = dict(fields(next((v for f, v in parts if f == 2), b"")))
        norm = dict(fields(next((v for f, v in parts if f == 3), b"")))
        pieces = [dict(fields(v)) for f, v in parts if f == 1]
        kinds = [p.get(3, 1) for p in pieces]
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0) or {4, 5} & set(kinds):
            raise ValueError("only BPE models with byte fallback, without user-defined or unused pieces")
        self.map = CharacterMap(norm.get(2, b""))
        self.prefix, self.trim, self.escape = bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1))
        self.plain = self.map.start is None and not self.trim and self.escape
        names = [p[1].decode() for p in pieces]
        normal = [k for k, kind in enumerate(kinds) if kind == 1]
        self.byte_ids = np.array([names.index(f"<0x{b:02X}>") for b in range(256)])
        #: Symbols: the normal pieces first, then characters that are only parts of pieces, then CODES unknown ones.
        symbol = {names[k]: n for n, k in enumerate(normal)}
        self.symbol_id = np.array(normal)
        self.n_pieces = len(symbol)
        for c in sorted({c for k in normal for c in names[k]} - set(symbol)):
            symbol[c] = len(symbol)
        self.n = len(symbol)
        self.length = np.array([len(s) for s in symbol])
        self.of_code = np.arange(CODES, dtype=np.int32) + np.int32(self.n)
        for s, n in symbol.items():
            if len(s) == 1:
                self.of_code[ord(s)] = n
        self.code = np.arange(CODES + self.n, dtype=np.int64) - self.n
        self.code[[n for s, n in symbol.items() if len(s) == 1]] = [ord(s) for s in symbol if len(s) == 1]
        scores = np.array([struct.unpack("<f", pieces[k][2])[0] if 2 in pieces[k] else 0.0 for k in normal])
        rank = np.unique(-scores, return_inverse=True)[1]
        table = {symbol[s[:k]] * (self.n + CODES) + symbol[s[k:]]: n for s, n in symbol.items() if n < self.n_pieces
                 for k in range(1, len(s)) if s[:k] in symbol and s[k:] in symbol}
        self.keys = np.array(sorted(table), np.int64)
        self.to = np.array([table[k] for k in self.keys.tolist()], np.int32)
        self.rank = rank[self.to].astype(np.int32) if len(self.to) else np.zeros(0, np.int32)
        #: A piece with the space mark after another character would reach over the cuts.
        self.cut = not any(MARK in s.lstrip(MARK) for s in symbol)

    # -------------------------------------------------------- normalisation
    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """(normalised text, for each of its characters and its end the byte of the text it came from)."""
        raw = text.encode()
        out, at, lead, done = [], [], [], 0  # lead: place in ``out`` of the replacement that a space begins; -1: kept
        n = head = 0  # head: where the text begins behind leading spaces
        heading = self.trim

        def add(new: str, where: np.ndarray, first: np.ndarray):
            nonlocal n
            out.append(new)
            at.append(where)
            lead.append(first)
            n += len(new)

        def copy(end: int):
            nonlocal heading, head
            part = raw[done:end]
            if heading:
                spaces = len(part) - len(part.lstrip(b" "))
                head, heading = done + spaces, spaces == len(part)
            starts = np.flatnonzero(np.frombuffer(part, np.uint8) & 0xC0 != 0x80)
            add(part.decode(), starts + done, n + np.arange(len(starts)))

        for place, size, new in self.map.spots(raw):
            copy(place)
            heading = heading and new == " "
            done = place + size
            head = done if heading else head
            inner = np.arange(len(new)) >= len(new) - len(new.lstrip(" "))
            add(new, np.full(len(new), place), np.where(inner, -1, n))
        copy(len(raw))
        norm, where, end = "".join(out), np.concatenate(at).astype(np.int64), len(raw)
        if self.trim:  # spaces that begin a replacement (or a copied character) go after a space and at the start
            if heading:
                return "", np.array([0])
            code, first = np.frombuffer(norm.encode("utf-32-le"), "<u4"), np.concatenate(lead)
            space = np.concatenate([[True], code == 32])  # of the character before
            keep = ~(space[1:] & (first >= 0) & space[np.maximum(first, 0)])
            norm, where = code[keep].tobytes().decode("utf-32-le"), where[keep]
        if self.prefix and raw:
            norm, where = " " + norm, np.concatenate([[head], where])
        norm = norm.replace(" ", MARK) if self.escape else norm
        if self.trim and (kept := len(norm.rstrip(MARK if self.escape else " "))) < len(norm):
            norm, where, end = norm[:kept], where[:kept], int(where[kept])
        return norm, np.append(where, end)

    def _block(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Normalised texts, and the alignments of all characters and ends, one text after the other."""
        if not self.plain:
            both = [self.normalise(t) for t in texts]
            return [t for t, _ in both], np.concatenate([w for _, w in both] or [np.zeros(0, np.int64)])
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        starts = np.flatnonzero(raw & 0xC0 != 0x80)
        chars = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(chars) - chars
        size = np.diff(np.append(starts, len(raw))[np.append(first, len(starts))])
        ahead = (chars > 0) * int(self.prefix)
        place = ragged(np.cumsum(ahead + chars + 1) - chars - 1, chars)
        out = np.zeros(int((ahead + chars + 1).sum()), np.int64)
        out[place] = starts - np.repeat(np.cumsum(size) - size, chars)
        out[np.cumsum(ahead + chars + 1) - 1] = size
        lead = MARK if self.prefix else ""
        return [t and lead + t.replace(" ", MARK) for t in texts], out

    # --------------------------------------------------------------- merges
    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the table of merges; -1: none."""
        key = left.astype(np.int64) * (self.n + CODES) + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((right >= 0) & (self.keys[at] == key), at, -1) if len(self.keys) else np.full(key.shape, -1)

    def _merge_rows(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, their final symbols) of a matrix of symbols, -1 behind each row's end."""
        who = np.arange(len(rows))
        pair = self._pairs(rows[:, :-1], rows[:, 1:])
        rank_of = np.append(self.rank, NONE)
        rank = rank_of[pair]
        while len(who):
            if not rank.shape[1]:
                yield who, rows
                return
            j = rank.argmin(1)
            over = rank[np.arange(len(who)), j] == NONE
            if over.any():
                yield who[over], rows[over]
                live = ~over
                who, rows, pair, rank, j = who[live], rows[live], pair[live], rank[live], j[live]
                if not len(who):
                    return
            line = np.arange(len(who))
            rows[line, j] = self.to[pair[line, j]]
            col = np.arange(rows.shape[1] - 1)
            rows = np.take_along_axis(rows, col + (col > j[:, None]), 1)
            col = np.arange(pair.shape[1] - 1)
            pair = np.take_along_axis(pair, col + (col >= j[:, None]), 1)
            for k, ok in ((j, j < pair.shape[1]), (j - 1, j > 0)):  # the pairs on both sides of the merged one
                at = line[ok]
                pair[at, k[ok]] = self._pairs(rows[at, k[ok]], rows[at, k[ok] + 1])
            rank = rank_of[pair]

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same for one long chunk: a heap of (rank, place) over a linked list."""
        n, base = len(symbols), self.n + CODES
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        table = self._long_table()
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int):
            if 0 <= i and after[i] < n and (hit := table.get(symbols[i] * base + symbols[after[i]])):
                heapq.heappush(heap, (hit[0], i, symbols[i], symbols[after[i]]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i] = table[left * base + right][1]
            alive[j], after[i] = False, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return [s for s, a in zip(symbols, alive) if a]

    def _long_table(self) -> dict[int, tuple[int, int]]:
        if not hasattr(self, "_table"):
            self._table = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.to.tolist())))
        return self._table

    def _symbols(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(final symbols of all chunks one after the other, how many each has)."""
        size = np.array([len(c) for c in chunks], np.int64)
        flat = self.of_code[np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")]
        begin = np.cumsum(size) - size
        count, parts = np.zeros(len(chunks), np.int64), []
        low = 0
        for width in WIDTHS:
            at = np.flatnonzero((size > low) & (size <= width))
            low = width
            if not len(at):
                continue
            rows = np.full((len(at), width), -1, np.int32)
            col = np.arange(width)
            inside = col < size[at, None]
            rows[inside] = flat[ragged(begin[at], size[at])]
            for who, final in self._merge_rows(rows):
                there = final >= 0
                count[at[who]] = there.sum(1)
                parts.append((at[who], final[there]))
        for k in np.flatnonzero(size > low).tolist():
            got = self._merge_long(flat[begin[k]:begin[k] + size[k]].tolist())
            count[k] = len(got)
            parts.append((np.array([k]), np.array(got, np.int32)))
        out, first = np.zeros(int(count.sum()), np.int32), np.cumsum(count) - count
        for at, symbols in parts:
            out[ragged(first[at], count[at])] = symbols
        return out, count

    def _pieces(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, characters that each takes, ids of each chunk); all but the last byte piece of a character take none."""
        symbols, count = self._symbols(chunks)
        known = symbols < self.n_pieces
        ids = self.symbol_id[np.where(known, symbols, 0)]
        chars = np.where(known, self.length[np.where(known, symbols, 0)], 1)
        odd = np.flatnonzero(~known)
        if len(odd):
            codes, which = np.unique(self.code[symbols[odd]], return_inverse=True)
            spelled = [chr(c).encode() for c in codes.tolist()]
            width = np.ones(len(symbols), np.int64)
            width[odd] = np.array([len(s) for s in spelled])[which]
            last = np.cumsum(width) - 1
            whole = np.zeros(int(width.sum()), np.int64)
            taken = np.zeros_like(whole)
            whole[last], taken[last] = ids, chars
            whole[ragged(last[odd] - width[odd] + 1, width[odd])] = self.byte_ids[np.frombuffer(b"".join([spelled[k] for k in which.tolist()]), np.uint8)]
            owner = np.repeat(np.arange(len(chunks)), count)
            count = np.bincount(owner, weights=width, minlength=len(chunks)).astype(np.int64)
            ids, chars = whole, taken
        return ids, chars, count

    # --------------------------------------------------------------- blocks
    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends, offsets): text k has the pieces offsets[k]:offsets[k + 1], spans in its bytes."""
        norm, align = self._block(texts)
        data = "".join(norm).encode()
        size = np.array([len(t.encode()) for t in norm] or [0], np.int64)
        starts = (np.cumsum(size) - size)[size > 0]
        raw = np.frombuffer(data, np.uint8)
        if self.cut and len(raw) > 2:
            mark = np.zeros(len(raw) + 3, bool)  # shifted by three: whether a mark ends before the place
            a, b, c = MARK.encode()
            mark[3:-2] = (raw[:-2] == a) & (raw[1:-1] == b) & (raw[2:] == c)
            begins = mark[3:] & ~mark[:-3]
            begins[starts] = True
            starts = np.flatnonzero(begins)
        ends = np.append(starts, len(raw)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        ids, chars, count = self._pieces(coded.dictionary.to_pylist())
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        take = ragged((np.cumsum(count) - count)[at], count[at])
        ids, chars = ids[take].astype(np.int32), chars[take]
        text_of = np.searchsorted(np.cumsum(size), starts, side="right")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(text_of, weights=count[at], minlength=len(texts)).astype(np.int64))])
        # A text has one more aligned place than characters: its end.
        first = np.cumsum(chars) - chars + np.repeat(np.arange(len(texts)), np.diff(offsets))
        return ids, align[first], align[first + chars], offsets

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


_loaded: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model of a file that every executor has, loaded once for each Python worker."""
    if path not in _loaded:
        with open(path, "rb") as f:
            _loaded[path] = PieceModel(f.read())
    return _loaded[path]


# ---------------------------------------------------------------- operators
def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, begins, ends of every document: equal-length arrays, spans in bytes of its UTF-8 text."""
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.list_(pa.int32())) for c in ("ids", "begins", "ends"))])

    def step(batches):
        for rows, texts in row_chunks(batches, CHUNK_BYTES):
            *columns, offsets = load(model).encode(texts)
            lists = [pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(c.astype(np.int32))) for c in columns]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *lists], schema=schema)

    return id_and_text(docs).mapInArrow(step, "doc_id bigint, ids array<int>, begins array<int>, ends array<int>")


def decode(pieces: DataFrame, model: str) -> DataFrame:
    """doc_id and the text of (doc_id, ids); null ids give the empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def step(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                yield table_batch({"doc_id": part.column("doc_id"), "text": [load(model).decode(x or []) for x in part.column("ids").to_pylist()]}, schema)

    return pieces.select("doc_id", "ids").mapInArrow(step, "doc_id bigint, text string")


def report(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and spans_crc32: of all begins, then all ends, as
    little-endian 32-bit integers. Encoded, projected and decoded in one pass, so that ids never leave the task."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string()), ("spans_crc32", pa.int64())])

    def step(batches):
        own = load(model)
        spelled = np.array([str(k) for k in range(len(own.library))], object)
        for rows, texts in row_chunks(batches, CHUNK_BYTES):
            ids, begins, ends, offsets = own.encode(texts)
            begins, ends = begins.astype("<i4"), ends.astype("<i4")
            cuts = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
            digest = [hashlib.sha256(",".join(spelled[ids[i:j]]).encode()).hexdigest() for i, j in cuts]
            decoded = [hashlib.sha256(own.decode(ids[i:j].tolist()).encode()).hexdigest() for i, j in cuts]
            spans = [zlib.crc32(ends[i:j].tobytes(), zlib.crc32(begins[i:j].tobytes())) for i, j in cuts]
            yield table_batch({"doc_id": rows.column("doc_id"), "n_tokens": np.diff(offsets), "ids_sha256": digest,
                               "decoded_sha256": decoded, "spans_crc32": spans}, schema)

    return id_and_text(docs).mapInArrow(step, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_crc32 bigint")
