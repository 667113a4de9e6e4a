import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from tillroll.llm import piece_encoding as E
from tillroll.llm.queries import PIECE_MODEL, tokenizer_path

BITS = ["a", "b", "é", "ß", " ", "  ", "   ", "\n", "\t", "'s", "1", "22", ".", "日本", "😀", "▁", "▁▁", "\x00", "�", "the", "ing",
        " the", "Ａ", "ﬁ", "ﬃ", "　", "<s>", "<0x41>", "́", "\U0010ffff", "x" * 50, " " * 30, "é"]
#: Replacements with keys that are prefixes of each other, longer and shorter results, spaces and nothing.
MAP = {"Ａ": "A", "ﬁ": "fi", "ﬃ": "ffi", "　": " ", "é": "é", "e": "e", "a": "", "ab": "zz", "\t": " ", "22": "日", "2": "two words", "🏽": ""}


def compiled(mapping):
    """A compiled map as the model files hold it, placed first-fit."""
    texts, where = b"", {}
    for new in mapping.values():
        where[new] = len(texts)
        texts += new.encode() + b"\0"
    trie = {}
    for key, new in mapping.items():
        node = trie
        for byte in key.encode():
            node = node.setdefault(byte, {})
        node[None] = where[new]
    units, used, bases, todo = {0: 0}, {0}, set(), [(0, trie)]
    while todo:
        at, node = todo.pop(0)
        labels = [k or 0 for k in node]
        base = next(b for b in range(1, 1 << 16) if b not in bases and not used & {b ^ k for k in labels})
        bases.add(base)
        used |= {base ^ k for k in labels}
        units[at] |= (at ^ base) << 10 | (1 << 8 if None in node else 0)
        for k, child in node.items():
            units[base ^ (k or 0)] = child | 1 << 31 if k is None else k
            if k is not None:
                todo.append((base ^ k, child))
    array = np.full(-(-(max(units) + 256) // 256) * 256, 1 << 31, "<u4")  # no byte leads to an unused unit
    array[list(units)] = list(units.values())
    return struct.pack("<I", array.nbytes) + array.tobytes() + texts


def varint(n):
    return bytes([n & 127 | 128]) + varint(n >> 7) if n > 127 else bytes([n])


def model_with(mapping, prefix, trim, escape=True):
    """The public model with another normaliser."""
    with open(tokenizer_path(PIECE_MODEL), "rb") as f:
        model = f.read()
    blob = compiled(mapping) if mapping else b""
    norm = b"\x0a\x01n" + (b"\x12" + varint(len(blob)) + blob if blob else b"") + bytes([0x18, prefix, 0x20, trim, 0x28, escape])
    out = b""
    for field, value in E.fields(model):
        value = norm if field == 3 else value
        out += varint(field << 3 | 2) + varint(len(value)) + value
    return out


@pytest.mark.parametrize("model", [None, (MAP, 1, 1), (MAP, 1, 0), (MAP, 0, 0), ({}, 1, 1), ({}, 0, 1), ({}, 0, 0), (MAP, 1, 1, 0)],
                         ids=["as it is", "map trim", "map", "map bare", "trim", "bare trim", "bare", "no escape"])
def test_pieces_and_spans_equal_the_library(model):
    if model is None:
        with open(tokenizer_path(PIECE_MODEL), "rb") as f:
            own = E.PieceModel(f.read())
    else:
        own = E.PieceModel(model_with(*model))
    r = random.Random(5)
    texts = ["", " ", "   ", *("".join(r.choice(BITS) for _ in range(r.randint(0, 40))) for _ in range(1500))]
    ids, begins, ends, offsets = own.encode(texts)
    for k, text in enumerate(texts):
        cut = slice(offsets[k], offsets[k + 1])
        want = own.library.encode(text, return_type="proto").pieces
        assert ids[cut].tolist() == [p.id for p in want], text
        assert list(zip(begins[cut].tolist(), ends[cut].tolist())) == [(p.begin, p.end) for p in want], text
        assert own.decode(ids[cut].tolist()) == own.library.decode(own.library.encode(text))


def test_long_chunks():
    own = E.load(tokenizer_path(PIECE_MODEL))
    r = random.Random(2)
    texts = ["a" * 3000, " " * 3000, "".join(r.choice("abcdeéthing") for _ in range(20000)), "the thing " * 9000]
    ids, _, ends, offsets = own.encode(texts)
    assert [ids[i:j].tolist() for i, j in zip(offsets, offsets[1:])] == own.library.encode(texts)
    assert [int(ends[j - 1]) for j in offsets[1:]] == [len(t.encode()) for t in texts]


def test_refuses_other_models():
    with open(tokenizer_path(PIECE_MODEL), "rb") as f:
        model = f.read()
    other = b"".join(varint(k << 3 | 2) + varint(len(v)) + v for k, v in
                     ((k, v.replace(b"\x18\x02", b"\x18\x01", 1) if k == 2 else v) for k, v in E.fields(model)))
    with pytest.raises(ValueError):
        E.PieceModel(other)


def test_operators(spark):
    docs = [(5, "five five"), (2, None), (9, ""), (None, "null id 日本"), (2, "again"), (2, "again"), (700, "x" * 3000), (1, "  two  spaces ")]
    df = spark.createDataFrame([(t, i, "z", 0) for i, t in docs], "text string, doc_id long, ids string, begins int")
    path = tokenizer_path(PIECE_MODEL)
    own = E.load(path)
    order = lambda r: (r.doc_id is not None, r.doc_id or 0, str(r))
    got = sorted(E.encode(df, path).collect(), key=order)
    assert len(got) == len(docs)
    for i, t in docs:
        ids, begins, ends, _ = own.encode([t or ""])
        assert [r for r in got if r.doc_id == i and (r.ids, r.begins, r.ends) == (ids.tolist(), begins.tolist(), ends.tolist())]
    back = sorted(map(tuple, E.decode(E.encode(df, path), path).collect()), key=str)
    assert back == sorted(((i, own.library.decode(own.library.encode(t or ""))) for i, t in docs), key=str)
    want = []
    for i, t in docs:
        ids = own.library.encode(t or "")
        pieces = own.library.encode(t or "", return_type="proto").pieces
        spans = np.array([*(p.begin for p in pieces), *(p.end for p in pieces)], "<i4").tobytes()
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(own.library.decode(ids).encode()).hexdigest(), zlib.crc32(spans)))
    report = E.report(df, path)
    assert sorted(map(tuple, report.collect()), key=str) == sorted(want, key=str)
    assert report.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"]
    assert E.report(df.limit(0), path).count() == 0 == E.encode(df.limit(0), path).count()
