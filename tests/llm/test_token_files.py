import random
import zlib

import numpy as np
import pytest

from tillroll.llm import token_files as TF
from tillroll.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER, tokenizer_path
from tillroll.llm.tokenise import Encoder

ODD = ["a", "b", "é", "ß", "ñ", " ", "  ", "\n", "\t", "'s", "'", "1", "22", ".", "!", "-", " ", "́", "　", "日本", "😀",
       "I'll", "İ", "Σ", "<|endoftext|>", "_", "\x1c", "\u0085", "ｶﾞ", "'re", '"', " \n", "ª", "µ", "×", "Z", "word", " The"]


@pytest.mark.parametrize("name", [WORD_TOKENIZER, BYTE_TOKENIZER])
def test_memo_equals_the_library(name):
    enc, r = Encoder(tokenizer_path(name)), random.Random(3)
    texts = ["", " ", *("".join(r.choice(ODD) for _ in range(r.randint(0, 30))) for _ in range(3000))]
    assert [x.tolist() for x in enc.ids_of(texts)] == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_codec_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (r.integers(0, 2**32, n, dtype=np.uint64) >> r.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        assert (TF.decode_values(*TF.encode_values(v), n) == v).all()
    assert TF.encode_values(np.array([0, 255, 256, 2**24]))[0] == bytes([0b11_01_00_00])
    with pytest.raises(ValueError):
        TF.read_block(b"nope" + bytes(40))


def test_files_hold_every_document_in_order(spark):
    docs = [(5, "five five"), (2, None), (9, ""), (-1, "Minus " * 50), (None, "null id"), (2, "again"), (2, "again"), (700, "x" * 3000)]
    df = spark.createDataFrame([(t, i, 0) for i, t in docs], "text string, doc_id long, start int")
    path = tokenizer_path(WORD_TOKENIZER)
    got = TF.read_files(*TF.write_files(df, path, 1, block_values=20)).orderBy("start").collect()
    enc = Encoder(path).tokenizer
    want = {}
    for i, t in docs:
        ids = np.array([*enc.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        want.setdefault(i, []).append((len(ids) // 4, zlib.crc32(ids), ids))
    assert [r.doc_id for r in got] == sorted((i for i, _ in docs), key=lambda x: (x is not None, x or 0))
    at = 0
    for r in got:
        assert r.start == at
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32, bytes(r.ids)))
        at += r.n_tokens
    assert TF.read_files(*TF.write_files(df.limit(0), path, 1)).count() == 0
