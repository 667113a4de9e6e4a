import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import packing as P
from tillroll.llm.queries import BYTE_TOKENIZER, tokenizer_path
from tillroll.llm.tokenise import Encoder


def padded(total, size):
    return total if total & (total - 1) == 0 else size


@pytest.mark.parametrize("size,n,seed", [(64, 4000, 1), (64, 5, 2), (1024, 20000, 3), (1024, 0, 4), (16, 300, 5)])
def test_slots_place_every_piece_once_with_little_padding(size, n, seed):
    r = random.Random(seed)
    histogram = Counter(min(size, 1 + int(r.expovariate(4 / size))) for _ in range(n))
    seen, fill = Counter(), {}
    for x, first, ranks, per, seq, at in P.slots(dict(histogram), size):
        for k in range(ranks):
            assert (x, first + k) not in seen
            seen[x, first + k] += 1
            fill.setdefault(seq + k // per, []).append((at + k % per * x, x))
    assert Counter(x for x, _ in seen) == histogram
    for parts in fill.values():
        end = 0
        for at, x in sorted(parts):
            assert at == end
            end += x
        assert end <= size
    total = sum(x * k for x, k in histogram.items())
    if n > 1000:
        assert sum(padded(sum(x for _, x in p), size) for p in fill.values()) < 1.02 * total


def test_pack_keeps_every_token(spark):
    r = random.Random(7)
    docs = [(k % 190, " ".join(r.choice(["the", "word", "xyzzy,", "é"]) for _ in range(r.randint(0, 90)))) for k in range(200)]
    docs += [(None, "null id"), (500, None), (501, ""), (502, "long " * 700)]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, length int")
    path, size = tokenizer_path(BYTE_TOKENIZER), 64
    got = P.pack(df, path, 0, size).collect()
    enc = Encoder(path).tokenizer
    want = Counter((i, np.array([*enc.encode(t or "", add_special_tokens=False).ids, 0], "<u2").tobytes()) for i, t in docs)
    assert sum(x.length for x in got) == sum(len(b) // 2 * n for (_, b), n in want.items())
    assert Counter((x.doc_id, bytes(x.ids)) for x in got) == Counter((i, b[2 * k:2 * (k + size)]) for (i, b), n in want.items() for _ in range(n) for k in range(0, len(b) // 2, size))
    fill = {}
    for x in got:
        assert x.ids_crc32 == zlib.crc32(np.frombuffer(bytes(x.ids), "<u2").astype("<u4").tobytes())
        fill.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in fill.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [at for at, _ in sorted(parts)] == ends[:-1] and ends[-1] <= size
    assert P.pack(df.limit(0), path, 0, size).count() == 0
