import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from shiftloom.llm._bytes import ALNUM, LOWER, SPACED, chunks, hash_spans, joined_words, text_buffer, words, xxh64_spans

ALPHABET = "abcXYZ 09é中😀\t\n.,-\x00\x1f"


def texts(n, seed=0):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 90))) for _ in range(n)] + ["", None, "x" * 500]


def test_buffer_of_sliced_column_with_nulls():
    full = pa.array(["ab", None, "é", "", "cd"])
    buf, off = text_buffer(full.slice(1, 4))
    assert off.tolist() == [0, 0, 2, 2, 4]
    assert buf[:4].tobytes() == "écd".encode()


def test_words_agree_with_the_patterns():
    t = texts(300)
    buf, off = text_buffer(pa.array(t))
    for table, pattern in ((SPACED, "[^\x20\x09-\x0d]+"), (ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        low = LOWER[buf]
        s, e, wo = words(low, off, table)
        for i, x in enumerate(t):
            x = (x or "").translate({k: k + 32 for k in range(65, 91)})
            assert [low[a:b].tobytes().decode() for a, b in zip(s[wo[i] : wo[i + 1]], e[wo[i] : wo[i + 1]])] == re.findall(pattern, x)


def test_xxh64_equals_the_library_at_all_lengths():
    data = np.random.default_rng(0).integers(0, 256, 4000).astype(np.uint8)
    buf = np.concatenate([data, np.zeros(64, np.uint8)])
    starts, lens = np.arange(0, 3000, 7), np.arange(0, 3000, 7) % 131
    got = xxh64_spans(buf, starts, lens, 42)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a : a + n].tobytes(), 42) for a, n in zip(starts, lens)]


def test_span_hash_ignores_surroundings():
    buf = np.frombuffer(b"..hello world.. hello world!" + bytes(64), np.uint8)
    a, b = hash_spans(buf, np.array([2, 16]), np.array([11, 11]))
    assert a == b


def test_joined_words_and_chunks():
    t = ["  A  b ", "", "c"]
    buf, off = text_buffer(pa.array(t))
    out, s, e, wo = joined_words(buf, off)
    assert wo.tolist() == [0, 2, 2, 3] and out[s[0] : e[1]].tobytes() == b"a b"
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, "b" * 50, None, "c"]})
    assert [r.num_rows for r, _, _ in chunks(iter([batch]), "text", 20)] == [1, 1, 2]
