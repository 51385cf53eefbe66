import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from knotwork.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(docs):
    """(id, piece, start, length, crc) by the tokenizers library."""
    library, out = Tokenizer.from_file(PATH), []
    for d, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        edges = [0, *range(first, len(ids) + 1, 1024)]
        out += [(d, k, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return sorted(out, key=str)


def check(got, docs):
    """Pieces are right, and each sequence is gapless, from 0, and no longer than 1024."""
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == expected(docs)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences)


def test_pieces_and_places(docs, rows, none):
    got = packing.pack_documents(docs, PATH).collect()
    n = check(got, [(r[0], r[1]) for r in rows])
    total = sum(r.length for r in got)
    assert n <= -(-total // 1024) + 2
    assert packing.pack_documents(none, PATH).count() == 0
    with_ids = packing.pack_documents(docs, PATH, with_ids=True).collect()
    assert all(zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    limit = rng.choice([10, 64, 1024])
    histogram = {n: rng.randint(1, 30) for n in rng.sample(range(1, limit + 1), min(limit, 25))}
    room = []
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            fit = min((r for r in room if r >= n), default=None)
            if fit is not None:
                room.remove(fit)
            room.append((limit if fit is None else fit) - n)
    used = defaultdict(list)
    for length, a, b, first, each, offset in packing.plan(histogram, limit):
        for r in range(a, b):
            used[first + (r - a) // each].append((offset + length * ((r - a) % each), length))
    assert sorted(limit - sum(n for _, n in x) for x in used.values()) == sorted(room)
    assert sorted(n for x in used.values() for _, n in x) == sorted(n for n, c in histogram.items() for _ in range(c))
    for x in used.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n


def test_ids_of_odd_texts():
    bpe, rng = packing.ByteBpe(PATH), random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "　", "'s", "'re", "é", "１", "½", "中", "́", "😀", "\t", "▁", "\x00", "<|endoftext|>", "राम", "​", "Th", "0", "12", "!", "\r\n", " "]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == bpe.library.encode(text, add_special_tokens=False).ids, text
