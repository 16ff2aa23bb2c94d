import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import Bin, TextIds, pack, pack_documents, patterns, utilisation

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\n", "a  b", "a \n b", "tab\t x", "x  y", "don't stop 's", " lead", "trail ", "trail \n",
    "é" * 50, "a<|endoftext|>b", "\x1c \x1d\n", "12 345,6 %%% $$", "日本語 text　wide", "\r\n a\r\n",
]


def test_ranks_give_the_ids_of_the_tokenizer():
    plain = Tokenizer.from_file(PATH)
    tokens = TextIds(PATH)
    assert tokens.ranked
    dice = random.Random(3)
    common = [chr(c) for c in (*range(0x250), *range(0x2010, 0x2028))]
    texts = [x or "" for x in ODD] + ["".join(dice.choice("ab é'\n\t .1 \x1f") for _ in range(60)) for _ in range(400)]
    texts += ["".join(dice.choice(common) for _ in range(80)) for _ in range(2000)]
    texts += [a + b + c for a in "x 1." for b in common for c in "y 1."]
    texts += ["a" * 3000, " " * 3000 + "x", "ab " * 3000]
    for text in texts:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tokens.of(text), dtype="<u4").tolist() == want, repr(text)


def check(rows, docs, bin):
    plain = Tokenizer.from_file(PATH)
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= bin.tokens and len(held) <= bin.documents and sum(n * n for _, n in held) <= bin.attention
    for doc_id, text in docs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        got = sorted(pieces.pop(doc_id), key=lambda r: r.piece)
        at = 0
        for i, r in enumerate(got):
            assert (r.piece, r.start) == (i, at)
            part = b"".join(x.to_bytes(4, "little") for x in ids[at : at + r.length])
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
            assert i == 0 or r.length == bin.tokens
        assert at == len(ids) and (len(ids) > bin.tokens or len(got) == 1)
    assert not pieces
    return len(bins)


@pytest.mark.parametrize("bin", [Bin(), Bin(64, 3, 2500), Bin(16, 16, 256)])
def test_round_trip(spark, bin):
    dice = random.Random(1)
    docs = [(i, t) for i, t in enumerate(ODD)]
    bound = int(bin.attention**0.5)
    if bound >= bin.tokens:
        docs += [(100 + i, "word " * dice.choice([1, 5, 40, 400, 9000])) for i in range(60)]
    if bound < bin.tokens:
        docs = [x for x in docs if len(x[1] or "") < 30]
    docs += [(1000 + i, "same text here") for i in range(200)]
    frame = spark.createDataFrame([(a, b, 7, 1) for a, b in docs], "doc_id long, text string, length int, row int")
    rows = pack_documents(frame, PATH, bin).collect()
    made = check(rows, docs, bin)
    least = -(-sum(r.length for r in rows) // bin.tokens)
    if bin.documents >= 16:
        assert made <= least * 1.02 + 1


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize(
    "bin, binding",
    [(Bin(64, 64, 64 * 64), "tokens"), (Bin(64, 2, 64 * 64), "documents"), (Bin(64, 64, 400), "attention")],
)
def test_each_capacity_binds_and_is_reported(spark, bin, binding):
    dice = random.Random(7)
    lengths = [dice.choice([4, 5, 8, 16, 20]) for _ in range(400)]
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "row long, piece int, length long")
    packed = pack(pieces, bin).cache()
    rows = packed.collect()
    n = len({r.sequence_id for r in rows})
    squares = defaultdict(int)
    for r in rows:
        squares[r.sequence_id] += r.length**2
    assert max(squares.values()) <= bin.attention
    (got,) = utilisation(packed, bin).collect()
    want = (sum(lengths) / (n * bin.tokens), 400 / (n * bin.documents), sum(squares.values()) / (n * bin.attention))
    assert got.sequences == n and (got.tokens, got.documents, got.attention) == pytest.approx(want)
    assert max(("tokens", "documents", "attention"), key=lambda name: got[name]) == binding and got[binding] > 0.9
    (none,) = utilisation(packed.where("false"), bin).collect()
    assert tuple(none) == (0, None, None, None)


@pytest.mark.parametrize("score", ["dot", "norm"])
def test_patterns_use_every_piece_once(score):
    dice = random.Random(5)
    counts = {dice.randrange(1, 2049): dice.randrange(1, 1000) for _ in range(300)}
    made = patterns(counts, score=score)
    used = defaultdict(int)
    for pattern in made:
        assert sum(pattern.lengths) <= 2048
        for n in pattern.lengths:
            used[n] += pattern.times
    assert used == counts
    least = -(-sum(k * n for k, n in counts.items()) // 2048)
    alone = sum(n for k, n in counts.items() if k > 1024)
    assert sum(p.times for p in made) <= max(least, alone) * 1.1


def test_a_piece_must_fit():
    with pytest.raises(ValueError):
        patterns({10: 1}, Bin(16, 16, 99))
