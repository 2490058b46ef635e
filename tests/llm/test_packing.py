import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lectern.llm import packing
from lectern.llm.packing import Encoder, Plan, cuts, pack

PATH = public_tokenizers.path(packing.VOCABULARY)
RANKS = public_tokenizers.path(packing.RANKS)
PLAIN = Tokenizer.from_file(PATH)


def ids(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "it's we'll I'm", "x\n y\t z", "a  b  c", "é è  ü", "a é b", "語 語 x",
    "<|endoftext|> and <|endoftext|>", "1 2 3a 4", "a\x1c b \x85 c", "a" * 3000, "word " * 3000, "! a ? b . c", "½ a ª b º c µ d",
]


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_ids_are_those_of_the_vocabulary(spark, ranks):
    encoder = Encoder(PATH, ranks)
    rows = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    latin = "".join(map(chr, [*range(0x250), *range(0x2010, 0x2028), 0x20AC]))
    mixed = [latin, latin[::-1], " ".join(latin), "".join(c + "a 1" for c in latin)]
    for text in ODD + mixed + rows:
        assert [*encoder.encode(text or "").tolist(), 0] == ids(text)


def test_cuts():
    assert cuts(1, 8) == [(0, 1)] and cuts(8, 8) == [(0, 8)]
    assert cuts(9, 8) == [(0, 1), (1, 8)] and cuts(24, 8) == [(0, 8), (8, 8), (16, 8)]


def one_by_one(lengths, capacity):
    """Best-two-fit on single pieces, trying every pair: the bins as sorted lists."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        own, gap = [], capacity
        for length in list(left):
            if length <= gap:
                own.append(length)
                left.remove(length)
                gap -= length
        smallest = own[-1]
        both = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :]]
        pairs = [p for p in both if smallest < p[0] <= gap + smallest]
        if gap and len(own) > 1 and pairs:
            _, a, b = max(pairs)
            own[-1:] = [a, b]
            left.remove(a)
            left.remove(b)
            left = sorted([*left, smallest], reverse=True)
        bins.append(sorted(own, reverse=True))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_that_of_single_pieces(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100])
    lengths = [rng.randint(1, rng.choice([capacity, 1 + capacity // 3])) for _ in range(rng.choice([0, 1, 60, 200]))]
    plan, bins = Plan(Counter(lengths), capacity), defaultdict(list)
    for length, n in Counter(lengths).items():
        for rank in range(n):
            sequence, offset = plan.place(length, rank)
            bins[sequence].append((offset, length))
    assert sorted(bins) == list(range(plan.bins))
    for rows in bins.values():
        rows.sort()
        assert all(o + n == p for (o, n), (p, _) in zip(rows, rows[1:]))
        assert rows[0][0] == 0 and sum(n for _, n in rows) <= capacity
    want = Counter(tuple(b) for b in one_by_one(lengths, capacity))
    assert Counter(tuple(sorted((n for _, n in rows), reverse=True)) for rows in bins.values()) == want


def test_two_for_the_smallest():
    # 6 + 3 leaves a gap of 1; 6 + 2 + 2 leaves none
    assert packing.fill(np.array([0, 0, 2, 1, 0, 0, 1, 0, 0, 0, 0]), 10) == {6: 1, 2: 2}
    assert packing.fill(np.array([0, 0, 1, 1, 0, 0, 1, 0, 0, 0, 0]), 10) == {6: 1, 3: 1}


def test_round_trip(spark):
    rng = random.Random(1)
    words = "the of a token sequence packs documents tightly ,".split()
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(300)]
    rows += [(1000 + k, "same text again") for k in range(200)] + [(2000 + k, t) for k, t in enumerate(ODD)]
    rows += [(None, "x"), (7, "x"), (7, "x"), (2**62 + 1, "y")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, length string").repartition(5)
    got = pack(df, PATH, RANKS, capacity=64).collect()
    assert got[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}

    want = Counter()
    for key, text in rows:
        own = ids(text)
        for number, (start, n) in enumerate(cuts(len(own), 64)):
            want[key, number, start, n, zlib.crc32(np.array(own[start : start + n], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want

    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(own, own[1:]))
        assert sum(n for _, n in own) <= 64
    tokens = sum(r["length"] for r in got)
    assert len(bins) <= -(-tokens // 64) + 1


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
