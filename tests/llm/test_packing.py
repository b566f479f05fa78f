import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from punctual.llm import packing
from tokenizers import Tokenizer

from tests.llm.conftest import SMALL


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: np.array(
        tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4"
    )


def check(out, rows, encode):
    sequences, pieces = defaultdict(list), Counter()
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= packing.LENGTH
    # Every id of every row lies in one piece.
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = encode(text)
        cuts = range(0, len(ids), packing.LENGTH)
        expected.update(
            (doc_id, a, len(ids[a : a + packing.LENGTH]),
             zlib.crc32(ids[a : a + packing.LENGTH].tobytes()), len(ids)) for a in cuts
        )
    assert pieces == expected
    return len(sequences), sum(r.length for r in out)


def test_round_trip_and_little_padding(spark, encode):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sequences, tokens = check(packing.pack(docs).collect(), rows, encode)
    assert sequences * packing.LENGTH <= 1.02 * tokens


def test_odd_rows(documents, odd_rows, encode):
    rows = [r for r in odd_rows if r[0] != 25]
    check(packing.pack(documents(rows)).collect(), rows, encode)


def test_long_word(documents, encode):
    rows = [(1, "ab" * 20_000)]
    check(packing.pack(documents(rows)).collect(), rows, encode)


@pytest.mark.parametrize("blank", [" ", "\n", "\u3000", "\r\n \xa0"])
def test_huge_runs_of_white_space(documents, encode, blank):
    """Longer than the pattern's backtracking stack, at every place of a text."""
    run = blank * (1_000_000 // len(blank))
    rows = [(1, run), (2, f"a{run}b"), (3, f"{run}\x1c{run}'s {run}\n1"), (4, f"é {run} {run}")]
    check(packing.pack(documents(rows)).collect(), rows, encode)


@pytest.mark.parametrize("more", [-1, 0, 1, 2])
def test_runs_around_the_limit(encode, more):
    run = " \t" * ((packing.LONG_RUN + more + 1) // 2)
    run = run[: packing.LONG_RUN + more]
    for text in (run, f"a{run}b", f"{run}\x85.", f"x{run}\ny{run} z"):
        ids = packing._ids(packing._encoder(None), text)
        assert np.append(ids, 1).tolist() == encode(text).tolist()


def test_empty_table(documents):
    assert packing.pack(documents([])).count() == 0


@pytest.mark.parametrize("low,high", [(1, 513), (1, 40), (100, 300), (512, 513)])
@pytest.mark.parametrize("n", [1, 30, 20_000])
def test_patterns_hold_every_piece(low, high, n):
    counts = Counter(np.random.default_rng(n).integers(low, high, n).tolist())
    plan = packing.cutting_stock(dict(counts), 512)
    held = Counter()
    for times, pattern in plan:
        assert times > 0 and sum(s * k for s, k in pattern.items()) <= 512
        for size, k in pattern.items():
            held[size] += times * k
    assert held == counts


def test_patterns_are_near_the_bound():
    counts = Counter(np.random.default_rng(7).integers(1, 513, 50_000).tolist())
    rows = sum(times for times, _ in packing.cutting_stock(dict(counts), 512))
    assert rows <= 1.01 * sum(s * n for s, n in counts.items()) / 512


def test_best_pattern_equals_all_patterns():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = np.sort(rng.choice(np.arange(1, 13), 4, replace=False))
        prices = rng.random(4)
        worth, pattern = packing._best_pattern(prices, sizes, 20)
        best = max(
            a * prices[0] + b * prices[1] + c * prices[2] + d * prices[3]
            for a in range(21) for b in range(21) for c in range(21) for d in range(21)
            if a * sizes[0] + b * sizes[1] + c * sizes[2] + d * sizes[3] <= 20
        ) if sizes[0] > 2 else None
        assert pattern @ sizes <= 20 and pattern @ prices == pytest.approx(worth)
        if best is not None:
            assert worth == pytest.approx(best)
