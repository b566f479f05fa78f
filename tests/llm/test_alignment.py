import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from punctual.llm import alignment

from tests.llm.conftest import SMALL


@pytest.fixture(scope="module")
def plain():
    """Ids and bytes of both tokenizers, from the library files named in the contract."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    # The visible character of each byte in a byte-level vocabulary.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [i for i in range(256) if i not in shown]
    byte_of = {chr(i): i for i in shown} | {chr(256 + k): i for k, i in enumerate(hidden)}
    vocabulary = {i: t for t, i in a.get_vocab().items()}

    def encode(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(byte_of[c] for c in vocabulary[i]) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
            else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        whole = (" " + text).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return [], [], [], []
        return ids_a, ids_b, np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])

    return encode


def brute(plain, rows):
    """Digest rows by sets of end offsets."""
    docs, pairs = [], Counter()
    for doc_id, text in rows:
        a, b, ends_a, ends_b = plain(text or "")
        at_a, at_b = ({int(e): i for e, i in zip(ends, ids)} for ends, ids in ((ends_a, a), (ends_b, b)))
        cuts = sorted(set(at_a) & set(at_b))
        links = [(at_a[c], at_b[c]) for c in cuts]
        pairs.update(links)
        groups = {c: ([], []) for c in cuts}
        for side, ends, ids in ((0, ends_a, a), (1, ends_b, b)):
            for e, i in zip(ends, ids):
                groups[cuts[bisect.bisect_left(cuts, e)]][side].append(str(i))
        written = [",".join(x) + "|" + ",".join(y) for x, y in groups.values()]
        docs.append((doc_id, len(a), len(b), links, ";".join(written)))
    highest = Counter()
    for (_, y), n in pairs.items():
        highest[y] = max(highest[y], n)
    return sorted(
        (repr(doc_id), n_a, n_b, len(links), len(links),
         sum(pairs[p] == highest[p[1]] for p in links), sum(pairs[p] for p in links),
         hashlib.sha256(text.encode()).hexdigest() if text else "")
        for doc_id, n_a, n_b, links, text in docs
    )


def collected(out):
    return sorted((repr(r[0]), *r[1:]) for r in out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    ).collect())


ODD = [
    "", " ", "  two  blanks ", "a\n\nb", "tab\there", "▁ under ▁▁x", "nul\0byte", "ﬁ ligature",
    "<s> </s> <unk> <0x41>", "<|endoftext|> and <|startoftext|>", "é à ü", "﻿bom", "\r\n",
    "nbsp\xa0 x\xa0y", "wide　 x   y", "漢字 かな 🙂 🙂", "it's don't  I'LL", "x" * 700,
    "1234567 89 , . !?", " ", "end ", "\x85 next", "a" * 3 + " " * 50 + "b", "один два три",
]


def test_equals_brute_force(spark, plain, documents):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(25).collect()]
    rows = [(i, t) for i, t in enumerate(ODD + texts)] + [(500, None), (None, ODD[2]), (3, ODD[3]), (3, ODD[3])]
    assert collected(alignment.aligned(documents(rows))) == brute(plain, rows)


def test_random_texts(spark, plain, documents):
    """Any order of white space, letters, marks and bytes that pieces spell out."""
    rng = random.Random(9)
    parts = [" ", "  ", "\n", "\t", "\xa0", " ", "▁", "a", "the", "É", "ß", "œ", "漢", "🙂", "'s", "!!", "7",
             "\0", "​", "ing", "Ω", "́", "\x85", "ю"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(1, 60)))) for i in range(300)]
    assert collected(alignment.aligned(documents(rows))) == brute(plain, rows)


def test_odd_rows(spark, plain, documents, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert collected(alignment.aligned(documents(odd_rows))) == brute(plain, rows)
    empty = alignment.aligned(documents([]))
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "n_a"]


def test_pairs_outside_the_head_are_joined(spark, plain, documents, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(12).collect()]
    rows = list(enumerate(texts))
    wanted = brute(plain, rows)
    for head in (0, 40, 1 << 16):
        monkeypatch.setattr(alignment, "HEAD_PAIRS", head)
        assert collected(alignment.aligned(documents(rows))) == wanted


def test_lanes_and_memory_do_not_change_the_result(spark, plain, documents, monkeypatch):
    text = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("n_chars").tail(1)[0].text
    tokenizers = alignment.Tokenizers()
    data = np.frombuffer((" " + text).encode(), np.uint8)
    found = []
    for lane in (16, 512, 1 << 30):
        monkeypatch.setattr(alignment, "LANE_BYTES", lane)
        out = alignment.Aligned(tokenizers, data, np.array([0, len(data)]))
        found.append((out.link_a.tolist(), out.link_b.tolist(), out.ends.tolist()))
    assert found[0] == found[1] == found[2]
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    rows = [(i, t) for i, t in enumerate(ODD * 2)]
    assert collected(alignment.aligned(documents(rows))) == brute(plain, rows)


def test_links_and_cuts(spark, plain, documents):
    rows = list(enumerate(ODD))
    for r in alignment.align(documents(rows)).collect():
        a, b, ends_a, ends_b = plain(r.row.text)
        assert (r.a_ids, r.b_ids) == (a, b)
        assert r.cuts == sorted(set(map(int, ends_a)) & set(map(int, ends_b)))
        assert [int(ends_a[i]) for i in r.link_a] == r.cuts
        assert [int(ends_b[i]) for i in r.link_b] == r.cuts


def test_memory_of_a_task_is_bounded_by_its_chunks():
    """Arrays of a chunk, not of a whole Arrow batch, stand beside what a task remembers."""
    import tracemalloc

    import pyarrow as pa

    texts = [" " + " ".join(f"w{(i * 37 + k) % 900}" for k in range(500)) for i in range(1500)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"]
    )
    run = alignment._digest(None, None)
    tracemalloc.start()
    try:
        out = run(iter([batch]))
        next(out)
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        rows = sum(part.num_rows for part in out)
        peak = tracemalloc.get_traced_memory()[1] - held
    finally:
        tracemalloc.stop()
    assert rows > 1000 and peak < 40e6
