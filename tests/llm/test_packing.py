import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import packing
from barloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def whole(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def laid(sizes, capacity):
    bins = packing.Bins(capacity, 7)
    for i, size in enumerate(sizes):
        bins.add(i, size)
    bins.finish()
    return bins.take()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=80), st.sampled_from([1, 2, 10, 16, 32]))
def test_every_token_is_in_one_piece_of_a_full_sequence(sizes, capacity):
    places, sequences = defaultdict(list), defaultdict(list)
    for document, start, end, sequence, offset in laid(sizes, capacity):
        assert start < end
        places[document] += range(start, end)
        sequences[sequence].append((offset, end - start))
    assert {d: sorted(p) for d, p in places.items()} == {i: list(range(n)) for i, n in enumerate(sizes)}
    assert sorted(sequences) == list(range(7, 7 + len(sequences)))
    short = []
    for pieces in sequences.values():
        upto = 0
        for offset, length in sorted(pieces):
            assert offset == upto
            upto += length
        if upto != capacity:
            short.append(upto)
    # What is left over is less than one sequence, and in powers of two.
    assert sum(short) < capacity and all(n & (n - 1) == 0 for n in short)


def test_bins_of_a_class_hold_its_count_of_whole_documents():
    rng = random.Random(2)
    sizes = [rng.choice([rng.randint(1, 60), rng.randint(400, 3000)]) for _ in range(5000)]
    pieces = defaultdict(list)
    for document, start, end, sequence, _ in laid(sizes, 4096):
        pieces[sequence].append((document, start, end))
    plain = cut = 0
    for own in pieces.values():
        first = 4096 // (own[0][2] - own[0][1])
        kept = [p for p in own[:first] if p[1] == 0 and p[2] == sizes[p[0]]]
        plain += len(kept) == first and {4096 // (e - s) for _, s, e in kept} == {first}
    cut = sum(1 for p in pieces.values() for _, s, e in p) - len(sizes)
    assert plain > 0.8 * len(pieces) and cut <= len(pieces)


def test_documents(spark, docs):
    rng = random.Random(5)
    words = ["Apple", "berry", "é", "x1", "cherry-pie", "漢字"]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([1, 30, 900])))) for i in range(60)]
    rows += [(None, "no key"), (3, "again"), (70, None), (71, ""), (72, "long word " * 30_000), (73, "<|endoftext|>")]
    found = packing.pack(docs(rows), PATH, 2, special=True, capacity=512).collect()
    by_row = defaultdict(list)
    for r in found:
        by_row[r.doc_id, r.doc_tokens].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        assert r.length * 4 == len(r.ids)
    assert sum(r.length for r in found) == sum(len(whole(t)) for _, t in rows)
    for d, t in rows:
        if d != 3:
            assert [i for _, ids in sorted(by_row[d, len(whole(t))]) for i in ids] == whole(t)
    assert {r.start + r.length <= r.doc_tokens for r in found} == {True}
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and (ends[-1] == 512 or ends[-1] & (ends[-1] - 1) == 0)
    assert packing.pack(docs([]), PATH, 2).count() == 0
    text_keys = packing.pack(docs(rows).selectExpr("concat('k', doc_id) AS name", "text", "doc_id AS length"), PATH, 2, key="name")
    assert {r.name for r in text_keys.select("name").distinct().collect()} == {f"k{d}" if d is not None else None for d, _ in rows}


def test_the_query_loses_no_token(spark):
    folder = "/root/testdata/sf0.001"
    found = QUERIES["op11_packing"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    pieces = defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == texts.keys()
    for d, own in pieces.items():
        ids = np.array(whole(texts[d]), "<u4")
        assert all(r.doc_tokens == len(ids) for r in own)
        for r in own:
            assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert sum(r.length for r in own) == len(ids)


@pytest.mark.parametrize("size", [1, 4096, 4097, 8192])
def test_single_documents(size):
    found = laid([size], 4096)
    assert sum(e - s for _, s, e, *_ in found) == size
