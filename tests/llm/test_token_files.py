import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import token_files
from barloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True
ENCODER = token_files.Encoder(PATH, 2)


def whole(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_numbers_come_back(values):
    counts = np.array([len(values) // 3, 0, len(values) - len(values) // 3])
    values = np.array(values, np.uint32)
    control, data, quads, sizes = token_files.pack(values, counts)
    needed = [max(1, -(-int(v).bit_length() // 8)) for v in values]
    assert quads.tolist() == [-(-n // 4) for n in counts] and len(control) == quads.sum()
    assert sizes.tolist() == [sum(needed[:counts[0]]), 0, sum(needed[counts[0]:])] and len(data) == sizes.sum()
    assert (token_files.unpack(control, data, counts) == values).all()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'aeÉ́\x1c")), max_size=40))
def test_ids_match_the_library_on_whole_texts(text):
    for limit in (3, 1 << 20):
        ids, counts = ENCODER([text.encode(), None, text.encode()], limit)
        assert ids.tolist() == [*whole(text), 2, *whole(text)] and counts.tolist() == [len(whole(text)), 1, len(whole(text))]


def test_documents(spark, docs):
    rng = random.Random(1)
    words = "The cat's hat, über <|endoftext|> naïve 12345 — 😀".split(" ")
    rows = [(d, " ".join(rng.choices(words, k=rng.randint(0, 80)))) for d in rng.sample(range(-50, 500), 200)]
    rows += [(None, "no key"), (600, None), (601, ""), (rows[0][0], rows[0][1]), (602, "long words " * 30_000)]
    for options in ({}, {"file_tokens": 1000, "memo": 3}):
        found = token_files.round_trip(docs(rows), PATH, 2, **options).collect()
        keyed = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
        assert len(found) == len(rows)
        found.sort(key=lambda r: r.start)
        assert [r.doc_id for r in found] == [d for d, _ in keyed]
        start = 0
        for row, (_, text) in zip(found, keyed):
            ids = np.array(whole(text), "<u4")
            assert row.start == start and zlib.crc32(bytes(row.ids)) == zlib.crc32(ids.tobytes())
            start += len(ids)
    assert token_files.round_trip(docs([]), PATH, 2).count() == 0


def test_ranks_and_stray_files(spark, docs, tmp_path):
    df = docs([(i, "the the the cat") for i in range(20)])
    files, by_rank = token_files.write(df, f"file://{tmp_path}/out", PATH, 2, file_tokens=30)
    the, cat = whole("the")[0], whole("cat")[0]
    assert by_rank == [the, *sorted([2, cat])]
    listed = files.collect()
    assert min(r.start for r in listed) == 0 and sum(r.tokens for r in listed) == 100 and len(listed) > 2
    # What a task that was run again has left behind is not in the table of files.
    (tmp_path / "out" / "00000000-stray.tok").write_bytes(b"junk")
    assert token_files.read(files, by_rank).count() == 20


UNTOUCHED = Tokenizer.from_file(PATH)
SPECIAL = ["a <|endoftext|> b", "a<|endoftext|>b", "It's<|startoftext|><|endoftext|>!? <|ENDOFTEXT|>", "<|endoftext|", "<|endoftext|>",
           "über,<|endoftext|>naïve\u0301 e\u0301<|startoftext|>\u0301", "x\u00a0<|endoftext|>\u00a0y " * 50, "", "The cat's hat"]


def untouched(text):
    return [*UNTOUCHED.encode(text, add_special_tokens=False).ids, 2]


def test_special_tokens_match_the_untouched_library():
    for limit in (3, 1 << 20):
        ids, counts = token_files.Encoder(PATH, 2, special=True)([t.encode() for t in SPECIAL], limit)
        expected = [untouched(t) for t in SPECIAL]
        assert ids.tolist() == sum(expected, []) and counts.tolist() == [len(e) for e in expected]


def test_the_query_matches_the_untouched_library(spark, docs, tmp_path):
    docs(list(enumerate(SPECIAL))).write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    for row in sorted(QUERIES["op2_token_files"](spark, str(tmp_path)).collect(), key=lambda r: r.doc_id):
        ids = np.array(untouched(SPECIAL[row.doc_id]), "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_files_hold_what_was_asked_whatever_the_keys(spark, docs):
    rng = random.Random(9)
    rows = [(7 if i % 3 == 0 else None if i % 50 == 1 else i, " ".join(rng.choices(["cat", "hat", "über"], k=int(rng.paretovariate(1) * 8) % 1500)))
            for i in range(3000)]
    rows += [(7, "the same text")] * 500 + [(9, "word " * 30_000)]
    files, by_rank = token_files.write(docs(rows), f"file://{token_files.work_folder(spark)}", PATH, 2, file_tokens=20_000)
    listed = files.orderBy("part").collect()
    sizes = [r.tokens for r in listed]
    assert sum(sizes) == sum(len(whole(t)) for _, t in rows) and len({r.part for r in listed}) == len(listed)
    # One document is longer than a file; no other file is above what was asked by more than a document.
    assert sorted(sizes)[-2] <= 22_000 and sum(n < 10_000 for n in sizes) <= 3
    found = sorted(token_files.read(files, by_rank).collect(), key=lambda r: r.start)
    keys = [r.doc_id for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len(keys) == len(rows)
