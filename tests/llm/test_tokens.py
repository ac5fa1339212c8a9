"""BPE against the tokenizers library, and best-two-fit packing."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from punctuality.llm import bpe, packing
from punctuality.llm.queries import vocabulary

ODD = [
    "", "  \n", "a" * 3000, "ab" * 40 + "é" * 300, "<|endoftext|>x<|startoftext|> It's we'll 'S !!'s I'VE", "ΑΣ ΣΑΣ. Σ", "İstanbul ǅ ﬁ",
    "a\x1cb\x85c d e　f", "\x00\x01\x7fabc", "é ́a", "日本語テキスト" * 20, "١٢٣ 12３ ²ª", "🙂👩‍👩‍👧 x", "'re'", "a'sb", "<|endoftext|", "xy" * 16, "x" * 33,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, text, "x") for n, text in enumerate(ODD)] + [(0, "", "x"), (None, None, "y"), (None, "Zwei Wörter", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_encoding_equals_library(text):
    held = bpe.encoder(vocabulary()).encode_batch([text])[0].tolist()
    assert held == ids_of(Tokenizer.from_file(vocabulary()), text)


def test_round_trip_of_rows(docs, library):
    got = sorted(((r.doc_id, tuple(r.ids), r.decoded) for r in bpe.encode(docs, vocabulary()).collect()), key=repr)
    rows = [(r.doc_id, ids_of(library, r.text)) for r in docs.collect()]
    assert got == sorted(((d, tuple(i), library.decode(i, skip_special_tokens=False)) for d, i in rows), key=repr)
    assert bpe.encode(docs.limit(0), vocabulary()).collect() == []


@pytest.mark.parametrize("gathered", [1, 3, 1 << 16])
def test_ids_do_not_depend_on_how_many_pieces_are_gathered(library, monkeypatch, gathered):
    monkeypatch.setattr(bpe, "GATHERED", gathered, raising=False)
    assert [x.tolist() for x in bpe.encoder(vocabulary()).encode_batch(ODD)] == [ids_of(library, text) for text in ODD]


def test_plain_pieces_are_split_together(library, monkeypatch):
    """Only pieces with an apostrophe, a "<" or other than plain characters are taken one by one, and each of them once."""
    held, alone = bpe.WordBpe(vocabulary()), []
    split = held._words_of
    monkeypatch.setattr(held, "_words_of", lambda piece: alone.append(piece) or split(piece))
    plain = [f"W{n}-straße,{chr(97 + n % 26) * (n % 40)}É{n}²!" for n in range(500)]
    odd = ["it's", "<b>", "Σ", "日本", "İ", "\x00"]
    texts = [" ".join(plain), "", " ".join(odd + plain[:5] + odd), *odd, *plain[:5]]
    assert [x.tolist() for x in held.encode_batch(texts)] == [ids_of(library, text) for text in texts]
    assert sorted(alone) == sorted(odd)


def test_every_pair_has_its_rank_and_no_other():
    held = bpe.encoder(vocabulary())
    left, right = held._keys >> 32, held._keys & 0xFFFFFFFF
    assert held._ranks(left, right).tolist() == list(range(len(left)))
    known = set(held._keys.tolist())
    rng = np.random.default_rng(3)
    a, b = rng.choice(left, 200_000), rng.choice(right, 200_000)
    wrong = np.array([key not in known for key in (a << 32 | b).tolist()])
    assert ((held._ranks(a, b) == bpe.NEVER) == wrong).all() and wrong.any() and not wrong.all()


def test_every_character_beside_others_equals_library(library):
    near = ["{0}", "{0}{0}", "a{0}b", "A{0}É", "1{0}2", ".{0}!", "'{0}", "{0}'s", "<{0}|endoftext|>", "<|endoftext|>{0}"]
    texts = [form.format(chr(n)) for n in range(0x250) for form in near]
    assert [x.tolist() for x in bpe.encoder(vocabulary()).encode_batch(texts)] == [ids_of(library, text) for text in texts]


@pytest.mark.parametrize("job", [bpe.digests, bpe.encode, packing.cut])
def test_workers_keep_no_pieces_after_a_task(spark, job):
    """Workers are used again by later stages, which should not carry what a tokenizer task has learned."""
    path = vocabulary()
    docs = spark.range(0, 64, 1, 8).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 50), x -> 'w' || (x * 97 + id))) AS text")

    def held(batches):
        for batch in batches:
            bpe_here = bpe.encoder(path)
            yield pa.RecordBatch.from_arrays([pa.array([len(bpe_here._pieces)] * batch.num_rows, pa.int64())], names=["n"])

    job(docs, path).write.format("noop").mode("overwrite").save()
    assert {r.n for r in spark.range(0, 64, 1, 8).mapInArrow(held, "n long").collect()} == {0}


def test_digests(docs):
    held = {r.n_tokens for r in bpe.digests(docs.filter("text is null"), vocabulary()).collect()}
    assert held == {0}


def test_pieces_hold_all_ids(docs, library):
    pieces = packing.cut(docs, vocabulary(), capacity=16, keep_ids=True).collect()
    by_row = {}
    for p in sorted(pieces, key=lambda p: p.piece):
        by_row.setdefault(p.row_key, []).append(p)
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and p.length == len(p.ids) <= 16
    got = sorted(([i for p in own for i in p.ids] for own in by_row.values()), key=repr)
    assert got == sorted(([*ids_of(library, r.text), 1] for r in docs.collect()), key=repr)
    assert all(p.start == 16 * p.piece for p in pieces)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_packing_is_gapless_and_fits(lengths):
    bins, offsets = packing.best_two_fit(np.array(lengths, dtype=np.int64), 50)
    for number in set(bins.tolist()):
        own = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == number))
        ends = np.cumsum([size for _, size in own])
        assert [at for at, _ in own] == [0, *ends[:-1]] and ends[-1] <= 50
    assert len(set(bins.tolist())) <= 2 * -(-sum(lengths) // 50) + 1


def test_two_documents_replace_the_smallest():
    bins, _ = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert bins[0] == bins[2] == bins[3] != bins[1]  # 6 + 3 leaves 1; 6 + 2 + 2 leaves none


def test_packed_rows(docs):
    placed = packing.pack(packing.cut(docs, vocabulary(), capacity=64), capacity=64, group_pieces=8).collect()
    assert len(placed) == packing.cut(docs, vocabulary(), capacity=64).count()
    by_bin = {}
    for p in placed:
        by_bin.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in by_bin.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.cut(docs.limit(0), vocabulary())).collect() == []


def one_by_one(lengths, capacity):
    """Bins of best-two-fit, made piece by piece from a plain list."""
    left, out = sorted(lengths), []
    while left:
        held, gap = [], capacity
        while any(x <= gap for x in left):
            size = max(x for x in left if x <= gap)
            left.remove(size)
            held.append(size)
            gap -= size
        if gap and left:
            room = gap + held[-1]
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[:i] if held[-1] < a + b <= room]
            if pairs:
                _, a, b = max(pairs)
                left.remove(a)
                left.remove(b)
                left = sorted([*left, held.pop()])
                held += [a, b]
        out.append(sorted(held))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 12)), max_size=8))
def test_patterns_equal_bins_one_by_one(counted):
    lengths = [size for size, n in counted for _ in range(n)]
    found = [sorted(held) for held, times in packing.patterns(Counter(lengths), 30) for _ in range(times)]
    assert found == one_by_one(lengths, 30)


def test_packing_does_not_grow_worse():
    """Four and sixteen times the pieces take four and sixteen times the sequences, from patterns that hardly become more."""
    rng = np.random.default_rng(4)
    lengths = np.minimum(np.maximum(rng.lognormal(6.2, 1.2, 20_000).astype(int), 1), 4096)
    counts = Counter(lengths.tolist())
    sizes = {}
    for times in (1, 4, 16):
        bins = packing.patterns({size: n * times for size, n in counts.items()}, 4096)
        sizes[times] = len(bins)
        full = -(-int(lengths.sum()) * times // 4096)
        assert full <= sum(n for _, n in bins) <= full * 1.002 + 1
    assert sizes[16] < 2 * sizes[1] + 5000


def test_rows_that_repeat_and_names_that_clash(spark, library):
    rows = [(1, "one two", 9, "a"), (1, "one two", 9, "a"), (None, None, 9, "b"), (None, "x", 9, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, row_key string")
    found = packing.pack(packing.cut(docs, vocabulary())).collect()
    assert sorted((r.doc_id or 0, r.length) for r in found) == sorted((n or 0, 1 + len(ids_of(library, t))) for n, t, _, _ in rows)
    assert len({r.offset for r in found}) == 4 and len({r.sequence_id for r in found}) == 1
    assert sorted((r.doc_id or 0, r.n_tokens) for r in bpe.digests(docs, vocabulary()).collect()) == sorted((n or 0, len(ids_of(library, t))) for n, t, _, _ in rows)
    assert bpe.digests(docs.limit(0), vocabulary()).collect() == []
    with pytest.raises(ValueError, match="row_key"):
        packing.cut(docs, vocabulary(), id_column="row_key")
