"""Registered queries without SQL, and the pipeline, against plain Python over the smallest test tables."""

import hashlib
import math
import zlib
from collections import Counter
from pathlib import Path

import pytest
from test_text import measures, plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from punctuality.llm import pii, queries

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()}


def run(spark, name):
    return queries.QUERIES[name](spark, str(TABLES)).collect()


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_bpe(spark, texts):
    import numpy as np

    library = Tokenizer.from_file(queries.vocabulary())
    for r in run(spark, "op3_bpe_round_trip"):
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False)))


def test_packing(spark, texts):
    library = Tokenizer.from_file(queries.vocabulary())
    placed = run(spark, "op10_best_two_fit")
    held = Counter()
    for r in placed:
        held[r.doc_id] += r.length
    assert held == {d: 1 + len(library.encode(t, add_special_tokens=False).ids) for d, t in texts.items()}
    assert len({r.sequence_id for r in placed}) <= math.ceil(sum(held.values()) / 4096) + 1


def test_personal_data(spark, texts):
    for r in run(spark, "op4_candidate_boosting"):
        base = plain_spans(texts[r.doc_id])
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == sha(line) and set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_language_model(spark, texts):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = {d: t.translate(low).encode().split() + [None] for d, t in texts.items()}
    out = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    c = Counter(w for d, words in split.items() if not out(d) for w in words)
    n, v = sum(c.values()), len(c)
    rows = run(spark, "op7_brown_classes")
    for r in rows:
        own = split[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(own), sum(c[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_toxicity(spark, texts):
    rows = run(spark, "op8_folded_lexicon")
    assert {r.doc_id for r in rows} == set(texts)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_quality(spark, texts):
    for r in run(spark, "op9_line_first"):
        n, chars, symbols, again, covered, failed = measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, chars, symbols, again, covered, failed)
        assert not (failed and r.kept)


def test_pipeline_by_stages(spark, texts, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, kept = docs.columns, {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, after = kept, stage(spark, docs, str(TABLES))
        after.write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number == len(corpus_pipeline.STAGES) - 1:
            break
        assert docs.columns == columns, name
        kept = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality_rules":
            assert kept and all(not measures(texts[d])[-1] for d in kept)
        elif name == "near_duplicates":
            sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, t in before.items() for w in [t.lower().split()]}
            alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0
            assert not [1 for a in kept for b in kept if a < b and alike(a, b)]
            gone = set(before) - set(kept)
            assert gone and all(any(alike(d, o) for o in before if o != d) for d in gone)
        elif name == "substring_duplicates":
            split = {d: t.split() for d, t in before.items()}
            seen = Counter(tuple(w[i : i + 35]) for w in split.values() for i in range(len(w) - 34))
            for d, w in split.items():
                out = [False] * len(w)
                for i in range(len(w) - 34):
                    if seen[tuple(w[i : i + 35])] > 1:
                        out[i : i + 35] = [True] * 35
                assert kept[d].split() == [x for x, o in zip(w, out, strict=True) if not o]
        elif name == "personal_data":
            assert set(kept) == set(before) and not any(plain_spans(t) for t in kept.values())
    assert {r.doc_id for r in docs.collect()} == set(kept)
