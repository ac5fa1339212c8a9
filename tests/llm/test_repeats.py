"""Substring dedup, MinHash and embeddings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows_of

from punctuality.llm import embeddings, minhash, substring
from punctuality.llm.components import components


def prose(rng, n, words=400):
    return [f"w{rng.randint(0, words)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    shared, edge = prose(rng, 30), prose(rng, 12)
    out = [" ".join(prose(rng, rng.randint(0, 120))) for _ in range(30)]
    out += [" ".join(prose(rng, 20) + shared + prose(rng, 20)) for _ in range(12)]
    out += ["\n".join(edge[:11] + prose(rng, 5)), " ".join(prose(rng, 5) + edge), " ".join(edge), "la " * 90, "la la\x0bla\tla"]
    out += [out[3], out[3], None, None, "", " \n ", " ".join(shared[:9]), "x"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(n if n % 9 else None, t, 1, "z") for n, t in enumerate(texts)] + [(10, texts[10], 1, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, row_key int, anchor string")


def expected_repeats(rows, window):
    split = [(r.text or "").encode().split() for r in rows]
    starts = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    for r, w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        yield r.doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize(("window", "seed"), [(10, 4), (10, 10), (3, 1), (35, 10)])
def test_substring_equals_brute_force(docs, window, seed):
    got = rows_of(substring.deduplicate(docs, window, seed).drop("kept_text"))
    assert got == sorted(expected_repeats(docs.collect(), window), key=repr)


def test_removal_keeps_the_rest_as_it_is(docs):
    after = substring.without_repeats(docs, 10, 4)
    assert after.columns == docs.columns and after.count() == docs.count()
    told = Counter((r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in after.collect())
    assert told == Counter((d, sha) for d, _, _, sha in expected_repeats(docs.collect(), 10))
    assert substring.without_repeats(docs.limit(0)).collect() == []


def test_substring_of_nothing(docs):
    assert substring.deduplicate(docs.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(5)
    edges = [(n, n + 1) for n in range(0, 60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(7, 7), (None, 3)]
    edges += [(1000, n) for n in range(1001, 1100)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def near_texts():
    rng = random.Random(11)
    out, held = [], prose(rng, 60)
    for _ in range(40):  # a chain: each text differs from the one before in one word
        held = list(held)
        held[rng.randrange(60)] = f"n{rng.randint(0, 10**6)}"
        out.append(" ".join(held))
    base = prose(rng, 80)
    for _ in range(15):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(80)] = f"m{rng.randint(0, 10**6)}"
        out.append(" ".join(copy).upper())
    out += [" ".join(prose(rng, 50)) for _ in range(20)] + ["a b", "A  B", "b a", "a", "", None, " ", out[0], out[0]]
    return out


@pytest.mark.parametrize(("shingle", "percent"), [(3, 85), (5, 80)])
def test_minhash_equals_brute_force(spark, shingle, percent):
    texts = near_texts()
    rows = [(n, t, n) for n, t in enumerate(texts)] + [(3, texts[3], 3), (None, texts[0], 4), (None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component int")
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for n, t in enumerate(texts):
        w = (t or "").encode().translate(low).split()
        sets[n] = {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set())
    parent = {n: n for n in sets}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a in sets:
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    expected = [(n, len(sets[n]), find(n), find(n) == n) for n in [*sets, 3]] + [(None, len(sets[0]), None, True), (None, 0, None, True)]
    assert rows_of(minhash.near_duplicates(docs, minhash.Similarity(shingle, percent))) == sorted(expected, key=repr)


def ever_more_different():
    """Copies with ever more words of their own, and ids of several texts of which one is a copy, its own or another's."""
    rng = random.Random(23)
    base = prose(rng, 200, 4000)
    rows = []
    for n in range(60):
        copy = list(base)
        for place in rng.sample(range(200), n // 2):
            copy[place] = f"o{n}x{place}"
        rows.append((n, " ".join(copy)))
    near = list(rows[9][1].split())
    near[100] = "other"
    other = lambda: " ".join(prose(rng, 200, 10**6))
    rows += [(70, " ".join(near)), (70, other()), (71, other()), (71, rows[3][1]), (72, other()), (72, rows[-1][1]), (72, None)]
    rows += [(73, rows[20][1]), (73, rows[20][1]), (74, other()), (75, other())]
    return rows


@pytest.mark.parametrize("stars", [0, 2])
def test_minhash_of_ids_with_several_texts(spark, monkeypatch, stars):
    """Without stars all pairs go through the last step, whose bounds are of one text."""
    monkeypatch.setattr(minhash, "STAR_ROUNDS", stars)
    rows = ever_more_different()
    sets = [{tuple(w[i : i + 5]) for w in [(t or "").split()] for i in range(len(w) - 4)} for _, t in rows]
    parent = {n: n for n, _ in rows}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(a), find(rows[j][0])
                parent[max(x, y)] = min(x, y)
    expected = [(n, len(s), find(n), find(n) == n) for (n, _), s in zip(rows, sets, strict=True)]
    assert len({row[2] for row in expected}) > 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(docs)) == sorted(expected, key=repr)


def test_minhash_of_nothing(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_bit_estimate_is_near_the_similarity():
    how = minhash.Similarity(1, 80)
    rng = np.random.default_rng(1)
    both = rng.integers(0, 2**63, 900).astype(np.uint64)
    more = rng.integers(0, 2**63, 100).astype(np.uint64)
    one, two = (minhash._signature(np.sort(s), how)[1].view(np.uint64) for s in (both, np.concatenate((both, more))))
    unequal = sum(bin(int(x | (x >> np.uint64(1))) & 0x5555555555555555).count("1") for x in one ^ two)
    share = 1 - unequal / how.hashes
    assert abs((share - 0.25) / 0.75 - 0.9) < 0.12


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    hubs = rng.normal(size=(6, 8))
    vectors = [hubs[n % 6] + 0.25 * rng.normal(size=8) for n in range(150)] + [hubs[0]] * 20
    rows = [(n, v.tolist()) for n, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 8, [1.0] * 7 + [None], [float("nan")] * 8, [float("inf")] + [1.0] * 7]
    docs = spark.createDataFrame([*rows, *((500 + n, v) for n, v in enumerate(odd)), (None, vectors[0].tolist())], "vec_id long, embedding array<double>")
    unit = np.array([v / np.linalg.norm(v) for v in vectors])
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(unit))
    for _ in unit:
        label = np.minimum(label, np.where(linked, label[None, :], len(unit)).min(axis=1))
    expected = [(n, int(linked[n].sum()), int(label[n]), bool(label[n] == n)) for n in range(len(unit))]
    expected += [(500 + n, 0, 500 + n, True) for n in range(len(odd))] + [(None, 0, None, True)]
    for how in (embeddings.Cells(), embeddings.Cells(block=16, most_cells=5), embeddings.Cells(block=7, sample=20)):
        assert rows_of(embeddings.near_duplicates(docs, how)) == sorted(expected, key=repr)
    assert embeddings.near_duplicates(docs.limit(0)).collect() == []
