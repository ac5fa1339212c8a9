"""Ranked search, importance resampling and language identification against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from punctuality.llm import language, lexical, queries, resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


# Importance resampling


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="abZ9é ,.\n€", max_size=60), min_size=1, max_size=6), st.sampled_from([1, 2, 3]), st.sampled_from([1, 7, 1000]))
def test_runs_equal_plain_crcs(texts, longest, limit):
    found = [Counter() for _ in texts]
    words = Counter()
    for rows, runs in resampling.runs(batch(texts), resampling.Shifts(), longest, 0, limit):
        words.update(rows.tolist())
        for own, crc in runs:
            for row, value in zip(own.tolist(), crc.tolist(), strict=True):
                found[row][value] += 1
    for row, text in enumerate(texts):
        own = terms(text)
        assert words[row] == len(own)
        assert found[row] == Counter(zlib.crc32(" ".join(own[i : i + n]).encode()) for n in range(1, longest + 1) for i in range(len(own) - n + 1))


def test_shifts_of_any_length():
    values = np.array([0, 1, 0xDEADBEEF, 0xFFFFFFFF], np.uint32)
    shifts = resampling.Shifts()
    for length in (0, 1, 255, 256, 257, 70_000, 1 << 20):
        before = [zlib.crc32(bytes([k]) * 3) for k in range(4)]
        tail = b"q" * length
        whole = [zlib.crc32(bytes([k]) * 3 + tail) for k in range(4)]
        got = shifts(np.array(before, np.uint32), np.full(4, length)) ^ np.uint32(zlib.crc32(tail))
        assert got.tolist() == whole
    assert shifts(values, np.zeros(4, np.int64)).tolist() == values.tolist()


def resampled(docs, target, percent=25, least=20):
    features = lambda text: [" ".join(w[i : i + n]) for w in [terms(text)] for n in (1, 2) for i in range(len(w) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (Counter(bucket(f) for text in texts for f in features(text)) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda k: math.floor(1000 * math.log(((t[k] + 1) * (all_s + 10_000)) / ((s[k] + 1) * (all_t + 10_000))))
    out = []
    for n, text in docs:
        own = [gain(bucket(f)) for f in features(text)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if n is None else n}".encode()).hexdigest()[:8], 16)
        out.append((n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(terms(text))))
    enough = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    drawn = percent * len(enough) // 100
    ranks = {}
    for place, r in enumerate(enough[:drawn], 1):
        ranks.setdefault(r, []).append(place)
    return sorted(((*r[:4], ranks[r].pop() if ranks.get(r) else None) for r in out), key=repr)


def test_resampling_equals_plain_python(spark):
    chance = random.Random(1)
    words = [f"w{n}" for n in range(60)] + ["été", "X9"]
    text = lambda n: " ".join(chance.choice(words[: chance.choice((8, 62))]) for _ in range(n))
    docs = [(n, text(chance.choice((1, 19, 20, 40, 300)))) for n in range(300)]
    docs += [(300, None), (301, ""), (302, " .,; "), (None, text(30)), (None, None), *docs[:5], *[(7, docs[7][1])] * 3]
    target = [text(30) for _ in range(5)] + [None, ""]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, score string, id int").repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(frame, aim)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows_of(found) == resampled(docs, target)
    places = [r["rank"] for r in found.collect() if r["rank"]]
    assert sorted(places) == list(range(1, len(places) + 1)) and places
    kept = resampling.drawn(frame, found)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in found.collect() if r["rank"]}


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 30), (2, "c " * 30)], "doc_id long, text string")
    assert resampling.resample(none, some).collect() == []
    assert rows_of(resampling.resample(some, none)) == resampled([tuple(r) for r in some.collect()], [])
    half = resampling.Resampling(percent=50, least_words=0)
    assert sum(r["rank"] is not None for r in resampling.resample(some, some, half).collect()) == 1
    words = spark.createDataFrame([("b", "x"), ("a", "y")], "doc_id string, text string")
    assert rows_of(resampling.resample(words, none, resampling.Resampling(least_words=2)).select("doc_id", "rank")) == [("a", None), ("b", None)]


# Ranked search


def searched(docs, items, k=10):
    held = [(n, Counter(terms(text))) for n, text in docs]
    sizes = [sum(c.values()) for _, c in held]
    count, uses = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for (n, c), size in zip(held, sizes, strict=True):
            m = 25 + (75 * size * count) // max(uses, 1)
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, n is None, n or 0, n))
        out += [(item, place, row[3], -row[0]) for place, row in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def corpus():
    chance = random.Random(3)
    words = [f"w{n}" for n in range(80)]
    text = lambda n: " ".join(words[min(int(chance.expovariate(0.08)), 79)] for _ in range(n))
    docs = [(n, text(chance.choice((3, 20, 90)))) for n in range(500)]
    docs += [(n, "w70 w71 copy of many") for n in range(500, 560)]  # ties: more than ten documents of one score
    docs += [(600, None), (601, ""), (602, "  ;"), (None, "w70 w71 copy of many"), (510, "w70 w71 copy of many"), (603, "W70 w71,w70 É")]
    items = [(n, text(12)) for n in range(20)] + [(20, "w70 W71!"), (21, None), (22, "unknown"), (23, ""), (24, "w1 w1 w1 w70"), (24, "é É"), (None, "w2")]
    return docs, items


def test_search_equals_plain_python(spark, corpus, monkeypatch):
    docs, items = corpus
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string").repartition(3)
    asked = spark.createDataFrame([(*i, 0.5) for i in items], "item_id long, text string, score double")
    found = lexical.ranked(frame, asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    expected = searched(docs, items)
    assert rows_of(found) == expected
    # Small shards, waves and blocks of items give the same rows.
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 300)
    assert rows_of(lexical.ranked(frame, asked)) == expected
    assert rows_of(lexical.ranked(frame, asked, lexical.Ranking(k=3))) == searched(docs, items, 3)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_one_shard_at_a_time(data):
    """Posting lists, range maxima and the search itself, over shards of any size."""
    word = st.sampled_from([f"w{n}" for n in range(6)])
    docs = data.draw(st.lists(st.lists(word, max_size=8), min_size=1, max_size=40))
    asked = data.draw(st.lists(word, min_size=1, max_size=5))
    size = data.draw(st.integers(1, 12))
    rule = lexical.Ranking(k=data.draw(st.integers(1, 5)))
    known = lexical.Statistics([], np.array([7, 1, 3, 0, 5, 2], np.int64), len(docs), max(sum(map(len, docs)), 1))
    best = lexical.Best(rule.k)
    wanted, times = np.unique(np.array([int(w[1]) for w in asked], np.int64), return_counts=True)
    scores = []
    for n, doc in enumerate(docs):
        tf, m = Counter(doc), 25 + (75 * len(doc) * known.documents) // known.uses
        score = sum(int(t) * int(known.weight[w]) * ((10**9 * tf[f"w{w}"]) // (1000 * tf[f"w{w}"] + 8 * m)) for w, t in zip(wanted, times, strict=True) if tf[f"w{w}"])
        scores.append((-score, n))
    for at in range(0, len(docs), size):
        held = [(at + n, Counter(int(w[1]) for w in doc), len(doc)) for n, doc in enumerate(docs[at : at + size])][::-1]
        shard = pa.table(
            {
                "id": pa.array([n for n, _, _ in held], pa.int64()),
                "n": pa.array([length for _, _, length in held], pa.int64()),
                "terms": pa.array([sorted(c) for _, c, _ in held], pa.list_(pa.int32())),
                "tf": pa.array([[c[w] for w in sorted(c)] for _, c, _ in held], pa.list_(pa.int32())),
            }
        )
        postings, ids = lexical._postings(shard, known, rule)
        assert lexical.search(postings, ids, wanted, times.astype(np.int64), best) <= len(held)
    assert best.rows == [(-s, n) for s, n in sorted(scores)[: rule.k] if s < 0]


def test_search_looks_at_few_documents():
    """Of 4,000 documents of which twelve hold the rare terms, hardly more than these are scored."""
    chance = np.random.default_rng(5)
    rows = [(n, 0, int(chance.integers(1, 9))) for n in range(4000)] + [(n * 333, t, 1) for n in range(12) for t in (1, 2)]
    doc, term, tf = (np.array(x) for x in zip(*rows, strict=True))
    weight = np.array([1, 5000, 5000])
    postings = lexical.Postings(term, doc, weight[term] * ((10**9 * tf) // (1000 * tf + 800)), 4000)
    best = lexical.Best(10)
    assert lexical.search(postings, list(range(4000)), np.array([0, 1, 2]), np.ones(3, np.int64), best) < 200
    assert {n for _, n in best.rows} <= {n * 333 for n in range(12)}


def test_search_in_nothing(spark):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    docs = spark.createDataFrame([("z", "a b"), ("y", "a b")], "doc_id string, text string")
    assert lexical.ranked(none, items).collect() == []
    assert lexical.ranked(docs, items.limit(0)).collect() == [] and lexical.ranked(docs, items.filter("false")).columns[2] == "doc_id"
    assert searched([(1, "a b"), (2, "a b")], [(1, "a")]) == [(1, 1, 1, 182 * (10**9 // 1800)), (1, 2, 2, 182 * (10**9 // 1800))]
    assert [r.doc_id for r in lexical.ranked(docs, items).orderBy("rank").collect()] == ["y", "z"]


def test_long_text_is_searched_whole(spark):
    docs = [(1, "x " * 300_000 + "needle"), (2, "hay " * 50)]
    found = lexical.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "needle hay")], "item_id long, text string"))
    assert rows_of(found) == searched(docs, [(1, "needle hay")])


# Language identification

SPOKEN = {
    "en": "the and of that with this from have which there been would their about through people house water",
    "de": "der und das nicht eine werden schon durch über zwischen straße häuser wasser können müssen sich auch",
    "fr": "les des une est dans pour avec mais être était très même où après maison l'eau français garçon",
    "el": "και που την είναι από για δεν ότι αυτό μια στο σπίτι νερό άνθρωποι μέσα μετά πολύ",
}


def spoken(lang, n, seed):
    chance = random.Random(f"{lang}{seed}")
    return " ".join(chance.choice(SPOKEN[lang].split()) for _ in range(n))


@pytest.mark.parametrize("n", [2, 3, 6, 7, 40, 300])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert len({tuple(row) for row in code.tolist()}) == n and ((code.min(0) == 0) & (code.max(0) == 1)).all()
    distance = min((code[a] != code[b]).sum() for a in range(n) for b in range(a))
    assert distance >= (1 if n == 2 else 2) and (code == language.codewords(n)).all()
    assert language.codewords(1).shape == (1, 0) and language.codewords(0).shape == (0, 0)


def test_grams_equal_plain_python(monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 5)
    words = ["Ab1c", "ÀB", "—", "x-y"]
    found = Counter()
    for word, n, bucket in language._gram_blocks(pa.array(words)):
        found.update(zip(word.tolist(), [n] * len(word), strict=True))
        assert ((bucket >= 0) & (bucket < language.BUCKETS)).all()
    plain = {0: " ab c ", 1: " àb ", 3: " x y "}
    assert found == {(k, n): len(t.encode()) - n + 1 for k, t in plain.items() for n in language.ORDERS}


def test_languages_are_told(spark):
    rows = [(n, spoken(lang, 12 + n % 9, n), lang, "s") for lang in SPOKEN for n in range(60)]
    rows += [(n, "wrong", None, "s") for n in range(5)] + [(6, None, "en", "s"), (None, "123 456", "en", "s"), (8, "", "de", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    decoder = language.learned(docs)
    assert decoder.languages == sorted(SPOKEN)
    fresh = [(n, spoken(lang, 9, f"new{n}").upper() if n % 3 == 0 and lang != "de" else spoken(lang, 9, f"new{n}"), lang) for lang in SPOKEN for n in range(50)]
    asked = [*[(n, t) for n, t, _ in fresh], (-1, None), (-2, ""), (-3, "12 — 34 !"), (None, spoken("fr", 2000, "long")), (None, "١٢٣")]
    asked_frame = spark.createDataFrame([(*x, 1) for x in asked], "doc_id long, text string, lang_pred int")
    found = language.predict(asked_frame, decoder).collect()
    assert len(found) == len(asked) and all(0 <= r.score <= 1 for r in found)
    told = Counter()
    for (_, _, lang), r in zip(fresh, found, strict=False):
        told[lang == r.lang_pred] += 1
    assert told[True] >= 0.98 * len(fresh)
    rest = [(r.lang_pred, r.score) for r in found[len(fresh) :]]
    assert rest[:3] == [("und", 0.0)] * 3 and rest[3][0] == "fr" and rest[4] == ("und", 0.0)
    # Half of each is flagged, a clear text is not, and the sample's size changes the counts alone.
    mixed = spark.createDataFrame([(1, spoken("en", 40, 1) + " " + spoken("de", 40, 1)), (2, spoken("en", 40, 1))], "doc_id long, text string")
    flags = {r.doc_id: r.ambiguous for r in language.predict(mixed, decoder).collect()}
    assert flags[2] is False
    few = language.learned(docs, sample=8)
    assert few.languages == decoder.languages
    assert language.predict(docs.limit(0), decoder).collect() == []


def test_scores_equal_plain_python(spark):
    """Margins, loss-weighted decoding and score of one text, from the decoder's own tables."""
    docs = spark.createDataFrame([(n, spoken(lang, 15, n), lang) for lang in SPOKEN for n in range(40)], "doc_id long, text string, lang string")
    decoder = language.learned(docs)
    text = "The house, und über: the WATER x9 7"
    said = []
    for word in text.split():
        plain = re.sub(r"[^\w]|\d", " ", word.lower()).split()
        if not plain:
            continue
        held = (" " + " ".join(plain) + " ").encode()
        total = np.zeros(decoder.code.shape[1])
        for n in language.ORDERS:
            for i in range(len(held) - n + 1):
                mixed = 0
                for byte in held[i : i + n]:
                    mixed = (mixed * 0x01000193 + byte + 1) % 2**32
                mixed = ((mixed ^ (n * 0x9E3779B1 % 2**32)) * 0x85EBCA6B) % 2**32
                total += decoder.odds[(mixed >> 16) % language.BUCKETS]
        said.append(np.tanh(total / language.ENOUGH))
    margin = np.mean(said, axis=0) * decoder.scale[:, 0] + decoder.scale[:, 1]
    loss = [(decoder.weight[k] * np.log1p(np.exp(-(2.0 * decoder.code[k] - 1) * margin))).sum() for k in range(len(decoder.languages))]
    share = np.exp(-np.array(loss)) / np.exp(-np.array(loss)).sum()
    (row,) = language.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), decoder).collect()
    assert row.lang_pred == decoder.languages[int(share.argmax())] and row.score == pytest.approx(share.max(), abs=1e-6)


def test_no_language_and_one(spark):
    docs = spark.createDataFrame([(1, "a b c", "xx"), (2, None, "yy")], "doc_id long, text string, lang string")
    one, none = language.learned(docs), language.learned(docs.filter("lang is null"))
    asked = spark.createDataFrame([(1, "hello"), (2, None)], "doc_id long, text string")
    assert rows_of(language.predict(asked, one)) == [(1, "xx", 1.0, False), (2, "und", 0.0, False)]
    assert rows_of(language.predict(asked, none)) == [(1, "und", 0.0, False), (2, "und", 0.0, False)]


def test_registered_language_query(spark):
    from test_registered import TABLES

    if not TABLES.exists():
        pytest.skip("no test tables")
    found = {r.doc_id: r for r in queries.QUERIES["op13_output_codes"](spark, str(TABLES)).collect()}
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "lang").collect()
    held = [found[r.doc_id].lang_pred == r.lang for r in docs if found[r.doc_id].held_out]
    assert {r.doc_id for r in docs} == set(found) and held and sum(held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(n).encode()) % 4 == 2) for n, r in found.items())
