"""BPE encoding and decoding with a contiguous array of ranks.

A word is held as its parts and the ranks of adjacent parts. The smallest rank (leftmost among equals) is looked for
again and again, its boundary is deleted and the two neighbouring ranks are refreshed. Short words lie behind one
another in one contiguous array, so every scan, deletion and refresh serves thousands of words at once; a word
beyond ``SHORT`` parts keeps its ranks in a heap instead, which gives the same merges in n log n.

The result equals the tokenizers library with the same file: normalisation (NFC, white space, lower case) and the
split into words follow that file, special tokens in a text are taken literally, and a text's ids are the ids of
its pieces between white space. Pieces of plain characters, nearly all in most texts, are split together by the kinds of
their characters; the others go one by one through the patterns or the library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from punctuality.llm.common import slices, split_words

SHORT = 32
SLOT_BITS = 18
#: Entries a task remembers of pieces and of words before it starts again.
REMEMBERED = 400_000
#: Pieces that are split into words at once.
GATHERED = 1 << 16
NEVER = np.int32(2**31 - 1)
#: The split pattern of the file, for printable lower-case ASCII and for printable text below PLAIN_END, where no
#: character composes with another and letter case does not depend on the neighbours.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
PLAIN_END = "\u0180"
PLAIN_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Kinds of characters. Without ODD ones, the words of the split pattern are runs of one kind, and each digit is a word.
SPACE, LETTER, DIGIT, OTHER, ODD = range(5)


def _kind(c: str) -> int:
    """ODD: what may begin a contraction or a special token, and what is not below PLAIN_END as it is or in lower case."""
    if c == " ":
        return SPACE
    if not c.isprintable() or c in "'<" or max(c.lower()) >= PLAIN_END:
        return ODD
    return {"L": LETTER, "N": DIGIT}.get(unicodedata.category(c.lower())[0], OTHER)


KINDS = np.array([*(_kind(chr(n)) for n in range(ord(PLAIN_END))), ODD], dtype=np.uint8)
LOWER = np.array([ord(chr(n).lower()[0]) for n in range(ord(PLAIN_END))], dtype="<u4")


def _letters(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all pieces, a space after each piece, and their kinds."""
    letters = np.frombuffer(" ".join([*pieces, ""]).encode("utf-32-le"), dtype="<u4")
    return letters, KINDS[np.minimum(letters, ord(PLAIN_END))]


class WordBpe:
    """Encoder of a BPE file with word ends, lower case and dropped white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        library = Tokenizer.from_file(path)
        self._normalize = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        self.vocab: dict[str, int] = held["model"]["vocab"]
        self._suffix: str = held["model"]["end_of_word_suffix"]
        special = {token["content"]: token["id"] for token in held["added_tokens"]}
        # The space only parts pieces that are split together, so it has no ids.
        self._special = {" ": b""} | {token: self._packed([number]) for token, number in special.items()}
        self._bytes = {n: "".join(w for w, _ in self._split(chr(n))) for n in range(33, ord(PLAIN_END)) if chr(n).isprintable()}
        self._symbols = np.arange(256, dtype="<u4")
        for n, symbols in self._bytes.items():
            self._symbols[[*chr(n).encode()]] = [*map(ord, symbols)]
        alphabet = [c for c in self.vocab if len(c) == 1]
        self._inner = np.zeros(max(map(ord, alphabet)) + 1, dtype=np.int32)
        self._final = self._inner.copy()
        for c in alphabet:
            self._inner[ord(c)], self._final[ord(c)] = self.vocab[c], self.vocab[c + self._suffix]
        self._special_pattern = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.tokens = {number: token.encode() for token, number in (self.vocab | special).items()}
        pairs = [tuple(pair) if isinstance(pair, list) else tuple(pair.split(" ")) for pair in held["model"]["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], dtype=np.int64)
        self._merged = np.array([self.vocab[a + b] for a, b in pairs], dtype=np.int32)
        self._keys = left << 32 | right
        self._rank = {key: rank for rank, key in enumerate(self._keys.tolist())}
        # Each pair has a slot; of pairs with one slot the last has it, the others are looked for by bisection.
        slots, numbers = self._slot(self._keys), np.arange(len(pairs), dtype=np.int32)
        self._slots = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        self._slots[slots] = numbers
        others = numbers[self._slots[slots] != numbers]
        self._others = others[np.argsort(self._keys[others])]
        self._other_keys = np.append(self._keys[self._others], np.iinfo(np.int64).max)
        self._pieces: dict[str, bytes] = {}
        self._words: dict[str, bytes] = dict(self._special)

    @staticmethod
    def _packed(ids: Iterable[int]) -> bytes:
        return np.fromiter(ids, dtype="<u4").tobytes()

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of adjacent parts, NEVER where there is no merge."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        ranks = self._slots[self._slot(keys)]
        unlike = np.flatnonzero(self._keys[ranks] != keys)
        taken = unlike[ranks[unlike] >= 0]
        ranks[unlike] = NEVER
        place = np.searchsorted(self._other_keys, keys[taken])
        found = self._other_keys[place] == keys[taken]
        ranks[taken[found]] = self._others[place[found]]
        return ranks

    def _initial(self, word: str) -> list[int]:
        return [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + self._suffix]]

    def _merge_short(self, words: list[str]) -> list[bytes]:
        """Ids of words of at most SHORT parts; the arrays of all words lie behind one another."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        last = np.cumsum(sizes) - 1
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        parts = self._inner[letters]
        parts[last] = self._final[letters[last]]
        ranks = np.full(len(parts), NEVER, dtype=np.int64)
        ranks[:-1] = self._ranks(parts[:-1], parts[1:])
        ranks[last] = NEVER
        while True:
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(ranks << 32 | np.arange(len(ranks)), starts)  # the leftmost of equal ranks
            go = np.flatnonzero(least >> 32 != NEVER)
            if not len(go):
                break
            at, best = least[go] & 0xFFFFFFFF, least[go] >> 32
            parts[at] = self._merged[best]
            keep = np.ones(len(parts), dtype=bool)
            keep[at + 1] = False
            parts, ranks = parts[keep], ranks[keep]
            sizes[go] -= 1
            gone = np.arange(len(go))
            at -= gone
            first = starts[go] - gone
            ends_here = at == first + sizes[go] - 1
            ranks[at[ends_here]] = NEVER
            for pair in (at[~ends_here], at[at > first] - 1):
                ranks[pair] = self._ranks(parts[pair], parts[pair + 1])
        bounds = np.concatenate(([0], np.cumsum(sizes * 4))).tolist()
        packed = parts.astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _heap(self, word: str) -> bytes:
        """Ids of a long word; the same merges, the smallest rank taken from a heap."""
        ids = self._initial(word)
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        first = self._ranks(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NEVER]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self._merged[best]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := self._rank.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return self._packed(i for i in ids if i >= 0)

    def _learn_words(self, words: list[str]) -> None:
        short = sorted((word for word in words if len(word) <= SHORT), key=len)  # those of like length need about as many merges
        for start in range(0, len(short), 16384):
            part = short[start : start + 16384]
            self._words.update(zip(part, self._merge_short(part), strict=True))
        if len(short) < len(words):
            self._words.update((word, self._heap(word)) for word in words if len(word) > SHORT)

    def _words_of(self, piece: str) -> list[str]:
        """Words of a piece without white space of ASCII, in the byte alphabet of the vocabulary."""
        if piece.isprintable():
            low = piece.lower()
            if low.isascii():
                return ASCII_WORDS.findall(low)
            if max(low) < PLAIN_END and max(piece) < PLAIN_END:
                return [word.translate(self._bytes) for word in PLAIN_WORDS.findall(low)]
        return [word for word, _ in self._split(self._normalize(piece))]

    def _plain(self, pieces: list[str]) -> pa.LargeBinaryArray:
        """Ids of pieces without ODD characters. The words of all pieces are found at once; each distinct one is looked up once."""
        letters, kinds = _letters(pieces)
        low = LOWER[letters]
        begins = np.flatnonzero(np.concatenate(([True], (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT))))
        bounds = np.concatenate(([0], np.cumsum(1 + (low >= 128), dtype=np.int64)))[np.append(begins, len(low))]
        text = pa.py_buffer(low.tobytes().decode("utf-32-le").encode())
        coded = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(bounds), text).dictionary_encode()
        distinct = np.frombuffer("\n".join(coded.dictionary.to_numpy(zero_copy_only=False)).encode(), dtype=np.uint8)
        words = self._symbols[distinct].tobytes().decode("utf-32-le").split("\n")
        known = self._words
        self._learn_words([word for word in words if word not in known])
        _, ends, ids = pa.array([known[word] for word in words], pa.large_binary()).take(coded.indices).buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[1 : len(begins) + 1][kinds[begins] == SPACE]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(np.concatenate(([0], ends))), ids])

    def _odd(self, pieces: list[str]) -> pa.LargeBinaryArray:
        """Ids of any pieces, each split on its own unless it is remembered."""
        if len(self._pieces) > REMEMBERED:
            self._pieces.clear()
        new = [piece for piece in pieces if piece not in self._pieces]
        made: list[list[str]] = []
        for piece in new:
            if "<|" in piece and self._special_pattern.search(piece):
                parts = self._special_pattern.split(piece)
                made.append([w for n, p in enumerate(parts) if p for w in ([p] if n % 2 else self._words_of(p))])
            else:
                made.append(self._words_of(piece))
        known = self._words
        self._learn_words([word for word in set().union(*made) if word not in known])
        self._pieces.update((piece, b"".join([known[w] for w in words])) for piece, words in zip(new, made, strict=True))
        return pa.array([self._pieces[piece] for piece in pieces], pa.large_binary())

    def _ids(self, pieces: list[str]) -> pa.LargeBinaryArray:
        """Ids of each piece."""
        if len(self._words) > REMEMBERED:
            self._words = dict(self._special)
        _, kinds = _letters(pieces)
        plain = np.ones(len(pieces), dtype=bool)
        plain[np.searchsorted(np.flatnonzero(kinds == SPACE), np.flatnonzero(kinds == ODD))] = False
        if plain.all():
            return self._plain(pieces)
        if not plain.any():
            return self._odd(pieces)
        own, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        found = pa.concat_arrays([self._plain([pieces[n] for n in own]), self._odd([pieces[n] for n in others])])
        return found.take(pa.array(np.argsort(np.concatenate((own, others)))))

    def encode_slice(self, part: pa.RecordBatch, column: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, one after the other, and where each text's ids end."""
        pieces, codes, counts = split_words(part, column)
        if not len(codes):
            return np.empty(0, dtype="<u4"), np.zeros(len(counts), dtype=np.int64)
        wanted = pieces.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes an object of Arrow's for each first
        found = [self._ids(wanted[start : start + GATHERED]) for start in range(0, len(wanted), GATHERED)]
        _, ends, ids = pa.concat_arrays(found).take(pa.array(codes)).buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[: len(codes) + 1] // 4
        return np.frombuffer(ids, dtype="<u4")[: ends[-1]], ends[np.cumsum(counts)]

    def forget(self) -> None:
        """Give back what was remembered: a worker outlives its task and would hold it through the stages that follow."""
        self._pieces.clear()
        self._words = dict(self._special)
        pa.default_memory_pool().release_unused()

    def encode_batch(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, ends = self.encode_slice(pa.RecordBatch.from_arrays([pa.array(batch, pa.string())], names=["text"]), 0)
        return np.split(ids, ends[:-1])

    def decode(self, ids: np.ndarray) -> bytes:
        """What the library's decode gives without a decoder and with special tokens: token strings, joined by spaces."""
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    """One encoder a worker and file."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id_column, ids array<int>, decoded string)`` of every whole text. Map-only, no shuffle.

    Null and empty texts give no ids and an empty decoded text; repeated rows and null ids stay rows of their own;
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for part in slices(batches):
            ids, ends = bpe.encode_slice(part)
            decoded = pa.array([bpe.decode(held).decode() for held in np.split(ids, ends[:-1])], pa.string())
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists, decoded], names=[id_column, "ids", "decoded"])
        bpe.forget()

    rows = docs.select(id_column, text_column)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id_column, n_tokens, ids_sha256, decoded_sha256)`` by the same encoder, without moving the ids about.

    Null and empty texts have no ids and the digests of nothing; repeated rows and null ids stay rows of their own; an empty
    table gives no rows; other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        digest = lambda data: hashlib.sha256(data).hexdigest()
        for part in slices(batches):
            ids, ends = bpe.encode_slice(part)
            held = np.split(ids, ends[:-1])
            columns = [
                part.column(0),
                pa.array([len(p) for p in held], pa.int64()),
                pa.array([digest(p.tobytes()) for p in held], pa.string()),
                pa.array([digest(bpe.decode(p)) for p in held], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.forget()

    rows = docs.select(id_column, text_column)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
