"""Byte-pair encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. A round finds the rank of every pair
of neighbours by binary search over the sorted pair keys, takes the lowest rank of
each word, and merges all its occurrences at once.
"""

from __future__ import annotations

import codecs
import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkyield.llm.common import texts

# Fixed values of the byte-level pre-tokenizer: its word pattern, and the code points
# that its Unicode tables do not yet count as letters or digits (first, last).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNKNOWN = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D),
    (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE),
    (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191),
    (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED),
    (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]

_WORDS = regex.compile(PATTERN)
_UNKNOWN = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNKNOWN) + "]")
_NEVER = np.int64(1 << 40)
#: chunks kept between batches, words of one block, characters of one batch
_CACHE, _BLOCK, _CHARS = 500_000, 400_000, 2_000_000


def _byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return [out[b] for b in range(256)]


class Vocabulary:
    """Tokens and merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, raw: bytes):
        data = json.loads(raw)
        vocab, chars = data["model"]["vocab"], _byte_chars()
        self.byte_ids = np.array([vocab[c] for c in chars], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.splitter = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        byte_of = {c: b for b, c in enumerate(chars)}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        tokens |= {i: t.encode() for t, i in self.special.items()}
        ordered = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.token_bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.token_len = np.array([len(t) for t in ordered], np.int64)
        self.token_start = np.cumsum(self.token_len) - self.token_len

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)

    def result(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.merged[np.searchsorted(self.keys, (left << 32) | right)]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all words and the number of ids of each; no word is empty."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lens)
        rank = np.full(len(sym), _NEVER)
        if len(sym) > 1:
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside] = self.rank(sym[inside], sym[inside + 1])
        out_sym, out_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            best = np.repeat(lowest, np.diff(np.r_[starts, len(sym)]))
            going = best < _NEVER
            if not going.all():
                out_sym.append(sym[~going])
                out_word.append(word[~going])
                sym, word, rank, best = sym[going], word[going], rank[going], best[going]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == best)
            if len(at) > 1:  # of overlapping occurrences every other one, from the left
                fresh = np.r_[True, np.diff(at) != 1]
                run = np.arange(len(at)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
                at = at[run % 2 == 0]
            sym[at] = self.result(sym[at], sym[at + 1])
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # where they stand once the right halves are gone
            sym, word, rank = sym[keep], word[keep], rank[keep]
            near = np.concatenate([at, at[at > 0] - 1])
            rank[near] = _NEVER
            near = near[near + 1 < len(sym)]
            near = near[word[near] == word[near + 1]]
            rank[near] = self.rank(sym[near], sym[near + 1])
        sym, word = np.concatenate(out_sym), np.concatenate(out_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``; their text may need replacement characters."""
        n = self.token_len[ids]
        ends = np.cumsum(n)
        if not len(ends):
            return b""
        index = np.arange(ends[-1]) + np.repeat(self.token_start[ids] - (ends - n), n)
        return self.token_bytes[index].tobytes()


def _pieces(text: str) -> Iterator[str] | list[str]:
    """The words of the pre-tokenizer."""
    if not text.isascii() and max(text) >= "\u0558" and _UNKNOWN.search(text):
        same = _UNKNOWN.sub("\u0378", text)  # an unassigned code point
        return (text[m.start() : m.end()] for m in _WORDS.finditer(same))
    if len(text) <= _CHARS:
        return _WORDS.findall(text)
    return (m[0] for m in _WORDS.finditer(text))


class Encoder:
    """Encodes texts, remembering what it has encoded up to a bound.

    No word of the pre-tokenizer goes on over a single space between two characters
    that are not white space. So a text is cut there, and each chunk is encoded once.
    A text with a space beside other white space is cut into words instead.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self):
        self.code: dict[str, int] = {}  # of chunks and words as they are
        self.after_space: dict[str, int] = {}  # of chunks without their leading space
        self.written: list[str] = []
        self.pool, self.used = np.zeros(1 << 16, np.int64), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, chunks: list[str]) -> range:
        """Encode chunks; their codes."""
        pieces, counts = [], []
        for chunk in chunks:
            found = list(_pieces(chunk))
            pieces += found
            counts.append(len(found))
        ids, sizes = self.vocabulary.encode_words([w.encode("utf-8", "replace") for w in pieces])
        sizes = np.add.reduceat(sizes, np.cumsum(counts) - counts)
        n, m = len(self.written), len(self.written) + len(chunks)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.r_[self.pool[: self.used], np.zeros(self.used + 2 * len(ids), np.int64)]
        if m > len(self.start):
            self.start = np.r_[self.start, np.zeros(2 * m, np.int64)]
            self.size = np.r_[self.size, np.zeros(2 * m, np.int64)]
        self.pool[self.used : self.used + len(ids)] = ids
        ends = np.cumsum(sizes)
        self.start[n:m], self.size[n:m] = self.used + ends - sizes, sizes
        self.used += len(ids)
        digits = list(map(str, ids.tolist()))
        self.written += [",".join(digits[b - s : b]) for b, s in zip(ends.tolist(), sizes.tolist())]
        return range(n, m)

    def _know(self, plain: set[str], spaced: set[str]):
        if len(self.written) > _CACHE:
            self._forget()
        if new := [x for x in plain if x not in self.code]:
            self.code.update(zip(new, self._learn(new)))
        # -1: white space beside the space, so the text can't be cut there
        new = []
        for x in spaced:
            if x not in self.after_space:
                if x and not x[0].isspace() and not x[-1].isspace():
                    new.append(x)
                else:
                    self.after_space[x] = -1
        if new:
            self.after_space.update(zip(new, self._learn([" " + x for x in new])))

    def _segments(self, text: str) -> Iterator[tuple[int | None, str]]:
        """Special tokens, and between them ordinary text; no empty ones."""
        if not any(s in text for s in self.vocabulary.special):
            pieces = [text]
        else:
            pieces = self.vocabulary.splitter.split(text)
        return ((self.vocabulary.special.get(p), p) for p in pieces if p)

    def _part(self, codes: np.ndarray) -> tuple[np.ndarray, str]:
        n = self.size[codes]
        ends = np.cumsum(n)
        ids = self.pool[np.arange(ends[-1]) + np.repeat(self.start[codes] - (ends - n), n)]
        return ids, ",".join(map(self.written.__getitem__, codes.tolist()))

    def _codes(self, text: str, chunks: list[str]) -> np.ndarray:
        """Codes of the chunks of a text, or of its words where it can't be cut."""
        first, middle = chunks[0], chunks[1:]
        if first and not first[-1].isspace():
            codes = np.fromiter(map(self.after_space.__getitem__, middle), np.int64, len(middle))
            if not len(codes) or codes.min() >= 0:
                return np.r_[self.code[first], codes]
        words = list(_pieces(text))
        if new := [x for x in set(words) if x not in self.code]:
            self.code.update(zip(new, self._learn(new)))
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def _special(self, special: int) -> tuple[np.ndarray, str]:
        return np.array([special]), str(special)

    def _small(self, group: list[str]) -> list[list[tuple[np.ndarray, str]]]:
        split = [[(s, p, p.split(" ")) for s, p in self._segments(t)] for t in group]
        plain, spaced = set(), set()
        for _, _, chunks in (x for segments in split for x in segments):
            if chunks[0]:
                plain.add(chunks[0])
            spaced.update(chunks[1:])
        self._know(plain, spaced)
        return [
            [self._part(self._codes(p, c)) if s is None else self._special(s) for s, p, c in segments]
            for segments in split
        ]

    def _large(self, text: str) -> Iterator[tuple[np.ndarray, str]]:
        for special, piece in self._segments(text):
            if special is not None:
                yield self._special(special)
                continue
            words = iter(_pieces(piece))
            while block := list(itertools.islice(words, _BLOCK)):
                self._know(set(block), set())
                codes = np.fromiter(map(self.code.__getitem__, block), np.int64, len(block))
                yield self._part(codes)

    def batches(self, values: Iterator[str]) -> Iterator[list]:
        """For texts of about ``_CHARS`` characters in all: per text its parts.

        A part has its ids and their decimal form. A longer text comes alone, as a
        generator of parts.
        """
        group, chars = [], 0
        for text in values:
            if len(text) > _CHARS:
                if group:
                    yield self._small(group)
                    group, chars = [], 0
                yield [self._large(text)]
                continue
            group.append(text)
            chars += len(text)
            if chars > _CHARS:
                yield self._small(group)
                group, chars = [], 0
        if group:
            yield self._small(group)


def load(docs: DataFrame, path: str):
    """The vocabulary file as a broadcast: its size is that of one file, about 2 MB."""
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids array<int>`` to every row; null and empty texts have none.

    The strings of special tokens become their ids, as the tokenizers library has it.
    A column named ``ids`` is replaced; all other columns and repeated rows stay.
    """
    keep = [c for c in docs.columns if c != ids]
    raw, at = load(docs, path), keep.index(text)
    given = docs.select(*[F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(keep)])
    schema = ", ".join(f"d{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(raw.value))
        for batch in batches:
            first = 0
            for group in encoder.batches(texts(batch.column(at))):
                parts = [[i for i, _ in p] for p in group]
                rows = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
                sizes = np.cumsum([0, *map(len, rows)])
                flat = np.concatenate(rows).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat))
                cut = batch.slice(first, len(rows))
                first += len(rows)
                yield pa.RecordBatch.from_arrays(
                    [*cut.columns, column], [f"d{i}" for i in range(len(keep))] + ["ids"]
                )

    out = given.mapInArrow(scan, f"{schema}, ids array<int>")
    names = [F.col(f"d{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(*names, F.col("ids").alias(ids))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of ``ids``; null ids give a null text. Invalid bytes become U+FFFD."""
    keep = [c for c in docs.columns if c != text]
    raw, at = load(docs, path), keep.index(ids)
    given = docs.select(*[F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(keep)])
    schema = ", ".join(f"d{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(raw.value)
        for batch in batches:
            out = []
            for row in batch.column(at):
                value = None
                if row.is_valid:
                    number = row.values.to_numpy(zero_copy_only=False).astype(np.int64)
                    value = vocabulary.decode_bytes(number).decode("utf-8", "replace")
                out.append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.string())],
                [f"d{i}" for i in range(len(keep))] + ["decoded"],
            )

    out = given.mapInArrow(scan, f"{schema}, decoded string")
    names = [F.col(f"d{i}").alias(c) for i, c in enumerate(keep)]
    return out.select(*names, F.col("decoded").alias(text))


def digests(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encode every text and decode its ids again; the digests of both.

    ``n_tokens``, ``ids_sha256`` of the decimal ids joined by commas and
    ``decoded_sha256`` of the decoded text in UTF-8. Null texts count as empty. A very
    long text is worked on in blocks of words, so memory stays bounded.
    """
    raw = load(docs, path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(raw.value))
        for batch in batches:
            counts, written, decoded = [], [], []
            for group in encoder.batches(texts(batch.column(1))):
                for parts in group:
                    n, a, b = 0, hashlib.sha256(), hashlib.sha256()
                    lossy = codecs.getincrementaldecoder("utf-8")("replace")
                    for ids, digits in parts:
                        a.update(b"," if n else b"")
                        a.update(digits.encode())
                        n += len(ids)
                        b.update(lossy.decode(encoder.vocabulary.decode_bytes(ids)).encode())
                    b.update(lossy.decode(b"", final=True).encode())
                    counts.append(n)
                    written.append(a.hexdigest())
                    decoded.append(b.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(written), pa.array(decoded)],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(
        scan, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
