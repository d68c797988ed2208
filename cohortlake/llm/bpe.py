"""Byte-pair encoding and decoding of whole texts by batched merge rounds.

The file of a public tokenizer (``tokenizers`` format, BPE over byte-level symbols with a
word-end suffix) gives vocabulary and merges; nothing is trained. Texts are cut at spaces, and each
distinct chunk is encoded once per worker. All new chunks' symbols lie in one flat array. A round
finds the rank of every adjacent pair by binary search over sorted pair keys, and in each word
replaces the pairs of its lowest rank; words without a pair left drop out. If a merge's symbol can
take part in a merge of lower rank, only the first such pair of the word is replaced in a round,
which is the order one merge at a time would take.

Cases: a null text counts as empty and has no ids; decoding no ids gives the empty text. Strings
of special tokens in a text become their ids, as in the library. Rows are independent, so null or
repeated doc_ids and other columns make no difference.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import batch, prepare

#: Distinct chunks that a worker remembers before it starts anew.
REMEMBERED = 1_000_000
#: Bytes of chunks and ids, about, beyond which a memory forgets all.
MOST_BYTES = 64 << 20
#: New chunks that are encoded in one go.
TOGETHER = 100_000
NONE = np.iinfo(np.int64).max
#: A chunk that ends in one of these after a letter below U+0130 is its two parts' ids: such letters
#: stay letters when normalized, so a word ends there.
STOPS, LETTERS = frozenset(".,;:!?"), "\u0130"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable ones for themselves, the rest
    from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in plain)
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class Bpe:
    """A vocabulary with its merges. Normalization (NFC, one space for white space, lower case by
    code point) and the pattern of words are read from the file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._specials = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._words = regex.compile(pattern, regex.V0)
        self.tokens = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token.encode()
        symbols = byte_symbols()
        self._inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self._final = np.array([vocab[s + suffix] for s in symbols], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self._keys, self._rank, self._made = keys[order], order, made
        first = np.full(len(self.tokens), NONE)
        np.minimum.at(first, left, np.arange(len(pairs)))
        np.minimum.at(first, right, np.arange(len(pairs)))
        self._safe = first[made] > np.arange(len(pairs))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
        return np.where(self._keys[at] == wanted, self._rank[at], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of non-empty words, and how many each word has."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbol = self._inner[raw]
        ends = np.cumsum(sizes) - 1
        symbol[ends] = self._final[raw[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_words = [], []
        rank = np.full(len(symbol), NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self._ranks(symbol[inside], symbol[inside + 1])
        while len(symbol):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            spans = np.diff(np.append(starts, len(word)))
            lowest = np.minimum.reduceat(rank, starts)
            over = lowest == NONE
            if over.any():
                out = np.repeat(over, spans)
                done_ids.append(symbol[out])
                done_words.append(word[out])
                symbol, word, rank = symbol[~out], word[~out], rank[~out]
                if not len(symbol):
                    break
                starts = np.flatnonzero(np.diff(word, prepend=-1))
                spans, lowest = spans[~over], lowest[~over]
            hit = np.flatnonzero(rank == np.repeat(lowest, spans))
            # of pairs that overlap (a a a), take every other one from the left
            chain = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
            place = np.arange(len(hit)) - np.repeat(chain, np.diff(np.append(chain, len(hit))))
            hit = hit[place % 2 == 0]
            owner = word[hit]
            first = np.diff(owner, prepend=-1) != 0
            hit = hit[first | self._safe[rank[hit]]]
            symbol[hit] = self._made[rank[hit]]
            stay = np.ones(len(symbol), dtype=bool)
            stay[hit + 1] = False
            at = (np.cumsum(stay) - 1)[hit]
            symbol, word, rank = symbol[stay], word[stay], rank[stay]
            touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[touched] = NONE
            pair = touched[touched + 1 < len(word)]
            pair = pair[word[pair] == word[pair + 1]]
            rank[pair] = self._ranks(symbol[pair], symbol[pair + 1])
        if not done_ids:
            return symbol, sizes
        ids, owners = np.concatenate(done_ids), np.concatenate(done_words)
        return ids[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))

    def _pieces(self, chunk: str) -> list[bytes | int]:
        """The words of a chunk in UTF-8; special tokens as ids."""
        if "<|" not in chunk:
            return self._plain(chunk)
        out: list[bytes | int] = []
        at = 0
        for found in self._specials.finditer(chunk):
            out += self._plain(chunk[at : found.start()])
            out.append(self.special[found.group()])
            at = found.end()
        return out + self._plain(chunk[at:])

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return [w.encode() for w in self._words.findall(text.lower())]

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the chunks, and how many each has."""
        place: dict[bytes, int] = {}
        wanted, counts = [], np.zeros(len(chunks), dtype=np.int64)
        for i, chunk in enumerate(chunks):
            pieces = self._pieces(chunk)
            counts[i] = len(pieces)
            for piece in pieces:
                special = isinstance(piece, int)
                wanted.append(-1 - piece if special else place.setdefault(piece, len(place)))
        if not wanted:
            return np.empty(0, dtype=np.int64), counts
        flat, sizes = self.merge(list(place)) if place else (np.empty(0, np.int64), np.empty(0, np.int64))
        specials = np.array(sorted(self.special.values()), dtype=np.int64)
        flat, begin = np.concatenate([flat, specials]), len(flat)
        sizes = np.concatenate([sizes, np.ones(len(specials), dtype=np.int64)])
        offsets = np.concatenate([np.cumsum(sizes[: len(place)]) - sizes[: len(place)],
                                  begin + np.arange(len(specials))])
        at = np.array(wanted, dtype=np.int64)
        at = np.where(at < 0, len(place) + np.searchsorted(specials, -1 - at), at)
        owner = np.repeat(np.arange(len(chunks)), counts)
        n = np.bincount(owner, weights=sizes[at], minlength=len(chunks)).astype(np.int64)
        return gather(flat, offsets[at], sizes[at]), n

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids as the library gives it for a file without a decoder: the tokens as they
        are written in the vocabulary, a space between them; in UTF-8."""
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


def gather(flat: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges ``flat[o : o + n]``, one after the other."""
    total = int(sizes.sum())
    shift = np.repeat(offsets - (np.cumsum(sizes) - sizes), sizes)
    return flat[shift + np.arange(total)]


class Memory(dict):
    """Encodes texts chunk by chunk and remembers chunks. ``encode_chunks`` maps a list of chunks
    to flat ids and counts."""

    def __init__(self, encode_chunks: Callable, vocabulary: int, most: int = REMEMBERED) -> None:
        super().__init__()
        self._encode, self._most = encode_chunks, most
        self.dtype = np.uint16 if vocabulary <= 1 << 16 else np.uint32
        self.begin()

    def begin(self) -> None:
        """Forget all chunks."""
        self.clear()
        self._bytes = 0
        self._new: list[tuple[str, tuple[int, int] | None]] = []
        self._flat = np.empty(1 << 16, dtype=self.dtype)
        self._used = 0
        self._offsets = np.empty(0, dtype=np.int64)
        self._sizes = np.empty(0, dtype=np.int64)

    def __missing__(self, chunk: str) -> int:
        parts = None
        if len(chunk) > 1 and chunk[-1] in STOPS and chunk[-2] < LETTERS and chunk[-2].isalpha():
            parts = self[chunk[:-1]], self[chunk[-1]]
        self[chunk] = i = len(self)
        self._bytes += 4 * len(chunk) + 16
        self._new.append((chunk, parts))
        return i

    def _learn(self) -> None:
        if not self._new:
            return
        whole = np.array([parts is None for _, parts in self._new])
        flat, own = self._encode([chunk for chunk, parts in self._new if parts is None])
        sizes, offsets = (np.zeros(len(self._new), dtype=np.int64) for _ in range(2))
        sizes[whole], offsets[whole] = own, self._keep(flat) + np.cumsum(own) - own
        self._sizes = np.concatenate([self._sizes, sizes])
        self._offsets = np.concatenate([self._offsets, offsets])
        if not whole.all():
            at = np.array([parts for _, parts in self._new if parts is not None])
            begin = len(self._sizes) - len(whole)
            own = self._sizes[at].sum(axis=1)
            flat = gather(self._flat, self._offsets[at.ravel()], self._sizes[at.ravel()])
            self._sizes[begin:][~whole] = own
            self._offsets[begin:][~whole] = self._keep(flat) + np.cumsum(own) - own
        self._new = []

    def _keep(self, flat: np.ndarray) -> int:
        """Append ids to those that are remembered; returns where they begin."""
        begin, need = self._used, self._used + len(flat)
        if need > len(self._flat):
            grown = np.empty(max(need, 2 * len(self._flat)), dtype=self.dtype)
            grown[:begin] = self._flat[:begin]
            self._flat = grown
        self._flat[begin:need] = flat
        self._used = need
        return begin

    def encode(self, texts: Iterator[str | None]) -> Iterator[np.ndarray]:
        """The ids of every text, in order. What is remembered is looked at before the first text, and
        after every so many chunks or bytes."""
        waiting: list[np.ndarray] = []
        length = 0
        self._bound()
        for text in texts:
            plain = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ")
            chunks = plain.split(" ")
            waiting.append(np.fromiter(map(self.__getitem__, chunks), np.int32, len(chunks)))
            length += len(chunks)
            if len(self._new) >= TOGETHER or length >= 1 << 20 or self._bytes > MOST_BYTES:
                yield from self._flush(waiting)
                waiting, length = [], 0
                self._bound()
        yield from self._flush(waiting)

    def _bound(self) -> None:
        if len(self) > self._most or self._bytes > MOST_BYTES:
            self.begin()

    def _flush(self, waiting: list[np.ndarray]) -> Iterator[np.ndarray]:
        self._learn()
        for at in waiting:
            yield gather(self._flat, self._offsets[at], self._sizes[at])


@cache
def load(path: str) -> Bpe:
    return Bpe(path)


@cache
def memory(path: str) -> Memory:
    """A worker's own memory for one vocabulary file; it is emptied when a task ends, so that what
    runs next in the worker has the room."""
    bpe = load(path)
    return Memory(bpe.encode_chunks, len(bpe.tokens), REMEMBERED // 4)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bpe = memory(where), load(where)
        for part in batches:
            ids = list(own.encode(part.column("text").to_pylist()))
            yield batch(
                ["doc_id", "ids", "decoded"],
                part.column("doc_id"),
                pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                pa.array([bpe.decode(x).decode() for x in ids], pa.string()),
            )
        own.begin()

    where = path or vocabulary_path()
    return _input(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes like
    ``encode_documents``, and carries only the digests out of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bpe = memory(where), load(where)
        for part in batches:
            n, of_ids, of_text = [], [], []
            for ids in own.encode(part.column("text").to_pylist()):
                n.append(len(ids))
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield batch(
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                part.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(of_ids, pa.string()),
                pa.array(of_text, pa.string()),
            )
        own.begin()

    where = path or vocabulary_path()
    return _input(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _input(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
