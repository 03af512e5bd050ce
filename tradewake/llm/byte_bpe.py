"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

A task cuts the texts of a batch into words with the tokenizer's own pattern, encodes every
distinct word once and puts the documents together by array indexing. Encoding is done for all
new words at once: their symbols lie in one flat array; in a round, the ranks of all neighbouring
pairs are found by binary search over the sorted pair keys, every word merges all occurrences of
its lowest-ranking pair from left to right, and finished words leave. Decoding gathers the bytes
of the ids. The vocabulary is a file whose path is a parameter; tasks read it where they run.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tradewake.llm.flat import row_ranges, text_buffers
from tradewake.llm.frames import bounded_batches, doc_texts, map_batches

# Fixed values of the public byte-level pre-tokenizer: word pattern and printable stand-ins.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

# Bytes of text handled at once, and words remembered between batches; neither changes a result.
BATCH_BYTES = 1 << 19
REMEMBERED = 150_000

SHIFT = np.int64(1 << 32)


def byte_names() -> dict[str, int]:
    """The vocabulary's character for every byte: itself if printable, else the next above 255."""
    names = {chr(b): b for b in PRINTABLE}
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {**names, **{chr(256 + i): b for i, b in enumerate(rest)}}


@dataclass
class Vocabulary:
    pair_keys: np.ndarray
    pair_rank: np.ndarray
    pair_result: np.ndarray
    byte_id: np.ndarray
    token_bytes: np.ndarray
    token_start: np.ndarray
    token_size: np.ndarray
    added: dict[str, int]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    ids, names = described["model"]["vocab"], byte_names()
    added = {t["content"]: t["id"] for t in described.get("added_tokens", ())}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
              for m in described["model"]["merges"]]
    keys = np.array([ids[a] * int(SHIFT) + ids[b] for a, b in merges], np.int64)
    order = np.argsort(keys)
    spelled = {i: bytes(names[c] for c in token) for token, i in ids.items()}
    spelled.update({i: token.encode() for token, i in added.items()})
    pieces = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
    sizes = np.array([len(p) for p in pieces], np.int64)
    by_byte = {b: ids[c] for c, b in names.items()}
    return Vocabulary(
        keys[order], order.astype(np.int64),
        np.array([ids[a + b] for a, b in merges], np.int64)[order],
        np.array([by_byte[b] for b in range(256)], np.int64),
        np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes, added)


def merge_rounds(vocab: Vocabulary, symbols: np.ndarray,
                 sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encode words given as byte symbols laid end to end; ids laid end to end and their counts."""
    done_ids, done_words = [], []
    word = np.repeat(np.arange(len(sizes)), sizes)
    none = len(vocab.pair_rank)
    while len(symbols):
        keys = symbols[:-1] * SHIFT + symbols[1:]
        at = np.searchsorted(vocab.pair_keys, keys)
        at[at == none] = 0
        found = (vocab.pair_keys[at] == keys) & (word[:-1] == word[1:])
        rank = np.full(len(symbols), none, np.int64)
        rank[:-1][found] = vocab.pair_rank[at[found]]
        firsts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lowest = np.minimum.reduceat(rank, firsts)
        lengths = np.diff(np.r_[firsts, len(symbols)])
        finished = np.repeat(lowest == none, lengths)
        if finished.any():
            done_ids.append(symbols[finished])
            done_words.append(word[finished])
        hit = rank == np.repeat(lowest, lengths)
        hit &= ~finished
        # In a row of equal symbols hits overlap: of each run of hits every other one counts.
        places = np.flatnonzero(hit)
        if len(places):
            new_run = np.r_[True, np.diff(places) > 1]
            run_start = places[new_run][np.cumsum(new_run) - 1]
            places = places[(places - run_start) % 2 == 0]
            symbols = symbols.copy()
            into = np.searchsorted(vocab.pair_keys, symbols[places] * SHIFT + symbols[places + 1])
            symbols[places] = vocab.pair_result[into]
        stay = ~finished
        stay[places + 1] = False
        symbols, word = symbols[stay], word[stay]
    if not done_ids:
        return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
    ids, owner = np.concatenate(done_ids), np.concatenate(done_words)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=len(sizes))


class Encoder:
    """Encodes batches of texts; remembers the ids of words that it has met."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        added = sorted(self.vocab.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pattern = regex.compile(WORD_PATTERN)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool, self.size = np.zeros(1 << 16, np.int32), []
        self.used = 0

    def pieces(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text)
        found, last = [], 0
        for match in self.special.finditer(text):
            found += self.pattern.findall(text[last:match.start()])
            found.append("\0" + match.group())  # no word of the pattern spells like this
            last = match.end()
        return found + self.pattern.findall(text[last:])

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if not (w[0] == "\0" and w[1:] in self.vocab.added)]
        sizes = np.array([len(w.encode()) for w in plain], np.int64)
        data = np.frombuffer("".join(plain).encode(), np.uint8)
        ids, counts = merge_rounds(self.vocab, self.vocab.byte_id[data], sizes)
        marked = [w for w in new if w[0] == "\0" and w[1:] in self.vocab.added]
        ids = np.r_[ids, np.array([self.vocab.added[w[1:]] for w in marked], np.int64)]
        counts = np.r_[counts, np.ones(len(marked), np.int64)]
        for w in plain + marked:
            self.known[w] = len(self.known)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.r_[self.pool, np.zeros(len(self.pool), np.int32)]
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.size.append(counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, and the number of ids of each text."""
        if len(self.known) > REMEMBERED:
            self._forget()
        split = [self.pieces(t) for t in texts]
        fresh = set().union(*split) - self.known.keys()
        if fresh:
            self._learn(sorted(fresh))
        counts = np.array([len(s) for s in split], np.int64)
        index = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64,
                            int(counts.sum()))
        if not len(index):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        size = np.concatenate(self.size)
        self.size = [size]
        start = np.cumsum(size) - size
        each = size[index]
        ends = np.cumsum(each)
        ids = self.pool[np.repeat(start[index] - (ends - each), each) + np.arange(ends[-1])]
        bounds = np.r_[0, ends][np.r_[0, np.cumsum(counts)]]
        return ids, np.diff(bounds)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids laid end to end, and where the bytes of each id end."""
        size = self.vocab.token_size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.vocab.token_start[ids] - (ends - size), size) + np.arange(total)
        return self.vocab.token_bytes[at], ends


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _coded(batch: pa.RecordBatch, path: str, full: bool):
    coder = encoder(path)
    doc_ids, texts = batch.column(0), batch.column(1)
    _, offsets = text_buffers(texts)
    for first, last in row_ranges(offsets, BATCH_BYTES):
        part = texts.slice(first, last - first).to_pylist()
        ids, counts = coder.encode(part)
        data, ends = coder.decode(ids)
        ends = np.r_[0, ends]
        bounds = np.r_[0, np.cumsum(counts)]
        little = ids.astype("<u4")
        lists, id_sha, text_sha, decoded = [], [], [], []
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            id_sha.append(hashlib.sha256(little[begin:end]).hexdigest())
            spelled = data[ends[begin]:ends[end]].tobytes().decode("utf-8", "replace")
            text_sha.append(hashlib.sha256(spelled.encode()).hexdigest())
            if full:
                lists.append(ids[begin:end])
                decoded.append(spelled)
        columns = [doc_ids.slice(first, last - first), pa.array(counts, pa.int64()),
                   pa.array(id_sha, pa.string()), pa.array(text_sha, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if full:
            columns += [pa.array(lists, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            names += ["ids", "decoded"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, path: str, full: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if ``full``, ids and decoded.

    Null and empty texts have no tokens. Added tokens of the vocabulary that occur in a text are
    single tokens. Repeated rows give repeated rows, an empty table an empty result; other
    columns are not looked at. Nothing is truncated, padded or added.
    """
    bounded_batches(docs.sparkSession)
    schema = DIGESTS + (", ids array<int>, decoded string" if full else "")
    return map_batches(doc_texts(docs), lambda batch: _coded(batch, path, full), schema)
