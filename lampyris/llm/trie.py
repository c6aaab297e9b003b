"""BPE encoding and decoding by a depth-first walk over the trie of distinct words.

Every prefix of a word has one last token: the only token ending there that can stand after the last token of what
precedes it. Walking the trie depth-first, the states of a shared prefix are worked out once and inherited by all words
below it; a word's ids are read off backwards along its states. Two tokens can stand side by side if no merge would
ever have joined across the border while their halves were being built.

Defined results: null texts encode as empty ones and decode to the empty string; every row gives one row, also rows
that repeat or lack a doc_id. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .units import Library, encoder

END = "</w>"


class Merges:
    """Vocabulary and merges of a word BPE whose words end in a mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.id = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = self.id[left], self.id[right], self.id[left + right]
            self.rank[a, b] = rank
            self.halves.setdefault(c, (a, b, rank))
        self.longest = max(len(t.removesuffix(END)) for t in self.id)
        self.never = len(self.rank) + 1
        self._beside: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at one edge of a token while it is built, outermost first, with the rank that ends it."""
        out, until = [], self.never
        while True:
            out.append((token, until))
            if token not in self.halves:
                return out
            until = self.halves[token][2]
            token = self.halves[token][side]

    def apart(self, a: int, b: int, until: int) -> bool:
        """No merge before rank ``until`` joins the end of ``a`` to the start of ``b``."""
        for left, left_end in self._edge(a, 1):
            for right, right_end in self._edge(b, 0):
                rank = self.rank.get((left, right))
                # of equal merges the one further left comes first
                if rank is not None and rank < min(left_end, until) and rank <= right_end:
                    return False
        return True

    def whole(self, token: int) -> bool:
        """The token is what its own text is encoded as."""
        known = self._whole.get(token)
        if known is None:
            half = self.halves.get(token)
            known = half is None or (self.whole(half[0]) and self.whole(half[1]) and self.apart(*half))
            self._whole[token] = known
        return known

    def beside(self, a: int, b: int) -> bool:
        known = self._beside.get((a, b))
        if known is None:
            if len(self._beside) > 2_000_000:
                self._beside.clear()
            known = self._beside[a, b] = self.apart(a, b, self.never)
        return known


class Trie(Library):
    """Ids of pieces from the trie; other chunks go to the library."""

    def __init__(self, path: str):
        super().__init__(path)
        self.merges = Merges(path)

    def _last(self, word: str, end: int, states: list[tuple[int, int]], mark: str) -> tuple[int, int]:
        """(last token, its length) of word[:end]; ``states`` has those of all shorter prefixes."""
        m = self.merges
        for start in range(max(0, end - m.longest), end):
            token = m.id.get(word[start:end] + mark)
            if token is not None and m.whole(token) and (start == 0 or m.beside(states[start][0], token)):
                return token, end - start
        raise ValueError(f"{word[:end]!r} has a letter that the vocabulary lacks")

    def pieces(self, found: list[bytes]) -> list[list[int]]:
        spelt = ["".join([self.letters[b] for b in x]) for x in found]
        out: list = [None] * len(spelt)
        before, states = "", [(-1, 0)]  # states[i]: of the prefix of i letters, along the path to the word
        for i in sorted(range(len(spelt)), key=spelt.__getitem__):
            word = spelt[i]
            shared, most = 0, min(len(before), len(word), len(states) - 1)
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :]
            for end in range(len(states), len(word)):
                states.append(self._last(word, end, states, ""))
            token, n = self._last(word, len(word), states, END)
            ids, at = [token], len(word) - n
            while at:
                token, n = states[at]
                ids.append(token)
                at -= n
            out[i] = ids[::-1]
            before = word
        return out


def _encoded(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, Trie)
        for batch in words.slices(batches, "text"):
            ids, at = encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids): the token ids of each whole text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encoded(path), "doc_id long, ids array<int>")


def _spelt(path: str | None) -> np.ndarray:
    tokenizer = encoder(path, Trie).source.tokenizer
    out = np.empty(tokenizer.get_vocab_size(), dtype=object)
    for token, i in tokenizer.get_vocab().items():
        out[i] = token.encode()
    return out


def _decoded(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = _spelt(path)
        for batch in batches:
            column = batch.column("ids")
            at = column.offsets.to_numpy() - column.offsets[0].as_py()
            flat = spelt[column.flatten().to_numpy()].tolist()
            text = [b" ".join(flat[a:b]).decode() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids): tokens joined by one space, as a tokenizer without a decoder does."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(path), "doc_id long, text string")


def _digests(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, spelt = encoder(path, Trie), _spelt(path)
        numbers = np.array([str(i).encode() for i in range(len(spelt))], dtype=object)
        for batch in words.slices(batches, "text", 1 << 21):
            ids, at = encode(batch.column("text"))
            columns = []
            for table in (numbers, spelt):
                flat = table[ids].tolist()
                columns.append(pa.array([hashlib.sha256(b" ".join(flat[a:b])).hexdigest() for a, b in zip(at[:-1], at[1:])]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(at)), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return run


def round_trip_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each text, encoded and decoded in one pass."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
