"""Greedy word-piece counts by a linear longest-match automaton.

A trie over the vocabulary gets, for every node, a failure link and the number of pieces that
following it pops: if the node's string is a piece, one piece is popped and the link leads to
the root; otherwise the link continues the parent's failure with the node's symbol, adding
the pieces popped on the way.  Reading a word symbol by symbol and adding the popped counts
gives the number of pieces of the greedy longest-match-first split in time linear in the
word's length, without building a piece.

Words are runs of letters and digits (non-ASCII bytes count as letters), or one other
visible character; A-Z are lower-cased.  Symbols are the word's bytes and one end mark, as
in a vocabulary whose word-final pieces carry a suffix.  A word without a full split counts
as one unknown piece.

Each task keeps the automaton (built once per worker from the vocabulary file) and a bounded
cache of word counts.

Defined cases: null and empty texts have no words and no pieces; repeated rows are counted
each; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm._work import arrow_map

END = 256
WORD = re.compile(rb"[0-9a-z\x80-\xff]+|[^\x00-\x20\x7f0-9a-z\x80-\xff]")
CACHE_WORDS = 400_000


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet of public BPE vocabularies: printable bytes stand for
    themselves, the others for the characters from U+0100 on, in byte order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str, suffix: str = "</w>") -> list[tuple[int, ...]]:
    """Pieces of a tokenizer file as symbol strings; word-final pieces end in ``END``.  A piece
    without the suffix may end a word too, else a longest match could strand the end mark."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    alphabet = byte_alphabet()
    out = []
    for piece in vocab:
        final = piece.endswith(suffix)
        body = piece[: -len(suffix)] if final else piece
        if body and all(c in alphabet for c in body):
            symbols = tuple(alphabet[c] for c in body)
            out.append((*symbols, END))
            if not final:
                out.append(symbols)
    return out


class Automaton:
    """Trie with failure links and popped-piece counts over symbol strings."""

    def __init__(self, pieces):
        self.child: dict[int, int] = {}  # node * 257 + symbol -> node
        parent, symbol, final = [-1], [-1], [False]
        for piece in pieces:
            node = 0
            for c in piece:
                nxt = self.child.get(node * 257 + c)
                if nxt is None:
                    nxt = len(parent)
                    self.child[node * 257 + c] = nxt
                    parent.append(node)
                    symbol.append(c)
                    final.append(False)
                node = nxt
            final[node] = True
        n = len(parent)
        depth = [0] * n
        for v in range(1, n):  # a node is made after its parent
            depth[v] = depth[parent[v]] + 1
        self.fail, self.pops = [-1] * n, [0] * n
        for v in sorted(range(1, n), key=depth.__getitem__):
            if final[v]:
                self.fail[v], self.pops[v] = 0, 1
                continue
            u, c = parent[v], symbol[v]
            z, popped = self.fail[u], self.pops[u]
            while z >= 0:
                nxt = self.child.get(z * 257 + c)
                if nxt is not None:
                    self.fail[v], self.pops[v] = nxt, popped
                    break
                popped += self.pops[z]
                z = self.fail[z]

    def count(self, word: bytes) -> int:
        """Pieces of the greedy split, or 0 if there is none."""
        child, fail, pops = self.child, self.fail, self.pops
        node = total = 0
        for c in (*word, END):
            while True:
                nxt = child.get(node * 257 + c)
                if nxt is not None:
                    node = nxt
                    break
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 0
        while node > 0:
            total += pops[node]
            node = fail[node]
        return total if node == 0 else 0


@functools.lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(read_vocabulary(path))


def count_pieces(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_words, n_pieces, n_unknown)`` for every document row; ``n_pieces`` has one
    for each unknown word."""

    def run(batches):
        find, known = automaton(path).count, {}
        for batch in batches:
            words, pieces, unknown = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            texts = batch.column(1)
            for i in range(batch.num_rows):
                raw = (texts[i].as_py() or "").encode().lower()
                if len(known) > CACHE_WORDS:
                    known.clear()
                ws = WORD.findall(raw)
                for w in set(ws):
                    if w not in known:
                        known[w] = find(w)
                got = list(map(known.__getitem__, ws))
                words[i], unknown[i] = len(ws), got.count(0)
                pieces[i] = sum(got) + unknown[i]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(pieces), pa.array(unknown)], names=["doc_id", "n_words", "n_pieces", "n_unknown"]
            )

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(d, run, "doc_id long, n_words long, n_pieces long, n_unknown long")
