"""Greedy word-piece token counts with a linear longest-match automaton.

The vocabulary (a rank file of byte strings, its path is a parameter) becomes a trie.
Every node carries a failure link and the number of tokens popped on the way there, so
that a word is counted in one pass over its bytes, without backing up and without ever
building the pieces. A word is a run of characters other than space, tab, LF, VT, FF
and CR; it is read with one space in front, which is how word-initial pieces are
written in the vocabulary. All single bytes must be in the vocabulary, hence every
word has a count.

Defined cases: null and empty texts count 0; texts are read whole; equal rows get equal
counts; an empty table gives no rows; other columns are kept.
"""
from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

CACHE_WORDS = 150_000


def read_vocabulary(path: str) -> list[bytes]:
    """The byte strings of a rank file (base64 and rank a line)."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class LongestMatch:
    """Trie with failure links; count(word) is the number of greedy longest-match pieces."""

    def __init__(self, vocabulary: list[bytes]):
        self.child: list[dict[int, int]] = [{}]
        is_token = [False]
        order = [0]  # nodes by depth: parents before children
        by_len = sorted(vocabulary, key=len)
        for token in by_len:
            at = 0
            for c in token:
                nxt = self.child[at].get(c)
                if nxt is None:
                    nxt = len(self.child)
                    self.child[at][c] = nxt
                    self.child.append({})
                    is_token.append(False)
                at = nxt
            is_token[at] = True
        missing = [b for b in range(256) if b not in self.child[0] or not is_token[self.child[0][b]]]
        if missing:
            raise ValueError(f"{len(missing)} single bytes are not in the vocabulary")
        n = len(self.child)
        self.fail, self.pops = [0] * n, [0] * n
        for at in order:
            for c, v in self.child[at].items():
                if is_token[v]:
                    self.fail[v], self.pops[v] = 0, 1
                else:
                    z, pops = self.fail[at], self.pops[at]
                    while c not in self.child[z]:
                        pops += self.pops[z]
                        z = self.fail[z]
                    self.fail[v], self.pops[v] = self.child[z][c], pops
                order.append(v)
        # tokens popped from a node down to the root, for the end of a word
        self.rest = [0] * n
        for v in order[1:]:
            self.rest[v] = self.pops[v] + self.rest[self.fail[v]]

    def count(self, word: bytes) -> int:
        child, fail, pops = self.child, self.fail, self.pops
        at = total = 0
        for c in word:
            nxt = child[at].get(c)
            while nxt is None:
                total += pops[at]
                at = fail[at]
                nxt = child[at].get(c)
            at = nxt
        return total + self.rest[at]


class _Counts(dict):
    """Counts of words seen, bounded: forgotten as a whole when full."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self[word] = self.automaton.count(b" " + word)
        return n


_LOADED: dict[str, _Counts] = {}


def _counts(path: str) -> _Counts:
    if path not in _LOADED:
        _LOADED[path] = _Counts(LongestMatch(read_vocabulary(path)))
    return _LOADED[path]


def token_counts(text: Column, vocabulary_path: str) -> Column:
    """struct<n_words, n_tokens>. The file is read once per Python worker; its path must
    exist on every executor."""
    @F.pandas_udf("n_words bigint, n_tokens bigint")
    def run(t: pd.Series) -> pd.DataFrame:
        counts = _counts(vocabulary_path)
        rows = []
        for x in t:
            words = x.encode().split() if x else []
            rows.append((len(words), sum(map(counts.__getitem__, words))))
        return pd.DataFrame(rows, columns=["n_words", "n_tokens"])
    return run(text)
