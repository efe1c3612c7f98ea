"""Token counts by a linear longest-match automaton.

A trie holds the vocabulary; symbols are bytes, with a word's last byte a symbol of its own
(pieces that end words differ from those inside).  Every trie node has a failure link and
the number of pieces that are popped when it is followed, both computed breadth-first when
the automaton is built: a node that ends a piece pops that piece and goes to the root; any
other node follows its parent's links until its symbol can be read, adding up what they
pop.  One pass over a word then adds popped counts and never goes back, so the number of
greedy longest-match pieces takes time linear in the word, without building the pieces.

Words: the text in NFC and lower case (character by character); contractions, runs of
letters (category L), single number signs (category N), runs of other visible characters.  Each word is UTF-8.  A word the vocabulary cannot spell counts
as one piece and as unknown (a byte-complete vocabulary spells all).

Defined results: null or empty text has zero words and pieces; whole texts of any length;
equal rows give equal counts.  Other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterable
from itertools import chain

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Memo, broadcast_file, per_worker, text_udf, whole_text

# fixed value: the vocabulary's own splitting pattern
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
LAST = 256  # added to the last byte of a word
FIELDS = {"n_words": "long", "n_tokens": "long", "n_unknown": "long"}


class Automaton:
    """Greedy longest-match piece counts over a vocabulary of symbol sequences."""

    def __init__(self, vocabulary: Iterable[tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in vocabulary:
            node = 0
            for s in piece:
                to = self.next[node].get(s)
                if to is None:
                    to = self.next[node][s] = len(self.next)
                    self.next.append({})
                    ends.append(False)
                node = to
            ends[node] = bool(piece)
        # failure link, or -1 where no further symbol can be matched; pieces it pops
        self.fail, self.pops = [-1] * len(self.next), [0] * len(self.next)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for s, v in self.next[u].items():
                queue.append(v)
                if ends[v]:
                    self.fail[v], self.pops[v] = 0, 1
                    continue
                popped, z = self.pops[u], self.fail[u]
                while z >= 0 and s not in self.next[z]:
                    popped, z = popped + self.pops[z], self.fail[z]
                if z >= 0:
                    self.fail[v], self.pops[v] = self.next[z][s], popped

    def count(self, symbols: Iterable[int]) -> int:
        """Pieces of a word, 0 if the vocabulary cannot spell it."""
        node, total = 0, 0
        for s in symbols:
            while s not in self.next[node]:
                total += self.pops[node]
                node = self.fail[node]
                if node < 0:
                    return 0
            node = self.next[node][s]
        while node > 0:
            total += self.pops[node]
            node = self.fail[node]
        return total if node == 0 else 0


def word_symbols(word: str) -> list[int]:
    raw = list(word.encode("utf-8", "surrogatepass"))
    raw[-1] += LAST
    return raw


def byte_letters() -> dict[str, int]:
    """Inverse of the usual printable spelling of bytes in byte-level vocabularies:
    printable Latin-1 stands for itself, the other bytes for code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def vocabulary_symbols(tokenizer_json: bytes, suffix: str = "</w>") -> list[tuple[int, ...]]:
    """Pieces of a byte-level vocabulary whose word-final pieces carry ``suffix``."""
    letters, out = byte_letters(), []
    for piece in json.loads(tokenizer_json)["model"]["vocab"]:
        body = piece.removesuffix(suffix)
        if body and all(c in letters for c in body):
            raw = [letters[c] for c in body]
            raw[-1] += LAST * piece.endswith(suffix)
            out.append(tuple(raw))
    return out


class Counter:
    def __init__(self, tokenizer_json: bytes):
        automaton = Automaton(vocabulary_symbols(tokenizer_json))
        self.memo = Memo(lambda words: [automaton.count(word_symbols(w)) for w in words])

    def __call__(self, texts: list[str]) -> list[tuple[int, int, int]]:
        # one character's lower case does not depend on its neighbours: no final sigma
        split = [WORD.findall(unicodedata.normalize("NFC", t).replace("Σ", "σ").lower()) for t in texts]
        found, out, at = self.memo.look(list(chain.from_iterable(split))), [], 0
        for words in split:
            own = found[at:at + len(words)]
            at += len(words)
            unknown = own.count(0)
            out.append((len(words), sum(own) + unknown, unknown))
        return out


def count_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every row; no shuffle."""
    held = broadcast_file(docs.sparkSession, vocabulary)

    def setup():
        return per_worker(Counter, held.value)

    return docs.select(F.col("doc_id"), text_udf(setup, FIELDS)(whole_text()).alias("__r")).select("doc_id", "__r.*")
