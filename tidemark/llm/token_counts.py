"""Token counts by a linear longest-match automaton over a vocabulary trie.

Greedy longest-match-first cuts a word into the longest vocabulary piece at
its beginning, then the longest at the rest, and so on.  The automaton does it
in one pass: a trie node at which the next character has no edge follows its
failure link to the node reached after cutting off the longest piece (or
pieces), whose number is stored with the link.  Only numbers are added up; no
piece is ever built.

A node's failure link and count are computed from its parent's: if the node's
string is itself a piece, the link is the root and the count one; otherwise the
parent's links are followed until the last character fits.  Where that never
happens the rest cannot be cut, and every character of it counts as one token.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.words import NON_SPACE, split_words, text_slices

#: Distinct words whose counts a task keeps.
CACHE_WORDS = 200_000


class LongestMatch:
    """Trie with failure links over the code points of the pieces.

    ``end`` is put after each word before it is cut (the word-end mark of the
    vocabulary, or nothing).
    """

    def __init__(self, pieces: list[str], end: str = ""):
        self.end = end
        self.edges: list[dict[str, int]] = [{}]
        final = self.final = [False]
        for piece in pieces:
            v = 0
            for ch in piece:
                u = self.edges[v].get(ch)
                if u is None:
                    u = self.edges[v][ch] = len(self.edges)
                    self.edges.append({})
                    final.append(False)
                v = u
            if v:
                final[v] = True
        # link None: the node's string cannot be cut so that the rest is a trie path
        self.link: list[int | None] = [None] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque([0])
        while queue:
            v = queue.popleft()
            for ch, u in self.edges[v].items():
                if final[u]:
                    self.link[u], self.popped[u] = 0, 1
                else:
                    z, n = self.link[v], self.popped[v]
                    while z is not None and ch not in self.edges[z]:
                        n += self.popped[z]
                        z = self.link[z]
                    if z is not None:
                        self.link[u], self.popped[u] = self.edges[z][ch], n
                queue.append(u)

        self.depth = [0] * len(self.edges)
        queue = deque([0])
        while queue:
            v = queue.popleft()
            for u in self.edges[v].values():
                self.depth[u] = self.depth[v] + 1
                queue.append(u)

    def count(self, word: str) -> int:
        """Number of greedy pieces of the word; from where none fits, one per character."""
        text = word + self.end
        edges, link, popped = self.edges, self.link, self.popped
        n = v = 0
        for i, ch in enumerate(text):
            while ch not in edges[v]:
                z = link[v]
                if z is None:
                    return n + self._stuck(word, i - self.depth[v])
                n += popped[v]
                v = z
            v = edges[v][ch]
        while v:
            z = link[v]
            if z is None:
                return n + self._stuck(word, len(text) - self.depth[v])
            n += popped[v]
            v = z
        return n

    def _stuck(self, word: str, begin: int) -> int:
        """Count from ``begin``, where cutting ends within one node's string at a place that no piece fits."""
        text, n = word + self.end, 0
        while begin < len(text):
            v, longest = 0, 0
            for i in range(begin, len(text)):
                v = self.edges[v].get(text[i])
                if v is None:
                    break
                if self.final[v]:
                    longest = i + 1 - begin
            if not longest:
                return n + max(len(word) - begin, 1)
            n, begin = n + 1, begin + longest
        return n


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the other bytes in order
    for the characters from U+0100.
    """
    out, extra = [], 256
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def read_pieces(raw: bytes) -> list[str]:
    """Pieces of a tokenizer file in JSON: the keys of its vocabulary, special tokens left out."""
    content = json.loads(raw)
    special = {t["content"] for t in content.get("added_tokens", []) if t.get("special")}
    return sorted(p for p in content["model"]["vocab"] if p and p not in special)


def word_end(raw: bytes) -> str:
    return json.loads(raw)["model"].get("end_of_word_suffix") or ""


def count_tokens(docs: DataFrame, pieces: list[str], end: str = "") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_tokens by greedy longest match.

    Texts are lower-cased (A-Z) and split at ASCII white space; each word, as
    characters of the byte alphabet and followed by the mark ``end``, is cut by
    longest match first.  From a place where no piece fits, every remaining
    byte of the word is one token (one token if only the mark remains).

    Cases: a null, empty or blank text has 0 words and tokens; rows with a null
    or repeated doc_id are counted like others; very long words are cut in one
    pass; an empty table gives no rows; other columns are ignored.
    """
    automaton = LongestMatch(pieces, end)
    letters = byte_alphabet()
    shared = docs.sparkSession.sparkContext.broadcast(automaton)  # a vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, int] = {}
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                words = split_words(data, bounds, NON_SPACE)
                unique, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
                if len(known) > CACHE_WORDS:
                    known.clear()
                counts = np.empty(len(unique), dtype=np.int64)
                for x, (h, at) in enumerate(zip(unique.tolist(), first.tolist())):
                    n = known.get(h)
                    if n is None:
                        n = known[h] = shared.value.count("".join([letters[b] for b in words.word(at)]))
                    counts[x] = n
                total = np.concatenate([[0], np.cumsum(counts[which])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(words.counts().astype(np.int64)),
                     pa.array(total[words.first[1:]] - total[words.first[:-1]])], ["doc_id", "n_words", "n_tokens"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_words long, n_tokens long")
