"""Token counts by a linear longest-match automaton.

Greedy word pieces take the longest vocabulary entry at each place of a word. A trie of the vocabulary gets a
failure link and a count for every node: if the text goes on in a way the trie does not, that many pieces
are complete, and matching resumes at the link. A word is then counted in one pass over its bytes, without
a step back and without building pieces.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

from pyspark.sql import DataFrame

from tierline.llm.common import Columns, map_columns, small_batches, table

# Entries of a worker's word cache before it starts anew.
CACHE = 1 << 18
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def read_vocabulary(path: str) -> list[bytes]:
    """Entries of a file with one base64 entry and its rank per line, read on the driver."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class LongestMatch:
    """Automaton over the entries' bytes; pieces of a word with a byte of no entry count as one (unknown)."""

    def __init__(self, entries: list[bytes]):
        self.go: dict[int, int] = {}
        final = [False]
        for entry in entries:
            node = 0
            for byte in entry:
                step = node << 8 | byte
                node = self.go.setdefault(step, len(final))
                if node == len(final):
                    final.append(False)
            final[node] = bool(entry)
        # Nodes by depth: a child has a higher number than its parent only within one entry, so walk levels.
        children: dict[int, list[tuple[int, int]]] = {}
        for step, child in self.go.items():
            children.setdefault(step >> 8, []).append((step & 255, child))
        self.link, self.popped = [-1] * len(final), [0] * len(final)
        level = [0]
        while level:
            below = []
            for parent in level:
                for byte, child in children.get(parent, ()):
                    below.append(child)
                    if final[child]:
                        self.link[child], self.popped[child] = 0, 1
                    else:
                        self._fail(parent, byte, child)
            level = below

    def _fail(self, parent: int, byte: int, child: int) -> None:
        pieces, node = self.popped[parent], self.link[parent]
        while node >= 0:
            if (to := self.go.get(node << 8 | byte)) is not None:
                self.link[child], self.popped[child] = to, pieces
                return
            pieces += self.popped[node]
            node = self.link[node]

    def count(self, word: bytes) -> int:
        go, link, popped = self.go, self.link, self.popped
        node = pieces = 0
        for byte in word:
            while (to := go.get(node << 8 | byte)) is None:
                if link[node] < 0:
                    return 1
                pieces += popped[node]
                node = link[node]
            node = to
        while node:
            if link[node] < 0:
                return 1
            pieces += popped[node]
            node = link[node]
        return pieces


class WordCounts(dict):
    """Pieces by word, kept while the cache is small."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = self.automaton.count(b" " + word)
        return value


def count_tokens(docs: DataFrame, entries: list[bytes]) -> DataFrame:
    """id, n_words, n_tokens for every row of ``docs`` (id, text).

    Words are the runs between ASCII white space, in UTF-8 with one space before each, and are cut into pieces
    greedily; the white space itself is not counted further. A word with a byte that no entry covers is
    one unknown token. Null and empty texts have no words. Equal rows are each returned. The automaton
    goes to every task once; its size is that of the vocabulary.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(LongestMatch(entries))

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        counts = WordCounts(shared.value)
        for batch in batches:
            words = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in batch["text"]]
            yield {
                "id": batch["id"],
                "n_words": [len(w) for w in words],
                "n_tokens": [sum(map(counts.__getitem__, w)) for w in words],
            }

    kind = docs.schema["id"].dataType.simpleString()
    return map_columns(docs.select("id", "text"), run, f"id {kind}, n_words bigint, n_tokens bigint")


def op4_token_counts(spark, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Words and greedy pieces of every document."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "text")
    return count_tokens(docs, read_vocabulary(vocabulary)).withColumnRenamed("id", "doc_id")
