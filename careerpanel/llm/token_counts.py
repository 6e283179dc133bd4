"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens."""

from __future__ import annotations

import base64
import math

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from careerpanel.llm.common import map_slices, strings
from careerpanel.llm.pretokens import pieces

#: Bounds of a task's memory: pre-tokens whose counts are kept, and nodes of one trie. Both start anew when full.
CACHE, NODES = 400_000, 300_000
#: Prefixes up to this length are shared in the trie; of what lies beyond, the scores of one window are kept.
DEPTH, KEPT = 64, 65_536


def rank_costs(path: str) -> dict[bytes, int]:
    """Integer costs -log p of the tokens of a rank file, with p in proportion to 1 / (rank + 2).

    Integers make sums exact, so equal segmentations tie and the tie rule decides.
    """
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(t): round(65536 * math.log(int(r) + 2)) for t, r in pairs}


def token_automaton(costs: dict[bytes, int]) -> tuple[ahocorasick.Automaton, int]:
    """Finds the tokens that end at each place of a pre-token, as (length, cost); and the length of the longest."""
    automaton = ahocorasick.Automaton()
    for token, cost in costs.items():
        automaton.add_word(token.decode("latin-1"), (len(token), cost))
    automaton.make_automaton()
    return automaton, max(map(len, costs))


class Trie:
    """Pre-tokens share the nodes of their common prefixes; a node holds the least cost of a segmentation
    of its prefix and the tokens in it (of equal costs, the fewest tokens)."""

    def __init__(self, automaton: ahocorasick.Automaton, longest: int):
        self.automaton, self.longest = automaton, longest
        self.next: dict[int, int] = {}
        self.best: list[tuple[int, int]] = [(0, 0)]

    def count(self, word: bytes) -> int:
        """Insert ``word``; scores are computed for new nodes alone, from the tokens that end there. Returns
        its number of tokens. A pre-token of any length makes at most DEPTH nodes."""
        node, path = 0, [(0, 0)]
        get, best = self.next.get, self.best
        for byte in word[:DEPTH]:
            child = get(node << 8 | byte)
            if child is None:
                break
            node = child
            path.append(best[node])
        known = len(path) - 1
        if known == len(word):
            return path[-1][1]
        gone = 0  # scores before this place are no longer in path
        start = max(0, known + 1 - self.longest)
        least = None
        for last, (length, cost) in self.automaton.iter(word.decode("latin-1"), start):
            if last < known:
                continue
            if last - gone == len(path):  # the scores of the place before are complete
                path.append(least)
                node = self._insert(node, word, last - 1, least)
                least = None
                if len(path) > KEPT + self.longest:
                    del path[: len(path) - self.longest - 1]
                    gone = last - len(path) + 1
            cost_before, n = path[last + 1 - length - gone]
            found = cost_before + cost, n + 1
            if least is None or found < least:
                least = found
        self._insert(node, word, len(word) - 1, least)
        return least[1]

    def _insert(self, node: int, word: bytes, at: int, score: tuple[int, int]) -> int:
        if at >= DEPTH:
            return node
        child = self.next[node << 8 | word[at]] = len(self.best)
        self.best.append(score)
        return child


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pretokens, n_tokens) of every row: tokens of the least-cost segmentation of each pre-token.

    ``vocabulary`` is a rank file that each executor can open; it must hold all single bytes. Null and
    empty texts have 0 tokens; repeated rows give repeated results; further columns are not read. A text
    of any length is one row; memory is bounded by one slice of rows, the trie and the kept counts, however long
    a pre-token is.
    """

    def start():
        tokens = token_automaton(rank_costs(vocabulary))
        kept: dict[str, int] = {}
        trie = Trie(*tokens)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal trie
            n_pieces, n_tokens = [], []
            for text in strings(batch, 1):
                words = pieces(text)
                for word in set(words).difference(kept):
                    if len(trie.best) > NODES:
                        trie = Trie(*tokens)
                    kept[word] = trie.count(word.encode())
                n_pieces.append(len(words))
                n_tokens.append(sum(map(kept.__getitem__, words)))
                if len(kept) > CACHE:
                    kept.clear()
            return pa.record_batch([batch.column(0), pa.array(n_pieces, pa.int64()), pa.array(n_tokens, pa.int64())], names=["id", "n_pretokens", "n_tokens"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_slices(docs.select(id_col, text_col), start, f"id {kind}, n_pretokens bigint, n_tokens bigint")
    return out.withColumnRenamed("id", id_col)
