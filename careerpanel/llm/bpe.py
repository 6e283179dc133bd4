"""Byte-pair encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import json

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from careerpanel.llm.common import map_slices, strings
from careerpanel.llm.pretokens import pieces

#: Pre-tokens whose ids a task keeps; the store starts anew when full.
CACHE = 300_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 for itself, the rest
    from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Ids of pre-tokens, exactly as merging in order of rank gives them.

    Every prefix of a pre-token has one encoding, and dropping its last token leaves the encoding of a
    shorter prefix. So the last token of each prefix is all that need be stored. Candidates are the tokens
    that end there (matches of an automaton); the right one is that which the last token of the remaining
    prefix may stand before. Following the stored tokens back from the end gives the ids.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        model = spec["model"]
        raw = {t: bytes(letters[c] for c in t) for t in model["vocab"] if all(c in letters for c in t)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {raw[t]: i for t, i in model["vocab"].items() if t in raw and t not in self.special}
        self.bytes_of = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, merge in enumerate(model["merges"]):
            left, right = (ids[raw[x]] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self.rank[left, right] = r
            self.parts.setdefault(ids[self.bytes_of[left] + self.bytes_of[right]], (r, left, right))
        self.fits: dict[tuple[int, int], bool] = {}
        self.whole = {t: i for t, i in ids.items() if self._is_itself(i)}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.whole.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t), i))
        self.automaton.make_automaton()

    def _is_itself(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token: its two parts must be able to meet."""
        if token not in self.parts:
            return len(self.bytes_of[token]) == 1
        r, left, right = self.parts[token]
        return self._is_itself(left) and self._is_itself(right) and self._meet(left, right, r)

    def _meet(self, left: int, right: int, until: int | None = None) -> bool:
        """Whether no merge across the border comes before rank ``until``. Undo the later of the two
        border tokens' merges, again and again: at each point in between, the border pair must not have
        had a merge that was due earlier. Of equal ranks the left comes first."""
        limit = len(self.rank) if until is None else until
        while True:
            if (r := self.rank.get((left, right))) is not None and r < limit:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and a[0] > b[0]:
                limit, left = a[0], a[2]
            else:
                limit, right = b[0] + 1, b[1]

    def compatible(self, left: int, right: int) -> bool:
        key = left, right
        if (known := self.fits.get(key)) is None:
            if len(self.fits) > 2 * CACHE:
                self.fits.clear()
            known = self.fits[key] = self._meet(left, right)
        return known

    def encode(self, piece: bytes) -> list[int]:
        last = [-1] * len(piece)
        length = [0] * len(piece)
        fits = self.fits
        for end, (n, token) in self.automaton.iter(piece.decode("latin-1")):
            if last[end] < 0:
                before = end - n
                if before >= 0:
                    pair = last[before], token
                    ok = fits.get(pair)
                    if not (self.compatible(*pair) if ok is None else ok):
                        continue
                last[end], length[end] = token, n
        out, at = [], len(piece) - 1
        while at >= 0:
            out.append(last[at])
            at -= length[at]
        return out[::-1]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def bpe_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded) of every row: the text's ids and the text that these ids decode to.

    ``tokenizer`` is the JSON file of a byte-level BPE tokenizer that each executor can open. Strings of
    its added tokens in a text give their ids. Null counts as empty text (no ids); repeated rows give
    repeated results; further columns are not read. A text of any length is one row. There is no shuffle;
    a task keeps the ids of at most ``CACHE`` pre-tokens.
    """

    def start():
        codec = Codec(tokenizer)
        special = tuple(codec.special)
        fixed = {s: np.array([i], np.int32).tobytes() for s, i in codec.special.items()}
        kept: dict[str, bytes] = dict(fixed)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            packed, decoded = [], []
            for text in strings(batch, 1):
                words = pieces(text, special)
                for word in set(words).difference(kept):
                    kept[word] = np.array(codec.encode(word.encode()), np.int32).tobytes()
                ids = b"".join(map(kept.__getitem__, words))
                packed.append(ids)
                decoded.append(codec.decode(memoryview(ids).cast("i").tolist()))
                if len(kept) > CACHE:
                    kept.clear()
                    kept.update(fixed)
            ends = np.cumsum([0, *(len(x) // 4 for x in packed)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            return pa.record_batch([batch.column(0), ids, pa.array(decoded, pa.string())], names=["id", "ids", "decoded"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_slices(docs.select(id_col, text_col), start, f"id {kind}, ids array<int>, decoded string", rows=200)
    return out.withColumnRenamed("id", id_col)
