"""A hidden Markov language model over words, trained by Baum-Welch with counts from all partitions."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain as joined
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerpanel.llm.common import strings
from careerpanel.sources.staging import scratch, stage

#: Hidden states; words with an emission of their own; classes of all other words; words whose counts each
#: task holds (the counts of the rest are joined). Fixed sizes, so what is sent to tasks does not grow.
STATES, OWN, CLASSES, HELD = 4, 32_768, 1024, 262_144
#: WARM rounds find a start. They take turns over up to WARM parts of all training rows, of SAMPLE rows or more, so
#: that all rows have a say. Then rounds over all training rows give the model: until one raises the log likelihood
#: by less than the share RISE, at most FULL.
SAMPLE, WARM, FULL, RISE = 2000, 12, 3, 1e-5
#: Strength of the prior (the corpus' own distribution) in each state's emissions.
PRIOR = 50.0
#: Tokens of a piece of a text, and about as many tokens as are worked on at once.
PIECE, BLOCK = 128, 200_000
#: Words that a task counts before it hands them on.
FLUSH = 400_000
#: Stands for the end of a text; no word is a space.
END = b" "


def words(text: str) -> list[bytes]:
    """Runs of other bytes than 0x20 and 0x09 to 0x0D, with A-Z in lower case."""
    return text.encode().lower().split()


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


@dataclass
class Chain:
    """start (states), move (states x states), emit (symbols x states)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


@dataclass
class Pieces:
    """Texts cut into pieces of at most PIECE symbols, longest piece first; symbols by step and piece."""

    symbols: np.ndarray
    active: np.ndarray  # pieces that have a symbol at each step
    rows: list[np.ndarray]  # for the j-th piece of a text: the texts that have one
    at: list[np.ndarray]  # and where it stands

    @classmethod
    def cut(cls, flat: np.ndarray, sizes: np.ndarray) -> Pieces:
        """``flat``: the symbols of all texts one after another, at least one each."""
        n = -(-sizes // PIECE)
        text = np.repeat(np.arange(len(sizes)), n)
        j = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        length = np.minimum(PIECE, sizes[text] - j * PIECE)
        order = np.argsort(-length, kind="stable")
        place = np.empty(len(order), int)
        place[order] = np.arange(len(order))
        steps = int(length.max())
        first = (np.cumsum(sizes) - sizes)[text[order]] + j[order] * PIECE
        grid = np.minimum(first[None, :] + np.arange(steps)[:, None], len(flat) - 1)
        active = (length[None, :] > np.arange(steps)[:, None]).sum(axis=1)
        turns = range(int(n.max()))
        return cls(flat[grid], active, [text[j == k] for k in turns], [place[j == k] for k in turns])

    def transfers(self, chain: Chain, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece the matrix that takes the state expected before it to the one after it, rows
        scaled, and the logarithms of the scales. ``emit``: of each step and piece."""
        k, c = len(chain.start), self.symbols.shape[1]
        x = np.tile(np.eye(k), (c, 1, 1))
        logs = np.zeros((c, k))
        for t, a in enumerate(self.active):
            x[:a] = ((x[:a] * emit[t, :a, None, :]).reshape(-1, k) @ chain.move).reshape(a, k, k)
            if t % 12 == 11 or t == len(self.active) - 1:
                scale = x.sum(axis=2)
                x /= scale[:, :, None]
                logs += np.log(scale)
        return x, logs

    def forward(self, chain: Chain, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """log likelihood of each text, the state expected before each piece, and the transfers."""
        x, logs = self.transfers(chain, emit)
        before = np.empty((x.shape[0], x.shape[1]))
        state = np.tile(chain.start, (len(self.rows[0]), 1))
        total = np.zeros(len(self.rows[0]))
        for rows, at in zip(self.rows, self.at, strict=True):
            p = before[at] = state[rows]
            top = logs[at].max(axis=1)
            after = np.einsum("ci,cij->cj", p * np.exp(logs[at] - top[:, None]), x[at])
            scale = after.sum(axis=1)
            state[rows] = after / scale[:, None]
            total[rows] += np.log(scale) + top
        return total, before, x, logs

    def likelihood(self, chain: Chain) -> np.ndarray:
        return self.forward(chain, chain.emit[self.symbols])[0]

    def expected(self, chain: Chain) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Log likelihood and the expected counts of first states, moves and emissions."""
        emit = chain.emit[self.symbols]
        total, before, x, logs = self.forward(chain, emit)
        k = len(chain.start)
        after = np.ones_like(before)
        last = np.zeros(len(before), bool)
        ahead = np.ones((len(total), k))
        seen = np.zeros(len(total), bool)
        for rows, at in zip(reversed(self.rows), reversed(self.at), strict=True):
            last[at] = ~seen[rows]
            seen[rows] = True
            after[at] = ahead[rows]
            top = logs[at].max(axis=1)
            back = np.einsum("cij,cj->ci", x[at], ahead[rows]) * np.exp(logs[at] - top[:, None])
            ahead[rows] = back / back.sum(axis=1, keepdims=True)
        ones = np.ones((k, 1))  # sums over states by matrix product
        chance = np.empty_like(emit)
        chance[0] = before
        for t, a in enumerate(self.active[:-1]):
            nxt = (chance[t, :a] * emit[t, :a]) @ chain.move
            chance[t + 1, :a] = nxt / (nxt @ ones)
        moves = np.zeros((k, k))
        for t in range(len(self.active) - 1, -1, -1):
            a = self.active[t]
            still = self.active[t + 1] if t + 1 < len(self.active) else 0
            ahead_t = after[:a] @ chain.move.T
            u = chance[t, :a] * emit[t, :a]
            joint = u * ahead_t
            norm = joint @ ones
            u /= norm
            u[still:][last[still:a]] = 0  # nothing follows a text's last symbol
            moves += u.T @ after[:a]
            back = emit[t, :a] * ahead_t
            after[:a] = back / (back @ ones)
            chance[t, :a] = joint / norm  # from here on: of each state, given the whole text
        on = np.arange(self.symbols.shape[1])[None, :] < self.active[:, None]
        symbols, weights = self.symbols[on], chance[on]
        emits = np.stack([np.bincount(symbols, weights[:, i], len(chain.emit)) for i in range(k)], axis=1)
        return float(total.sum()), chance[0, self.at[0]].sum(axis=0), moves * chain.move, emits


@dataclass
class Vocabulary:
    """Held words, most frequent first; the first ``own`` have symbols of their own."""

    rank: dict[bytes, int]
    symbol: np.ndarray  # of each held word
    count: np.ndarray
    own: int
    ends: int
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def end(self) -> int:
        return self.own + CLASSES

    def look_up(self, texts: list[list[bytes]]) -> Found:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = list(joined.from_iterable(texts))
        rank = np.fromiter(map(self.rank.get, flat, repeat(-1)), np.int64, len(flat))
        rare = np.flatnonzero(rank < 0)
        names = [flat[i] for i in rare.tolist()]
        symbol = self.symbol[rank] if len(self.symbol) else np.zeros(len(rank), np.int64)
        symbol[rare] = self.own + np.fromiter(map(word_class, names), np.int64, len(names))
        ends = np.cumsum(sizes)
        return Found(np.insert(symbol, ends, self.end), sizes + 1, symbol, rank, np.repeat(np.arange(len(texts)), sizes), names)

    def share(self) -> np.ndarray:
        """What is expected of each symbol: its count, and for a class what its unseen words need."""
        counts = np.zeros(self.end + 1)
        counts[: self.own] = self.count[: self.own]
        counts[self.own : self.end] = self.class_tokens
        counts[self.end] = self.ends
        return counts + self.unseen() + 1

    def unseen(self) -> np.ndarray:
        return np.concatenate([np.zeros(self.own), self.class_words + 1, [0]])


@dataclass
class Found:
    """Symbols of some texts with their ends, and, without the ends, each word's symbol, rank (-1: not held)
    and text; the words that are not held."""

    flat: np.ndarray
    sizes: np.ndarray
    symbol: np.ndarray
    rank: np.ndarray
    text: np.ndarray
    rare: list[bytes]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def rows() -> pa.RecordBatch:
        out = pa.record_batch([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        seen.clear()
        return out

    for batch in batches:
        for i in range(0, batch.num_rows, 100):
            texts = strings(batch.slice(i, 100), 0)
            for text in texts:
                seen.update(words(text))
            seen[END] += len(texts)
            if len(seen) > FLUSH:
                yield rows()
    if seen:
        yield rows()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all whole texts, counted in each task before the shuffle; the end of a text is a word."""
    return texts.mapInArrow(_counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The driver gets HELD words and CLASSES sums, however large ``counts`` is."""
    tokens, distinct, ends = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("n"))), F.lit(0))
    ).first()
    # only words of the powers of two that can be among the HELD most frequent are ranked
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy(F.desc("power")).collect()
    least, above = 0, 0
    for power, n in sizes:
        if above < HELD:
            least, above = power, above + n
    few = counts.where((F.col("word") != F.lit(END)) & (F.col("n") >= 1 << least))
    top = few.orderBy(F.desc("n"), "word").limit(HELD).toArrow()
    found = list(zip(top["word"].to_pylist(), top["n"].to_pylist(), strict=True))
    own = min(OWN, len(found) // 2)  # a small corpus keeps words for the classes
    symbol = np.array([i if i < own else own + word_class(w) for i, (w, _) in enumerate(found)], np.int64)
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    length = F.length("word")
    tail = F.substring(F.col("word"), F.greatest(length - 2, F.lit(1)), F.lit(3))
    by_class = counts.where(F.col("word") != F.lit(END)).groupBy((F.crc32(tail) % CLASSES).alias("k")).agg(F.sum("n"), F.count("*"))
    for k, n, v in by_class.collect():
        class_tokens[k], class_words[k] = n, v
    for w, n in found[:own]:
        class_tokens[word_class(w)] -= n
        class_words[word_class(w)] -= 1
    return Vocabulary({w: i for i, (w, _) in enumerate(found)}, symbol, np.array([n for _, n in found], np.int64), own, ends, tokens, distinct, class_tokens, class_words)


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of about BLOCK tokens, with the words of each text."""
    for batch in batches:
        start, size, block = 0, 0, []
        for i, text in enumerate(batch.column(column)):
            block.append(words(text.as_py() or ""))
            size += len(block[-1]) + 1
            if size >= BLOCK or i == batch.num_rows - 1:
                yield batch.slice(start, i + 1 - start), block
                start, size, block = i + 1, 0, []


def encoded(rows: DataFrame, part: Column, text_col: str, vocab: Broadcast[Vocabulary]) -> DataFrame:
    """(part, symbols) of each whole text, its end included; symbols as 32-bit numbers in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in _blocks(batches, 1):
            found = vocab.value.look_up(block)
            ends = np.concatenate([[0], np.cumsum(found.sizes * 4)]).astype(np.int32)
            data = pa.py_buffer(np.ascontiguousarray(found.flat, np.int32))
            symbols = pa.Array.from_buffers(pa.binary(), len(block), [None, pa.py_buffer(ends), data])
            yield pa.record_batch([batch.column(0), symbols], names=["part", "symbols"])

    return rows.select(part.cast("int").alias("part"), F.col(text_col).alias("text")).mapInArrow(run, "part int, symbols binary")


def _symbol_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """About BLOCK symbols at once, those of all texts one after another, and the texts' sizes."""
    for batch in batches:
        block, size = [], 0
        for i, row in enumerate(batch.column(0)):
            block.append(np.frombuffer(row.as_buffer(), np.int32))
            size += len(block[-1])
            if size >= BLOCK or i == batch.num_rows - 1:
                yield np.concatenate(block), np.fromiter(map(len, block), np.int64, len(block))
                block, size = [], 0


def expected_counts(symbols: DataFrame, chain: Chain) -> tuple[float, Chain]:
    """One pass of Baum-Welch over the texts of ``encoded``: log likelihood and expected counts, summed over partitions.

    Each task adds up its own texts' counts and hands on one row per symbol it met; the driver gets one
    row per symbol.
    """
    sent = symbols.sparkSession.sparkContext.broadcast(chain)
    k, s = len(chain.start), len(chain.emit)
    kinds = ", ".join(["symbol int", *(f"s{i} double" for i in range(k))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = sent.value
        total = np.zeros((s + k + 2, k))  # emissions, then moves, first states and the log likelihood
        for flat, sizes in _symbol_blocks(batches):
            like, first, moves, emits = Pieces.cut(flat, sizes).expected(chain)
            total[:s] += emits
            total[s : s + k] += moves
            total[s + k] += first
            total[s + k + 1, 0] += like
        rows = np.flatnonzero(total.any(axis=1))
        yield pa.record_batch([pa.array(rows, pa.int32()), *(pa.array(total[rows, i]) for i in range(k))], names=["symbol", *(f"s{i}" for i in range(k))])

    sums = symbols.select("symbols").mapInArrow(run, kinds).groupBy("symbol").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(k))).toArrow()
    total = np.zeros((s + k + 2, k))
    if len(sums):
        total[sums["symbol"].to_numpy()] = np.stack([sums[f"s{i}"].to_numpy() for i in range(k)], axis=1)
    sent.unpersist()
    return float(total[s + k + 1, 0]), Chain(total[s + k], total[s : s + k], total[:s])


def maximise(counts: Chain, vocab: Vocabulary) -> Chain:
    """The model of expected counts, smoothed so that each symbol can be emitted in each state."""
    share = vocab.share()
    seen = share - vocab.unseen()
    emit = counts.emit * (share / seen)[:, None] + PRIOR * (share / share.sum())[:, None]
    start, move = counts.start + 1, counts.move + 1
    return Chain(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def first_chain(vocab: Vocabulary, states: int, seed: int = 0) -> Chain:
    """States that tend to stay, with the corpus' own emissions, each shaken by up to a half."""
    draw = np.random.default_rng(seed)
    share = vocab.share()
    emit = share[:, None] * draw.uniform(0.5, 1.5, (len(share), states))
    move = np.full((states, states), 0.03 / max(1, states - 1))
    np.fill_diagonal(move, 0.97 if states > 1 else 1.0)
    return Chain(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


@dataclass
class HMM:
    chain: Chain
    vocab: Broadcast[Vocabulary]
    counts: DataFrame  # (word, n) of the training rows, for words that tasks do not hold
    likelihoods: list[float]  # of all training rows before each round over them


def fit(rows: DataFrame, text_col: str = "text", states: int = STATES, seed: int = 0, id_col: str = "doc_id") -> HMM:
    """Learn from all ``rows``. Counts, vocabulary and the last rounds cover every row and whole text, and so do the
    rounds before, that find a start: each takes one of the parts that rows are dealt into by a hash of id and text,
    and there are no more parts than rounds. So the model doesn't depend on how rows are dealt, but for the rounding of sums."""
    texts = rows.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = stage(word_counts(texts), "words")
    vocab = vocabulary(counts)
    sent = rows.sparkSession.sparkContext.broadcast(vocab)
    chain = first_chain(vocab, states, seed)
    place = F.xxhash64(F.lit(seed), id_col, text_col)
    parts = max(1, min(WARM, vocab.ends // SAMPLE))
    likelihoods: list[float] = []
    with scratch(rows.sparkSession):
        # texts are cut into words once, and not in each round
        symbols = stage(encoded(rows, F.pmod(place, F.lit(parts)), text_col, sent), "symbols")
        for i in range(WARM):
            expected = expected_counts(symbols.where(F.col("part") == i % parts), chain)[1]
            if expected.emit.any():  # else no row has this turn
                chain = maximise(expected, vocab)
        while len(likelihoods) < FULL:
            likelihood, expected = expected_counts(symbols, chain)
            likelihoods.append(likelihood)
            chain = maximise(expected, vocab)
            if len(likelihoods) > 1 and likelihood - likelihoods[-2] < RISE * abs(likelihood):
                break
    return HMM(chain, sent, counts, likelihoods)


def score(docs: DataFrame, model: HMM, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row, and the columns of ``carry``.

    ``score`` is log10 of the text's exact probability, end included: the scaled forward recursion over
    symbols, and for a word that shares its symbol with others its smoothed share of the class.
    ``base_score`` is the add-one unigram score. Null counts as empty: one token, the end. Repeated rows are
    scored each. Texts of any length are scored whole. Counts of words that tasks do not hold are joined;
    each such word is rarer than HELD others, so no key of that join is hot.
    """
    chain, sent = docs.sparkSession.sparkContext.broadcast(model.chain), model.vocab
    carry = carry or {}
    names = ["rid", "id", "n_tokens", "n_known", "base", "score", "rare", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = sent.value
        log_count = np.log10(vocab.count + 1.0) if len(vocab.count) else np.zeros(1)
        log_class = np.zeros(vocab.end)
        log_class[vocab.own :] = np.log10(vocab.class_tokens + vocab.class_words + 1)
        log_base = np.log10(vocab.tokens + vocab.distinct + 1)
        for batch, block in _blocks(batches, 2):
            found = vocab.look_up(block)
            n = len(block)
            like = Pieces.cut(found.flat, found.sizes).likelihood(chain.value) / np.log(10)
            held = found.rank >= 0
            gain = np.where(held, log_count[found.rank], 0.0)
            shared = found.symbol >= vocab.own
            like += np.bincount(found.text, np.where(shared, gain - log_class[found.symbol], 0.0), n)
            base = np.bincount(found.text, gain, n) + np.log10(vocab.ends + 1) - log_base * found.sizes
            known = np.bincount(found.text, held, n).astype(np.int64) + (vocab.ends > 0)
            misses = np.concatenate([[0], np.cumsum(np.bincount(found.text, ~held, n))]).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(misses), pa.array(found.rare, pa.binary()))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found.sizes), pa.array(known), pa.array(base), pa.array(like), rare, *batch.columns[3:]], names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), text_col, *(c.alias(k) for k, c in carry.items()))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"rid bigint, id {kinds['id']}, n_tokens bigint, n_known bigint, base double, score double, rare array<binary>"
    held = stage(rows.mapInArrow(run, schema + "".join(f", `{k}` {kinds[k]}" for k in carry)), "scores")
    rare = held.select("rid", F.explode("rare").alias("word")).join(model.counts, "word")
    more = rare.groupBy("rid").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("gain"))
    none = F.lit(0)
    return held.join(more, "rid", "left").select(
        F.col("id").alias(id_col),
        *carry,
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", none)).alias("n_known"),
        F.lit(sent.value.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", none)).alias("base_score"),
        (F.col("score") + F.coalesce("gain", none)).alias("score"),
    )
