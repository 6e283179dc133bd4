"""Each operator on small tables, against brute force, with nulls, empty tables, repeats and clashing names."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from careerpanel.llm import bpe, components, decontam, exact_dedup, hmm, html_text, jaccard, langid, quality, sharding, token_counts
from careerpanel.llm.common import fold
from careerpanel.llm.pretokens import pieces
from careerpanel.sources.staging import stage
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, id string, kept int, score double, c bigint, name string"
BASE = "the quick brown fox jumps over the lazy dog while seven wizards mix a jar of odd potions near an old quiet mill "
TEXTS = [
    (1, BASE * 3, "en"), (2, BASE * 3, "en"), (3, (BASE * 3).replace(" ", "\n\t"), "en"), (4, None, "en"), (5, "", None),
    (6, "eins zwei drei", "de"), (7, "Eins zwei drei", "de"), (7, "Eins zwei drei", "de"), (None, "12 34 !!", None), (None, None, None),
    (8, " ".join(f"w{i}" for i in range(400)), "de"), (9, " ".join(f"w{i}" for i in range(399)) + " x", "de"), (10, "a", "en"),
    (11, "naïve <|endoftext|> 日本 🙂  \n x" + "y" * 5000, "fr"), (12, " a ", "en"), (13, "z" * 9000 + " end", "de"), (14, "z" * 9000 + " End", "de"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, x, "x", 7, 0.5, 3, "n") for i, t, x in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def test_bpe_equals_the_library(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = Counter()
    for i, t, _ in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    got = bpe.bpe_round_trip(docs, path).collect()
    assert Counter((r[0], tuple(r[1]), r[2]) for r in got) == want
    assert bpe.bpe_round_trip(empty, path).count() == 0


def test_token_counts_equal_a_plain_segmentation(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    costs = token_counts.rank_costs(path)

    def plain(word: bytes) -> int:
        best = [(0, 0)]
        for end in range(1, len(word) + 1):
            best.append(min((best[s][0] + costs[word[s:end]], best[s][1] + 1) for s in range(max(0, end - 130), end) if word[s:end] in costs))
        return best[-1][1]

    want = Counter((i, len(p := pieces(t or "")), sum(plain(w.encode()) for w in p)) for i, t, _ in TEXTS)
    assert counted(token_counts.token_counts(docs, path)) == want
    assert token_counts.token_counts(empty, path).count() == 0


def test_long_pre_tokens_take_few_nodes():
    """Beyond the trie's depth and beyond the window of kept scores, the counts are those of a plain segmentation."""
    costs = token_counts.rank_costs(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    word = "".join(chr(97 + (i * i + i // 7) % 11) for i in range(token_counts.KEPT + 5000)).encode()
    best, longest = [(0, 0)], max(map(len, costs))
    for end in range(1, len(word) + 1):
        best.append(min((best[s][0] + costs[word[s:end]], best[s][1] + 1) for s in range(max(0, end - longest), end) if word[s:end] in costs))
    trie = token_counts.Trie(*token_counts.token_automaton(costs))
    for n in (1, 63, 64, 65, 200, 70, len(word), 64, len(word) - 1):
        assert trie.count(word[:n]) == best[n][1]
        assert len(trie.best) <= token_counts.DEPTH + 1


def test_exact_dedup_equals_grouping(docs, empty):
    groups = defaultdict(list)
    for i, t, _ in TEXTS:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()].append(i)
    want = Counter()
    for sha, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        stays = ids.index(least)
        want.update((i, least, len(ids), k == stays, sha) for k, i in enumerate(ids))
    assert counted(exact_dedup.exact_dedup(docs)) == want
    assert exact_dedup.drop_copies(docs).count() == len(groups)
    assert exact_dedup.drop_copies(docs).columns == docs.columns
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_very_long_texts_are_cut_in_time(spark):
    """Texts of 24 MB, alike but for the last character, and a copy with other white space."""
    long = "é spaced  text \n" * 1_600_000
    rows = [(1, long), (2, long + "a"), (3, long.replace("  ", "\t")), (4, long + "b"), (5, long + "a")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(frame).collect()}
    assert got == {1: (1, 2), 2: (2, 2), 3: (1, 2), 4: (4, 1), 5: (2, 2)}


def test_shards_follow_from_row_numbers(docs, empty):
    rows = sharding.document_shards(docs, 4).collect()
    assert Counter((r[0], r[1], r[2]) for r in rows) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in TEXTS)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert counted(sharding.document_shards(docs.repartition(5), 4)) == Counter(map(tuple, rows))
    assert sharding.document_shards(empty, 4).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 200])
def test_feistel_permutes(spark, n):
    rows = sharding.permuted(spark.range(n).withColumnRenamed("id", "row"), n).collect()
    assert sorted(r.place for r in rows) == list(range(n))


def near(texts, width, percent):
    """(id, size, component) by comparing all pairs."""
    sets = []
    for _, t, _ in texts:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    group = list(range(len(texts)))
    for a in range(len(sets)):
        for b in range(a):
            o = len(sets[a] & sets[b])
            if o and 100 * o >= percent * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    least = lambda g: min((t[0] for t, h in zip(texts, group, strict=True) if h == g and t[0] is not None), default=None)
    return Counter((t[0], len(s), least(g) if s else t[0]) for t, s, g in zip(texts, sets, group, strict=True))


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components_equal_all_pairs(docs, empty, width, percent):
    assert counted(jaccard.jaccard_components(docs, width, percent)) == near(TEXTS, width, percent)
    assert jaccard.jaccard_components(empty, width, percent).count() == 0


def test_near_copies_of_five_words_and_four_fifths_go(spark):
    """Scattered edits and an added passage, above 0.8 on 5 words and below 0.9 on 3."""
    import corpus_pipeline

    words = [f"w{k}" for k in range(400)]
    edited = [f"x{k}" if k % 80 == 40 else w for k, w in enumerate(words)]
    texts = [(1, words), (2, edited), (3, words + [f"y{k}" for k in range(80)]), (4, words[:200] + [f"z{k}" for k in range(200)]), (5, words[200:])]
    texts = [(i, " ".join(w), "en") for i, w in texts]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    assert near(texts, 3, 90) != near(texts, 5, 80)
    stay = {i for i, _, c in near(texts, 5, 80).elements() if i == c}
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, frame, "").collect()} == stay == {1, 4, 5}


def test_prefixes_of_linked_sets_meet():
    draw = np.random.default_rng(6)
    for percent in (80, 90):
        for n in [*range(1, 40), 517]:
            whole = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
            for drop in range(len(whole)):
                b = np.delete(whole, draw.permutation(len(whole))[:drop])
                if 100 * len(b) >= percent * len(whole):
                    met = len(np.intersect1d(jaccard.prefix(whole, percent), jaccard.prefix(b, percent)))
                    assert met >= max(jaccard.least_marks(len(whole), percent), jaccard.least_marks(len(b), percent))


def test_jaccard_cuts_large_clusters(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TREE", 8)
    draw = np.random.default_rng(3)
    texts = []
    for i in range(40):
        words = [f"w{k}" for k in range(150)]
        for k in draw.integers(0, 150, i % 4):
            words[k] = f"v{draw.integers(0, 9)}"
        texts.append((i, " ".join(words), "en"))
    frame = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    assert counted(jaccard.jaccard_components(frame, 3, 90)) == near(texts, 3, 90)


def test_jaccard_cuts_chains_by_rare_shingles(spark, monkeypatch):
    """Texts around one passage hang together by parts of it; only near copies of each other stay together."""
    monkeypatch.setattr(jaccard, "TREE", 8)
    draw = np.random.default_rng(8)
    texts = []
    for i in range(60):
        own = [f"o{i // 3}x{k}" for k in range(int(draw.integers(20, 120)) if i % 3 == 0 else len(own))]  # noqa: F821
        for k in draw.integers(0, len(own), i % 3):
            own[k] = f"v{i}"
        texts.append((i, " ".join([f"p{k}" for k in range(80)] + own), "en"))
    frame = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    assert counted(jaccard.jaccard_components(frame, 5, 80)) == near(texts, 5, 80)
    shingle = jaccard.Shingler(5)
    sets = spark.createDataFrame([(0, i, shingle(t).view(np.int64).tolist()) for i, t, _ in texts], "k bigint, c bigint, set array<bigint>")
    cut = {r.c: r.k for r in jaccard.refine(sets.union(sets.limit(4)), 80).collect()}
    linked = {r.doc_id: r.component_id for r in jaccard.jaccard_components(frame, 5, 80).collect()}
    for i, k in linked.items():
        assert i == k or cut[i] == cut[k]
    assert len(set(cut.values())) > 10


def test_linked_sets_share_rare_parts_and_passages_make_no_chains(spark):
    """Texts of 300 words, each of which has a passage of 90 in common with the next, do not hang together."""
    draw = np.random.default_rng(12)
    shingle, parts = jaccard.Shingler(5), jaccard.Parts(80)
    own = [[f"t{i}x{k}" for k in range(300)] for i in range(60)]
    texts = [own[i][:210] + own[(i + 1) % 60][:90] for i in range(60)]
    for i in range(0, 60, 3):  # above 0.8 with the text itself
        near_by = list(texts[i])
        for k in draw.integers(0, 300, 5):
            near_by[k] = "v"
        texts.append(near_by)
    sets = [shingle(" ".join(t)) for t in texts]
    groups = [(i, [n for n, _ in parts.groups(s)], [k.view(np.int64).tolist() for _, k in parts.groups(s)]) for i, s in enumerate(sets)]
    groups += groups[:5]  # a row read twice
    frame = spark.createDataFrame(groups, "c bigint, need array<bigint>, value array<array<bigint>>")
    met = {}
    for r in jaccard.rare_parts(frame).collect():
        met.setdefault(r.part, set()).add(r.c)
    pairs = {(a, b) for at in met.values() for a in at for b in at if a < b}
    assert pairs == {(i, 60 + i // 3) for i in range(0, 60, 3)}


def test_components_of_chains_stars_and_small_groups(spark, monkeypatch):
    """Few rounds of few written tables, each in no more tasks than its rows are worth, whatever the session deals to."""
    written = []
    monkeypatch.setattr(components, "stage", lambda df, name: written.append((name, df := stage(df, name))) or df)
    draw = np.random.default_rng(4)
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(2000, 2000), (2002, 2001), (2001, 2002)]
    links += [(3000 + int(a), 3000 + int(b)) for a, b in draw.integers(0, 300, (150, 2))]
    least = {}
    for u, v in [x for x in links if x[0] != x[1]] * 300:
        least[u] = least[v] = min(least.get(u, u), least.get(v, v))
    deal = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", deal)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r.node: r.label for r in got} == least and len(got) == len(least)
    assert len(written) <= 25
    assert all(len(df.inputFiles()) <= 8 for _, df in written[1:])


def test_parts_of_linked_sets_meet():
    draw = np.random.default_rng(5)
    for percent in (80, 90):
        parts = jaccard.Parts(percent)
        for n in [*range(1, 40), 100, 517, 2000]:
            whole = draw.integers(0, 2**63, n).astype(np.uint64)
            for _ in range(20):
                drop = draw.integers(0, max(1, n * (100 - percent) // 100 + 1))
                a, b = np.unique(whole), np.unique(whole[drop:])
                o = len(np.intersect1d(a, b))
                if len(b) and len(a) != len(b) and 100 * o >= percent * (len(a) + len(b) - o):
                    assert len(np.intersect1d(parts(a), parts(b)))


def test_contained_items_equal_all_pairs(spark, docs, empty):
    items = [(1, BASE), (2, "zwei drei"), (3, None), (4, ""), (5, " ".join(f"w{i}" for i in range(20, 60)) + " no"), (2, "zwei drei"), (6, "not there at all in any")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    shingle = lambda t, k: {tuple(w[i : i + k]) for w in [(t or "").lower().encode().translate(decontam._TABLE).split()] for i in range(len(w) - k + 1)}
    want = Counter()
    for item, text in items:
        k = min(5, len((text or "").split()))
        wanted = shingle(text, k) if k else set()
        for i, t, _ in TEXTS:
            o = len(wanted & shingle(t, k)) if wanted else 0
            if o and 100 * o >= 80 * len(wanted):
                want[i, item, len(wanted), o] += 1
    got = decontam.contained_items(docs, frame)
    assert Counter((r[0], r[1], r[2], r[3]) for r in got.collect()) == want
    assert want
    assert decontam.contained_items(empty, frame).count() == 0
    assert decontam.contained_items(docs, frame.limit(0)).count() == 0


def test_language(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table.where(fold("doc_id", 3) != 1))
    right = langid.predict(table.where(fold("doc_id", 3) == 1), model, carry={"lang": F.col("lang")})
    assert right.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    rows = langid.predict(docs, model).collect()
    assert len(rows) == len(TEXTS)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == "und" for r in rows) == 4  # null, empty, digits, null
    assert langid.fit(empty).languages == []
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty)).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_false_positives_are_taken_off():
    """A language whose filter is full has no count above what chance gives."""
    full = langid.Model(["aa", "bb"], np.full((1 << 10, 1), 1, np.uint64), np.array([1 - 1e-9, 0.0]))
    gram, _ = langid.grams(["some text"], langid.letter_table())
    hits = (full.masks(gram)[:, 0] & np.uint64(1)).sum()
    assert abs((hits - len(gram) * full.false_rate[0]) / len(gram)) < 1e-6


def test_hmm_equals_a_plain_forward_recursion(docs, empty):
    model = hmm.fit(docs)
    rows = hmm.score(docs, model).collect()
    vocab, chain = model.vocab.value, model.chain
    counts = Counter()
    for _, t, _ in TEXTS:
        counts.update([*(t or "").encode().lower().split(), b" "])
    assert (vocab.tokens, vocab.distinct) == (sum(counts.values()), len(counts))
    want = {}
    for i, t, _ in TEXTS:
        words = (t or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (vocab.tokens + vocab.distinct + 1)) for w in [*words, b" "])
        found = vocab.look_up([words])
        p, total = chain.start, 0.0
        for s in found.flat:
            p = p * chain.emit[s]
            total += math.log10(p.sum())
            p = p / p.sum() @ chain.move
        for w, s in zip(words, found.symbol, strict=True):
            if s >= vocab.own:
                k = s - vocab.own
                total += math.log10((counts[w] + 1) / (vocab.class_tokens[k] + vocab.class_words[k] + 1))
        want[i, t] = (len(words) + 1, len(words) + 1, base, total)
    assert len(rows) == len(TEXTS)
    for r in rows:
        near_ = [w for (i, _), w in want.items() if i == r.doc_id and w[0] == r.n_tokens]
        assert any(np.allclose([r.n_tokens, r.n_known, r.base_score, r.score], w, rtol=1e-9) for w in near_)
    assert hmm.score(empty, model).count() == 0
    assert hmm.score(docs, hmm.fit(empty)).count() == len(TEXTS)


def test_language_model_learns_from_all_rows_alike(spark, monkeypatch):
    """The likelihood rises, texts that were held out are likelier than under the base, and neither the order nor
    the dealing of rows makes another model, though the start is found on a sample."""
    monkeypatch.setattr(hmm, "SAMPLE", 300)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train, rest = (table.where(c) for c in (fold("doc_id", 7) != 2, fold("doc_id", 7) == 2))
    model = hmm.fit(train)
    assert len(model.likelihoods) >= 2 and all(a < b for a, b in zip(model.likelihoods, model.likelihoods[1:]))
    total = hmm.score(rest, model).agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
    assert (total.score - total.base) / total.n > 0.2  # log10 a token
    other = hmm.fit(train.repartition(7, "source").sortWithinPartitions("lang"))
    assert np.allclose(model.likelihoods, other.likelihoods, rtol=1e-9)
    assert all(np.allclose(a, b, rtol=1e-6) for a, b in zip((model.chain.start, model.chain.move, model.chain.emit), (other.chain.start, other.chain.move, other.chain.emit), strict=True))


def test_every_row_takes_part_in_the_search_of_a_start(spark, monkeypatch):
    monkeypatch.setattr(hmm, "SAMPLE", 10)
    rows = spark.createDataFrame([(i, f"w{i} w{i % 7}") for i in range(250)] + [(7, None), (None, "alone")], "doc_id bigint, text string")
    seen, counted = [], hmm.expected_counts
    monkeypatch.setattr(hmm, "expected_counts", lambda texts, *a: seen.append(texts.count()) or counted(texts, *a))
    hmm.fit(rows)
    warm, full = seen[: hmm.WARM], seen[hmm.WARM :]
    assert sum(warm) == 252 and len(warm) == hmm.WARM and max(warm) < 60
    assert full and set(full) == {252}


def test_expected_counts_do_not_depend_on_pieces(monkeypatch):
    draw = np.random.default_rng(1)
    emit = draw.random((9, 3))
    chain = hmm.Chain(np.array([0.2, 0.3, 0.5]), np.array([[0.8, 0.1, 0.1], [0.2, 0.7, 0.1], [0.3, 0.3, 0.4]]), emit / emit.sum(axis=0))
    sizes = np.array([1, 40, 300, 7])
    flat = draw.integers(0, 9, sizes.sum())
    whole = hmm.Pieces.cut(flat, sizes).expected(chain)
    monkeypatch.setattr(hmm, "PIECE", 16)
    for a, b in zip(whole, hmm.Pieces.cut(flat, sizes).expected(chain), strict=True):
        assert np.allclose(a, b)
    assert np.isclose(whole[3].sum(), sizes.sum())
    assert np.isclose(whole[2].sum(), (sizes - 1).sum())


def test_quality_model_sums_to_one_and_keeps_clean_text(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(table.join(labels.where("quality = 1"), "doc_id", "left_semi"))
    for logs in model.tables.values():
        assert np.allclose(np.exp(logs.reshape(-1, quality.SYMBOLS).astype(float)).sum(axis=1), 1, atol=1e-4)
    rows = quality.classify(table, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = dict(map(tuple, rows))
    assert share[1] > 0.85
    assert share[0] < 0.3
    assert quality.classify(docs, labels.limit(0)).where("kept").count() == 0
    assert quality.classify(empty, labels).count() == 0


def test_thresholds_are_quantiles_of_all_held_out_rows(spark, monkeypatch):
    """A bound on the fitted rows doesn't bound the rows that the thresholds come from."""
    monkeypatch.setattr(quality, "MAX_TRUSTED", 50)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turn = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(quality.CALIBRATION))
    held = {r.doc_id for r in labels.where((F.col("quality") == 1) & (turn == 0)).collect()}
    assert len(held) > 50
    rows = quality.classify(table, labels.unionByName(labels)).collect()  # repeated labels change nothing
    place = {r.doc_id: round(quality.GRID * math.log(r.perplexity)) for r in rows if r.perplexity}
    by = defaultdict(list)
    for r in rows:
        if r.doc_id in held and r.perplexity:
            for of in (r.lang, None):
                by[of].append(place[r.doc_id])
    for r in rows:
        mine = sorted(by.get(r.lang) or by[None])
        low, high = mine[math.floor((len(mine) - 1) * quality.LOW)], mine[math.ceil((len(mine) - 1) * quality.HIGH)]
        assert math.isclose(r.low, math.exp(low / quality.GRID)) and math.isclose(r.high, math.exp(high / quality.GRID))
        assert r.kept == (r.doc_id in place and low <= place[r.doc_id] <= high)


def test_quality_model_is_fitted_on_all_trusted_rows(spark, monkeypatch):
    """Every trusted row that is not held out is counted, however many there are."""
    n, seen = 30_000, []
    turn = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(quality.CALIBRATION))
    ids = spark.range(n).select(F.col("id").alias("doc_id"))
    table = ids.select("doc_id", F.lit("en").alias("lang"), F.lit("abc").alias("text"))
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, *a: seen.append(rows.select("doc_id").distinct().count()) or fit(rows, *a))
    assert quality.classify(table, ids.withColumn("quality", F.lit(1))).where("kept").count() == n
    assert seen == [ids.where(turn > 0).count()] and seen[0] > 20_000


def test_main_text(spark):
    words = "word " * 40
    pages = {
        None: "", "": "", "plain &amp; simple": "plain & simple",
        f"<nav><a href=x>Home</a></nav><div><h1>T</h1><p>{words}</p><p>To.</p><p>{words}</p></div><div id='comments'><p>{words}</p></div>": f"T\n{words.strip()}\nTo.\n{words.strip()}",
        "<article><h1>A</h1><p><b>x<br><p>y  &lt;z&gt;<script>'</p>'</script><div class=ad>buy</div><p>end</article><footer>f</footer>": "A\nx\ny <z>\nend",
    }
    frame = spark.createDataFrame([(i, None, p, "clash") for i, p in enumerate(pages)], "page_id bigint, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(frame).collect()}
    assert got == {i: (t, len(t)) for i, t in enumerate(pages.values())}
    assert html_text.extract(frame.limit(0)).count() == 0


def test_wrapped_blocks_and_marked_pages_keep_their_text():
    long = "word " * 39 + "word"
    assert html_text.main_text(f"<div><h1>T</h1></div><div><p>{long}</p></div>") == f"T\n{long}"
    assert html_text.main_text(f"<div><p>{long}</p></div><div><p>Short end.</p></div>") == f"{long}\nShort end."
    assert html_text.main_text(f"<body class='has-sidebar search'><main id=comments><p>{long}</p></main></body>") == long


def test_pipeline_keeps_what_no_stage_rejects(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if any(map(str.isalpha, r.text or ""))]
    first = {}
    for i, t, _ in sorted(rows):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    rows = [r for r in rows if r[0] in set(first.values())]
    rows = [r for r, (i, _, c) in zip(rows, near(rows, 5, 80).elements(), strict=True) if i == c]
    grams = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().encode().translate(decontam._TABLE).split()] for i in range(len(w) - 4)}
    items = [grams(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(100 * len(g & grams(r[1])) >= 80 * len(g) for g in items)]
    assert set(got) == {r[0] for r in rows}
    for i, t, _ in rows:
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
