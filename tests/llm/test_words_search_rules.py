"""Spelling variants, ranked search and quality rules against brute force, with nulls, empty tables, long texts,
ties, repeats and clashing names."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from careerpanel.llm import lexical, quality_rules, spelling
from careerpanel.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF

SCHEMA = "doc_id bigint, text string, lang string, source string, word string, n bigint, id string, q int, score double, total int"
EXTRA = ("x", 7, "y", 1, 0.5, 3)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, *EXTRA) for i, t, lang, source in rows], SCHEMA)


def given(spark):
    return [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# --- spelling variants


def variants(texts):
    counts = Counter()
    for i, t in texts:
        for run in re.findall("[a-zÀ-ÿ]+", (t or "").encode().lower().decode()):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    lost, near = defaultdict(list), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            lost[rest, i].append(w)
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
    for group in lost.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = Counter()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w, form[w], root, n, len(near[w]), counts.get(form[w])] += 1
    return out


LONG = "ab" * 400
WORDS = [
    (1, "information " * 400 + "informatio " * 30 + "infornatio infornatio infornatio INFORMATION!", "en", "a"),
    (2, "élégance élégances Élégance élégance éléganca élégance", "fr", "a"), (2, "élégance élégances Élégance élégance éléganca élégance", "fr", "a"),
    (3, None, None, None), (4, "", "en", None), (None, "general-general, generel_generel 12general34 short short", None, "a"),
    (5, f"{LONG} {LONG}c {LONG} {LONG}c {LONG}{LONG} x{LONG} x{LONG} {'z' * 3000} {'z' * 3000} {'z' * 2999} {'z' * 2999}", "en", "b"),
    (6, " ".join(f"common{a}{b} common{a}{b}" for a in "abcdefghij" for b in "abcdefghij"), "en", "b"),
    (7, "absence absenco absense absence absenco absense " * 2, "en", "b"),
]


@pytest.mark.parametrize(("frequent", "most", "hot"), [(50, 250_000, 64), (1, 250_000, 64), (1, 250_000, 2), (1, 20, 5)])
def test_spelling_variants_equal_brute_force(spark, monkeypatch, frequent, most, hot):
    """Lists of one gram, merged lists, merged lists that are dealt again, and a full dictionary."""
    monkeypatch.setattr(spelling, "LIST", frequent)
    monkeypatch.setattr(spelling, "GRAMS", most)
    monkeypatch.setattr(spelling, "HOT", hot)
    got = spelling.spelling_variants(table(spark, WORDS))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = Counter(map(tuple, got.collect()))
    assert got == variants([r[:2] for r in WORDS])
    assert {r[0]: r[2] for r in got}["infornatio"] == "information"  # a form of a form


def test_spelling_query_equals_brute_force(spark):
    got = Counter(map(tuple, QUERIES["op11_spelling_variants"](spark, SF).collect()))
    assert got == variants([r[:2] for r in given(spark)]) and any(r[1] for r in got)


def test_no_words(spark):
    assert spelling.spelling_variants(table(spark, [])).count() == 0
    assert spelling.spelling_variants(table(spark, [(1, None, None, None), (2, "a b", "en", "x")])).count() == 0


def test_dictionary_is_pruned_by_frequency(spark):
    words = spark.createDataFrame([(w, 2) for w in ("abcdefgh", "abcdefgx", "abcdexyz", "qrstuvw")], "word string, n bigint")
    rows = {}
    for least in (1, 2, 3):
        spelling.LIST, old = least, spelling.LIST
        try:
            rows[least] = sum(len(g) for g, _ in spelling.gram_dictionary(words).grams.values())
        finally:
            spelling.LIST = old
    assert rows[1] > rows[2] > rows[3] == 0


# --- ranked search


def ranked(docs, items, top):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").encode().lower().decode())
    rows = [(i, Counter(find(t))) for i, t in docs]
    total, length = sum(1 for _, c in rows if c), sum(c.total() for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = Counter()
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in rows:
            m = 100 - 50 + (50 * c.total() * total) // length if length else 0
            weight = lambda t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(find(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:top], 1):
            out[item, rank, i, -score] += 1
    return out


TEXTS = [
    (1, "the mill by the river turns", "en", "a"), (2, "The MILL; the river", "en", "a"), (2, "the mill the river", "en", "a"), (3, None, None, None),
    (4, "", "en", "a"), (None, "river river river", "en", None), (5, "Été 2024 — naïve café", "fr", "a"), (6, "mill " * 400 + "end", "en", "b"),
    (7, " ".join(f"t{i}" for i in range(60_000)) + " mill", "en", "b"), (8, "nothing alike", "en", "b"), (9, "mill", "en", "b"), (10, "mill", "en", "b"),
]
ITEMS = [(1, "Mill river"), (2, "the the the"), (3, None), (4, ""), (5, "ÉTÉ été naïve T59999 café 2024"), (6, "unheard"), (7, "mill"), (7, "mill"), (None, "river mill t1 t2 t3")]


@pytest.mark.parametrize("top", [1, 3, 50])
@pytest.mark.parametrize("block", [20_000, 4])
def test_search_equals_brute_force(spark, monkeypatch, top, block):
    monkeypatch.setattr(lexical, "BLOCK", block)
    items = spark.createDataFrame([(i, t, 1, "x") for i, t in ITEMS], "item_id bigint, text string, rank int, doc_id string")
    docs = table(spark, TEXTS).repartition(5)
    got = lexical.search(docs, items, top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == ranked([r[:2] for r in TEXTS], ITEMS, top)


def test_search_in_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert lexical.search(table(spark, []), items).count() == 0
    assert lexical.search(table(spark, [(1, None, None, None)]), items).count() == 0
    assert lexical.search(table(spark, TEXTS), items.limit(0)).count() == 0


def test_search_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = con.execute(ORACLE_SQL["op12_lexical_search"])
    got = QUERIES["op12_lexical_search"](spark, SF)
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_bounds_hold_and_cut(spark):
    """A sketch never bounds a score from below, and most documents are not scored exactly."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    index = lexical.build_index(docs).collect()
    texts = {r.doc_id: Counter(lexical.terms(r.text or "")) for r in docs.collect()}
    for row in index:
        if row.n:
            sketch = np.frombuffer(row.sketch, np.uint8)
            names = list(texts[row.id])
            h = np.array([lexical.xxhash.xxh3_64_intdigest(t) for t in names], np.uint64)
            bound = lexical.looked_up(sketch[None, :], h, row.level)[0]
            assert (bound >= np.minimum([texts[row.id][t] for t in names], 255)).all()
            other = np.random.default_rng(0).integers(0, 1 << 63, 2000, dtype=np.uint64)
            assert (lexical.looked_up(sketch[None, :], other, row.level) > 0).mean() < 0.03


# --- quality rules


def base(text):
    raw = (text or "").encode()
    words = raw.split()
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside |= {i, i + 1, i + 2}
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside), len(lines)


def plain_mcd(x):
    """The same concentration steps on one group in memory."""
    df = x.shape[1]
    floors = np.array(list(quality_rules.FLOORS.values())) ** 2
    inner = quality_rules.chi2_quantile(quality_rules.SHARE, df)
    factor = quality_rules.SHARE / quality_rules.chi2(inner, df + 2)
    mean = np.median(x, 0)
    inv = np.diag(1 / ((np.median(abs(x - mean), 0) * 1.4826) ** 2 + floors))
    for _ in range(quality_rules.STEPS):
        d = np.einsum("ij,jk,ik->i", x - mean, inv, x - mean)
        place = np.minimum(np.floor(np.log2(1 + d) * (quality_rules.BINS / 16)), quality_rules.BINS - 1)
        cut = np.sort(place)[math.ceil(quality_rules.SHARE * len(x)) - 1]
        near = x[place <= cut]
        mean, inv = near.mean(0), np.linalg.inv(factor * (near.T @ near / len(near) - np.outer(near.mean(0), near.mean(0))) + np.diag(floors))
    return mean, inv


def verdicts(rows):
    stats = [base(t) for _, t, _, _ in rows]
    failed = [s[0] < 50 or 100 * s[4] > 50 * s[0] for s in stats]
    x = np.array([[round(1000 * v) / 1000 for v in (math.log(s[1] / max(s[0], 1)) if s[1] else 0, math.sqrt(s[2] / max(s[0], 1)), math.sqrt(s[3] / max(s[5], 1)), math.sqrt(s[4] / max(s[0], 1)))] for s in stats])
    groups = defaultdict(list)
    for k, (_, _, lang, source) in enumerate(rows):
        if not failed[k]:
            for name in ((lang, source), (lang,), ()):
                groups[name].append(k)
    found = {name: plain_mcd(x[mine]) for name, mine in groups.items() if len(mine) >= quality_rules.LEAST}
    cut = quality_rules.chi2_quantile(1 - quality_rules.REJECT, 4)
    out = Counter()
    for k, (i, _, lang, source) in enumerate(rows):
        by = next((found[n] for n in ((lang, source), (lang,), ()) if n in found), None)
        kept = not failed[k] and (by is None or (x[k] - by[0]) @ by[1] @ (x[k] - by[0]) <= cut)
        out[(i, *stats[k][:5], failed[k], bool(kept))] += 1
    return out


def judged(docs):
    return Counter(map(tuple, quality_rules.judge(docs).drop("distance").collect()))


@pytest.fixture(scope="module")
def mixed(spark):
    """The given rows, three quarters of them of one source, with edge cases."""
    rows = [(i, t, lang, "hot" if i % 4 else source) for i, t, lang, source in given(spark)]
    words = " ".join(f"word{i}" for i in range(80))
    return rows + [
        (900, None, None, None), (901, "", "en", ""), (902, words, None, None), (902, words, None, None), (None, words.replace(" ", " # "), "en", "hot"),
        (903, "a b c " * 5000, "en", "hot"), (904, f"{words}\n{words}\n \n\n{words}", "xx", "new"), (905, " ".join(f"w{i}" for i in range(50_000)), "en", "hot"),
        (906, words[: words.rindex("word50")], "en", "hot"), (907, " ".join(f"w{i}" for i in range(49)), "en", "hot"),
    ]


def test_quality_rules_equal_brute_force(spark, mixed):
    docs = table(spark, mixed)
    want = verdicts(mixed)
    assert judged(docs) == want
    assert judged(docs.repartition(7)) == want  # sums are exact in any order
    assert len({r[-1] for r in want}) == 2


def test_quality_query_equals_brute_force(spark):
    got = QUERIES["op13_quality_rules"](spark, SF)
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance"]
    assert Counter(map(tuple, got.drop("distance").collect())) == verdicts(given(spark))


def test_outliers_go_and_good_texts_stay(spark):
    """Labels are never read; they show what the verdict is worth."""
    sf = SF.replace("0.001", "0.01")
    rows = QUERIES["op13_quality_rules"](spark, sf).where(~F.col("base_failed")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = {r.quality: r.kept for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.97 and share[0] < 0.05


def test_small_and_empty_tables_are_judged_by_the_base_rule(spark):
    assert quality_rules.judge(table(spark, [])).count() == 0
    few = [(i, " ".join(f"w{k}" for k in range(60 * i)), "en", "a") for i in range(3)]
    assert [r.kept for r in quality_rules.judge(table(spark, few)).orderBy("doc_id").collect()] == [False, True, True]


def test_repeated_words():
    count = lambda text: quality_rules.repeated_words(quality_rules.Words().numbers(text.encode().split()))
    assert count("") == count("a") == count("a b c") == count("a b c d e f") == 0
    assert count("a a a a") == 4
    assert count("a b c x a b c") == 6
    assert count("a b c a b c a") == 7
    wide = np.array([1, 2, 3, 4, 1, 2, 3], np.int64) << 30
    assert quality_rules.repeated_words(wide) == 6
