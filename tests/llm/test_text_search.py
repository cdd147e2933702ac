"""Ranked search, fingerprints and resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from helpers_text import DOCS, awkward, lower, sha
from rillwork.llm import ranked, resampling, winnowing
from rillwork.llm.common import prepared
from rillwork.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()


def terms(text):
    return TERM.findall(lower(text or ""))


# Ranked search --------------------------------------------------------------------------------------------

def brute_search(docs, items, k=10):
    """docs: (doc_id, text); items: distinct (item_id, text)."""
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            n = sum(c.values())
            m = 25 + 75 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


ITEMS = "item_id bigint, text string"


def test_search_of_awkward_rows(spark):
    df = awkward(prepared(spark))
    asked = [(1, "same words here twice"), (2, None), (3, ""), (4, "WORD word 12345 straße nowhere"), (5, "zzz")]
    got = ranked.search(df, spark.createDataFrame([*asked, asked[0]], ITEMS))
    want = brute_search([(r.doc_id, r.text) for r in df.collect()], asked)
    assert sorted(map(tuple, got.collect())) == want


def test_search_of_empty_tables(spark):
    prepared(spark)
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b", "", "", 3)], DOCS)
    items = spark.createDataFrame([(1, "a")], ITEMS)
    assert ranked.search(none, items).collect() == []
    assert ranked.search(some, items.where("false")).collect() == []
    assert len(ranked.search(some, items).collect()) == 1


def made(n, seed=5):
    """Texts on topics, so that lists have similar documents, with ties and repeats."""
    rng = random.Random(seed)
    topics = [[f"t{i}w{j}" for j in range(30)] for i in range(12)]
    common = [f"c{j}" for j in range(20)]
    out = []
    for i in range(n):
        words = rng.choices(rng.choice(topics), k=rng.randrange(1, 25)) + rng.choices(common, k=rng.randrange(12))
        out.append((i * 7 % n, " ".join(words)))
    return out + out[:50], topics, common


def test_search_is_exact_and_skips_blocks():
    docs, topics, common = made(6000)
    rng = random.Random(9)
    items = [(q, " ".join(rng.choices(rng.choice(topics), k=6) + rng.choices(common, k=3))) for q in range(30)]
    number = {t: i for i, t in enumerate(sorted({t.encode() for _, x in items for t in terms(x)}))}
    table = pa.record_batch([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs])],
                            ["doc_id", "text"])
    forward = list(ranked.forward_rows(number)([table]))
    n_docs, length = len(docs), sum(len(terms(t)) for _, t in docs)
    df = Counter(t for _, x in docs for t in set(terms(x)))
    weighted = [{number[t.encode()]: c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                 for t, c in Counter(terms(x)).items() if df[t]} for _, x in items]
    ordered = pa.Table.from_batches(forward).select([0, 1, 2, 3]).to_batches()
    out = pa.Table.from_batches(list(ranked.searcher(weighted, len(number), n_docs, length, [1] * 30, 10)(
        ordered))).to_pylist()
    want = brute_search(docs, items)
    got = sorted((r["query"], r["score"]) for r in out)
    assert got == sorted((q, s) for q, _, _, s in want)
    assert sorted((r["query"], r["doc_id"]) for r in out) == sorted((q, i) for q, _, i, _ in want)
    # With the final thresholds most documents are never scored.
    queries = ranked.Queries(weighted, len(number))
    batch = forward[0].slice(0, ranked.DOCS)
    per_doc = np.diff(batch.column(2).offsets.to_numpy())
    impact = ranked.impacts(batch.column(1).to_pylist(), per_doc, batch.column(3).flatten().to_numpy(),
                            n_docs, length)
    index = ranked.Slice(batch.column(0).to_numpy(), np.r_[0, np.cumsum(per_doc)],
                         batch.column(2).flatten().to_numpy(), impact, queries)
    least = np.array([min(s for q, _, _, s in want if q == i) for i in range(30)], float)
    loose, tight = index.candidates(np.ones(30)), index.candidates(least)
    assert not (tight & ~loose).any() and tight.sum() < 0.4 * loose.sum()
    for q in range(30):
        exact = index.scores(np.arange(len(index.ids)), q)
        assert tight[exact >= least[q], q].all()


def test_search_in_many_blocks_of_queries(spark):
    docs, topics, common = made(500)
    items = [(i, " ".join(random.Random(i).choices(sum(topics, common), k=8))) for i in range(300)]
    df = prepared(spark).createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = ranked.search(df, spark.createDataFrame(items, ITEMS), k=3)
    assert sorted(map(tuple, got.collect())) == brute_search(docs, items, 3)


# Fingerprints ---------------------------------------------------------------------------------------------

def brute_winnow(text):
    plain = [(i, c) for i, c in enumerate(lower(text)) if c not in " \t\n\x0b\x0c\r"]
    width = min(winnowing.GRAM, len(plain))
    if not width:
        return []
    hashes = []
    for s in range(len(plain) - width + 1):
        h = 0
        for _, c in plain[s:s + width]:
            h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2 ** 64
        h = (h ^ (h >> 31)) * 0xBF58476D1CE4E5B9 % 2 ** 64
        hashes.append((h ^ (h >> 29), plain[s][0]))
    kept = []
    size = min(winnowing.WINDOW, len(hashes))
    for s in range(len(hashes) - size + 1):
        window = hashes[s:s + size]
        low = min(h for h, _ in window)
        best = max(p for h, p in window if h == low)
        if not kept or kept[-1] != (low, best):
            kept.append((low, best))
    return kept


def as_text(kept):
    return ",".join(f"{h:016x}@{p}" for h, p in kept)


def share(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_edits(docs):
    order = sorted(((i is None, i or 0, t or "") for i, t in docs))
    out = []
    for at, (no_id, i, t) in enumerate(order):
        following = order[(at + 1) % len(order)][2]
        quarter = len(t) // 4
        changed = t[:len(t) - quarter] + following[:quarter]
        a, b, c = map(brute_winnow, (t, changed, following))
        out.append((None if no_id else i, len(t), sha(changed), as_text(a), as_text(b), share(a, b), share(a, c)))
    return sorted(out, key=repr)


def test_fingerprints_equal_plain_version(spark, sf_dir):
    got = QUERIES["op12_fingerprints"](spark, sf_dir).collect()
    want = brute_edits([(r.doc_id, r.text) for r in rows(spark, sf_dir, "documents")])
    assert sorted(map(tuple, got), key=repr) == want


def test_fingerprints_of_awkward_rows(spark):
    df = awkward(prepared(spark)).where("doc_id is null or doc_id != 5").repartition(5)
    rest = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, winnowing.compare_edited(df).collect()), key=repr) == brute_edits(rest)
    kept = winnowing.fingerprints(awkward(spark), to="prints").collect()
    assert len(kept) == 12 and all(set(r.asDict()) >= {"key", "ids.x", "prints"} for r in kept)
    assert [len(r.prints) for r in kept if not (r.text or "").strip()] == [0, 0, 0]
    one = winnowing.compare_edited(spark.createDataFrame([(3, "one single text" * 9)], "doc_id bigint, text string"))
    assert one.first().near_next == 1.0
    assert winnowing.compare_edited(spark.createDataFrame([], DOCS)).collect() == []


def test_shared_passages_are_always_found():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    for _ in range(200):
        passage = "".join(word() for _ in range(10))[:winnowing.GRAM + winnowing.WINDOW - 1]
        a = " ".join(word() for _ in range(rng.randrange(40))) + passage + word()
        b = word() + passage.upper() + " ".join(word() for _ in range(rng.randrange(40)))
        both = set(winnowing.winnow(a)[0].tolist()) & set(winnowing.winnow(b)[0].tolist())
        assert both


def test_ties_keep_the_rightmost():
    values = np.array([5, 3, 3, 9, 3, 7] * 20, np.uint64)
    got = winnowing.smallest(values)
    want = []
    for s in range(len(values) - winnowing.WINDOW + 1):
        window = values[s:s + winnowing.WINDOW].tolist()
        at = s + len(window) - 1 - window[::-1].index(min(window))
        want += [at] if not want or want[-1] != at else []
    assert got.tolist() == want


# Resampling -----------------------------------------------------------------------------------------------

def features(text):
    words = terms(text)
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute_resample(docs, target):
    mine = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in mine:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    out = []
    for i, n, f in mine:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, len(f), weight, score, None])
    may = sorted((r for r in out if r[1] >= 20 and r[0] is not None), key=lambda r: (-r[4], r[0]))
    for rank, r in enumerate(may[:5 * len(may) // 100]):
        r[5] = rank + 1
    return sorted(map(tuple, out), key=repr)


def test_resampling_equals_plain_version(spark, sf_dir):
    got = QUERIES["op13_importance_resampling"](spark, sf_dir).collect()
    want = brute_resample([(r.doc_id, r.text) for r in rows(spark, sf_dir, "documents")],
                          [r.text for r in rows(spark, sf_dir, "benchmark")])
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got), key=repr) == sorted(
        ((i, f, w, s, r) for i, _, f, w, s, r in want), key=repr)


def test_resampling_of_awkward_rows(spark):
    df = awkward(prepared(spark))
    for target in ([(1, "same text here"), (2, None), (3, "")], []):
        got = resampling.resample(df, spark.createDataFrame(target, ITEMS)).collect()
        assert sorted(map(tuple, got), key=repr) == brute_resample(
            [(r.doc_id, r.text) for r in df.collect()], [t for _, t in target])
    none = spark.createDataFrame([], DOCS)
    assert resampling.resample(none, none).collect() == []
    assert resampling.drawn_documents(df, df, percent=100).columns == df.columns


def test_checksums_of_long_runs():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcé日", k=rng.choice([1, 3, 30, 200]))) for _ in range(300)]
    n, found = resampling.Features().of(" ".join(words))
    assert (n, found.tolist()) == features(" ".join(words))


@pytest.mark.parametrize("part_rows", [7, 1 << 20])
def test_radix_ranks(spark, part_rows):
    rng = random.Random(2)
    big = 2 ** 63
    data = [(rng.choice([rng.randrange(-big, big), rng.randrange(-3, 3), big - 1, -big]),
             rng.choice([rng.randrange(-big, big), rng.randrange(5)])) for _ in range(400)] + [(1, 1)] * 150
    df = spark.createDataFrame(data, "part bigint, digit bigint").repartition(3)
    got = resampling.radix_ranks(df, [("part", True), ("digit", False)], "rank", part_rows).collect()
    assert [(r.part, r.digit) for r in sorted(got, key=lambda r: r.rank)] == sorted(
        data, key=lambda r: (-r[0], r[1]))
    assert sorted(r.rank for r in got) == list(range(1, len(data) + 1))
