"""Parts of the operators against plain versions, without Spark where that is possible."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest

from helpers_text import brute_components
from rillwork.llm import chunks, language, mixing, multiindex, simhash
from rillwork.llm.automata import Automaton
from rillwork.llm.cuckoo import CuckooFilter
from rillwork.llm.graph import components
from rillwork.llm.lines import built
from rillwork.llm.mincut import labels


def test_cuckoo_filter():
    rng = random.Random(1)
    keys = [rng.randbytes(16) for _ in range(3000)]
    f = CuckooFilter.sized(2000)
    f.insert(keys[:2000])
    assert not f.full and f.contains(keys[:2000]).all() and f.contains(keys[2000:]).mean() < 0.01
    f.remove(keys[:1000])
    assert f.contains(keys[1000:2000]).all() and f.contains(keys[:1000]).mean() < 0.01
    again = CuckooFilter.load(f.dump())
    assert (again.table == f.table).all() and again.contains(keys[1000:2000]).all()
    small = CuckooFilter(2)
    small.insert(keys[:50])
    assert small.full and small.contains(keys).all()
    made = built(pd.DataFrame({"shard": 3, "key": keys}))
    assert made["shard"].tolist() == [3] and CuckooFilter.load(made["filter"][0]).contains(keys).all()


def test_minimum_cut():
    rng = random.Random(0)
    for _ in range(200):
        n = rng.randint(1, 8)
        costs = [rng.choice([-3, -2, -1, 0, 0.5, 1, 2, 3]) for _ in range(n)]
        ties = [(a, b, rng.choice([0.5, 1, 2])) for a in range(n) for b in range(a) if rng.random() < 0.4]

        def value(way):
            return (sum(c for c, x in zip(costs, way) if x)
                    + sum(w for a, b, w in ties if way[a] != way[b]))

        best = min(map(value, itertools.product([False, True], repeat=n)))
        assert value(labels(costs, ties)) == pytest.approx(best)


def test_flight_keeps_sums_and_landing_is_near():
    rng = random.Random(2)
    for n in (0, 1, 2, 5, 40, 900):
        words = [float(rng.randint(1, 3000)) for _ in range(n)]
        counts = [1.0] * n
        start = [0.4] * n
        flown = mixing.flight(start, counts, words, random.Random(7), land=False)
        assert sum(0 < p < 1 for p in flown) <= 2
        assert sum(flown) == pytest.approx(sum(start))
        assert np.dot(flown, words) == pytest.approx(np.dot(start, words))
        landed = mixing.flight(start, counts, words, random.Random(7), land=True)
        assert set(landed) <= {0.0, 1.0}
        if n >= 40:
            assert abs(np.dot(landed, words) - np.dot(start, words)) < 100
    equal = mixing.flight([0.5] * 100, [1.0] * 100, [10.0] * 100, random.Random(1), land=True)
    assert sum(equal) == 50


def test_flight_is_fair():
    """Units are taken as often as their chance says."""
    words = [float(w) for w in (5, 900, 31, 4, 77, 250, 8, 19)]
    taken = np.zeros(8)
    for seed in range(3000):
        taken += np.array(mixing.flight([0.3] * 8, [1.0] * 8, words, random.Random(seed), land=False))
    assert np.abs(taken / 3000 - 0.3).max() < 0.04


def planted(rng, n):
    p = rng.integers(0, 2 ** 64, n, dtype=np.uint64)
    near = p[:n // 4].copy()
    for _ in range(5):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)
    ball = p[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    return np.unique(np.concatenate([p, near, ball, np.uint64([0, 2 ** 64 - 1])]))


def test_shards_find_every_link():
    rng = np.random.default_rng(4)
    points = planted(rng, 1500)
    tree = simhash.build_tree(points[::3], 4)
    shard, row, home = simhash.route(tree, points, 4)
    assert np.array_equal(np.sort(row[home]), np.arange(len(points)))
    root = {int(p): int(p) for p in points.view(np.int64)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for s in np.unique(shard):
        at = shard == s
        fps = np.concatenate([points[row[at & home]], points[row[at]]]).view(np.int64)
        flags = np.r_[np.ones((at & home).sum(), bool), np.zeros(at.sum(), bool)]
        for a, b in simhash.block_links(pd.DataFrame({"fp": fps, "home": flags}), 4).itertuples(index=False):
            root[find(a)] = find(b)
    want = brute_components({i: int(p) for i, p in enumerate(points)})
    groups = {}
    for i, p in enumerate(points.view(np.int64)):
        groups.setdefault(find(int(p)), set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(
        sorted(i for i in want if want[i] == r) for r in set(want.values()))


def test_near_duplicates_over_small_blocks(spark, monkeypatch):
    """Shards cut into many blocks give the same links."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 20)
    points = planted(np.random.default_rng(9), 200)
    distinct = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp bigint")
    found = {r.node: r.label for r in components(simhash.links(distinct)).collect()}
    want = brute_components({int(p): int(p) % 2 ** 64 for p in points.view(np.int64)})
    assert {p: found.get(p, p) for p in want} == want


def test_components_of_long_chains(spark):
    n = 300
    order = np.random.default_rng(1).permutation(n)
    pairs = [(int(order[i]), int(order[i + 1])) for i in range(n - 1) if i != 150]
    pairs += [(1000, 1001), (1001, 1000), (2000, 2000), (None, 5), pairs[0]]
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    one, two = set(order[:151].tolist()), set(order[151:].tolist())
    want = {i: min(part) for part in (one, two) for i in part} | {1000: 1000, 1001: 1000, 2000: 2000}
    assert got == want


def test_language_models_are_distributions():
    """Over all characters the chances after any context add up to one."""
    model = language.Models.merged({
        "a": language.fit(["anna", "bann", "nab"], [3, 1, 2]), "b": language.fit(["otto", "tot"], [1, 5])})
    letters = "abnot "
    for before in ("", "a", "ann", "xq", "banna"):
        words = [f"{before}{c}" for c in letters if c != " "]
        _, place, hashes = language.grams(words)
        ends = [sum(len(w) + 2 for w in words[:i]) + len(before) + 1 for i in range(len(words))]
        chance = model.chances(np.array(ends), place, hashes).sum(0)
        _, place, hashes = language.grams([before])
        chance += model.chances(np.array([len(before) + 1]), place, hashes)[0]
        rest = language.ALPHABET - len(letters)
        _, place, hashes = language.grams([before + "z"])
        chance += rest * model.chances(np.array([len(before) + 1]), place, hashes)[0]
        assert chance == pytest.approx([1, 1], abs=1e-6)


def test_automata_merge_what_looks_alike():
    rng = random.Random(3)
    texts = ["id-" + "".join(rng.choice("0123456789") for _ in range(rng.randint(3, 9))) for _ in range(300)]
    model = Automaton.learned(texts)
    assert 3 < len(model.ends) < 40
    total = sum(np.exp(lp) * 1 for lp, _ in model.steps[0].values())
    assert total <= 1.0 + 1e-9
    assert model.log_chance("id-12345") > model.log_chance("12345-id") + 10


@pytest.mark.parametrize("text", ["", "a", "short", "x" * 500, "déjà vu " * 50])
def test_chunks_cover_texts(text):
    (raw, borders), = chunks.cut_batch([text])
    assert borders[0] == 0 and borders[-1] == len(raw)
    assert "".join(raw[s:e].decode() for s, e in itertools.pairwise(borders.tolist())) == text


def test_chunks_resist_insertions():
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(2000))
    (a, one), (b, two) = chunks.cut_batch([text, text[:5000] + "inserted words" + text[5000:]])
    pieces = lambda raw, x: {raw[s:e] for s, e in itertools.pairwise(x.tolist())}
    assert len(pieces(a, one) ^ pieces(b, two)) <= 8
    # The gear sums, one by one.
    data = np.frombuffer(a[:200], np.uint8)
    rolled = chunks.gear(data)
    for i in (0, 5, 40, 199):
        want = sum(int(chunks.GEAR[data[i - k]]) << k for k in range(min(i + 1, chunks.ROLL)))
        assert int(rolled[i]) == want % 2 ** 32


def test_walk_takes_cells_in_order():
    rng = np.random.default_rng(6)
    one, two = rng.random(7), rng.random(9)
    sizes = rng.integers(0, 4, (7, 9))
    cells = multiindex.walk(one, two, sizes, 10 ** 9)
    sums = [one[i] + two[j] for i, j in cells]
    assert sums == sorted(sums) and len(cells) == (sizes > 0).sum()
    some = multiindex.walk(one, two, sizes, 12)
    assert some == cells[:len(some)] and sum(sizes[c] for c in some[:-1]) < 12


def test_automata_keep_the_length_of_a_format():
    rng = random.Random(4)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(120)]
    model = Automaton.learned(hexes[:80])
    assert len(model.ends) == 41
    gain = lambda x: model.log_chance(x) + len(x) * np.log(16)  # over characters at random
    for v in hexes[80:]:
        assert gain(v) > -20
        assert all(gain(x) < gain(v) - 5 for x in (v[:-1], v + "0", v[:20], v + v))
    keys = ["AK" + "".join(rng.choice("XYZ") for _ in range(rng.choice([4, 9]))) for _ in range(200)]
    model = Automaton.learned(keys)
    gain = lambda n: model.log_chance(("AK" + "XYZ" * 4)[:2 + n]) + n * np.log(20)  # one class of 20 letters
    assert min(gain(4), gain(9)) > max(map(gain, (2, 3, 5, 6, 7, 8, 10))) + 5


def test_held_out_credentials_are_recognised(spark, sf_dir):
    """Labelled values hidden from the rules: learned from two thirds, looked for among ordinary tokens."""
    import pyarrow as pa
    from rillwork.llm import credentials
    docs = pa.table({"text": [r.text for r in spark.read.parquet(
        sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").select("text").collect()]})
    found = pa.Table.from_batches(list(credentials.samples(docs.to_batches()))).to_pylist()
    values = {}
    for r in found:
        values.setdefault(r["kind"], []).append(r["value"])
    plain = values.pop("")
    for kind, mine in values.items():
        held = mine[::3]
        model = Automaton.learned([v for v in mine if v not in held])
        background = credentials.Background.learned(plain[::2])
        formats = credentials.Formats([model], [min(map(len, mine))], background, [credentials.LIMITS[1]])
        score = lambda v: formats.ratios(v)[0]
        bound = credentials.limit([score(v) for v in plain[::2]], [score(v) for v in mine if v not in held])
        assert len(model.ends) > 1, kind
        assert sum(score(v) > bound for v in held) >= 0.9 * len(held), kind
        assert sum(score(v) > bound for v in plain[1::2]) <= 0.001 * len(plain), kind


def test_few_ordinary_tokens_do_not_switch_the_method_off(spark):
    from rillwork.llm import credentials
    rng = random.Random(5)
    key = lambda: "zk_" + "".join(rng.choice("0123456789") for _ in range(12))
    rows = [(i, f"token={key()}") for i in range(40)] + [(99, f"x {key()} y")]
    got = credentials.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [s.kind for r in got if r.doc_id == 99 for s in r.spans] == ["format"]


def test_formats_are_learned_from_all_values(spark):
    """States and limits come from every value and token: counts of far more than a sample would hold, whole long
    values, and the same result however the rows are dealt."""
    import math
    import zlib
    from rillwork.llm import credentials
    rng = random.Random(11)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    keys = ["zk_" + pick("0123456789", 12) for _ in range(3000)] + ["X" + pick("XYZ", 300) for _ in range(20)]
    words = [pick("etaoinshrdlu", rng.randint(6, 20)) for _ in range(6000)]
    rows = [(f"token={k} {w}",) for k, w in itertools.zip_longest(keys, words, fillvalue="longer")]
    df = spark.createDataFrame(rows, "text string")
    formats, again = (credentials.train(df.repartition(n)) for n in (3, 7))
    trained = [k for k in [*keys, "longer"] if zlib.crc32(k.encode()) % credentials.HELD]
    model = formats.automata[0]
    assert model == again.automata[0] and formats.limits == again.limits
    assert formats.background == again.background
    start = {c: math.exp(chance) for c, (chance, _) in model.steps[0].items()}
    long = [k for k in trained if k[0] == "X"]
    share = len(long) / len(trained)
    assert long and start == pytest.approx({"g": (1 - share) / 20, "G": share / 20})  # classes of 20 letters
    tokens = spark.createDataFrame([(w,) for w in words], "value string").repartition(5)
    assert credentials.unclaimed(tokens, formats, [math.inf]) == credentials.Background.learned(words)
    gain = lambda x: model.log_chance(x) + len(x) * math.log(20)
    assert gain(long[0]) > gain(long[0][:150]) + 3  # places from DEEP on are one
    ratios = [r[0] for r in map(formats.ratios, keys[:50])]
    codes, s, e = credentials.placed(keys[:50])
    assert formats.ratios_of(codes, s, e)[0] == pytest.approx(ratios)


def test_counts_make_the_tree_of_the_strings():
    """Counted in one piece or in many, and as far as prefixes are common the same states as the tree."""
    from rillwork.llm.automata import classes, count_places, counted_tree
    rng = random.Random(12)
    texts = ["ab-" + "".join(rng.choice("0123456789XYZ") for _ in range(rng.choice([4, 9]))) for _ in range(400)]
    shapes = ["".join(classes(t)) for t in texts]
    common = {s[:i] for s in shapes for i in range(len(s) + 1)}
    rows = lambda counts: [(*k, n) for k, n in counts.items()]
    whole = Automaton.merged(counted_tree(rows(count_places(shapes, common)), common))
    assert whole == Automaton.learned(texts)
    some = {s for s in common if len(s) < 5}
    parts = count_places(shapes[:100], some)
    parts.update(count_places(shapes[100:], some))
    assert Automaton.merged(counted_tree(rows(parts), some)) == Automaton.merged(
        counted_tree(rows(count_places(shapes, some)), some))
    assert sum(parts["", None, n] for n in range(20)) == len(texts)
