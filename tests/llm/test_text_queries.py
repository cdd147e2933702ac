"""Registered text queries over whole tables: against DuckDB, or against plain versions."""

import functools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, difference
from helpers_text import (WORD, brute_components, brute_fingerprint, brute_lines, brute_targets, sha)
from rillwork.llm import language
from rillwork.llm.queries import ORACLE, QUERIES, model_path


def rows(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return rows(spark, sf_dir, "documents")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_oracle(spark, sf_dir, name):
    assert difference(connect(sf_dir), ORACLE[name], QUERIES[name](spark, sf_dir)) is None


def test_substring_dedup_finds_shared_passages_only(spark, sf_dir, docs):
    text = {r.doc_id: r.text or "" for r in docs}
    found = QUERIES["op2_substring_dedup"](spark, sf_dir).collect()
    spans = defaultdict(list)
    for r in found:
        assert 64 <= r.end - r.start and r.end <= len(text[r.doc_id])
        spans[r.doc_id].append((r.start, r.end))
    # Each found passage starts with 20 characters or more that stand at another place.
    for i, (s, e) in [(i, x) for i, xs in spans.items() for x in xs][:200]:
        part = text[i][s:s + 20]
        assert any(part in t for j, t in text.items() if j != i) or text[i].count(part) > 1
    by_text = defaultdict(list)
    for i, t in text.items():
        by_text[t].append(i)
    for t, same in by_text.items():
        if len(same) > 1 and len(t) >= 64:
            assert all(spans[i] == [(0, len(t))] for i in same)


def test_language_id_by_held_out_accuracy(spark, sf_dir, docs):
    lang = {r.doc_id: r.lang for r in docs}
    found = QUERIES["op3_language_id"](spark, sf_dir).collect()
    assert len(found) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    held = [r.lang_pred == lang[r.doc_id] for r in found if r.held_out and lang[r.doc_id]]
    assert sum(held) >= 0.98 * len(held) > 0


def plain_models(pieces):
    """language -> word -> nats: interpolated Kneser-Ney in dictionaries, built from (lang, piece)."""
    words = defaultdict(Counter)
    for lang, piece in pieces:
        words[lang].update(language.words_of(piece))
    made = {}
    for lang, counts in words.items():
        raw, before = defaultdict(Counter), defaultdict(set)
        for w, times in counts.items():
            s = f" {w} "
            for end in range(1, len(s)):
                for k in range(1, min(language.ORDER, end + 1) + 1):
                    gram = s[end - k + 1:end + 1]
                    raw[k][gram] += times
                    if end >= k:
                        before[gram].add(s[end - k])
        orders = {}
        for k in range(1, language.ORDER + 1):
            # Counts at the start of a word and in the highest order, else the number of preceding characters.
            amount = {g: n if k == language.ORDER or k > 1 and g[0] == " " else len(before[g])
                      for g, n in raw[k].items()}
            ones, twos = (sum(a == x for a in amount.values()) for x in (1, 2))
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total, taken = Counter(), Counter()
            for g, a in amount.items():
                total[g[:-1]] += a
                taken[g[:-1]] += min(a, discount)
            orders[k] = amount, discount, total, taken

        def chance(s, end, orders=orders):
            p = 1 / language.ALPHABET
            for k in range(1, min(language.ORDER, end + 1) + 1):
                amount, discount, total, taken = orders[k]
                gram = s[end - k + 1:end + 1]
                if gram[:-1] in total:
                    a = amount.get(gram, 0)
                    p = (a - min(a, discount) + taken[gram[:-1]] * p) / total[gram[:-1]]
            return p

        made[lang] = functools.cache(lambda w, chance=chance: -sum(
            math.log(chance(f" {w} ", end)) for end in range(1, len(w) + 2)))
    return made


def test_language_id_equals_plain_models(spark, sf_dir, docs):
    """Languages and cross-entropies of all documents, from dictionaries over the same training pieces."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = [r for r in docs if r.lang is not None and r.text
               and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    pieces = language.training_pieces(df.where(~language.held_out(F.col("doc_id")))).collect()
    size = language.PIECE_CHARS
    assert Counter((r.lang, r.piece) for r in pieces) == Counter(
        (r.lang, r.text[i:i + size]) for r in learned for i in range(0, len(r.text), size))
    held = Counter(r.lang for r in pieces if r.held)
    assert held == {x: n // language.HELD for x, n in Counter(r.lang for r in pieces).items()}
    models = plain_models([(r.lang, r.piece) for r in pieces if not r.held])
    found = {r.doc_id: r.language for r in language.identify(df).select("doc_id", "language").collect()}
    query = {r.doc_id: r.lang_pred for r in QUERIES["op3_language_id"](spark, sf_dir).collect()}
    for r in docs:
        split = language.words_of(r.text)
        if not split:
            assert query[r.doc_id] == language.UNKNOWN
            continue
        chars = sum(len(w) + 1 for w in split)
        cost = sorted((sum(map(of, split)) / chars, lang) for lang, of in models.items())
        assert math.isclose(found[r.doc_id].entropy, cost[0][0], rel_tol=1e-5)
        if cost[1][0] - cost[0][0] > 1e-5:
            assert query[r.doc_id] == found[r.doc_id].lang == cost[0][1]


RULES = {"assign": (r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", 2, 6),
         "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]+", 0, 24)}


def test_secret_scan_base(spark, sf_dir, docs):
    found = {r.doc_id: r for r in QUERIES["op4_secret_scan"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for r in docs:
        base = []
        for n, (kind, (pattern, group, least)) in enumerate(RULES.items()):
            base += [(m.start(), n, f"{kind}:{m.start()}:{m.end()}")
                     for m in re.finditer(pattern, r.text or "") if len(m[group]) >= least]
        got = found[r.doc_id]
        assert [got.n_assign, got.n_access, got.n_hex] == [sum(b[1] == n for b in base)
                                                          for n in range(3)]
        spans = [b[2] for b in sorted(base)]
        assert got.base_sha256 == sha(",".join(spans))
        assert [s for s in got.spans.split(",") if s and not s.startswith("format:")] == spans


def test_simhash(spark, sf_dir, docs):
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs}
    want = brute_components(prints)
    found = QUERIES["op6_simhash"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == sorted(
        (i, f"{p:016x}", want[i]) for i, p in prints.items())


def test_sentencepiece(spark, sf_dir, docs):
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=model_path())
    found = {r.doc_id: r for r in QUERIES["op7_sentencepiece"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for r in docs:
        ids = sp.encode(r.text or "")
        got = found[r.doc_id]
        assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))


def check_mix(sizes, got):
    """sizes: (doc_id, source, size); got: rows with doc_id, size, source_size, target, taken."""
    totals = Counter()
    for _, s, n in sizes:
        totals[s] += n
    targets = brute_targets(dict(totals))
    taken, of = Counter(), {i: (s, n) for i, s, n in sizes}
    for r in got:
        s, n = of[r.doc_id]
        assert (r.size, r.source_size) == (n, totals[s]) and r.taken in (0, n, 2 * n)
        assert math.isclose(r.target, targets[s], rel_tol=1e-12)
        taken[s] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(5, 0.05 * t), (s, taken[s], t)


def test_mixing(spark, sf_dir, docs):
    sizes = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs]
    got = QUERIES["op8_mixing"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    check_mix(sizes, got)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        again = QUERIES["op8_mixing"](spark, sf_dir).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(got, key=repr) == sorted(again, key=repr)


def test_html_extraction(spark, sf_dir):
    """The pages' main text stands in <article>."""
    import html
    found = {r.page_id: r for r in QUERIES["op9_html_extraction"](spark, sf_dir).collect()}
    pages = rows(spark, sf_dir, "pages")
    assert len(found) == len(pages)
    for p in pages:
        part = re.search(r"<article>(.*?)(</article>|$)", p.html or "", re.S)
        part = re.sub(r"<br\s*/?>", " ", part[1]) if part else ""
        pieces = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split())
                  for x in re.split(r"</?(?:p|h1|li|ul|div)(?:\s[^>]*)?>", part)]
        want = "\n".join(x for x in pieces if x)
        assert (found[p.page_id].text, found[p.page_id].n_chars) == (want, len(want))


@pytest.mark.parametrize("scale", ["0.001", "0.1"])
def test_neighbours(spark, sf_dir, scale):
    """Recall at two sizes: 500 and 2,000 vectors."""
    sf_dir = sf_dir.replace("0.001", scale)
    vecs = {r.vec_id: np.array(r.embedding, float) for r in rows(spark, sf_dir, "embeddings")}
    found = defaultdict(list)
    for r in QUERIES["op10_ann"](spark, sf_dir).collect():
        found[r.query_id].append(r)
    hits = total = 0
    for q in [i for i in vecs if i % 100 == 0]:
        true = sorted((np.sqrt(((v - vecs[q]) ** 2).sum()), i) for i, v in vecs.items() if i != q)[:10]
        got = sorted(found[q], key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, len(true) + 1))
        assert all(math.isclose(r.score, np.sqrt(((vecs[r.vec_id] - vecs[q]) ** 2).sum()),
                                rel_tol=1e-12) for r in got)
        assert [(r.score, r.vec_id) for r in got] == sorted((r.score, r.vec_id) for r in got)
        hits += len({i for _, i in true} & {r.vec_id for r in got})
        total += len(true)
    assert hits >= 0.9 * total > 0


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    """Each stage over what its predecessor kept, against plain versions."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=model_path())
    before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = before.columns
    kept = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf_dir).write.parquet(str(tmp_path / str(n)))
        after = spark.read.parquet(str(tmp_path / str(n)))
        old, new = before.collect(), after.collect()
        assert n == 4 or after.columns == columns
        if n == 0:
            assert {r.doc_id for r in old} - {r.doc_id for r in new} == {
                r.doc_id for r in old if not any(c.isalpha() for c in r.text or "")}
        if n == 1:
            want = brute_lines([(r.doc_id, r.text) for r in old])
            assert {r.doc_id: r.text for r in new} == {i: w[2] for i, w in want.items()}
        if n == 2:
            groups = brute_components({r.doc_id: brute_fingerprint(r.text) for r in old})
            assert sorted(r.doc_id for r in new) == sorted(set(groups.values()))
        if n == 3:
            times = Counter(r.doc_id for r in new)
            sizes = {r.doc_id: len(WORD.findall(r.text or "")) for r in old}
            totals = Counter()
            for r in old:
                totals[r.source] += sizes[r.doc_id]
            got = Counter()
            for r in new:
                got[r.source] += sizes[r.doc_id]
            assert max(times.values()) <= 2
            for s, t in brute_targets(dict(totals)).items():
                assert abs(got[s] - t) <= max(5, 0.05 * t)
            kept = {r.doc_id: r.text for r in old}
        if n == 4:
            assert sorted(r.doc_id for r in new) == sorted(r.doc_id for r in old)
            for r in new[:100]:
                assert r.ids == sp.encode(kept[r.doc_id]) and r.decoded_sha256 == sha(sp.decode(r.ids))
        before = after
