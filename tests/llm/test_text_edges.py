"""Awkward rows, empty tables and clashing columns, for every operator."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers_text import DOCS, awkward, brute_components, brute_fingerprint, sha
from rillwork.llm import (chunks, credentials, extract, language, lines, mixing, multiindex, quality,
                          resampling, sentencepieces, simhash, winnowing)
from rillwork.llm.common import least_by_hash, prepared
from rillwork.llm.queries import model_path


@pytest.fixture(scope="module")
def odd(spark):
    return awkward(prepared(spark)).cache()


def per_row(df):
    return {
        "quality": quality.assess(df), "language": language.identify(df),
        "secrets": credentials.scan(df, to="found"), "redacted": credentials.redact(df),
        "lines": lines.dedup_lines(df), "chunks": chunks.drop_repeats(df),
        "ids": sentencepieces.encode_documents(df, model_path()), "text": extract.extract(df, "text", "main"),
        "prints": simhash.near_duplicates(df), "plan": mixing.plan(df),
        "winnowed": winnowing.compare_edited(df), "drawn": resampling.resample(df, df)}


NAMES = ["quality", "language", "secrets", "redacted", "lines", "chunks", "ids", "text", "prints", "plan",
         "winnowed", "drawn"]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows_all_come_back(odd, name):
    got = per_row(odd)[name]
    assert got.count() == odd.count()
    if name not in ("prints", "plan", "winnowed", "drawn"):
        assert set(odd.columns) <= set(got.columns)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_empty_results(spark, name):
    assert per_row(spark.createDataFrame([], DOCS))[name].collect() == []


def test_empty_tables_give_no_pairs(spark):
    none = spark.createDataFrame([], DOCS)
    assert chunks.repeated_spans(none).collect() == []
    assert mixing.mix(none).collect() == [] and simhash.representatives(none).collect() == []
    assert multiindex.neighbours(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), 1
                                 ).collect() == []


def test_quality_of_odd_rows(odd):
    q = {r.doc_id: r.quality for r in quality.assess(odd).collect() if r.doc_id != 6}
    for i in (1, 2, 3):
        assert q[i].n_words == q[i].n_lines == 0 and not q[i].kept and q[i].base_failed
    assert q[5].n_words == 80_000 == q[5].n_repeat_words and q[5].base_failed
    assert q[9].word_chars == 50_000 and q[9].n_repeat_words == 0


def test_quality_rules_one_by_one(spark):
    cases = {"A sentence that ends. And another one.": False, "no end of a sentence here": True,
             "Home | News | Sport | Contact. | About": True, "THE WHOLE LINE SHOUTS AT YOU!": True,
             "odd$$$ words### with%%% marks*** here.": True,
             "Licensed under the Apache License, Version 2.0.": True, "Is it so? Yes": False}
    df = spark.createDataFrame([(t,) for t in cases], "line string")
    got = {r.line: r.f for r in df.select("line", quality.line_fails(F.col("line")).alias("f")).collect()}
    assert got == cases


def test_documents_that_lose_too_much_are_rejected(spark):
    rng = np.random.default_rng(1)
    good = "\n".join(" ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(9)) + "."
                     for _ in range(9))
    bad = "\n".join(f"Menu {i} | Link {i} | Item {i * 3} | More {i * 5} | Last {i * 7}" for i in range(12))
    df = spark.createDataFrame([(1, good), (2, good + "\n" + bad), (3, good + "\nMenu | a | b | c | d")],
                               "doc_id int, text string")
    q = {r.doc_id: r.quality for r in quality.assess(df).collect()}
    assert [q[i].kept for i in (1, 2, 3)] == [True, False, True]
    assert q[3].cleaned == good and q[3].n_failed_lines == 1


def test_language_of_odd_rows(odd):
    got = {r.doc_id: r.language for r in language.identify(odd).collect()}
    for i in (1, 2, 3, 10):
        assert (got[i].lang, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[5].lang in ("en", "de")


def test_sentencepiece_of_odd_rows(odd):
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=model_path())
    coded = sentencepieces.encode_documents(odd, model_path())
    both = sentencepieces.decode_documents(coded, model_path()).collect()
    for r in both:
        assert r.ids == sp.encode(r.text or "") and r.decoded == sp.decode(r.ids)


def test_chunk_table_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(sentencepieces, "TABLE_ROWS", 5)
    with open(model_path(), "rb") as f:
        table = sentencepieces.ChunkTable(f.read())
    texts = ["one two three four", "five six  seven", None, "", "one " + "y" * 100, "▁a b▁▁c ", "\n\n a"]
    for batch in (texts, texts[::-1]):
        got = [np.frombuffer(x, np.int32).tolist() for x in table.lookup(batch)]
        assert got == [table.sp.encode(t or "") for t in batch]
    assert all(len(c) <= sentencepieces.KEPT_CHARS for c in table.ids)


def test_simhash_of_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    want = brute_components({i: brute_fingerprint(t) for i, t in texts.items() if i is not None})
    for r in got:
        assert r.fp % 2 ** 64 == brute_fingerprint(texts[r.doc_id])
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(set(want.values()))


def test_mix_of_odd_rows(odd):
    plan = mixing.plan(odd).collect()
    assert all(r.times == 0 for r in plan if r["size"] == 0) and {r.times for r in plan} <= {0, 1, 2}
    same = {r.times for r in plan if r.doc_id == 6}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and len(same) == 1
    assert mixed.count() == sum(r.times for r in plan)
    total = sum(r["size"] for r in plan)
    assert sum({(r.source, r.target) for r in plan}, ())  # every source has a target
    assert abs(sum(t for _, t in {(r.source, r.target) for r in plan}) - 1.5 * total) < 1e-6


def test_lines_of_odd_rows(spark, odd):
    got = lines.dedup_lines(odd).collect()
    for r in got:
        assert (r.n_lines, r.n_dropped, r.kept) == ((r.text or "").count("\n") + 1, 0, r.text or "")
    line = "This Line is held by many documents"
    rows = [(i, f"own {i}\n  {line.upper() if i % 2 else line}\t\n{line}") for i in range(1, 6)]
    rows += [(5, rows[-1][1]), (None, line), (None, line), (None, line)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for r in got:
        assert r.n_dropped == (0 if r.doc_id in (None, 5) else 2)
        assert r.kept == (r.text if r.doc_id in (None, 5) else f"own {r.doc_id}")


def test_line_index_is_reversible(spark, tmp_path):
    line, other = "a line that several documents hold", "another line that is held by some"
    docs = spark.createDataFrame([(i, f"{line}\n{other if i > 2 else i}") for i in range(1, 6)],
                                 "doc_id bigint, text string")
    index = lines.LineIndex(spark, str(tmp_path / "index"))
    state = lambda: sorted((r.n_docs, r.last_doc) for r in index.counts().collect())
    kept = lambda: {r.doc_id: r.n_dropped for r in index.clean(docs).collect()}
    index.insert(docs.where("doc_id <= 2"))
    assert state() == [(2, 2)] and set(kept().values()) == {0}
    index.insert(docs.where("doc_id > 2"))
    both = state()
    assert both == [(3, 5), (5, 5)] and kept() == {1: 1, 2: 1, 3: 2, 4: 2, 5: 0}
    index.delete(docs.where("doc_id = 5").select("doc_id"))
    assert state() == [(2, 4), (4, 4)] and kept() == {1: 1, 2: 1, 3: 1, 4: 0, 5: 1}
    index.insert(docs)  # only 5 is new again
    assert state() == both and kept() == {1: 1, 2: 1, 3: 2, 4: 2, 5: 0}
    index.delete(docs.select("doc_id"))
    assert state() == [] and set(kept().values()) == {0}


def test_spans_of_planted_passages(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghijklmno"), rng.integers(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(51)
    rows = [(i, f"{text(80)} {passage} {text(40)}" if i < 3 else text(150)) for i in range(6)]
    rows += [(7, None), (None, rows[0][1]), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = chunks.repeated_spans(df).collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 2]
    for r in got:
        at = rows[r.doc_id][1].index(passage)
        assert at - 60 < r.start and r.end < at + len(passage) + 60 and r.end - r.start > 64
        assert r.first_doc == 0 and (r.n_dropped == 0) == (r.doc_id == 0)
    left = {r.doc_id: r.text for r in chunks.drop_repeats(df.where("doc_id < 6")).collect()}
    assert left[0] == rows[0][1] and left[4] == rows[4][1]
    assert passage not in left[1] and left[1].startswith(rows[1][1][:100])


def plain_spans(docs, least=chunks.LEAST_SPAN):
    """Chunks by one sum per byte, and passages by looking every chunk up among all places."""
    places, cut = {}, {}
    for doc, text in docs:
        raw = text.encode()
        padded = chunks.PAD + raw + chunks.PAD
        sums = [sum(int(chunks.GEAR[padded[i - k]]) << k for k in range(min(i + 1, chunks.ROLL))) % 2 ** 32
                for i in range(len(padded))]
        start, borders = len(chunks.PAD), {0, len(raw)}
        for i in range(start - 3, start + len(raw)):
            before, after = sums[max(0, i - chunks.REACH):i], sums[i + 1:i + 1 + chunks.REACH]
            if sums[i] < min(before) and sums[i] <= min(after):
                at = i + 1
                while at < len(padded) and padded[at] & 0xC0 == 0x80:
                    at += 1
                if 0 < at - start < len(raw):
                    borders.add(at - start)
        edges = sorted(borders)
        cut[doc] = [(len(raw[:s].decode()), len(raw[:e].decode()), raw[s:e]) for s, e in zip(edges, edges[1:])]
        for s, _, piece in cut[doc]:
            places.setdefault(piece, []).append((doc, s))
    out = []
    for doc, pieces in cut.items():
        run = []
        for s, e, piece in [*pieces, (None, None, None)]:
            if piece is not None and len(places[piece]) > 1 and (not run or run[-1][1] == s):
                run.append((s, e, min(places[piece])))
                continue
            if run and run[-1][1] - run[0][0] >= least:
                out.append((doc, run[0][0], run[-1][1], len(run), sum(first != (doc, a) for a, _, first in run),
                            min(first[0] for _, _, first in run)))
            run = [(s, e, min(places[piece]))] if piece is not None and len(places[piece]) > 1 else []
    return sorted(out)


def test_spans_equal_plain_version(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 4000 and text <> ''").collect()
    docs = [(r.doc_id, r.text) for r in sorted(given, key=lambda r: r.doc_id)[:150]]
    top = max(i for i, _ in docs)
    docs += [(top + 1, f"{docs[0][1]} {docs[1][1]} {docs[0][1]}"), (top + 2, "déjà vu 日本語 \U0001f600 " * 40),
             (top + 3, docs[3][1][40:] + docs[4][1][:-30])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = [tuple(r) for r in chunks.repeated_spans(df).select(
        "doc_id", "start", "end", "n_chunks", "n_dropped", "first_doc").collect()]
    assert sorted(got) == plain_spans(docs) and len(got) >= 4


def test_passages_that_one_document_repeats(spark):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghijklmno"), rng.integers(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(60)
    twice = f"{text(50)} {passage} {text(50)} {passage} {text(50)}"
    df = spark.createDataFrame([(1, twice), (2, text(200))], "doc_id bigint, text string")
    first, second = chunks.repeated_spans(df).orderBy("start").collect()
    assert (first.doc_id, first.n_dropped, first.first_doc) == (1, 0, 1)
    assert second.n_dropped == second.n_chunks == first.n_chunks
    left = {r.doc_id: r.text for r in chunks.drop_repeats(df).collect()}
    middle = passage[60:-60]
    assert twice.count(middle) == 2 and left[1].count(middle) == 1 and left[1].startswith(twice[:400])


def test_formats_are_inferred(spark):
    rng = np.random.default_rng(5)
    pick = lambda chars, n: "".join(rng.choice(list(chars), n))
    base62 = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = lambda: "zk_" + pick("0123456789", 8) + "-" + pick(base62, 24)
    plain = lambda: pick("etaoinshrdlu", 18)
    rows = [(i, f"text token = '{key()}' and {plain()} {plain()}") for i in range(150)]
    rows += [(1000 + i, f"here {key()} stands, {plain()} too") for i in range(20)]
    rows += [(2000, None), (2001, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in credentials.scan(df).collect()}
    assert got[2000] == got[2001] == []
    for i, t in rows:
        kinds = [s.kind for s in got[i]]
        if i < 1000:
            assert kinds == ["assign"]
        elif i < 2000:
            assert kinds == ["format"] and t[got[i][0].start:got[i][0].end].startswith("zk_")
    hidden = {r.doc_id: r.text for r in credentials.redact(df).collect()}
    assert hidden[1000].startswith("here [secret] stands, ") and "zk_" not in hidden[3]


@pytest.mark.parametrize("n", [20, 150])
def test_formats_are_inferred_among_noisy_labels(spark, n):
    """A few words among the labelled values, and many hidden credentials."""
    rng = np.random.default_rng(6)
    pick = lambda chars, k: "".join(rng.choice(list(chars), k))
    plain = lambda: pick("etaoinshrdlu", 18)
    key = lambda: "zk_" + pick("0123456789", 8) + "-" + pick("abcdefghijkLMNOPQRSTUVWXYZ0123456789", 24)
    rows = [(i, f"text token = '{key()}' and {plain()} {plain()}") for i in range(150)]
    rows += [(500 + i, f"password: {plain()}") for i in range(30)]
    rows += [(1000 + i, f"here {key()} stands, {plain()} too") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: [s.kind for s in r.spans] for r in credentials.scan(df).collect()}
    assert all(got[i] == (["format"] if i >= 1000 else ["assign"]) for i, _ in rows)


def test_formats_are_inferred_in_parts_and_short_ones(spark):
    """Keys of ten characters, behind names, in paths and before a rule's find."""
    rng = np.random.default_rng(8)
    pick = lambda chars, k: "".join(rng.choice(list(chars), k))
    plain = lambda: pick("etaoinshrdlu", int(rng.integers(6, 19)))
    key = lambda: "Q" + pick("XZJ", 2) + pick("0123456789", 7)
    around = {1000: "here {} stands", 2000: "set SOMENAME={} now", 3000: "//some.host/longer/path/{}/edit.html",
              4000: "it is {}.", 5000: "a/{}/" + "0123456789abcdef" * 2}
    rows = [(i, f"text token = '{key()}' and {plain()} {plain()} {plain()}") for i in range(150)]
    rows += [(n + i, f"{plain()} {form.format(key())} {plain()}") for n, form in around.items() for i in range(15)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in credentials.scan(df).collect()}
    for i, t in rows:
        found = [t[s.start:s.end] for s in got[i] if s.kind == "format"]
        assert len(found) == (i >= 1000) and all(len(f) == 10 and f[0] == "Q" for f in found)


def test_parts_are_the_best_ones():
    """The parts beat their limits by as much as the best choice by trying all; the bound is one."""
    from rillwork.llm.automata import Automaton, Background
    rng = np.random.default_rng(9)
    pick = lambda chars, k: "".join(rng.choice(list(chars), k))
    models = [Automaton.learned([pick("0123456789", 6) + "/" + pick("XYZ", 3) for _ in range(60)]),
              Automaton.learned([pick("abcdef", int(rng.integers(6, 9))) for _ in range(60)])]
    plain = Background.learned([pick("etaoinshrdlu", 9) + "/" + pick("XYZ01", 2) for _ in range(99)])
    formats = credentials.Formats(models, [10, 6], plain, [7.0, 8.0])
    gains = formats.gains()
    for _ in range(200):
        token = pick([pick("0123456789", 6), pick("XYZ", 3), pick("abcdef", 7), "/", "/", ".", "noon"], 9)
        cuts = [0, *(i + 1 for i, c in enumerate(token) if c in "=/.")]
        ends = [*(i for i, c in enumerate(token) if c in "=/."), len(token)]
        best = [0.0] * (len(token) + 1)
        for e in range(1, len(token) + 1):
            best[e] = max([best[e - 1]] + [
                best[s] + r - limit for s in cuts if e in ends and s < e
                for r, limit, least in zip(formats.ratios(token[s:e]), formats.limits, formats.least) if e - s >= least])
        got = formats.parts(token, formats.limits)
        over = sum(x * (e - s) - min((limit for r, limit in zip(formats.ratios(token[s:e]), formats.limits)
                                      if abs(r - x * (e - s)) < 1e-6)) for s, e, x in got)
        assert abs(over - best[-1]) < 1e-6
        codes = credentials.codes_of(token)
        assert not got or formats.hopeful(codes, [(0, len(token))], gains)


def test_vectors_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]),
            (6, [inf, 1.0]), (7, [nan, 1.0]), (8, [1.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(1))
    got = multiindex.neighbours(df, every=100).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 1), (0, 9), (0, 2)]
    assert [r.score for r in got] == [0.0, 0.0, 2 ** 0.5]


@pytest.mark.parametrize("kind", ["double", "float", "decimal(38,18)", "int"])
def test_vectors_keep_their_type(spark, kind):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1e-12]), (2, [3.0, 1.0]), (3, [1e-18, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn(
        "embedding", F.col("embedding").cast(f"array<{kind}>"))
    got = [(r.vec_id, r.score) for r in multiindex.neighbours(df, every=100).orderBy("rank").collect()]
    near = {"double": 1e-12, "decimal(38,18)": 1e-12, "float": float(np.float32(1e-12)), "int": 0.0}[kind]
    assert got == [(1, near)] + [(3, 1.0)] * (kind != "int") + [(2, 5 ** 0.5)]


def test_vectors_at_the_ends_of_doubles(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 3e180]), (2, [1e-200, 0.0]), (3, [-1.7e308, 0.0]), (4, [1e200, 1e-200])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r.vec_id, r.score) for r in multiindex.neighbours(df, every=100).orderBy("rank").collect()]
    assert got == [(4, 1e-200), (1, 3e180), (2, 1e200), (3, 1.7e308)]


def test_samples_by_hash_are_the_least_ones(spark):
    df = spark.range(20_000).withColumnRenamed("id", "fp")
    want = [r.fp for r in df.orderBy(F.xxhash64("fp"), "fp").limit(300).collect()]
    assert [r.fp for r in least_by_hash(df, "fp", 300, 20_000).collect()] == want
    assert least_by_hash(df, "fp", 300, 20_000).count() == 300 and least_by_hash(df, "fp", 30_000, 20_000).count() == 20_000


PAGE = """<!DOCTYPE html><html><head><title>x</title><script>var a = "</p>";</script></head>
<body class="has-sidebar"><header><a href="/">Home</a> Site</header>
<div id="nav"><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div>
<div class="cookie-notice">We use cookies. Accept?</div>
<div class="wrapper"><div CLASS><h2>A title &amp; more</h2>
<p>First para with  text,<br>and a <a href="x">link</a>. A second sentence.
<div class="ad-box">Buy this now!</div><p>Short one.<ul><li>Item one.</li><li>Item two</li></ul>
<form><label>Name</label><input></form></div>
<div class="sidebar"><p>Some sidebar text that is rather long and has sentences. Really it has.</p></div>
<section id="comments"><h3>Comments</h3><article class="comment"><p>Nice, I like it. Thanks!</p></article>
</section></div><footer>&copy; 2024 Somebody</footer></body></html>"""
MAIN = ("A title & more\nFirst para with text, and a link. A second sentence.\nShort one.\nItem one.\n"
        "Item two")


@pytest.mark.parametrize("holder", ['class="post-content"', "", 'id="main"'])
def test_main_text(holder):
    assert extract.main_text(PAGE.replace("CLASS", holder)) == MAIN


@pytest.mark.parametrize("holder", [
    '<div id="search"><main>{}</main></div>', '<div class="modal"><article>{}</article></div>',
    '<article class="post related">{}</article>', '<form action="/"><div>{}</div></form>'])
def test_main_text_in_misleading_wrappers(holder):
    inner = ("<p>" + "A sentence of the article, with words. " * 8 + "<div class='ad'>Buy this now!</div>"
             "<p>Another one, that is to stay.")
    page = f"<body><nav><a href=x>Menu</a></nav>{holder.format(inner)}<footer>Imprint.</footer></body>"
    assert extract.main_text(page) == (" ".join(["A sentence of the article, with words."] * 8)
                                       + "\nAnother one, that is to stay.")


def test_comments_longer_than_the_article_stay_away():
    page = ("<body><article><p>A sentence of the article.</article><div id='comments'>"
            + "<p>A long comment, with words. " * 9 + "</div></body>")
    assert extract.main_text(page) == "A sentence of the article."


def test_main_text_of_odd_pages():
    for page in (None, "", "   ", "<", "<!-- ", "<script>x", "<p", "<nav><p>Only a menu. Yes.</nav>"):
        assert extract.main_text(page) == ""
    assert extract.main_text("<article>a &lt;b&gt; &amp c&nbsp;d <i>e</i>f") == "a <b> & c d ef"
    assert extract.main_text("<article><p hidden>no</p><p style='display:none'>no</p><p>yes") == "yes"
    assert len(extract.main_text("<article>" + "<p>Some words here." * 20_000)) == 20_000 * 17 - 1


def test_tokens_digest_of_nothing(odd):
    from rillwork.llm.queries import token_digests
    none = sentencepieces.encode_documents(odd.where("doc_id = 2"), model_path())
    row = none.withColumn("decoded", F.lit("")).select(*token_digests(none)).first()
    assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (0, sha(""), sha(""))


def test_an_index_is_opened_again_and_overwrites_what_a_lost_driver_left(spark, tmp_path, monkeypatch):
    from rillwork.sources import files
    docs = spark.createDataFrame([(i, f"a line that many documents hold\nown line of document {i}") for i in range(4)],
                                 "doc_id bigint, text string")
    folder = str(tmp_path / "index")
    lines.LineIndex(spark, folder).insert(docs)
    again = lines.LineIndex(spark, folder)
    dropped = lambda index: sum(r.n_dropped for r in index.clean(docs).collect())
    assert again.version == 1 and dropped(again) == 3
    with monkeypatch.context() as m:
        m.setattr(files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            again.delete(docs.where("doc_id < 2"))
    third = lines.LineIndex(spark, folder)
    assert third.version == 1 and dropped(third) == 3
    third.delete(docs.where("doc_id < 2"))
    assert dropped(lines.LineIndex(spark, folder)) == 0  # two holders are too few
    with pytest.raises(ValueError):
        lines.LineIndex(spark, folder, least_docs=5)


def test_an_index_gets_more_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 2)
    monkeypatch.setattr(lines, "LEAST_SHARDS", 1)
    made = lambda n, of: spark.createDataFrame(
        [(n * 100 + d, "\n".join(f"a common line of batch {n} number {k}" for k in range(of))) for d in range(3)],
        "doc_id bigint, text string")
    index = lines.LineIndex(spark, str(tmp_path / "i"))
    for n, of in ((0, 2), (1, 3), (2, 20)):
        index.insert(made(n, of))
    assert index.shards > 1
    assert [sum(r.n_dropped for r in index.clean(made(n, of)).collect()) for n, of in ((0, 2), (1, 3), (2, 20))] == [
        4, 6, 40]


def test_rows_with_one_id_lose_their_own_passages_only(spark):
    rng = np.random.default_rng(3)
    text = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n))
    shared, other = text(60), text(120)
    df = spark.createDataFrame([(1, shared + " " + text(20)), (2, text(20) + " " + shared), (2, other)],
                               "doc_id bigint, text string")
    got = {r.text for r in chunks.drop_repeats(df).collect()}
    assert other in got and len(got) == 3 and sum(len(t) for t in got) < sum(len(r.text) for r in df.collect()) - 300


def test_sentences_end_in_many_scripts(spark):
    ends = ["वाक्य है।", "جملہ ہے۔", "هل هذا؟", "Նախադասություն։", "ዓረፍተ ነገር።", "句子。", "ประโยคภาษาไทย", "ending."]
    df = spark.createDataFrame([(e, e.rstrip("।۔؟։።。.") + ",") for e in ends], "good string, bad string")
    rows = df.select(F.col("good").rlike(quality.SENTENCE_END), F.col("bad").rlike(quality.SENTENCE_END)).collect()
    assert [tuple(r) for r in rows] == [(True, False)] * len(ends)


def test_clashing_names_of_users(spark):
    df = spark.createDataFrame([(1, "a line of the user that is long enough", "x", "s")],
                               "doc_id bigint, text string, lang string, source string")
    names = ("__w", "__l", "__symbols", "__doc", "__gone", "__done", "spans", "whole", "own", "its", "cuts", "__times",
             "__turn", "__mix_size", "__want_doc_id")
    for n in names:
        df = df.withColumn(n, F.lit("mine"))
    for got in (quality.assess(df), lines.dedup_lines(df), credentials.redact(df), chunks.drop_repeats(df),
                mixing.mix(df)):
        row = got.first().asDict()
        assert all(row[n] == "mine" for n in names)


def test_words_keep_their_marks_and_tables_stay_small():
    assert language.words_of("हिन्दी भाषा, 12 ทั้งหมด été") == ["हिन्दी", "भाषा", "ทั้งหมด", "été"]
    model = language.fit(["abc", "abd", "xyz"], [3, 2, 1])
    scorer = language.Scorer(language.Models.merged({"a": model, "b": model}))
    long = ["q" * (language.KEPT_CHARS + 1 + i) for i in range(50)]
    first = scorer(["abc " + " ".join(long), "abc"])
    assert len(scorer.rows) == len(scorer.costs) == 1
    again = scorer(["abc " + " ".join(long), "abc"])
    assert np.array_equal(first[1], again[1]) and len(scorer.costs) == 1


def test_a_language_without_calibration_still_rejects():
    fits = {x: language.fit([f"{x}{y}{z}" for y in "abc" for z in "def"], [1] * 9) for x in "pq"}
    models = language.Models.merged(fits)
    language.calibrate(models, [("p", "pad pbe pcf " * 9)] * 3)
    assert np.isfinite(models.mean).all() and models.mean[1] == models.mean[0]
    chars, entropy = language.Scorer(models)(["qad qbe qcf", "ウィキペディア 日本語"])
    assert language.judge(models, chars, entropy)[3].tolist() == [False, True]
