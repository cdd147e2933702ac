"""Language identification with character language models.

For each language an interpolated Kneser-Ney model predicts the letters of lower-cased words (runs of
letters, with a word boundary before and after) from up to ``ORDER - 1`` preceding characters of the word.
The models lie in sorted arrays of n-gram hashes with one entry per n-gram and language. A text gets the language with the lowest cross-entropy per character; a calibrated limit rejects
texts that no learned language explains.

Models are fitted on a bounded sample of ``TRAINING`` code points per language: pieces of up to ``PIECE_CHARS``, in the
order of their hashes among all pieces of all labelled texts, until they hold so many. One in ``HELD`` of them
calibrates. So a language's model holds at most TRAINING * ORDER n-grams, and the broadcast grows with the
number of languages only.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rillwork.llm.common import arrow_map, quoted, written

ORDER = 5
PIECE_CHARS, HELD = 4096, 4
TRAINING = 320 * PIECE_CHARS
#: Ranges of hashes that are counted before pieces are put in order.
RANGES = 65_536
#: Equal shares of a character that no model has seen.
ALPHABET = 4096
#: A task's word table starts anew beyond so many words; longer words are not kept.
TABLE_ROWS, KEPT_CHARS = 100_000, 40
#: Rejection: so many standard errors, plus so many nats, above what calibration texts of the language have.
DEVIATIONS, SLACK = 6.0, 1.5
UNKNOWN = "und"

#: Combining marks belong to the letter before them.
MARKS = "".join(c for c in map(chr, range(0x300, 0x12000)) if unicodedata.category(c)[0] == "M")
LETTERS = re.compile(rf"[^\W\d_]+(?:[{re.escape(MARKS)}]+[^\W\d_]*)*")
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def grams(words: list[str]):
    """Hashes of all n-grams that end at a predicted character (letters and the closing boundary).

    Returns (word number, position in the word, hashes by order); the hash of an order is valid where the
    position is at least order - 1.
    """
    codes = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes = [(codes.astype(np.uint64) + np.uint64(1)) * BASE]
    for _ in range(1, ORDER):
        last = hashes[-1]
        longer = np.empty_like(last)
        longer[:1] = 0
        longer[1:] = (last[:-1] ^ (last[:-1] >> np.uint64(29))) * BASE + hashes[0][1:]
        hashes.append(longer)
    return word, place, hashes


def fit(words: list[str], counts: list[int]):
    """Per order: (n-gram hashes, discounted share), (context hashes, share left to the lower order).

    The highest order and n-grams at the start of a word use counts, all others the number of
    different characters that precede them. Arrays are sorted by hash.
    """
    word, place, hashes = grams(words)
    weight = np.asarray(counts, np.float64)[word]
    model = []
    for k in range(1, ORDER + 1):
        ok = place >= max(k - 1, 1)
        gram, at = hashes[k - 1][ok], place[ok]
        context = hashes[k - 2][np.flatnonzero(ok) - 1] if k > 1 else np.zeros(len(gram), np.uint64)
        keys, first, back = np.unique(gram, return_index=True, return_inverse=True)
        raw = np.bincount(back, weight[ok], len(keys))
        if k < ORDER:
            _, one = np.unique(hashes[k][place >= k], return_index=True)
            suffix = hashes[k - 1][place >= k][one]
            before = np.zeros(len(keys))
            where = np.searchsorted(keys, suffix)
            np.add.at(before, where, 1)
            starts = at[first] == k - 1
            amount = np.where(starts | (before == 0), raw, before)
        else:
            amount = raw
        ones, twos = (amount == 1).sum(), (amount == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        contexts, owner = np.unique(context[first], return_inverse=True)
        total = np.bincount(owner, amount, len(contexts))
        taken = np.minimum(amount, discount)
        model.append((keys, (amount - taken) / total[owner], contexts,
                      np.bincount(owner, taken, len(contexts)) / total))
    return model


@dataclass
class Models:
    """Models of all languages, and what calibration has found. Per order a sorted array of the hashes, and for
    each hash one (language, value) entry per language that has it: the size is that of all models together."""

    langs: list[str]
    shares: list[tuple[np.ndarray, ...]]
    rests: list[tuple[np.ndarray, ...]]
    mean: np.ndarray
    spread: np.ndarray
    sharpness: float = 1.0

    @classmethod
    def merged(cls, fitted: dict[str, list]) -> Models:
        langs = sorted(fitted)

        def merge(order, which):
            parts = [fitted[x][order] for x in langs]
            keys = np.concatenate([p[which] for p in parts])
            lang = np.repeat(np.arange(len(langs), dtype=np.uint16), [len(p[which]) for p in parts])
            value = np.concatenate([p[which + 1] for p in parts]).astype(np.float32)
            by = np.argsort(keys, kind="stable")
            distinct, first = np.unique(keys[by], return_index=True)
            return distinct, np.r_[first, len(keys)].astype(np.int64), lang[by], value[by]

        n = len(langs)
        return cls(langs, [merge(k, 0) for k in range(ORDER if n else 0)],
                   [merge(k, 2) for k in range(ORDER if n else 0)], np.zeros(n), np.ones(n))

    def word_costs(self, words: list[str]) -> np.ndarray:
        """Nats of each word (rows) in each language."""
        word, place, hashes = grams(words)
        at = np.flatnonzero(place >= 1)
        # A chance depends on the longest n-gram that fits: each distinct one is worked out once.
        longest = np.choose(np.minimum(place[at], ORDER - 1), [h[at] for h in hashes])
        _, one, back = np.unique(longest, return_index=True, return_inverse=True)
        nats = -np.log(self.chances(at[one], place, hashes))[back]
        starts = np.flatnonzero(np.r_[True, word[at][1:] != word[at][:-1]])
        return np.add.reduceat(nats, starts, axis=0)

    def chances(self, spots: np.ndarray, place: np.ndarray, hashes: list) -> np.ndarray:
        """Chance of the character at each spot, per language, given what precedes it in its word."""
        chance = np.full((len(spots), len(self.langs)), 1.0 / ALPHABET)
        for k in range(1, ORDER + 1):
            at = np.flatnonzero(place[spots] >= k - 1)
            spot = spots[at]
            context = hashes[k - 2][spot - 1] if k > 1 else np.zeros(len(spot), np.uint64)
            known, entry, lang, rest = look_up(self.rests[k - 1], context)
            chance[at[entry], lang] *= rest
            at, spot = at[known], spot[known]
            _, entry, lang, share = look_up(self.shares[k - 1], hashes[k - 1][spot])
            chance[at[entry], lang] += share
        return chance


def look_up(table, keys):
    """Which keys are in a sorted array, and the entries of those: number of the key, language, value."""
    sorted_, first, lang, value = table
    at = np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)
    known = sorted_[at] == keys
    where = np.flatnonzero(known)
    start, size = first[at[where]], first[at[where] + 1] - first[at[where]]
    entries = np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    return known, np.repeat(where, size), lang[entries], value[entries]


class Scorer:
    """Cross-entropies of texts; keeps the costs of the words it has met."""

    def __init__(self, models: Models):
        self.models, self.rows, self.costs = models, {}, np.zeros((0, len(models.langs)))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(characters, cross-entropy per character and language); no letters: zero characters."""
        split = [words_of(t) for t in texts]
        used = set().union(*split)
        new = sorted(used.difference(self.rows))
        if len(self.rows) + len(new) > TABLE_ROWS:
            self.rows, self.costs = {}, self.costs[:0]
            new = sorted(used)
        new.sort(key=lambda w: len(w) > KEPT_CHARS)  # those that are not kept come last
        if new:
            self.rows.update(zip(new, range(len(self.costs), len(self.costs) + len(new))))
            self.costs = np.concatenate([self.costs, self.models.word_costs(new)])
        chars = np.array([sum(map(len, w)) + len(w) for w in split], np.int64)
        total = np.array([self.costs[list(map(self.rows.__getitem__, w))].sum(0) if w
                          else np.zeros(self.costs.shape[1]) for w in split])
        long = [w for w in new if len(w) > KEPT_CHARS]
        for w in long:
            del self.rows[w]
        if long:
            self.costs = self.costs[:-len(long)]
        return chars, total.reshape(len(split), -1) / np.maximum(chars, 1)[:, None]


def judge(models: Models, chars: np.ndarray, entropy: np.ndarray):
    """(language number, cross-entropy, score, rejected). The score is the share of the chosen language
    among exp(-sharpness * cross-entropy) of all."""
    best = entropy.argmin(1)
    low = entropy[np.arange(len(best)), best]
    score = 1 / np.exp(-models.sharpness * (entropy - low[:, None])).sum(1)
    limit = (models.mean[best] + SLACK
             + DEVIATIONS * models.spread[best] / np.sqrt(np.maximum(chars, 1)))
    return best, low, score, (chars == 0) | (low > limit)


# Training ----------------------------------------------------------------------------------------

def training_pieces(docs: DataFrame) -> DataFrame:
    """(lang, piece, held) from labelled (doc_id, lang, text); ``TRAINING`` code points per language.

    Ranges of hashes are counted first, so only the pieces of the ranges that are needed are put in order.
    """
    usable = docs.where("doc_id is not null and lang is not null and length(text) > 0")
    last = F.floor((F.length("text") - 1) / PIECE_CHARS).cast("int")
    order = F.xxhash64("doc_id", "at")
    every = (usable.select("doc_id", "lang", F.length("text").alias("n"),
                           F.explode(F.sequence(F.lit(0), last)).alias("at"))
             .select("doc_id", "lang", "at", order.alias("order"),
                     F.least(F.lit(PIECE_CHARS), F.col("n") - F.col("at") * PIECE_CHARS).alias("chars"))
             .withColumn("range", F.shiftright("order", 48)))
    upto = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counted = every.groupBy("lang", "range").agg(F.sum("chars").alias("chars"))
    needed = counted.withColumn("before", F.coalesce(F.sum("chars").over(upto), F.lit(0))).where(
        F.col("before") < TRAINING).groupBy("lang").agg(F.max("range").alias("top"))  # a row a language
    some = every.join(needed, "lang").where("range <= top")
    by = Window.partitionBy("lang").orderBy("order", "doc_id", "at")
    place = some.dropDuplicates(["lang", "doc_id", "at"]).select(
        "lang", "doc_id", "at", F.row_number().over(by).alias("place"),
        F.coalesce(F.sum("chars").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    chosen = written(place.where(F.col("before") < TRAINING), "pieces")
    text = F.substring("text", F.col("at") * PIECE_CHARS + 1, F.lit(PIECE_CHARS))
    return (usable.join(chosen, ["doc_id", "lang"])
            .select("lang", "doc_id", "at", text.alias("piece"), (F.col("place") % HELD == 0).alias("held"))
            .dropDuplicates(["lang", "doc_id", "at"]).select("lang", "piece", "held"))


def fit_language(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per order with the sorted arrays of a language's model."""
    counts: dict[str, int] = {}
    for piece in rows["piece"]:
        for w in words_of(piece):
            counts[w] = counts.get(w, 0) + 1
    if not counts:
        return pd.DataFrame({"lang": [], "k": [], "arrays": []})
    names = sorted(counts)
    model = fit(names, [counts[w] for w in names])
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "k": range(ORDER),
                         "arrays": [[a.tobytes() for a in arrays] for arrays in model]})


def train(docs: DataFrame) -> Models:
    """Models from the non-null labels of (doc_id, lang, text). Without any the set of languages is empty."""
    pieces = written(training_pieces(docs), "training")
    rows = (pieces.where("not held").groupBy("lang")
            .applyInPandas(fit_language, "lang string, k int, arrays array<binary>")).collect()
    fitted: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["k"])):
        kinds = (np.uint64, np.float64, np.uint64, np.float64)
        fitted.setdefault(r["lang"], []).append(
            [np.frombuffer(bytes(a), t) for a, t in zip(r["arrays"], kinds)])
    models = Models.merged(fitted)
    if models.langs:
        calibrate(models, pieces.where("held").select("lang", "piece").collect())
    return models


def calibrate(models: Models, rows) -> None:
    """Mean and spread of a language's own cross-entropy, and the sharpness with which scores equal
    the accuracy (short texts included: pieces are also judged by their first words)."""
    own = {x: i for i, x in enumerate(models.langs)}
    texts, truth = [], []
    for lang, piece in rows:
        if lang in own:
            for cut in (piece, piece[:400], piece[:60], piece[:20]):
                texts.append(cut)
                truth.append(own[lang])
    chars, entropy = Scorer(models)(texts)
    truth = np.array(truth, np.int64)
    usable = chars > 0
    chars, entropy, truth = chars[usable], entropy[usable], truth[usable]
    mine = entropy[np.arange(len(truth)), truth]
    for i in range(len(models.langs)):
        at = truth == i
        if at.sum() >= 2:
            models.mean[i] = np.average(mine[at], weights=chars[at])
            models.spread[i] = max(1.0, np.sqrt(((mine[at] - models.mean[i]) ** 2 * chars[at]).mean()))
        else:
            models.mean[i] = np.nan
    # A language with too little to calibrate on is judged by the others' mean and spread.
    known = ~np.isnan(models.mean)
    models.spread[~known] = models.spread[known].mean() if known.any() else 1.0
    models.mean[~known] = models.mean[known].mean() if known.any() else np.inf
    if not len(truth):
        return
    goal = ((entropy.argmin(1) == truth).sum() + 1) / (len(truth) + 2)
    low, high = 0.01, 1000.0
    gap = entropy - entropy.min(1)[:, None]
    for _ in range(60):
        middle = (low * high) ** 0.5
        score = (1 / np.exp(-middle * gap).sum(1)).mean()
        low, high = (middle, high) if score < goal else (low, middle)
    models.sharpness = float(low)


# Use -----------------------------------------------------------------------------------------------

def held_out(id_col: Column) -> Column:
    """A third of the documents, by id; never used for training. Null ids are not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def identifier(df: DataFrame, models: Models):
    """Column function: text -> struct<lang, score, entropy, rejected>."""
    shared = df.sparkSession.sparkContext.broadcast(models)
    scorers: list[Scorer] = []
    shape = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()),
                       ("rejected", pa.bool_())])

    def run(texts):
        m = shared.value
        if not m.langs or not texts:
            cols = [[UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts),
                    [True] * len(texts)]
        else:
            if not scorers:
                scorers.append(Scorer(m))
            chars, entropy = scorers[0](texts)
            best, low, score, rejected = judge(m, chars, entropy)
            some = chars > 0
            cols = [[m.langs[b] if ok else UNKNOWN for b, ok in zip(best, some)],
                    np.where(some, score, 0.0), [x if ok else None for x, ok in zip(low, some)],
                    rejected]
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, shape)],
                                          fields=list(shape))

    return arrow_map(run, "lang string, score double, entropy double, rejected boolean")


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             to: str = "language") -> DataFrame:
    """The frame with a struct column (lang, score, entropy, rejected); one of that name is replaced.

    Models are learned from the non-null labels of rows that are not held out. A null text or one without
    a letter is ``und`` with score 0, null entropy, rejected; so is every text if nothing could be learned.
    A language whose pieces are too few to calibrate on is rejected by the others' limits; if no language has
    enough, nothing with a letter is rejected. Ties go to the smaller language name. Whole texts are judged, each word by word.
    """
    labelled = df.select(quoted(id_col).alias("doc_id"), quoted(lang_col).cast("string").alias("lang"),
                         quoted(text_col).alias("text"))
    models = train(labelled.where(~held_out(F.col("doc_id"))))
    return df.withColumn(to, identifier(df, models)(quoted(text_col)))
